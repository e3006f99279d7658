"""All grains out of one scan, and distinct customers from bitmaps, against plain groupings."""

import random
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import kpis, reconciliation as recon
from tallyhouse.operators.relational import revenue_orders

from .conftest import rows

START = date(2024, 2, 20)


@pytest.fixture(scope="module")
def orders(table):
    draw = random.Random(3)
    return table(
        "orders",
        *(
            {
                "id": i, "customer_id": draw.choice((0, 1, 32767, 32768, 40_000, 10**9, None, draw.randrange(50))), "channel": draw.choice((None, "Store", "Website")),
                "status": draw.choice(("Completed", "Cancelled", "Pending")), "order_date": draw.choice((None, START + timedelta(days=draw.randrange(40)))),
                "total_amount": draw.choice((None, Decimal(draw.randrange(9999)) / 100)),
            }
            for i in range(300)
        ),
    )


def plain(orders, grain, channel, *figures):
    period = F.lit(None).cast("date") if grain == "all" else F.col("order_date") if grain == "day" else F.trunc("order_date", grain)
    keys = [period.alias("period"), *([F.col("channel")] if channel else [])]
    return revenue_orders(orders).groupBy(*keys).agg(*figures)


@pytest.mark.parametrize("grain", kpis.GRAINS)
def test_revenue_of_every_grain(orders, grain):
    found = kpis.kpi_revenue_grains(orders).where(F.col("grain") == grain)
    figures = (F.count("*").alias("orders"), F.sum("total_amount").alias("revenue"))
    assert rows(found.where("total_channel").select("period", "orders", "revenue")) == rows(plain(orders, grain, False, *figures))
    assert rows(found.where("NOT total_channel").select("period", "channel", "orders", "revenue")) == rows(plain(orders, grain, True, *figures))


def test_distinct_customers_add_up(orders):
    halves = [kpis.customer_bitmaps(orders.where(F.col("id") % 2 == k)) for k in (0, 1)]
    found = kpis.kpi_unique_customers(kpis.united_bitmaps(*halves))
    for grain in kpis.GRAINS:
        expected = plain(orders.where("customer_id IS NOT NULL"), grain, False, F.count_distinct("customer_id").alias("unique_customers"))
        assert rows(found.where(F.col("grain") == grain).select("period", "unique_customers")) == rows(expected)


def test_one_scan(spark, orders, tmp_path):
    path = str(tmp_path / "orders")
    orders.write.parquet(path)
    stored = spark.read.parquet(path)
    for df in (kpis.kpi_revenue_grains(stored), kpis.kpi_unique_customers(kpis.customer_bitmaps(stored)), kpis.kpi_revenue_by_periods(stored)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 1 and plan.count("Exchange") <= 3


def test_system_totals_of_two_grains(table):
    day = date(2024, 1, 31)
    orders = table("orders", {"id": 1, "order_date": day, "total_amount": 5}, {"id": 2, "order_date": day + timedelta(days=1), "total_amount": 7})
    payments = table("payments", {"id": 1, "payment_date": day, "amount": 5, "status": "Completed"}, {"id": 2, "payment_date": None, "amount": 1, "status": "Completed"})
    invoices = table("invoices", {"id": 1, "invoice_date": day, "total_amount": 4})
    found = recon.recon_system_totals_by(orders, payments, invoices, ("day", "month")).select("grain", "period", "orders", "payments", "invoices")
    assert rows(found) == [
        ("day", None, 0, 1, 0), ("day", day, 1, 1, 1), ("day", date(2024, 2, 1), 1, 0, 0),
        ("month", None, 0, 1, 0), ("month", date(2024, 1, 1), 1, 1, 1), ("month", date(2024, 2, 1), 1, 0, 0),
    ]
