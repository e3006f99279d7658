import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import warehouse as wh

from .conftest import d, rows


def test_calendar(spark):
    days = {r.date: r for r in wh.dim_date(spark, date(2024, 1, 1), date(2024, 12, 31)).collect()}
    assert len(days) == 366
    leap = days[date(2024, 2, 29)]
    assert (leap.date_key, leap.quarter, leap.iso_weekday, leap.is_weekend, leap.accounting_period) == (20240229, 1, 4, False, "2024-02")
    assert days[date(2024, 1, 6)].is_weekend


def test_calendar_of_a_column_has_no_gaps(table):
    o = table("orders", {"id": 1, "order_date": date(2024, 1, 30)}, {"id": 2, "order_date": date(2024, 2, 2)})
    assert wh.dim_date_of(o, "order_date").count() == 4


def test_surrogate_keys_agree_between_dimension_and_fact(table):
    products = table("products", {"id": 1, "sku": "A", "cost_price": d("2.00")}, {"id": 2, "sku": "B", "cost_price": None})
    categories = table("categories", {"id": 1, "name": "c"})
    orders = table("orders", {"id": 1, "channel": None}, {"id": 2, "channel": "Store"})
    items = table("order_items", {"id": 1, "order_id": 1, "product_id": 1, "quantity": 3, "unit_price": d("9.99"), "discount_percent": d("10.00"), "line_total": d("26.97")},
                  {"id": 2, "order_id": 2, "product_id": 2, "quantity": 1, "discount_percent": None})
    fact = wh.fact_orderline(items, orders, products)
    keys = wh.dim_product(products, categories).select("product_key", "sku")
    assert fact.join(keys, "product_key").count() == 2
    assert fact.join(wh.dim_channel(orders), "channel_key").count() == 2
    assert fact.join(wh.dim_customer(table("customers", {"id": 1})), "customer_key").count() == 2
    first, second = fact.orderBy("order_item_id").collect()
    assert (first.recomputed_total, first.cost_amount, first.margin_amount) == (d("26.97"), d("6.00"), d("20.97"))
    assert second.cost_amount is None and second.recomputed_total == d("1.00")


def test_lines_without_order_or_product_stay_and_join_the_unknown_members(table):
    products, categories = table("products", {"id": 1, "cost_price": d("2.00")}), table("categories", {"id": 1})
    orders, customers = table("orders", {"id": 1, "channel": "Store"}), table("customers", {"id": 1})
    items = table("order_items", {"id": 1, "order_id": 1, "product_id": 1}, {"id": 2, "order_id": 99, "product_id": 1}, {"id": 3, "order_id": 1, "product_id": 77}, {"id": 4, "order_id": 1, "product_id": None})
    fact = wh.fact_orderline(items, orders, products)
    assert rows(fact.select("order_item_id", "order_status")) == [(1, "x"), (2, None), (3, "x"), (4, "x")]
    dims = {"customer": wh.dim_customer(customers), "product": wh.dim_product(products, categories), "channel": wh.dim_channel(orders)}
    found = {r.dimension: tuple(r)[2:] for r in wh.fact_dim_integrity({"line": fact}, dims).collect()}
    assert found == {"customer": (4, 1, 0, 0), "product": (4, 1, 1, 0), "channel": (4, 0, 0, 0)}
    twice = {"customer": dims["customer"].unionByName(dims["customer"].limit(1))}
    assert wh.fact_dim_integrity({"line": fact}, twice).first().repeated_keys == 1


def test_no_key_is_made_of_null(spark):
    df = spark.createDataFrame([(1,), (None,)], "id INT").select("id", wh.id_key("id").alias("k"))
    assert [r.k == wh.UNKNOWN_KEY for r in df.orderBy("id").collect()] == [True, False]


def test_applied_days_equal_a_rebuild(spark):
    draw = random.Random(7)
    days = [date(2024, 1, n) for n in range(1, 8)]
    seen = [(k, day, draw.choice(("a", "b", None))) for day in days for k in range(25) if draw.random() < 0.7]
    seen += [(1, days[2], "a"), (1, days[2], "b")]  # copies within a day
    snapshots = spark.createDataFrame(seen, "id INT, snapshot_date DATE, state STRING")
    columns = ("version_key", "id", "state", "valid_from", "valid_to", "is_current")
    history = wh.dim_customer_scd2(snapshots.where(F.col("snapshot_date") == F.lit(days[0])), ["state"])
    for day in days[1:]:
        history = wh.scd2_apply(history, snapshots.where(F.col("snapshot_date") == F.lit(day)).drop("snapshot_date"), day, ["state"])
        history = spark.createDataFrame(history.collect(), history.schema)
    assert rows(history.select(*columns)) == rows(wh.dim_customer_scd2(snapshots, ["state"]).select(*columns))


def test_facts_carry_date_rules(table):
    orders = table("orders", {"id": 1, "order_date": date(2024, 1, 30), "customer_id": 7})
    payments = table("payments", {"id": 1, "order_id": 1, "payment_date": date(2024, 2, 1)}, {"id": 2, "order_id": 9, "payment_date": date(2024, 2, 1)})
    found = rows(wh.fact_payment(payments, orders).select("payment_id", "customer_id", "days_to_pay", "has_order"))
    assert found == [(1, 7, 2, True), (2, None, None, False)]
    invoices = table("invoices", {"id": 1, "order_id": 1, "invoice_date": date(2024, 2, 1)})
    inv = wh.fact_invoice(invoices, orders).first()
    assert (inv.due_date, inv.accounting_period, inv.days_to_invoice) == (date(2024, 3, 2), "2024-02", 2)


@pytest.fixture
def history(spark):
    days = [date(2024, 1, n) for n in (1, 2, 3, 4)]
    seen = [
        (1, days[0], "New"), (1, days[1], "New"), (1, days[2], "VIP"), (1, days[3], "VIP"),
        (2, days[0], "New"), (2, days[2], "New"), (2, days[3], "New"),  # away on the second day
        (3, days[1], None), (3, days[2], "New"),  # gone on the fourth
        (1, days[0], "New"),  # a copy
    ]
    return wh.dim_customer_scd2(spark.createDataFrame(seen, "id INT, snapshot_date DATE, segment STRING"), ["segment"])


def test_history_versions(history):
    found = rows(history.select("id", "segment", "valid_from", "valid_to", "is_current"), "id", "valid_from")
    day = lambda n: date(2024, 1, n)
    assert found == [
        (1, "New", day(1), day(3), False), (1, "VIP", day(3), None, True),
        (2, "New", day(1), day(2), False), (2, "New", day(3), None, True),
        (3, None, day(2), day(3), False), (3, "New", day(3), day(4), False),
    ]


def test_fact_finds_the_version_of_its_day(spark, history):
    facts = spark.createDataFrame([(1, 1, date(2024, 1, 2)), (2, 1, date(2024, 1, 3)), (3, 2, date(2024, 1, 2)), (4, 1, date(2023, 1, 1))], "fact INT, customer INT, day DATE")
    found = wh.jn_scd2_lookup(facts, history, "customer", "day").select("fact", "segment")
    assert rows(found) == [(1, "New"), (2, "VIP"), (3, None), (4, None)]


def test_codes_are_gap_free_and_ordered(spark):
    df = spark.range(0, 5000, numPartitions=7).select(F.col("id"), F.pmod(F.col("id") * 37, F.lit(101)).alias("day"))
    coded = wh.util_code_sequence(df, "ORD", 2024, ["day", "id"], start=11)
    found = coded.orderBy("day", "id").collect()
    assert [r.code for r in found] == [f"ORD-2024-{n:06d}" for n in range(11, 5011)]


def test_codes_grow_past_six_digits(spark):
    coded = wh.util_code_sequence(spark.range(2).select("id"), "INV", 2024, ["id"], start=999_999)
    assert [r.code for r in coded.orderBy("id").collect()] == ["INV-2024-999999", "INV-2024-1000000"]


def test_sweep_equals_the_join_with_a_hot_key(spark):
    """A third of all facts on one key of 1,000 versions; keys and days that are missing; versions that end."""
    draw = random.Random(9)
    day = lambda k: date(2020, 1, 1) + timedelta(days=k)
    versions = [(1, f"s{k}", day(k), day(k + 1) if k < 999 else None) for k in range(1000)]
    for key in range(2, 40):
        at = 0
        for k in range(draw.randrange(6)):
            at += draw.randrange(1, 200)
            end = at + draw.randrange(1, 200)
            versions.append((key, f"k{k}", day(at), day(end) if draw.random() < 0.8 else None))
            at = end
            if versions[-1][3] is None:
                break
    versions.append((None, "none", day(0), None))
    facts = [(i, draw.choice((1, None, *range(2, 50))) if i % 3 else 1, draw.choice((None, day(draw.randrange(-20, 1300))))) for i in range(3000)]
    history = spark.createDataFrame(versions, "id INT, segment STRING, valid_from DATE, valid_to DATE")
    table = spark.createDataFrame(facts, "fact INT, customer INT, day DATE").repartition(3)
    plain = wh.jn_scd2_lookup(table, history, "customer", "day")
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        swept = wh.jn_scd2_sweep(table, history, "customer", "day")
        found = rows(swept.select(*plain.columns), "fact")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert found == rows(plain, "fact") and len(found) == 3000
