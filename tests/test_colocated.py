"""Tables stored side by side: same results, and no row moves."""

import random
import uuid
from datetime import date
from decimal import Decimal

import pytest

from tallyhouse.operators import reconciliation as recon, warehouse as wh
from tallyhouse.sources import colocated

from .conftest import rows


@pytest.fixture(scope="module")
def tables(spark, table, tmp_path_factory):
    draw = random.Random(4)
    orders = table("orders", *({"id": i, "order_date": date(2024, 1, 1), "status": draw.choice(("Completed", "Pending")), "total_amount": 10, "subtotal": 9, "tax_amount": 1} for i in range(60)))
    keys = [*range(70), None]  # some of no order
    payments = table("payments", *({"id": i, "order_id": draw.choice(keys), "amount": Decimal(draw.choice((5, 10))), "status": draw.choice(("Completed", "Failed"))} for i in range(90)))
    invoices = table("invoices", *({"id": i, "order_id": draw.choice(keys), "subtotal": 9, "tax_amount": draw.choice((1, 4))} for i in range(50)))
    items = table("order_items", *({"id": i, "order_id": draw.choice(keys), "product_id": 1} for i in range(50)))
    given = {"orders": orders, "payments": payments, "invoices": invoices, "order_items": items}
    stored = colocated.colocate(given, f"side_{uuid.uuid4().hex}", str(tmp_path_factory.mktemp("side") / "t"), 4)
    return given, stored


def unmoved(spark, build):
    """The result, made with joins by shuffle and sort only."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = build()
        return df._jdf.queryExecution().executedPlan().toString(), rows(df)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_reconciliation_without_shuffle(spark, tables):
    given, stored = tables
    plan, found = unmoved(spark, lambda: recon.fact_reconciliation(stored["orders"], stored["payments"], stored["invoices"], colocated=True))
    assert "Exchange" not in plan and "SortMergeJoin" in plan
    key = lambda r: tuple(str(x) for x in r)
    plain = rows(recon.fact_reconciliation(given["orders"], given["payments"], given["invoices"]))
    # Rows without order key are one group in sums of both, and of each, table.
    assert sorted((r for r in found if r[0] is not None), key=key) == sorted((r for r in plain if r[0] is not None), key=key)


def test_balance_without_shuffle(spark, tables):
    given, stored = tables
    plan, found = unmoved(spark, lambda: recon.recon_order_payment(stored["orders"], stored["payments"]))
    assert "Exchange" not in plan
    assert found == rows(recon.recon_order_payment(given["orders"], given["payments"]))


def test_order_lines_meet_their_orders_in_place(spark, table, tables):
    _, stored = tables
    products = table("products", {"id": 1})
    plan, _ = unmoved(spark, lambda: wh.fact_orderline(stored["order_items"], stored["orders"], products))
    assert plan.count("Exchange") == 2 and "hashpartitioning(order_id" not in plan  # those of the product join


def test_bucket_counts():
    assert [colocated.buckets_for(n) for n in (0, 40_000_000, 41_000_000, 10**12)] == [8, 8, 16, 262_144]
