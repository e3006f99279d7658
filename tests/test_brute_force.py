"""Operators on random small tables against plain loops."""

import random
from collections import Counter, defaultdict
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest

from tallyhouse.operators import kpis, quality as dq, reconciliation as recon, views, warehouse as wh
from tallyhouse.schemas import ORDER_STATUSES
from tallyhouse.sources import incremental as inc, snapshots as snap

from .conftest import d, rows

SEEDS = range(3)
DAY = date(2024, 1, 1)


def cents(rng, high=50_000):
    return Decimal(rng.randrange(1, high)) / 100


@pytest.mark.parametrize("seed", SEEDS)
def test_history(spark, seed):
    rng = random.Random(seed)
    days = sorted(rng.sample([DAY + timedelta(n) for n in range(30)], 8))
    states = {(k, day): rng.choice(["a", "b", None]) for k in range(25) for day in days if rng.random() < 0.7}
    seen_days = sorted({day for _, day in states})
    expected = []
    for k in range(25):
        open_version = None
        for day in [*seen_days, None]:
            there = (k, day) in states
            if open_version and (day is None or not there or states[(k, day)] != open_version[0]):
                expected.append((k, open_version[0], open_version[1], day))
                open_version = None
            if there and open_version is None:
                open_version = (states[(k, day)], day)
    snapshots = spark.createDataFrame([(k, day, s) for (k, day), s in states.items()], "id INT, snapshot_date DATE, state STRING")
    history = wh.dim_customer_scd2(snapshots, ["state"])
    assert rows(history.select("id", "state", "valid_from", "valid_to"), "id", "valid_from") == sorted(expected, key=lambda v: (v[0], v[2]))


@pytest.mark.parametrize("seed", SEEDS)
def test_merge(spark, seed):
    rng = random.Random(seed)
    schema = "id INT, v INT, updated_at TIMESTAMP_NTZ"
    at = lambda: datetime(2024, 1, 1) + timedelta(minutes=rng.randrange(50))
    base = [(k, rng.randrange(1000), at()) for k in rng.sample(range(60), 40)]
    delta = [(rng.randrange(60), rng.randrange(1000), at()) for _ in range(80)]
    delta = list({(k, when): (k, v, when) for k, v, when in delta}.values())  # one row per key and moment
    expected = {k: (when, v) for k, v, when in base}
    for k, v, when in sorted(delta, key=lambda r: r[2]):
        if k not in expected or when >= expected[k][0]:
            expected[k] = (when, v)
    merged = inc.inc_merge_latest(spark.createDataFrame(base, schema), spark.createDataFrame(delta, schema))
    assert rows(merged.select("id", "v", "updated_at")) == sorted((k, v, when) for k, (when, v) in expected.items())


@pytest.mark.parametrize("seed", SEEDS)
def test_difference_of_snapshots(spark, seed):
    rng = random.Random(seed)

    def table():
        return [(rng.randrange(30), rng.choice(["x", None]), rng.choice([1, None])) for _ in range(40)]

    before, after = table(), table()

    def by_key(found):
        groups = defaultdict(Counter)
        for k, a, b in found:
            groups[k][(a, b)] += 1
        return groups

    left, right = by_key(before), by_key(after)
    expected = []
    for k in sorted(left.keys() | right.keys()):
        change = "inserted" if k not in left else "deleted" if k not in right else "unchanged" if left[k] == right[k] else "updated"
        expected.append((k, change))
    schema = "id INT, a STRING, b INT"
    assert rows(snap.snap_diff(spark.createDataFrame(before, schema), spark.createDataFrame(after, schema), "id")) == expected


def book(rng, table):
    orders = [
        {"id": k, "order_number": f"O{k}", "customer_id": rng.randrange(8), "order_date": DAY + timedelta(rng.randrange(5)),
         "status": rng.choice(ORDER_STATUSES), "channel": rng.choice(["Store", "Website", None]), "total_amount": cents(rng),
         "discount_amount": rng.choice([None, cents(rng, 500)])}
        for k in range(60)
    ]
    for o in orders:
        o.update(subtotal=o["total_amount"] + rng.choice([Decimal(0), Decimal(2)]), tax_amount=rng.choice([None, d("0.50")]))
    payments = [
        {"id": k, "order_id": (o := rng.randrange(70)), "status": rng.choice(["Completed", "Completed", "Failed"]),
         "amount": orders[o]["total_amount"] + rng.choice([Decimal(0), Decimal(1), d("1.01"), d("-1.01")]) if o < 60 else cents(rng)}
        for k in range(70)
    ]
    invoices = [
        {"id": k, "order_id": (o := rng.randrange(62)), "subtotal": orders[o]["subtotal"] + rng.choice([Decimal(0), Decimal(3)]) if o < 60 else cents(rng),
         "tax_amount": orders[o]["tax_amount"] if o < 60 else None, "total_amount": cents(rng)}
        for k in range(40)
    ]
    frames = table("orders", *orders), table("payments", *payments), table("invoices", *invoices)
    return orders, payments, invoices, frames


@pytest.mark.parametrize("seed", SEEDS)
def test_three_way_match(table, seed):
    orders, payments, invoices, frames = book(random.Random(seed), table)
    expected = {}
    for k in {r["id"] for r in orders} | {r["order_id"] for r in payments if r["status"] == "Completed"} | {r["order_id"] for r in invoices}:
        order = next((o for o in orders if o["id"] == k), None)
        paid = [p["amount"] for p in payments if p["order_id"] == k and p["status"] == "Completed"]
        billed = [i["subtotal"] + (i["tax_amount"] or 0) for i in invoices if i["order_id"] == k]
        if order is None:
            expected[k] = "PAYMENT_WITHOUT_ORDER" if paid else "INVOICE_MISMATCH"
        elif not paid:
            expected[k] = "UNPAID"
        elif order["total_amount"] - sum(paid) > 1:
            expected[k] = "UNDERPAID"
        elif sum(paid) - order["total_amount"] > 1:
            expected[k] = "OVERPAID"
        elif order["status"] == "Completed" and not billed:
            expected[k] = "MISSING_INVOICE"
        elif billed and abs(order["subtotal"] + (order["tax_amount"] or 0) - sum(billed)) > 1:
            expected[k] = "INVOICE_MISMATCH"
        else:
            expected[k] = "MATCHED"
    fact = recon.fact_reconciliation(*frames)
    assert {r.order_id: r.match_class for r in fact.collect()} == expected


@pytest.mark.parametrize("seed", SEEDS)
def test_daily_sales_both_ways(table, seed):
    orders, _, _, (frame, _, _) = book(random.Random(seed), table)
    expected = {}
    for o in orders:
        if o["status"] in ("Cancelled", "Refunded"):
            continue
        group = expected.setdefault((o["order_date"], o["channel"]), [set(), set(), Decimal(0), None])
        group[0].add(o["id"])
        group[1].add(o["customer_id"])
        group[2] += o["total_amount"]
        if o["discount_amount"] is not None:
            group[3] = (group[3] or 0) + o["discount_amount"]
    for unique in (False, True):
        found = {(r.order_date, r.channel): r for r in views.view_daily_sales(frame, unique).collect()}
        assert found.keys() == expected.keys()
        for key, (ids, buyers, gross, discount) in expected.items():
            r = found[key]
            assert (r.order_count, r.unique_customers, r.gross_revenue, r.total_discount) == (len(ids), len(buyers), gross, discount)
            assert r.net_revenue == (None if discount is None else gross - discount)


@pytest.mark.parametrize("seed", SEEDS)
def test_references_and_keys(table, seed):
    rng = random.Random(seed)
    parents = [rng.randrange(20) for _ in range(15)]
    children = [{"id": rng.choice([None, *range(12)]), "customer_id": rng.choice([None, *range(25)])} for _ in range(60)]
    tables = {"customers": table("customers", *({"id": p} for p in parents)), "orders": table("orders", *children)}
    wanted = ("orders.id.pk", "orders.customer_id.fk")
    found = {r.rule_id: r.failed for r in dq.dq_run(tables, [r for r in dq.all_rules() if r.rule_id in wanted]).collect()}
    ids = Counter(c["id"] for c in children)
    assert found["orders.id.pk"] == ids.pop(None, 0) + sum(n > 1 for n in ids.values())
    assert found["orders.customer_id.fk"] == sum(c["customer_id"] not in parents for c in children)


@pytest.mark.parametrize("seed", SEEDS)
def test_churn_risk(table, seed):
    orders, _, _, (frame, _, _) = book(random.Random(seed), table)
    as_of = DAY + timedelta(6)
    found = {r.customer_id: r for r in kpis.kpi_churn_risk(table("customers", *({"id": i} for i in range(8))), frame, as_of).collect()}
    for k in range(8):
        bought = sorted(o["order_date"] for o in orders if o["customer_id"] == k and o["status"] not in ("Cancelled", "Refunded"))
        assert found[k].orders == len(bought)
        if len(bought) > 1:
            gaps = [(b - a).days for a, b in zip(bought, bought[1:])]
            assert found[k].mean_gap_days == pytest.approx(sum(gaps) / len(gaps))
