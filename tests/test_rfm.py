from datetime import date
from decimal import Decimal
import random

import pytest

from pyspark.sql import functions as F

from tallyhouse.operators import customer360, rfm

from .conftest import d, rows
from .test_kpis import order

AS_OF = date(2024, 12, 31)


def test_recency_and_frequency_limits(spark):
    days = [(30, 5), (31, 4), (60, 4), (61, 3), (90, 3), (91, 2), (180, 2), (181, 1)]
    scored = spark.createDataFrame([(x,) for x, _ in days], "x INT").select("x", rfm.recency_score(F.col("x")))
    assert [tuple(r) for r in scored.collect()] == days
    counts = [(0, 1), (1, 1), (2, 2), (3, 3), (5, 3), (6, 4), (9, 4), (10, 5)]
    scored = spark.createDataFrame([(x,) for x, _ in counts], "x INT").select("x", rfm.frequency_score(F.col("x")))
    assert [tuple(r) for r in scored.collect()] == counts


def expected_segment(r, f, m):
    rules = [
        ("Champions", r == 5 and f >= 4 and m >= 4),
        ("Loyal", r >= 3 and f >= 3 and m >= 3),
        ("Potential", r >= 4 and f <= 2 and m >= 3),
        ("At Risk", r in (2, 3) and f >= 3 and m >= 3),
        ("Hibernating", r <= 2 and f <= 2),
        ("New", r == 5 and f == 1),
    ]
    return next((name for name, holds in rules if holds), "Other")


def test_every_score_triple_has_its_segment(spark):
    triples = [(r, f, m) for r in range(1, 6) for f in range(1, 6) for m in range(1, 6)]
    df = spark.createDataFrame(triples, "r_score INT, f_score INT, m_score INT")
    found = {(x.r_score, x.f_score, x.m_score): x.rfm_segment for x in rfm.rfm_segment(df).collect()}
    assert found == {t: expected_segment(*t) for t in triples}
    assert sum(s == "Other" for s in found.values()) == 55
    assert found[(2, 3, 3)] == "At Risk" and found[(3, 3, 3)] == "Loyal" and found[(5, 1, 2)] == "New"


def test_base_windows(table):
    o = table(
        "orders",
        order(1, 1, "2023-12-31", "10.00"),  # exactly a year ago: outside the trailing 12 months
        order(2, 1, "2024-01-01", "20.00"),
        order(3, 1, "2024-12-31", "30.00"),
        order(4, 1, "2025-01-01", "99.00"),  # after the reference day
        order(5, 2, "2023-01-01", "5.00"),
        order(6, 3, "2024-06-01", "7.00", status="Cancelled"),
    )
    assert rows(rfm.rfm_base(o, AS_OF)) == [(1, 0, 2, d("60.00")), (2, 730, 0, d("5.00"))]


def interpolated(values, cut):
    values, cut = sorted(values), Decimal(cut)
    spot = (len(values) - 1) * cut
    low = int(spot)
    high = min(low + (spot > low), len(values) - 1)
    return values[low] + (values[high] - values[low]) * (spot - low)


@pytest.mark.parametrize("seed", range(4))
def test_percentiles_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    spread = [lambda: rng.randrange(1000), lambda: rng.randrange(10**13), lambda: rng.choice([5, 5, 5, 10**12]), lambda: rng.randrange(-(10**9), 10**9)][seed]
    values = [Decimal(spread()) / 100 for _ in range(rng.randrange(1, 400))]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "amount DECIMAL(25,2)")
    cuts = ["0.25", "0.50", "0.75", "0.90", "1.00"]
    found = rfm.exact_percentiles(df, "amount", cuts).first()
    assert [found[f"p{i}"] for i in range(5)] == [interpolated(values, c) for c in cuts]


def test_percentiles_keep_every_digit(spark):
    values = [Decimal("0.004"), Decimal("0.009"), Decimal("0.000001")]
    df = spark.createDataFrame([(v,) for v in values], "amount DECIMAL(19,6)")
    found = rfm.exact_percentiles(df, "amount", ["0.5", "0.75", "0.995"]).first()
    assert list(found) == [interpolated(values, c) for c in ("0.5", "0.75", "0.995")]
    many = [Decimal(i) for i in range(1, 1001)]
    df = spark.createDataFrame([(v,) for v in many], "amount DECIMAL(10,0)")
    assert rfm.exact_percentiles(df, "amount", ["0.995"]).first().p0 == Decimal("995.005")


@pytest.mark.parametrize("least, step", [(-(2**63), 2**61), (2**62, 1), (-5, 2**40), (7, 0)])
def test_percentiles_of_any_range(spark, least, step):
    values = [Decimal(least + i * step) for i in range(8)]
    df = spark.createDataFrame([(v,) for v in values], "amount DECIMAL(19,0)")
    assert list(rfm.exact_percentiles(df, "amount", ["0.0", "0.3", "1.0"]).first()) == [interpolated(values, c) for c in ("0.0", "0.3", "1.0")]


def test_percentiles_refuse_what_does_not_fit(spark):
    df = spark.createDataFrame([(Decimal(10) ** 20,)], "amount DECIMAL(38,6)")
    with pytest.raises(Exception, match="(?i)overflow"):
        rfm.exact_percentiles(df, "amount", ["0.5"]).collect()
    with pytest.raises(ValueError):
        rfm.exact_percentiles(df, "amount", ["1.5"])
    with pytest.raises(TypeError):
        rfm.exact_percentiles(spark.range(3), "id", ["0.5"])


def test_percentiles_of_nothing_are_null(spark):
    empty = spark.createDataFrame([], "amount DECIMAL(25,2)")
    assert tuple(rfm.exact_percentiles(empty, "amount", ["0.50"]).first()) == (None,)


def test_monetary_cuts_include_the_boundary(spark):
    base = spark.createDataFrame([(i, 1, 1, Decimal(i)) for i in range(1, 12)], "customer_id INT, recency_days INT, frequency INT, monetary DECIMAL(25,2)")
    scores = {r.customer_id: r.m_score for r in rfm.rfm_score(base).collect()}
    # 11 customers: the 90 % cut is customer 10, 75 % is 8.5, 50 % is 6, 25 % is 3.5.
    assert scores == {1: 1, 2: 1, 3: 1, 4: 2, 5: 2, 6: 3, 7: 3, 8: 3, 9: 4, 10: 5, 11: 5}


def test_customer_360_keeps_customers_without_orders(table):
    customers = table("customers", {"id": 1}, {"id": 2})
    o = table("orders", order(1, 1, "2024-12-01", "10.00", channel="Store"), order(2, 1, "2024-12-02", "10.00", channel="Store", status="Shipped"),
              order(3, 1, "2024-12-03", "30.00", channel="Website"))
    found = {r.customer_id: r for r in customer360.mart_customer_360(customers, o, AS_OF).collect()}
    assert found[1].preferred_channel == "Store" and found[1].channel_count == 2
    assert (found[1].total_spent, found[1].lifetime_value, found[1].recency_days) == (d("50.00"), d("40.00"), 28)
    assert (found[2].order_count, found[2].rfm_segment, found[2].total_spent) == (0, "No purchase", d("0.00"))
    summary = {r.rfm_segment: r for r in customer360.mart_segment_summary(customer360.mart_customer_360(customers, o, AS_OF)).collect()}
    assert summary["No purchase"].avg_order_value is None and sum(r.customers for r in summary.values()) == 2
