"""Column sketches against exact figures, and the gate that reads them."""

import random
from collections import Counter
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import sketches

SCHEMA = "n DOUBLE, k BIGINT, d DATE, t STRING, flag BOOLEAN, empty STRING"


def made(spark, draw, n, mean=0.0, weights=(5, 3, 1), nulls=0.1):
    day = date(2024, 1, 1)
    return spark.createDataFrame(
        [
            (draw.gauss(mean, 1), draw.randrange(10**12), day + timedelta(days=draw.randrange(300)), None if draw.random() < nulls else draw.choices("abc", weights)[0], draw.random() < 0.5, None)
            for _ in range(n)
        ],
        SCHEMA,
    ).repartition(5)


@pytest.fixture(scope="module")
def pair(spark):
    draw = random.Random(3)
    before, after = made(spark, draw, 20_000), made(spark, draw, 15_000, 0.5, (1, 3, 5), 0.3)
    return before, after, *(sketches.column_sketches(df, "x") for df in (before, after))


def test_estimates_are_within_the_bound(pair):
    before, _, kept, _ = pair
    found = {r.column_name: r for r in sketches.estimates(kept).collect()}
    values = sorted(r.n for r in before.select("n").collect())
    for share, value in zip((0.25, 0.5, 0.75), found["n"].quantiles, strict=True):
        rank = sum(v <= value for v in values) / len(values)
        assert abs(rank - share) <= sketches.RANK_ERROR
    counts = Counter(r.t for r in before.select("t").collect())
    assert found["t"].nulls == counts.pop(None) and found["t"].most_frequent == dict(counts)
    assert found["t"].distinct_values == 3 and abs(found["k"].distinct_values / 20_000 - 1) < 0.05
    assert found["empty"].nulls == 20_000 and found["empty"].most_frequent is None


def test_sketches_of_parts_add_up(pair):
    before, _, kept, _ = pair
    parts = [sketches.column_sketches(before.where(F.col("k") % 3 == i), "x") for i in range(3)]
    whole = sketches.merged(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    assert [r.status for r in sketches.column_drift(kept, whole).collect()] == ["PASS"] * 6
    a, b = ({r.column_name: r for r in sketches.estimates(x).collect()} for x in (kept, whole))
    assert a["t"] == b["t"] and (a["n"].rows, a["n"].nulls) == (b["n"].rows, b["n"].nulls)
    assert all(r.shift < 3 * sketches.RANK_ERROR for r in sketches.column_drift(kept, whole).collect())


def test_drift_is_near_the_exact_distance(pair):
    before, after, old, new = pair
    found = {r.column_name: r for r in sketches.column_drift(old, new).collect()}
    a, b = (sorted(r.n for r in df.select("n").collect()) for df in (before, after))
    exact = 0.0
    for x in a[::50] + b[::50]:
        exact = max(exact, abs(sum(v <= x for v in a) / len(a) - sum(v <= x for v in b) / len(b)))
    assert abs(found["n"].shift - exact) <= 2 * sketches.RANK_ERROR + 0.01
    shares = [Counter(r.t for r in df.where("t IS NOT NULL").select("t").collect()) for df in (before, after)]
    distance = sum(abs(shares[0][t] / shares[0].total() - shares[1][t] / shares[1].total()) for t in "abc") / 2
    assert found["t"].shift == pytest.approx(distance)
    assert {c for c, r in found.items() if r.status == "WARN"} == {"n", "t"}
    assert found["k"].shift < 0.03 and found["flag"].shift < 0.03 and found["empty"].shift == 0


def test_columns_that_come_go_or_change(spark, pair):
    before, _, old, _ = pair
    other = before.select("k", "d", F.col("n").cast("string").alias("n"), F.lit(None).cast("string").alias("t"), F.lit(1).alias("more"))
    found = {r.column_name: (r.shift, r.status) for r in sketches.column_drift(old, sketches.column_sketches(other, "x")).collect()}
    assert found["k"][0] < 0.02 and found["k"][1] == "PASS" and found["t"] == (1.0, "WARN")
    assert {c for c, (shift, _) in found.items() if shift is None} == {"n", "flag", "empty", "more"}
    none = sketches.column_sketches(before.limit(0), "x")
    assert sketches.column_drift(none, none).where("status <> 'PASS'").isEmpty()


def test_kept_sketches(spark, pair, tmp_path):
    sketches.keep_sketches(str(tmp_path), "run-1", pair[2])
    kept = sketches.kept_sketches(spark, str(tmp_path), "run-1")
    drift = sketches.column_drift(kept, pair[3])
    assert "n" in {r.column_name for r in drift.where("status = 'WARN'").collect()}
