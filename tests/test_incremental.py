from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallyhouse.sources import incremental as inc, versions

from .conftest import rows

OLD, MID, NEW = (datetime(2024, 1, n) for n in (1, 2, 3))


def customers(table, *triples):
    return table("customers", *({"id": i, "segment": s, "updated_at": at} for i, s, at in triples))


def test_extract_is_exclusive_and_pushed_down(table, spark, tmp_path):
    path = str(tmp_path / "c")
    customers(table, (1, "a", OLD), (2, "b", MID), (3, "c", NEW)).write.parquet(path)
    changed = inc.inc_extract(spark.read.parquet(path), MID)
    assert rows(changed.select("id")) == [(3,)]
    assert "GreaterThan(updated_at" in changed._jdf.queryExecution().executedPlan().toString()
    assert inc.inc_high_water(spark.read.parquet(path)).first().high_water == NEW


def test_merge_takes_the_newest_version(table):
    base = customers(table, (1, "keep", MID), (2, "old", OLD), (3, "newer", NEW))
    delta = customers(table, (2, "first", MID), (2, "second", NEW), (3, "stale", MID), (4, "insert", OLD), (4, "insert2", MID))
    merged = inc.inc_merge_latest(base, delta)
    found = rows(merged.select("id", "segment"))
    assert found == [(1, "keep"), (2, "second"), (3, "newer"), (4, "insert2")]
    assert rows(inc.inc_merge_latest(merged, delta).select("id", "segment")) == found


def test_merge_leaves_the_base_unshuffled_for_a_small_delta(table, spark, tmp_path):
    path = str(tmp_path / "base")
    customers(table, *((i, "x", OLD) for i in range(100))).write.parquet(path)
    merged = inc.inc_merge_latest(spark.read.parquet(path), customers(table, (5, "y", NEW)))
    plan = merged._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("BroadcastHashJoin") >= 2 and "SortMergeJoin" not in plan


def test_latest_version_of_a_hot_key(spark):
    df = spark.range(50_000).select(F.lit(1).alias("id"), F.col("id").alias("v"), (F.lit(OLD) + F.make_dt_interval(secs=F.col("id").cast("decimal(18,6)"))).alias("updated_at"))
    assert rows(inc.latest_per_key(df, "id").select("id", "v")) == [(1, 49_999)]


def test_no_version_loses_to_any(table):
    base = customers(table, (1, "old", None), (2, "kept", OLD), (3, "both", None))
    delta = customers(table, (1, "new", OLD), (2, "lost", None), (3, "delta", None), (4, "insert", None))
    expected = [(1, "new"), (2, "kept"), (3, "delta"), (4, "insert")]
    assert rows(inc.inc_merge_latest(base, delta).select("id", "segment")) == expected


def test_large_delta_reads_the_base_once(table, spark, tmp_path):
    path = str(tmp_path / "base")
    customers(table, (1, "old", None), (2, "kept", OLD), (3, "x", MID)).write.parquet(path)
    delta = customers(table, (1, "new", OLD), (2, "lost", None), (4, "insert", None))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = inc.inc_merge_latest(spark.read.parquet(path), delta)
        leaves = merged._jdf.queryExecution().optimizedPlan().collectLeaves()
        scanned = [leaves.apply(i).relation().location().rootPaths().head().toString() for i in range(leaves.size())]
        assert sum(p.endswith("/base") for p in scanned) == 1
        assert rows(merged.select("id", "segment")) == [(1, "new"), (2, "kept"), (3, "x"), (4, "insert")]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


DATED = "id INT, v STRING, updated_at TIMESTAMP_NTZ, day DATE"


def test_merge_adds_a_version_of_touched_dates_only(spark, tmp_path):
    path = str(tmp_path / "fact")
    base = spark.createDataFrame([(1, "a", OLD, OLD.date()), (2, "b", OLD, MID.date()), (3, "c", OLD, MID.date())], DATED)
    first = versions.write_version(base, path, "day")
    before = versions.read_current(spark, path, DATED)
    delta = spark.createDataFrame([(2, "B", NEW, MID.date()), (4, "d", NEW, NEW.date())], DATED)
    for check in (True, False):
        inc.merge_into_dates(spark, path, delta, "day", check_moved=check)
        assert rows(versions.read_current(spark, path, DATED).select("id", "v")) == [(1, "a"), (2, "B"), (3, "c"), (4, "d")]
    assert rows(before.select("id", "v")) == [(1, "a"), (2, "b"), (3, "c")]  # a reader that began earlier is not disturbed
    current = versions.read_current(spark, path, DATED).where(F.col("day") == F.lit(OLD.date())).inputFiles()
    assert all(first in f for f in current if f"day={OLD.date()}" in f)
    assert versions.expired_versions(versions.version_log(spark, path)).count() == 3


@pytest.mark.parametrize("limit", ["10m", "-1"])
def test_merge_keeps_stored_rows_without_date(spark, tmp_path, limit):
    path = str(tmp_path / "fact")
    base = [(1, "a", OLD, None), (2, "b", OLD, None), (3, "newer", NEW, None), (4, "d", OLD, OLD.date())]
    versions.write_version(spark.createDataFrame(base, DATED), path, "day")
    delta = spark.createDataFrame([(2, "B", MID, None), (3, "older", MID, None), (5, "e", MID, None)], DATED)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        for check in (True, False):
            inc.merge_into_dates(spark, path, delta, "day", check_moved=check)
            assert rows(versions.read_current(spark, path, DATED).select("id", "v")) == [(1, "a"), (2, "B"), (3, "newer"), (4, "d"), (5, "e")]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_failed_write_leaves_the_table_as_it_was(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.write_version(spark.createDataFrame([(1, "a", OLD, OLD.date())], DATED), path)
    bad = spark.createDataFrame([(2, "b", OLD, OLD.date())], DATED).withColumn("v", F.raise_error(F.lit("gone")).cast("string"))
    with pytest.raises(Exception, match="gone"):
        versions.write_version(bad, path)
    assert rows(versions.read_current(spark, path, DATED).select("id")) == [(1,)]
    assert versions.read_current(spark, str(tmp_path / "none"), DATED).count() == 0


def test_merge_refuses_a_moved_key(spark, tmp_path):
    path = str(tmp_path / "fact")
    versions.write_version(spark.createDataFrame([(1, "a", OLD, OLD.date())], DATED), path, "day")
    with pytest.raises(ValueError, match="day"):
        inc.merge_into_dates(spark, path, spark.createDataFrame([(1, "b", NEW, NEW.date())], DATED), "day")
    assert rows(versions.read_current(spark, path, DATED).select("id", "v")) == [(1, "a")]


def test_touch_marks_changed_rows_only(table):
    stored = customers(table, (1, "same", OLD), (2, "old", OLD))
    incoming = customers(table, (1, "same", MID), (2, "new", MID), (3, "insert", MID))
    found = rows(inc.util_touch_updated_at(stored, incoming, NEW).select("id", "updated_at"))
    assert found == [(1, OLD), (2, NEW), (3, MID)]
