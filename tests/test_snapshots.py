from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tallyhouse.schemas import TABLES
from tallyhouse.sources import snapshots as snap
from tallyhouse.sources.binding import Tables

from .conftest import rows

DAY = date(2024, 5, 1)


def broken(df):
    return df.withColumn("email", F.raise_error(F.lit("source went away")).cast("string"))


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "staging")


def test_round_trip_of_all_tables(spark, root):
    bound = Tables(spark, "/root/testdata/sf0.001")
    tables = {name: bound[name] for name in TABLES}
    for fmt in ("parquet", "csv"):
        snap.snap_write(tables, root, DAY, fmt)
        for name, df in tables.items():
            staged = snap.snap_as_of(spark, root, name, DAY, fmt).drop("snapshot_date")
            assert staged.columns == df.columns
            assert staged.exceptAll(df).isEmpty() and df.exceptAll(staged).isEmpty(), (fmt, name)
    stats = snap.snap_storage_stats(spark, root).collect()
    assert {r.table_name for r in stats} == set(TABLES) and all(r.csv_bytes > 0 and r.parquet_bytes > 0 for r in stats)


def test_manifest_records_rows_and_commits_last(spark, table, root):
    run = snap.snap_write({"customers": table("customers", {"id": 1}, {"id": 2}), "orders": table("orders", {"id": 1}).limit(0)}, root, DAY)
    manifest = snap.snap_manifest(spark, root)
    assert rows(manifest.where("table_name IS NOT NULL").select("table_name", "status", "rows")) == [("customers", "success", 2), ("orders", "success", 0)]
    commit = snap.snap_commit(manifest).first()
    assert (commit.run_id, commit.tables, commit.rows) == (run, 2, 2)
    nested = snap.snap_runs(manifest).first()
    assert nested.status == "COMPLETE" and [t.table_name for t in nested.tables] == ["customers", "orders"]
    assert nested.source.schema == "ecommerce"


def test_failed_run_is_recorded_and_never_read(spark, table, root):
    first, second = table("customers", {"id": 1}), table("customers", {"id": 1}, {"id": 2})
    orders = table("orders", {"id": 1}, {"id": 2}, {"id": 3})
    snap.snap_write({"orders": orders.limit(1), "customers": first}, root, DAY)
    with pytest.raises(Exception, match="source went away"):
        snap.snap_write({"orders": orders, "customers": broken(second)}, root, DAY, parallel=1)
    with pytest.raises(Exception, match="source went away"):
        snap.snap_write({"orders": orders, "customers": broken(second)}, root, DAY + timedelta(days=1), parallel=1)
    assert spark.read.parquet(f"{root}/parquet/orders").count() == 7  # files are there, nobody reads them
    assert snap.snap_latest(spark, root, "orders").count() == 1
    assert snap.snap_complete(spark, root, "orders").count() == 1
    assert snap.snap_as_of(spark, root, "orders", DAY + timedelta(days=1)).count() == 0
    statuses = rows(snap.snap_manifest(spark, root).where("table_name IS NULL").groupBy("status").count())
    assert statuses == [("COMPLETE", 1), ("FAILED", 2)]


def test_failure_stops_the_tables_after_it(spark, table, root):
    tables = {"customers": broken(table("customers", {"id": 1})), "orders": table("orders", {"id": 1})}
    with pytest.raises(Exception):
        snap.snap_write(tables, root, DAY, parallel=1)
    assert rows(snap.snap_manifest(spark, root).where("table_name IS NOT NULL").select("table_name", "status")) == [("customers", "failed")]


def test_repeated_day_serves_the_newest_run(spark, table, root):
    for n in (1, 2, 3):
        snap.snap_write({"orders": table("orders", *({"id": i} for i in range(n)))}, root, DAY)
    assert snap.snap_as_of(spark, root, "orders", DAY).count() == 3
    assert snap.snap_complete(spark, root, "orders").count() == 3


def test_formats_are_checked(table, root):
    with pytest.raises(ValueError):
        snap.snap_write({"orders": table("orders", {"id": 1})}, root, DAY, "xlsx")


def test_reads_list_only_the_run_they_need(spark, table, root):
    for n in (1, 2):
        run = snap.snap_write({"orders": table("orders", {"id": n})}, root, DAY + timedelta(days=n))
    files = snap.snap_latest(spark, root, "orders").inputFiles()
    assert files and all(f"run_id={run}" in f for f in files)
    assert snap.snap_latest(spark, root, "customers").count() == 0  # never exported


def test_row_counts_against_the_source(spark, table, root):
    orders, customers = table("orders", {"id": 1}, {"id": 2}), table("customers", {"id": 1})
    snap.snap_write({"orders": orders.limit(1), "customers": customers}, root, DAY)
    found = snap.snap_row_recon({"orders": orders, "customers": customers, "payments": table("payments", {"id": 1})}, root, DAY)
    assert rows(found) == [("customers", 1, 1, True, "PASS"), ("orders", 2, 1, False, "FAIL"), ("payments", 1, None, False, "FAIL")]


def test_sample_compares_every_column(table):
    a = table("orders", *({"id": i, "channel": None} for i in range(500)))
    b = table("orders", *({"id": i, "channel": "Store" if i % 2 else None} for i in range(500)))
    found = {r.column_name: r for r in snap.snap_sample_compare(a, b, "id", 256).collect()}
    assert found["channel"].compared == 500 and found["channel"].differing == 250 and found["status"].differing == 0
    part = snap.snap_sample_compare(a, b.where("id < 250"), "id", 64).first()
    assert 0 < part.compared < 125 and part.unpaired > 0


def test_diff(table):
    before = table("orders", {"id": 1}, {"id": 2, "channel": "Store", "shipping_city": None}, {"id": 3}, {"id": 4}, {"id": 4})
    after = table("orders", {"id": 1}, {"id": 2, "channel": None, "shipping_city": "Store"}, {"id": 4}, {"id": 5})
    assert rows(snap.snap_diff(before, after, "id")) == [(1, "unchanged"), (2, "updated"), (3, "deleted"), (4, "updated"), (5, "inserted")]
    assert rows(snap.snap_diff(before, before, "id").select("change").distinct()) == [("unchanged",)]


def test_diff_of_many_copies_of_one_key_does_not_multiply(spark):
    copies = spark.range(30_000).select(F.lit(1).alias("id"), F.col("id").alias("v"))
    assert rows(snap.snap_diff(copies, copies.union(copies.limit(1)), "id")) == [(1, "updated")]
    assert rows(snap.snap_diff(copies, copies.orderBy(F.desc("v")), "id")) == [(1, "unchanged")]


def test_one_table_again_hides_no_other(spark, table, root):
    full = {"customers": table("customers", {"id": 1}), "orders": table("orders", {"id": 1}, {"id": 2}), "payments": table("payments", {"id": 1})}
    snap.snap_write(full, root, DAY)
    snap.snap_write({"customers": table("customers", {"id": 1}, {"id": 2}, {"id": 3})}, root, DAY)
    with pytest.raises(Exception, match="source went away"):
        snap.snap_write({"payments": full["payments"].limit(0), "customers": broken(full["customers"])}, root, DAY, parallel=1)
    for read in (lambda n: snap.snap_as_of(spark, root, n, DAY), lambda n: snap.snap_latest(spark, root, n), lambda n: snap.snap_complete(spark, root, n)):
        assert [read(n).count() for n in ("customers", "orders", "payments")] == [3, 2, 1]
    recon = snap.snap_row_recon(full, root, DAY)
    assert rows(recon.select("table_name", "staging_count")) == [("customers", 3), ("orders", 2), ("payments", 1)]


def test_retention_keeps_the_last_readable_snapshot(spark, table, root):
    for age in (0, 30, 31):
        snap.snap_write({"orders": table("orders", {"id": 1})}, root, DAY - timedelta(days=age))
    for age in (40, 50):
        snap.snap_write({"customers": table("customers", {"id": 1})}, root, DAY - timedelta(days=age))
    expired = snap.snap_retention(snap.snap_manifest(spark, root), DAY)
    assert rows(expired.select("table_name", "age_days")) == [("customers", 50), ("orders", 31)]


def test_readers_take_the_compacted_run(spark, table, root):
    orders = table("orders", *({"id": i} for i in range(200)))
    first = snap.snap_write({"orders": orders.repartition(20)}, root, DAY)
    run = snap.snap_compact(spark, root, "orders", DAY, 8)
    found = snap.snap_latest(spark, root, "orders")
    files = found.inputFiles()
    assert run != first and len(files) == 1 and f"run_id={run}" in files[0]
    assert found.columns[-1] == "snapshot_date" and rows(found.select("snapshot_date").distinct()) == [(DAY,)]
    assert found.drop("snapshot_date").exceptAll(orders).isEmpty() and found.count() == 200


def test_size_against_the_day_before(spark, table, root):
    for n, count in ((0, 1), (1, 5_000)):
        orders = table("orders", *({"id": i, "order_number": str(hash((i, "x")))} for i in range(count)))
        snap.snap_write({"orders": orders, "customers": table("customers", {"id": 1})}, root, DAY + timedelta(days=n))
    change = {r.table_name: r for r in snap.snap_size_change(spark, root, DAY + timedelta(days=1)).collect()}
    assert change["customers"].ratio == 1.0 and change["orders"].ratio > 2
    first = snap.snap_size_change(spark, root, DAY).where("table_name = 'orders'").first()
    assert first.previous_bytes is None and first.ratio is None
