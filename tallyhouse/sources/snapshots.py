"""Daily snapshots of the source tables, with a run manifest.

Layout: ``<root>/<format>/<table>/snapshot_date=YYYY-MM-DD/run_id=…``, so both
are partition columns. A run never touches the files of another one; readers take
each table of a day from the newest COMPLETE run that exported it, so neither a
failed repeat nor one of a single table hides what lies there. The manifest has a row per table and a row per run
(without table name); they are written together, after the last table.
"""

from __future__ import annotations

import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ..schemas import TABLES
from .sinks import snk_parquet, write_as
from .tables import csv_reader, src_row_count

PIPELINE = "source_to_staging"
RETENTION_DAYS = 30

MANIFEST_SCHEMA = """run_id STRING, pipeline STRING, snapshot_date DATE, run_timestamp TIMESTAMP_NTZ,
    output_format STRING, source STRUCT<host: STRING, database: STRING, schema: STRING>, table_name STRING,
    status STRING, rows BIGINT, path STRING, duration_seconds DOUBLE, error STRING"""


def _manifest_path(root: str) -> str:
    return f"{root}/manifest"


def snap_manifest(spark: SparkSession, root: str) -> DataFrame:
    # Each run writes a folder of its own, so that runs at the same time share no file.
    return spark.read.schema(MANIFEST_SCHEMA).option("recursiveFileLookup", "true").parquet(_manifest_path(root))


def snap_runs(manifest: DataFrame) -> DataFrame:
    """The manifest with one nested row per run."""
    tables = manifest.where("table_name IS NOT NULL").groupBy("run_id").agg(
        F.sort_array(
            F.collect_list(F.struct("table_name", "status", "rows", "path", "duration_seconds", "error"))
        ).alias("tables")
    )
    runs = manifest.where("table_name IS NULL").drop("table_name", "rows", "path")
    return runs.join(tables, "run_id", "left")


def _export(df: DataFrame, path: str, fmt: str) -> int:
    """Write a table and return its rows, counted while writing."""
    written = Observation()
    write_as(df.observe(written, F.count(F.lit(1)).alias("rows")), path, fmt)
    return written.get["rows"]


def snap_write(
    tables: dict[str, DataFrame],
    root: str,
    snapshot_date: date | None = None,
    fmt: str = "parquet",
    run_timestamp: datetime | None = None,
    source: dict[str, str] | None = None,
    parallel: int = 4,
) -> str:
    """Export tables as one snapshot; returns the run id.

    Tables start in the given order, a few at a time, so small ones do not leave
    the cluster idle. The first failure stops the run, which the manifest records
    as FAILED.
    """
    spark = next(iter(tables.values())).sparkSession
    snapshot_date = snapshot_date or date.today()
    started, run_timestamp = time.time(), run_timestamp or datetime.now(timezone.utc).replace(tzinfo=None)
    run_id = f"run-{uuid.uuid4().hex}"
    origin = source or {"host": None, "database": None, "schema": "ecommerce"}

    def record(name, status, rows, path, seconds, error):
        return (run_id, PIPELINE, snapshot_date, run_timestamp, fmt, origin, name, status, rows, path, seconds, error)

    def commit(records: list[tuple]) -> None:
        frame = spark.createDataFrame(records, MANIFEST_SCHEMA)
        snk_parquet(frame.coalesce(1), f"{_manifest_path(root)}/{run_id}")

    def export(name: str) -> tuple:
        begun = time.time()
        path = _run_path(root, fmt, name, snapshot_date, run_id)
        try:
            rows = _export(tables[name], path, fmt)
        except Exception as error:
            failures.append(error)
            return record(name, "failed", None, path, time.time() - begun, str(error)[:2000])
        return record(name, "success", rows, path, time.time() - begun, None)

    failures: list[Exception] = []

    def export_unless_failed(name: str) -> tuple | None:
        return None if failures else export(name)

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        results = [r for r in pool.map(export_unless_failed, tables) if r is not None]
    seconds = time.time() - started
    if failures:
        commit([*results, record(None, "FAILED", None, None, seconds, str(failures[0])[:2000])])
        raise failures[0]
    commit([*results, record(None, "COMPLETE", None, None, seconds, None)])
    return run_id


# ---- readers -----------------------------------------------------------------


def readable_tables(manifest: DataFrame, fmt: str = "parquet") -> DataFrame:
    """What readers get: per day and table the newest complete run that exported it.

    One row per (snapshot_date, table_name) with run_id, run_timestamp and rows.
    """
    committed = manifest.where("table_name IS NULL AND status = 'COMPLETE'").select("run_id")
    exported = manifest.where(
        F.col("table_name").isNotNull() & (F.col("status") == "success") & (F.col("output_format") == fmt)
    ).join(committed, "run_id", "left_semi")
    newest = F.max(F.struct("run_timestamp", "run_id", "rows")).alias("newest")
    return exported.groupBy("snapshot_date", "table_name").agg(newest).select("snapshot_date", "table_name", "newest.*")


def snap_commit(manifest: DataFrame) -> DataFrame:
    """Completion markers: one row per committed run, with its tables and rows."""
    totals = manifest.where("table_name IS NOT NULL").groupBy("run_id").agg(
        F.count("*").alias("tables"), F.sum("rows").alias("rows")
    )
    return (
        manifest.where("table_name IS NULL AND status = 'COMPLETE'")
        .select("snapshot_date", "run_id", "status")
        .join(totals, "run_id")
    )


def _table_schema(table: str) -> str:
    return TABLES[table].ddl + ", snapshot_date DATE, run_id STRING"


def _run_path(root: str, fmt: str, table: str, day: date, run_id: str) -> str:
    return f"{root}/{fmt}/{table}/snapshot_date={day.isoformat()}/run_id={run_id}"


def _read_runs(spark: SparkSession, root: str, table: str, fmt: str, runs: DataFrame) -> DataFrame:
    """Rows of the given runs (snapshot_date, run_id).

    The runs, one row per day, are looked up first, so that Spark only ever lists
    the folders it will read, however many snapshots lie beside them.
    """
    schema = _table_schema(table)
    paths = [_run_path(root, fmt, table, r.snapshot_date, r.run_id) for r in runs.collect()]
    if not paths:
        return spark.createDataFrame([], schema).drop("run_id")
    reader = csv_reader(spark, schema) if fmt == "csv" else spark.read.schema(schema)
    return reader.option("basePath", f"{root}/{fmt}/{table}").format(fmt).load(paths).drop("run_id")


def _complete(spark: SparkSession, root: str, table: str, fmt: str) -> DataFrame:
    """Newest complete run of each day that has the table."""
    readable = readable_tables(snap_manifest(spark, root), fmt)
    return readable.where(F.col("table_name") == table).select("snapshot_date", "run_id")


def snap_complete(spark: SparkSession, root: str, table: str, fmt: str = "parquet") -> DataFrame:
    """All complete snapshots; what unfinished runs left behind is not read."""
    return _read_runs(spark, root, table, fmt, _complete(spark, root, table, fmt))


def snap_latest(spark: SparkSession, root: str, table: str, fmt: str = "parquet") -> DataFrame:
    """The newest complete snapshot."""
    newest = _complete(spark, root, table, fmt).orderBy(F.desc("snapshot_date")).limit(1)
    return _read_runs(spark, root, table, fmt, newest)


def snap_as_of(spark: SparkSession, root: str, table: str, day: date, fmt: str = "parquet") -> DataFrame:
    """The complete snapshot of that very day; no rows if there is none."""
    runs = _complete(spark, root, table, fmt).where(F.col("snapshot_date") == F.lit(day))
    return _read_runs(spark, root, table, fmt, runs)


# ---- checks ------------------------------------------------------------------


def snap_row_recon(
    tables: dict[str, DataFrame], root: str, day: date, fmt: str = "parquet"
) -> DataFrame:
    """Rows at the source against rows staged that day; a missing table fails."""
    spark = next(iter(tables.values())).sparkSession
    readable = readable_tables(snap_manifest(spark, root), fmt).where(F.col("snapshot_date") == F.lit(day))
    staged_names = {r.table_name for r in readable.select("table_name").collect()}  # table names only
    counts = []
    for name, df in tables.items():
        counts.append(src_row_count(df, name).withColumnRenamed("row_count", "source_count"))
        if name in staged_names:
            staged = src_row_count(snap_as_of(spark, root, name, day, fmt), name)
            counts.append(staged.withColumnRenamed("row_count", "staging_count"))
        else:
            counts[-1] = counts[-1].withColumn("staging_count", F.lit(None).cast("bigint"))
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), counts)
    match = F.coalesce(F.col("source_count") == F.col("staging_count"), F.lit(False))
    return (
        stacked.groupBy("table_name")
        .agg(F.max("source_count").alias("source_count"), F.max("staging_count").alias("staging_count"))
        .withColumn("match", match)
        .withColumn("status", F.when(F.col("match"), "PASS").otherwise("FAIL"))
    )


def snap_sample_compare(source: DataFrame, staged: DataFrame, pk: str, per_256: int = 16) -> DataFrame:
    """Compare a repeatable sample of keys column by column.

    The sample is drawn by a digest of the key, the same on both sides: about
    ``per_256`` of 256 keys. One result row per column. A key that is missing or
    not unique on one side is unpaired.
    """
    columns = [c for c in source.columns if c in staged.columns and c != pk]
    drawn = F.conv(F.substring(F.md5(F.col(pk).cast("string").cast("binary")), 1, 2), 16, 10).cast("int") < per_256

    def drawn_rows(df: DataFrame, side: str) -> DataFrame:
        """One row per drawn key, so that copies never pair up with copies."""
        row = F.max(F.struct(*columns)).alias(f"{side}_row")
        return df.where(drawn).groupBy(F.col(pk).alias("_key")).agg(F.count("*").alias(f"{side}_copies"), row)

    both = drawn_rows(source, "a").join(drawn_rows(staged, "b"), "_key", "full")
    found = F.coalesce((F.col("a_copies") == 1) & (F.col("b_copies") == 1), F.lit(False))
    counts = both.agg(
        F.count_if(found).alias("compared"),
        F.count_if(~found).alias("unpaired"),
        *(F.count_if(found & ~F.equal_null(f"a_row.{c}", f"b_row.{c}")).alias(c) for c in columns),
    )
    rows = F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(c).alias("differing")) for c in columns))
    return counts.select("compared", "unpaired", F.explode(rows).alias("r")).select(
        "r.column_name", "compared", "unpaired", "r.differing"
    )


def row_digest(df: DataFrame, pk: str, name: str) -> DataFrame:
    """One row per key: copies and an order-free 96-bit digest of their contents.

    NULLs are hashed as flags too, since the hashes themselves skip them. Grouping
    keeps the later join one-to-one even if a key has many copies.
    """
    rest = [c for c in df.columns if c != pk]
    parts = (*rest, *(F.col(c).isNull() for c in rest))
    rows = df.select(pk, F.xxhash64(*parts).cast("decimal(20,0)").alias("_x"), F.hash(*parts).cast("bigint").alias("_m"))
    return rows.groupBy(pk).agg(
        F.struct(F.count("*").alias("copies"), F.sum("_x").alias("x"), F.sum("_m").alias("m")).alias(name)
    )


def snap_diff(previous: DataFrame, current: DataFrame, pk: str) -> DataFrame:
    """Every key of two snapshots with inserted, deleted, updated or unchanged."""
    columns = sorted(set(previous.columns) & set(current.columns))
    before = row_digest(previous.select(*columns), pk, "before")
    after = row_digest(current.select(*columns), pk, "after")
    change = (
        F.when(F.col("before").isNull(), "inserted")
        .when(F.col("after").isNull(), "deleted")
        .when(F.col("before") != F.col("after"), "updated")
        .otherwise("unchanged")
    )
    return before.join(after, pk, "full").select(pk, change.alias("change"))


# ---- upkeep ------------------------------------------------------------------


def file_sizes(spark: SparkSession, root: str) -> DataFrame:
    """Path and bytes of every file below a folder; contents are not read."""
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", "length")
    )


def snap_storage_stats(spark: SparkSession, root: str) -> DataFrame:
    """Files and bytes per table as staged (CSV with gzip, Parquet with snappy), and how much smaller Parquet is than CSV, in %."""
    part = r"/(csv|parquet)/([^/]+)/snapshot_date="
    sizes = file_sizes(spark, root).select(
        F.regexp_extract("path", part, 1).alias("fmt"), F.regexp_extract("path", part, 2).alias("table_name"), "length"
    )
    csv, parquet = F.col("fmt") == "csv", F.col("fmt") == "parquet"
    smaller = (1 - F.try_divide(F.col("parquet_bytes").cast("double"), F.col("csv_bytes").cast("double"))) * 100
    return (
        sizes.where(csv | parquet)
        .groupBy("table_name")
        .agg(
            F.count_if(csv).alias("csv_files"),
            F.sum(F.when(csv, F.col("length"))).alias("csv_bytes"),
            F.count_if(parquet).alias("parquet_files"),
            F.sum(F.when(parquet, F.col("length"))).alias("parquet_bytes"),
        )
        .withColumn("percent_smaller", smaller)
    )


def snap_retention(manifest: DataFrame, as_of: date, days: int = RETENTION_DAYS) -> DataFrame:
    """Table snapshots older than the policy, but for the last readable one of a table.

    Deleting them is a separate step.
    """
    age = F.datediff(F.lit(as_of), "snapshot_date")
    formats = [r[0] for r in manifest.select("output_format").distinct().collect()]  # csv, parquet
    kept = [
        readable_tables(manifest, fmt).groupBy("table_name").agg(F.max_by("run_id", "snapshot_date").alias("run_id")) for fmt in formats
    ]
    old = manifest.where(F.col("table_name").isNotNull() & (age > days))
    if kept:
        old = old.join(reduce(DataFrame.unionByName, kept), ["table_name", "run_id"], "left_anti")
    return old.select("snapshot_date", "run_id", "table_name", "path", "rows", age.alias("age_days"))


def snap_compact(spark: SparkSession, root: str, table: str, day: date, target_mb: int = 256) -> str:
    """Rewrite a day's Parquet snapshot of a table as few large files; returns the new run's id.

    The rows go to a run of their own, which the manifest then names as the newest
    of that day and table, so readers change over at once and the old files stay
    until retention. A scan can pack many files into one task: with the packing
    set to the wanted size, each task writes one file and nothing is shuffled. The
    setting lives in a session of its own.
    """
    packing = spark.newSession()
    packing.conf.set("spark.sql.files.maxPartitionBytes", f"{target_mb}MB")
    packing.conf.set("spark.sql.files.openCostInBytes", "64KB")
    packing.conf.set("spark.sql.files.minPartitionNum", "1")
    rows = snap_as_of(packing, root, table, day).drop("snapshot_date")
    return snap_write({table: rows}, root, day)


def snap_size_change(spark: SparkSession, root: str, day: date, fmt: str = "parquet") -> DataFrame:
    """Bytes per table of a day's snapshot and of the table's one before, with their ratio."""
    readable = readable_tables(snap_manifest(spark, root), fmt).where(F.col("snapshot_date") <= F.lit(day))
    now = F.col("snapshot_date") == F.lit(day)
    before = readable.where(~now).groupBy("table_name").agg(F.max_by("run_id", "snapshot_date").alias("run_id"))
    wanted = readable.where(now).select("table_name", "run_id", F.lit(True).alias("now")).unionByName(
        before.withColumn("now", F.lit(False))
    )
    part = f"/{fmt}/([^/]+)/snapshot_date=[^/]+/run_id=([^/]+)/"
    sizes = file_sizes(spark, f"{root}/{fmt}").select(
        F.regexp_extract("path", part, 1).alias("table_name"), F.regexp_extract("path", part, 2).alias("run_id"), "length"
    )
    return (
        sizes.join(wanted, ["table_name", "run_id"])
        .groupBy("table_name")
        .agg(
            F.sum(F.when(F.col("now"), F.col("length"))).alias("bytes"),
            F.sum(F.when(~F.col("now"), F.col("length"))).alias("previous_bytes"),
        )
        .withColumn("ratio", F.try_divide(F.col("bytes").cast("double"), F.col("previous_bytes").cast("double")))
    )
