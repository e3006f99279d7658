"""Sales windows closed by event time: each is emitted once, what comes later is added beside it.

Two streams follow each other. ``sort_arrivals`` splits every batch by the watermark that
the batches before it have set: rows whose window is still open go on, rows whose window
has passed are summed up as corrections. ``close_windows`` is Spark's own windowed
aggregation with a watermark, in append mode, over the rows that went on. Its watermark
is never ahead of the first one, so it drops nothing, and a window it has closed never
gets another row: later ones are corrections. The reader adds closed windows,
corrections and the rows of windows that are still open, and so has every order.

What either stream delivers is committed by batch (see ``sources.commits``); a batch that
is repeated after a failure finds itself delivered. ``merge_batches`` makes one folder of
all batches so far.
"""

from __future__ import annotations

import uuid
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.relational import revenue_orders
from ..sources import commits
from .refresh import WINDOW

DELAY = timedelta(hours=1)

ARRIVED = "at timestamp, channel string, total_amount decimal(15,2)"
SUMS = "window_start timestamp_ntz, window_end timestamp_ntz, channel string, orders bigint, revenue decimal(25,2), kind string"
SEEN = "batch_id bigint, newest timestamp"


def _interval(span: timedelta) -> Column:
    return F.make_dt_interval(secs=F.lit(span.total_seconds()).cast("decimal(18,6)"))


def _summed(rows: DataFrame, window: str) -> DataFrame:
    """Orders and revenue per window and channel of rows (at, channel, total_amount)."""
    return (
        rows.groupBy(F.window("at", window).alias("w"), "channel")
        .agg(F.count("*").alias("orders"), F.sum("total_amount").cast("decimal(25,2)").alias("revenue"))
        .select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), F.col("w.end").cast("timestamp_ntz").alias("window_end"), "channel", "orders", "revenue")
    )


def _deliver(rows: DataFrame, path: str, name: str) -> None:
    """Commit the rows as the part ``name``, unless an earlier attempt did."""
    spark = rows.sparkSession
    if not commits.history(spark, path).where(F.col("partition") == name).isEmpty():
        return
    folder = f"{path}/data/{name}-{uuid.uuid4().hex}"
    rows.write.parquet(folder)
    commits.commit(spark, path, name, [(name, folder)])


def _delivered(spark: SparkSession, path: str, schema: str, named: Column | None = None) -> DataFrame:
    newest, _ = commits.current(spark, path)
    folders = [r.folder for r in (newest if named is None else newest.where(named)).collect()]  # one row per part
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def sort_arrivals(orders: DataFrame, out: str, checkpoint: str, window: str = WINDOW, delay: timedelta = DELAY) -> StreamingQuery:
    """First stream: orders of open windows go on, those of windows that have passed become corrections."""

    def split(batch: DataFrame, batch_id: int) -> None:
        spark, name = batch.sparkSession, f"batch={batch_id}"
        earlier = _delivered(spark, f"{out}/seen", SEEN).where(F.col("batch_id") < batch_id)
        passed = earlier.agg((F.max("newest") - _interval(delay)).alias("mark")).scalar()
        rows = revenue_orders(batch).select(F.col("order_timestamp").cast("timestamp").alias("at"), "channel", "total_amount")
        marked = rows.where("at IS NOT NULL").withColumn("late", F.coalesce(F.window("at", window)["end"] <= passed, F.lit(False)))
        _deliver(_summed(marked.where("late"), window).withColumn("kind", F.lit("late")), f"{out}/sums", f"late-{name}")
        seen = marked.agg(F.max("at").alias("newest")).select(F.lit(batch_id).cast("bigint").alias("batch_id"), "newest")
        # The rows last: the second stream may take them as soon as they are there.
        _deliver(seen, f"{out}/seen", name)
        publish(marked.where("NOT late").select("at", "channel", "total_amount"), f"{out}/arrived/{name}")

    return orders.writeStream.option("checkpointLocation", checkpoint).foreachBatch(split).trigger(availableNow=True).start()


def publish(rows: DataFrame, path: str) -> None:
    """Write a folder that appears whole, or leave the one that is there."""
    spark = rows.sparkSession
    final = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = final.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(final):
        hidden = f"{final.getParent().toString()}/_{final.getName()}-{uuid.uuid4().hex}"
        rows.write.parquet(hidden)
        fs.rename(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(hidden), final)


def close_windows(spark: SparkSession, out: str, checkpoint: str, window: str = WINDOW, delay: timedelta = DELAY) -> StreamingQuery:
    """Second stream: windows behind the watermark, each once, from Spark's windowed state."""
    arrived = spark.readStream.schema(ARRIVED).option("recursiveFileLookup", "true").parquet(f"{out}/arrived")
    closed = _summed(arrived.withWatermark("at", f"{int(delay.total_seconds())} seconds"), window)

    def deliver(batch: DataFrame, batch_id: int) -> None:
        _deliver(batch.withColumn("kind", F.lit("closed")), f"{out}/sums", f"closed-batch={batch_id}")

    return closed.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(deliver).trigger(availableNow=True).start()


def closed_sales(spark: SparkSession, out: str) -> DataFrame:
    """Closed windows and corrections as delivered: (window, channel, orders, revenue, kind)."""
    return _delivered(spark, f"{out}/sums", SUMS)


def windowed_totals(spark: SparkSession, out: str, window: str = WINDOW) -> DataFrame:
    """Figures of every window and channel so far: closed ones, corrections, and those still open."""
    sums = closed_sales(spark, out)
    # All windows up to the newest closed one are closed; only batches that reach beyond it are read again.
    upto = sums.where("kind = 'closed'").agg(F.max("window_end")).first()[0]
    seen = _delivered(spark, f"{out}/seen", SEEN).where("newest IS NOT NULL")
    if upto is not None:
        seen = seen.where(F.window("newest", window)["end"].cast("timestamp_ntz") > F.lit(upto).cast("timestamp_ntz"))
    folders = [f"{out}/arrived/batch={r.batch_id}" for r in seen.select("batch_id").collect()]  # one row per open batch
    arrived = spark.read.schema(ARRIVED).parquet(*folders) if folders else spark.createDataFrame([], ARRIVED)
    still_open = _summed(arrived, window)
    if upto is not None:
        still_open = still_open.where(F.col("window_end") > F.lit(upto).cast("timestamp_ntz"))
    every = sums.drop("kind").unionByName(still_open)
    return every.groupBy("window_start", "window_end", "channel").agg(F.sum("orders").alias("orders"), F.sum("revenue").alias("revenue"))


def merge_batches(spark: SparkSession, out: str) -> int:
    """One folder of all closed windows and corrections so far, summed per window; returns the folders it stands for."""
    path = f"{out}/sums"
    for _ in range(commits.TRIES):
        newest, number = commits.current(spark, path)
        many = newest.count()
        merged = (
            _delivered(spark, path, SUMS)
            .groupBy("window_start", "window_end", "channel", "kind")
            .agg(F.sum("orders").alias("orders"), F.sum("revenue").cast("decimal(25,2)").alias("revenue"))
        )
        folder = f"{path}/data/merged-{uuid.uuid4().hex}"
        merged.select(*(f.split()[0] for f in SUMS.split(", "))).write.parquet(folder)
        try:
            commits.commit(spark, path, "merged", [(commits.WHOLE, folder)], number)
            return many
        except commits.Overlap:  # a batch was delivered meanwhile
            commits.remove(spark, folder)
    raise RuntimeError(f"batches kept arriving at {path}")
