"""Session building and the settings every job of this package relies on."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Runtime SQL settings. All of them may be set on a session that already runs.
RUNTIME_SETTINGS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Row-level fact-to-dimension joins meet hot customers and hot products:
    # let the running query split such partitions, also where a later
    # aggregation would otherwise keep Spark from doing so.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Whole texts travel to Python tasks: a batch of them has to fit beside the heap.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    # The default (STATIC) would wipe every other snapshot on a partition write.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def pin_runtime(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def get_session(app: str = "tallyhouse", cores: str | None = None) -> SparkSession:
    """Local session for tests and the benchmark; on a cluster use the one given."""
    cores = cores or os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("TALLYHOUSE_DRIVER_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", cores)
    )
    for key, value in RUNTIME_SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return pin_runtime(spark)
