"""Shared working folder: staged intermediate tables and job output.

Everything staged lands in the folder the cluster names in
``spark.checkpoint.dir``, so a lost executor costs a re-read, not a re-run.
Where no such folder is configured, the warehouse folder, which all executors
share as well, takes its place. Both hold in every mode alike.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    configured = spark.conf.get("spark.checkpoint.dir", None)
    configured = configured or spark.sparkContext.getCheckpointDir()
    return (configured or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_staging").rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path of its own for each run, below the shared folder."""
    return f"{shared_root(spark)}/tallyhouse/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet and go on from the written table."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


BROADCAST_ROWS = 2_000_000


def sized(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A staged table of few columns, marked for broadcast if it has at most ``rows`` rows.

    A larger one is left as it is, and Spark joins it by shuffle.
    """
    return df.hint("broadcast") if df.limit(rows + 1).count() <= rows else df


def broadcastable(df: DataFrame) -> bool:
    """Does Spark's estimate, for a staged table the size of its files, allow a broadcast?"""
    spark = df.sparkSession
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    if limit.startswith("-"):
        return False
    bytes_ = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(limit)
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= bytes_


def discard(df: DataFrame) -> None:
    """Remove the files of a staged table that nothing reads any more."""
    spark, jvm = df.sparkSession, df.sparkSession.sparkContext._jvm
    root = shared_root(spark)
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        if f"{root.split(':', 1)[-1].rstrip('/')}/tallyhouse/".replace("//", "/") in folder.replace("//", "/"):
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def staged(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """A staged table for the length of a block that also writes out what it makes of it."""
    table = stage(df, name)
    try:
        yield table
    finally:
        discard(table)
