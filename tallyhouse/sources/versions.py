"""Warehouse tables as immutable versions with a log.

Layout: ``<path>/data/version=<id>[/<column>=<value>]`` and ``<path>/log``. A write
adds a version folder and then one numbered commit that names it, for the whole table
or for the partitions it delivers; that commit is the switch. Files a reader has begun
to read are never touched, and a write that fails before its commit leaves the table
as it was. Any number of writers may work at a time, see ``commits``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import commits
from .commits import LOG_SCHEMA as LOG_SCHEMA


def version_log(spark: SparkSession, path: str) -> DataFrame:
    """All versions; an empty log for a table that has none yet."""
    return commits.history(spark, path)


def write_version(
    df: DataFrame,
    path: str,
    partition_by: str | None = None,
    read: int | None = None,
    between: Callable[[], None] | None = None,
    replaced: Iterable[str] = (),
) -> str:
    """Add a version; returns its id.

    A partitioned version replaces the partitions it has rows for, any other the
    whole table. Rows are balanced over write tasks, so one huge partition does not
    fall to one task. ``read`` is the commit the rows were made from: if a later one
    has touched the same partitions, ``commits.Overlap`` is raised and the version's
    files are removed. ``between`` is called before the number is taken if other
    partitions were committed meanwhile, and may refuse. Partitions named in
    ``replaced`` have no rows from then on if none arrive.
    """
    spark, version = df.sparkSession, f"v-{uuid.uuid4().hex}"
    folder = f"{path}/data/version={version}"
    if partition_by is None:
        df.write.option("compression", "snappy").parquet(folder)
        delivered = [(commits.WHOLE, folder)]
    else:
        writer = df.hint("rebalance", F.col(partition_by)).write.option("compression", "snappy")
        writer.partitionBy(partition_by).parquet(folder)
        names = commits.subfolders(spark, folder)
        delivered = [(name, f"{folder}/{name}") for name in names] + [(name, None) for name in set(replaced) - set(names)]
    if delivered:
        try:
            commits.commit(spark, path, version, delivered, read, between)
        except Exception:
            commits.remove(spark, folder)  # named by no commit
            raise
    return version


def partition_name(column: str, value: object) -> str:
    """Name of the folder of a date or whole number, or of NULL."""
    return f"{column}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}"


def read_at(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, int]:
    """The newest version of the table, or of each of its partitions, and the number of its last commit."""
    newest, number = commits.current(spark, path)
    folders = [r.folder for r in newest.where("folder IS NOT NULL").collect()]  # one row per partition
    if not folders:
        return spark.createDataFrame([], schema), number
    reader = spark.read.schema(f"{schema}, version STRING").option("basePath", f"{path}/data")
    return reader.parquet(*folders).drop("version"), number


def read_current(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return read_at(spark, path, schema)[0]


def expired_versions(log: DataFrame) -> DataFrame:
    """Folders no reader would take any more. Deleting them is a separate step."""
    named = log.where("folder IS NOT NULL")
    return named.join(commits.newest_folders(log).select("folder"), "folder", "left_anti").select("number", "partition", "folder")
