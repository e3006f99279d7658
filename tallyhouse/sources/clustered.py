"""Files clustered by several columns at once, with zone maps that tell which to open.

Rows are ordered by interleaved bits: each column is cut into as many equally filled
slices as bits allow, and the bits of the slice numbers take turns. A file then covers a
small box of all columns instead of a thin layer of one. The least and greatest value of
every zone column, file by file, is kept beside the files; a reader filters that small
table first and lists only files that can match. Writes are versions of the whole table
(see ``commits``), so readers keep what they began with.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from . import commits

BITS = 6  # of a slice number: 64 slices to a column
FILE_ROWS = 5_000_000


def _number(column: str, kind: str) -> Column:
    """A column as a number that rises with it."""
    if kind in ("timestamp", "timestamp_ntz"):
        return F.unix_micros(F.col(column).cast("timestamp"))
    return F.datediff(F.col(column), F.lit("1970-01-01").cast("date")) if kind == "date" else F.col(column)


def slices(df: DataFrame, columns: list[str], bits: int = BITS) -> list[Column]:
    """Slice number of every column: how many of the cuts between equally filled slices lie at or below the value.

    One aggregate finds the cuts of all columns approximately; they only shape the
    files, no result depends on them. NULLs are in the first slice.
    """
    shares = [k / 2**bits for k in range(1, 2**bits)]
    kinds = dict(df.dtypes)
    cuts = df.agg(*(F.percentile_approx(_number(c, kinds[c]), shares, 10_000).alias(c) for c in columns)).first()

    def slice_of(c: str) -> Column:
        if not cuts[c]:
            return F.lit(0)
        value, bounds = _number(c, kinds[c]), F.array(*(F.lit(x) for x in sorted(set(cuts[c]))))
        return F.when(value.isNull(), 0).otherwise(F.size(F.filter(bounds, lambda cut: cut <= value)))

    return [slice_of(c) for c in columns]


def interleaved(numbers: list[Column], bits: int = BITS) -> Column:
    """The bits of several numbers taking turns, highest first."""
    parts = []
    for bit in range(bits):
        for place, number in enumerate(numbers):
            one = F.shiftright(number.cast("bigint"), bit).bitwiseAND(F.lit(1).cast("bigint"))
            parts.append(F.shiftleft(one, bit * len(numbers) + len(numbers) - 1 - place))
    return reduce(lambda a, b: a.bitwiseOR(b), parts)


def write_clustered(
    df: DataFrame, path: str, cluster_by: list[str], zones: list[str] | None = None, files: int | None = None
) -> str:
    """Replace the table at ``path`` by ``df``, clustered; returns the version.

    ``zones`` are the columns whose least and greatest values are kept: those of
    ``cluster_by`` if none are given. Rows of one slice are spread further by their
    content, so a value that a third of all rows share fills as many files as it needs.
    """
    spark, version = df.sparkSession, f"v-{uuid.uuid4().hex}"
    folder, zones = f"{path}/data/version={version}", zones or cluster_by
    files = files or max(1, -(-df.count() // FILE_ROWS))
    placed = df.withColumn("_place", interleaved(slices(df, cluster_by)))
    spread = F.xxhash64(*df.columns)
    placed.repartitionByRange(files, "_place", *cluster_by, spread).sortWithinPartitions("_place", *cluster_by).drop("_place").write.parquet(folder)
    zone_map(spark.read.schema(df.schema).parquet(folder), zones).coalesce(1).write.parquet(f"{path}/zones/version={version}")
    commits.commit(spark, path, version, [(commits.WHOLE, folder)])
    return version


def zone_map(stored: DataFrame, zones: list[str]) -> DataFrame:
    """(file, rows, least_c, greatest_c, nulls_c …), from the zone columns alone."""
    figures = [
        f for c in zones for f in (F.min(c).alias(f"least_{c}"), F.max(c).alias(f"greatest_{c}"), F.count_if(F.col(c).isNull()).alias(f"nulls_{c}"))
    ]
    named = stored.select(F.col("_metadata.file_path").alias("file"), *zones)
    return named.groupBy("file").agg(F.count("*").alias("rows"), *figures)


class Clustered:
    """The current version of a clustered table."""

    def __init__(self, spark: SparkSession, path: str, schema: str):
        newest, _ = commits.current(spark, path)
        (row,) = newest.select("version").collect()
        self.spark, self.schema = spark, schema
        self.zones = spark.read.parquet(f"{path}/zones/version={row.version}")

    def read(self, may_hold: Callable[[Callable[[str], Column], Callable[[str], Column]], Column] | None = None) -> DataFrame:
        """Rows of the files for which ``may_hold(least, greatest)`` is true, all without it.

        The caller's own filter still has to be applied; this only says which files
        are worth opening. A file without any value in a column has NULL bounds.
        """
        zones = self.zones if may_hold is None else self.zones.where(may_hold(lambda c: F.col(f"least_{c}"), lambda c: F.col(f"greatest_{c}")))
        files = [r.file for r in zones.select("file").collect()]  # one row per file
        if not files:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*files)

    def after(self, column: str, value: object) -> DataFrame:
        """Rows with a greater value, as ``incremental.inc_extract`` asks for."""
        return self.read(lambda least, greatest: greatest(column) > F.lit(value)).where(F.col(column) > F.lit(value))

    def equal(self, column: str, value: object) -> DataFrame:
        wanted = F.lit(value)
        return self.read(lambda least, greatest: (least(column) <= wanted) & (greatest(column) >= wanted)).where(F.col(column) == wanted)

    def missing(self, column: str) -> DataFrame:
        """Rows without a value."""
        return self.read(lambda least, greatest: F.col(f"nulls_{column}") > 0).where(F.col(column).isNull())

    def between(self, column: str, low: object, high: object) -> DataFrame:
        return self.read(lambda least, greatest: (greatest(column) >= F.lit(low)) & (least(column) <= F.lit(high))).where(
            F.col(column).between(F.lit(low), F.lit(high))
        )
