"""Tables stored by the hash of their order key, so that joins and sums by it need no shuffle.

Each table is written once into the same number of buckets, sorted within them; rows
of one order then lie in the bucket of the same number in all tables. Writing costs the
shuffle that every later join saves. Bucket counts are powers of two: tables whose
counts differ still meet, as Spark reads the finer one by the coarser count.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from ..workspace import fresh_path

#: The order key of each source table.
ORDER_KEYS = {"orders": "id", "order_items": "order_id", "payments": "order_id", "invoices": "order_id"}
BUCKETS = 64
#: While reading, tables of two bucket counts are read by the smaller one.
READ_SETTINGS = {"spark.sql.bucketing.coalesceBucketsInJoin.enabled": "true"}


def buckets_for(rows: int, rows_per_bucket: int = 5_000_000, least: int = 8) -> int:
    """A power of two that keeps a bucket at about so many rows."""
    wanted = max(least, -(-rows // rows_per_bucket))
    return 1 << (wanted - 1).bit_length()


def write_colocated(df: DataFrame, name: str, key: str, path: str, buckets: int = BUCKETS) -> DataFrame:
    """Store ``df`` as the catalog table ``name``, one sorted file per bucket; returns the stored table."""
    spark = df.sparkSession
    # One task per bucket writes one file of it; without, every task would write a file of each.
    df.repartition(buckets, key).write.option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    return spark.table(name)


def colocate(tables: dict[str, DataFrame], database: str, root: str, buckets: int = BUCKETS) -> dict[str, DataFrame]:
    """Store orders and what hangs on them side by side, in a catalog database of that name."""
    spark = next(iter(tables.values())).sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{root}'")
    return {
        name: write_colocated(df, f"{database}.{name}", ORDER_KEYS[name], f"{root}/{name}", buckets)
        for name, df in tables.items()
    }


@contextmanager
def reading(spark: SparkSession) -> Iterator[None]:
    """Settings under which tables of different bucket counts meet without a shuffle."""
    before = {key: spark.conf.get(key, None) for key in READ_SETTINGS}
    try:
        for key, value in READ_SETTINGS.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
