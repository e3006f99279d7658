"""Reading source tables: a database over JDBC, staged CSV, staged Parquet."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, DataFrameReader, SparkSession, functions as F

from ..schemas import TABLES

SOURCE_SCHEMA = "ecommerce"
WITH_FRACTION, WHOLE_SECONDS = "yyyy-MM-dd HH:mm:ss[.SSSSSS]", "yyyy-MM-dd HH:mm:ss"


def csv_options(timestamps: str = WITH_FRACTION) -> dict[str, str]:
    return {
        "header": "true",
        "encoding": "UTF-8",
        "nullValue": "",
        "emptyValue": "",
        "quote": '"',
        "escape": '"',  # a quote inside a field is doubled
        "ignoreLeadingWhiteSpace": "false",  # blanks are data
        "ignoreTrailingWhiteSpace": "false",
        "dateFormat": "yyyy-MM-dd",
        "timestampFormat": timestamps,
        "timestampNTZFormat": timestamps,
    }


def jdbc_options(url: str, properties: dict[str, str] | None = None, fetch_size: int = 10_000) -> dict[str, str]:
    return {"url": url, "fetchsize": str(fetch_size), **(properties or {})}


def src_jdbc_scan(
    spark: SparkSession, table: str, url: str, properties: dict[str, str] | None = None, partitions: int = 64
) -> DataFrame:
    """Full load of one database table, read by executors in key ranges.

    Filters, columns and counts of later steps reach the database, and numeric
    columns stay decimals.
    """
    spec, name = TABLES[table], f"{SOURCE_SCHEMA}.{table}"
    options = jdbc_options(url, properties)
    key = spec.primary_key
    bounds = (
        spark.read.format("jdbc")
        .options(**options, query=f"SELECT min({key}) AS lo, max({key}) AS hi FROM {name}")
        .load()
        .first()
    )
    reader = spark.read.format("jdbc").options(**options, dbtable=name)
    if bounds.lo is not None:
        reader = reader.options(
            partitionColumn=key, lowerBound=str(bounds.lo), upperBound=str(bounds.hi), numPartitions=str(partitions)
        )
    return reader.load()


def src_csv_scan(spark: SparkSession, path: str, schema: str, multi_line: bool = True) -> DataFrame:
    """Staged CSV with its declared schema, never an inferred one.

    Free text may hold line breaks; a file is then one split, and the writer bounds
    file sizes to keep the read parallel. ``multi_line=False`` lets many tasks read
    one large file that is known to hold no line break. A malformed row or a header
    other than the declared columns fails the read.
    """
    return csv_reader(spark, schema, multi_line).csv(path)


def csv_reader(spark: SparkSession, schema: str, multi_line: bool = True) -> DataFrameReader:
    checks = {"mode": "FAILFAST", "enforceSchema": "false"}
    return spark.read.schema(schema).options(**csv_options(), **checks, multiLine=str(multi_line).lower())


def src_parquet_scan(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def src_table_scan(df: DataFrame, table: str) -> DataFrame:
    """All rows and all declared columns of a table, in declared order."""
    return df.select(*TABLES[table].schema.names)


def src_row_count(df: DataFrame, table: str) -> DataFrame:
    return df.agg(F.count("*").alias("row_count")).select(F.lit(table).alias("table_name"), "row_count")


def src_row_count_summary(tables: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [src_row_count(df, name) for name, df in tables.items()])
