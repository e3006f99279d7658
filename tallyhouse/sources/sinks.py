"""Writing tables: staged files, database tables, warehouse layers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, FloatType

from .tables import WHOLE_SECONDS, csv_options
from .versions import write_version

FORMATS = ("csv", "parquet")
LAYERS = ("staging", "dw", "mart", "reconcile")
ROWS_PER_CSV_FILE = 500_000


def snk_csv(df: DataFrame, path: str, mode: str = "errorifexists", whole_seconds: bool = False, compression: str = "none") -> None:
    """Header, UTF-8, quotes only where needed, NULL as an empty field.

    Times keep their microseconds unless ``whole_seconds`` asks to cut them. Readers
    find out about ``compression`` (none, gzip) by the files' names; a compressed file
    is read by one task, so its rows are as limited as those of a plain one.
    """
    options = csv_options(WHOLE_SECONDS) if whole_seconds else csv_options()
    df.write.mode(mode).options(**options, maxRecordsPerFile=str(ROWS_PER_CSV_FILE)).option("zlib.compress.level", "BEST_SPEED").csv(path, compression=compression)


def snk_parquet(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("compression", "snappy").parquet(path)


def write_as(df: DataFrame, path: str, fmt: str) -> None:
    """Write a staged table: Parquet with snappy, CSV with gzip, as both are kept whole for days."""
    if fmt not in FORMATS:
        raise ValueError(f"format must be one of {FORMATS}, not {fmt!r}")
    snk_csv(df, path, compression="gzip") if fmt == "csv" else snk_parquet(df, path)


def nan_as_null(df: DataFrame) -> DataFrame:
    """Not-a-number has no place in a database column; store NULL."""
    return df.select(
        *(
            F.when(~F.isnan(f.name), F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, (DoubleType, FloatType))
            else F.col(f.name)
            for f in df.schema.fields
        )
    )


def snk_table_append(df: DataFrame, path: str) -> None:
    """Append to a file-based table, NaN stored as NULL."""
    snk_parquet(nan_as_null(df), path, mode="append")


def snk_jdbc_append(
    df: DataFrame, table: str, url: str, properties: dict[str, str] | None = None, batch_size: int = 10_000
) -> None:
    """Append to a database table in batches, NaN stored as NULL."""
    nan_as_null(df).write.format("jdbc").mode("append").options(
        url=url, dbtable=table, batchsize=str(batch_size), **(properties or {})
    ).save()


def snk_warehouse_write(df: DataFrame, root: str, layer: str, table: str, partition_by: str | None = None) -> str:
    """Replace a table of a warehouse layer, or its delivered partitions; returns its path.

    The rows become a new version; ``versions.read_current`` reads the newest.
    """
    if layer not in LAYERS:
        raise ValueError(f"layer must be one of {LAYERS}, not {layer!r}")
    path = f"{root.rstrip('/')}/{layer}/{table}"
    write_version(df, path, partition_by)
    return path
