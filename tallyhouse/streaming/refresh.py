"""Sales refresh and reconciliation alerts as structured-streaming jobs.

Both read staged Parquet folders as streams and run over what is available, every
15 to 30 minutes. Each micro-batch writes folders of its own, named by the batch
number, so a batch repeated after a failure replaces itself.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta
from decimal import Decimal

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.reconciliation import MATERIAL, order_balance
from ..operators.relational import revenue_orders
from ..schemas import TABLES
from ..workspace import staged

WINDOW = "30 minutes"
LATE_AFTER = timedelta(days=1)
ORDER_BUCKETS = 64

SALES = "window_start timestamp_ntz, window_end timestamp_ntz, channel string, orders bigint, revenue decimal(25,2), batch_id bigint"
LATE = "id bigint, order_timestamp timestamp_ntz, channel string, total_amount decimal(15,2), batch_id bigint"
SEEN = "newest timestamp_ntz, batch_id bigint"


def read_staged_stream(spark: SparkSession, path: str, table: str, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(TABLES[table].ddl)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def batch_folder(out: str) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    return write


def windowed_sales(orders: DataFrame, window: str = WINDOW) -> DataFrame:
    """Revenue per tumbling window and channel.

    Windows need an instant, so the zone-less order time is read as one in the
    session time zone and given back without zone.
    """
    at = F.window(F.col("order_timestamp").cast("timestamp"), window).alias("w")
    return (
        revenue_orders(orders)
        .groupBy(at, "channel")
        .agg(F.count("*").alias("orders"), F.sum("total_amount").alias("revenue"))
        .select(
            F.col("w.start").cast("timestamp_ntz").alias("window_start"),
            F.col("w.end").cast("timestamp_ntz").alias("window_end"),
            "channel",
            "orders",
            "revenue",
        )
    )


def stream_sales_refresh(
    orders: DataFrame, out: str, checkpoint: str, window: str = WINDOW, late_after: timedelta = LATE_AFTER
) -> StreamingQuery:
    """Every micro-batch writes the counts and sums of its own orders per window.

    They add up to the same figures whatever the order of arrival and the size of
    the batches; there is no state to lose and no row to drop. Orders that come
    ``late_after`` behind the newest of all earlier batches count like any other
    and are listed below ``late`` as well.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with staged(revenue_orders(batch).select("id", "order_timestamp", "channel", "total_amount", "status"), "sales-batch") as sold:
            batch_folder(f"{out}/sales")(windowed_sales(sold, window), batch_id)
            newest = F.max("order_timestamp")
            if batch_id:
                before = spark.read.schema(SEEN).parquet(f"{out}/seen").where(F.col("batch_id") < batch_id)
                limit = before.agg(newest_seen()).select(F.col("newest") - F.lit(late_after)).first()[0]
                late = F.lit(limit).cast("timestamp_ntz") if limit is not None else F.lit(None).cast("timestamp_ntz")
                batch_folder(f"{out}/late")(sold.where(F.col("order_timestamp") < late).drop("status"), batch_id)
            batch_folder(f"{out}/seen")(sold.agg(newest.alias("newest")), batch_id)

    return (
        orders.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write).trigger(availableNow=True).start()
    )


def newest_seen() -> Column:
    return F.max("newest").alias("newest")


def refreshed_sales(spark: SparkSession, out: str) -> DataFrame:
    """Figures of each window and channel over all batches."""
    return (
        spark.read.schema(SALES).parquet(f"{out}/sales")
        .groupBy("window_start", "window_end", "channel")
        .agg(F.sum("orders").alias("orders"), F.sum("revenue").alias("revenue"))
    )


def late_orders(spark: SparkSession, out: str) -> DataFrame:
    """Orders that came late, with the batch that brought them."""
    try:
        return spark.read.schema(LATE).parquet(f"{out}/late")
    except AnalysisException as absent:  # no second batch yet
        if absent.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LATE)


# ---- reconciliation ----------------------------------------------------------


def order_bucket(order: Column) -> Column:
    return F.pmod(F.xxhash64(order.cast("bigint")), F.lit(ORDER_BUCKETS)).cast("int")


def stage_by_order(df: DataFrame, path: str, order: str, mode: str = "errorifexists") -> None:
    """Stage a table in folders by bucket of its order, so that few orders are found in few folders."""
    bucketed = df.withColumn("order_bucket", order_bucket(F.col(order)))
    bucketed.hint("rebalance", F.col("order_bucket")).write.mode(mode).partitionBy("order_bucket").parquet(path)


def _in_buckets(spark: SparkSession, path: str, table: str, buckets: list[int]) -> DataFrame:
    rows = spark.read.schema(TABLES[table].ddl + ", order_bucket int").parquet(path)
    return rows.where(F.col("order_bucket").isin(buckets)).drop("order_bucket")


def check_orders(spark: SparkSession, touched: DataFrame, orders_path: str, payments_path: str, threshold: Decimal = MATERIAL) -> DataFrame:
    """Balance of the touched orders (order_id); only their buckets of both tables are read."""
    buckets = [r[0] for r in touched.select(order_bucket(F.col("order_id"))).distinct().collect()]  # ORDER_BUCKETS at most
    orders = _in_buckets(spark, orders_path, "orders", buckets)
    paid = _in_buckets(spark, payments_path, "payments", buckets)
    orders = orders.join(touched, orders.id == touched.order_id, "left_semi")
    balance = order_balance(orders, paid.join(touched, "order_id", "left_semi"))
    return balance.withColumn("material", F.abs("discrepancy") > F.lit(threshold))


def stream_recon_alerts(
    payments: DataFrame, orders_path: str, payments_path: str, out: str, checkpoint: str, threshold: Decimal = MATERIAL
) -> StreamingQuery:
    """Orders touched by new payments, rechecked against the full tables.

    Payments change state after they arrive, so a running sum would count them
    twice; the touched orders are recomputed instead. Both tables are staged by
    ``stage_by_order``, and only the buckets of touched orders are read.
    """

    def check(batch: DataFrame, batch_id: int) -> None:
        with staged(batch.select("order_id").distinct(), "touched") as touched:
            batch_folder(out)(check_orders(batch.sparkSession, touched, orders_path, payments_path, threshold), batch_id)

    return (
        payments.select("order_id")
        .writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(check)
        .trigger(availableNow=True)
        .start()
    )


def recon_alerts(spark: SparkSession, out: str) -> DataFrame:
    """Open alerts: an order counts with its newest check only."""
    columns = ("order_number", "order_date", "order_amount", "paid_amount", "discrepancy", "material")
    newest = F.max_by(F.struct(*columns), "batch_id")
    return (
        spark.read.parquet(out).groupBy("order_id").agg(newest.alias("r")).select("order_id", "r.*").where("material").drop("material")
    )
