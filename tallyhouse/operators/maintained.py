"""Sales views and customer figures that are kept up to date from change sets.

Every change becomes signed rows: the stored row counts -1, the new row +1, a deleted
one has no new row. Signed rows are summed up per day, channel and customer, with
multiplicities, so that distinct customers, first and last days stay exact when orders
go. Two states hold these sums, one split by month for the sales view, one split by
customer for the customer figures; the orders themselves are split by ranges of their
keys. A refresh reads and writes only the splits that a change touches, and one commit
switches all three over together, so a change set is never half applied and two
refreshes at the same time both arrive (see ``sources.commits``).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextlib import ExitStack
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.money import ratio
from ..sources import commits
from ..sources.incremental import latest_per_key, newer
from ..workspace import staged
from .customer360 import customer_360_of
from .relational import revenue_orders
from .rfm import trailing_year

GRAIN = ("order_date", "channel", "customer_id")
SUMS = ("orders", "total", "totals", "discount", "discounts", "completed", "completeds")
SPLITS = {"orders": "key_range", "sales": "month", "customers": "customer_range"}


def contributions(signed: DataFrame) -> DataFrame:
    """Sums per day, channel and customer of revenue orders that count ``sign`` times each."""
    sign, completed = F.col("sign"), F.col("status") == "Completed"

    def added(amount: Column) -> Column:
        return F.sum(F.when(sign > 0, amount).otherwise(-amount))

    def counted(there: Column) -> Column:
        return F.coalesce(F.sum(F.when(there, sign)), F.lit(0)).cast("bigint")

    return revenue_orders(signed).groupBy(*GRAIN).agg(
        F.sum(sign).cast("bigint").alias("orders"),
        added(F.col("total_amount")).cast("decimal(38,2)").alias("total"),
        counted(F.col("total_amount").isNotNull()).alias("totals"),
        added(F.col("discount_amount")).cast("decimal(38,2)").alias("discount"),
        counted(F.col("discount_amount").isNotNull()).alias("discounts"),
        added(F.when(completed, F.col("total_amount"))).cast("decimal(38,2)").alias("completed"),
        counted(completed & F.col("total_amount").isNotNull()).alias("completeds"),
    )


def _summed(states: DataFrame) -> DataFrame:
    """Sums of several states; a group of which nothing is left goes."""
    totals = states.groupBy(*GRAIN).agg(*(F.sum(c).cast(states.schema[c].dataType).alias(c) for c in SUMS))
    return totals.where("orders <> 0")


def daily_sales_of(state: DataFrame) -> DataFrame:
    """``views.view_daily_sales`` from the sums."""
    total, discount = F.col("total"), F.col("discount")
    days = state.groupBy("order_date", "channel").agg(
        F.sum("orders").alias("order_count"),
        F.count("customer_id").alias("unique_customers"),
        F.when(F.sum("totals") > 0, F.sum("total")).alias("total"),
        F.sum("totals").alias("totals"),
        F.when(F.sum("discounts") > 0, F.sum("discount")).alias("discount"),
    )
    return days.select(
        "order_date", "channel", "order_count", "unique_customers", total.alias("gross_revenue"), discount.alias("total_discount"),
        (total - discount).alias("net_revenue"), total.alias("net_revenue_after_discount"), ratio(total, F.col("totals")).alias("avg_order_value"),
    )


def purchase_behaviour_of(state: DataFrame, as_of: date) -> DataFrame:
    """``customer360.purchase_behaviour`` from the sums; days after ``as_of`` do not count."""
    by_channel = (
        state.where(F.col("order_date") <= F.lit(as_of))
        .groupBy("customer_id", "channel")
        .agg(
            F.sum("orders").alias("n"),
            F.coalesce(F.sum(F.when(trailing_year(F.col("order_date"), as_of), F.col("orders"))), F.lit(0)).alias("n_year"),
            F.when(F.sum("totals") > 0, F.sum("total")).alias("spent"),
            F.when(F.sum("completeds") > 0, F.sum("completed")).alias("completed"),
            F.min("order_date").alias("first"),
            F.max("order_date").alias("last"),
        )
    )
    return by_channel.groupBy("customer_id").agg(
        F.sum("n").alias("order_count"),
        F.sum("spent").cast("decimal(35,2)").alias("monetary"),
        F.sum("completed").cast("decimal(35,2)").alias("lifetime_value"),
        F.min("first").alias("first_order_date"),
        F.max("last").alias("last_order_date"),
        F.datediff(F.lit(as_of), F.max("last")).alias("recency_days"),
        F.sum("n_year").alias("frequency"),
        F.count("channel").alias("channel_count"),
        F.max_by("channel", F.struct("n", "channel")).alias("preferred_channel"),
    )


@dataclass(frozen=True)
class SalesViews:
    """Orders, their sums by month and by customer, below one folder.

    ``schema`` is that of the orders: one row per ``id``, which is not NULL. Splits
    are sized by the two widths, which belong to the folder: give the same ones each time.
    """

    spark: SparkSession
    path: str
    schema: str
    keys_per_range: int = 1_000_000
    customers_per_range: int = 1_000_000

    # ---- the splits ----------------------------------------------------------

    def _split(self, table: str) -> Column:
        return {
            "orders": F.floor(F.col("id") / self.keys_per_range).cast("bigint"),
            "sales": F.trunc("order_date", "month"),
            "customers": F.floor(F.col("customer_id") / self.customers_per_range).cast("bigint"),
        }[table].alias(SPLITS[table])

    def _named(self, table: str, rows: DataFrame) -> set[str]:
        """Names of the splits that some rows fall into; as many as splits."""
        values = rows.select(self._split(table)).distinct().collect()
        return {f"{table}/{SPLITS[table]}={'__HIVE_DEFAULT_PARTITION__' if r[0] is None else r[0]}" for r in values}

    def _read(self, table: str, folders: list[str]) -> DataFrame:
        schema = self.schema if table == "orders" else contributions(self._no_orders().withColumn("sign", F.lit(1))).schema
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*folders)

    def _no_orders(self) -> DataFrame:
        return self.spark.createDataFrame([], self.schema)

    def _current(self) -> tuple[dict[str, str], int]:
        newest, number = commits.current(self.spark, self.path)
        return {r.partition: r.folder for r in newest.where("folder IS NOT NULL").collect()}, number  # one row per split

    def _lay_out(self, table: str, rows: DataFrame, folder: str) -> dict[str, str]:
        """Write the rows of a table by their splits; returns the folder of each split."""
        split, out = SPLITS[table], f"{folder}/{table}"
        rows.withColumn(split, self._split(table)).hint("rebalance", F.col(split)).write.partitionBy(split).parquet(out)
        return {f"{table}/{name}": f"{out}/{name}" for name in commits.subfolders(self.spark, out)}

    def _write(self, tables: dict[str, Callable[[], DataFrame]], touched: set[str], read: int) -> int:
        """One version of the given tables and one commit for all; a touched split without rows is empty from then on.

        The tables are written at the same time, as none needs another one: the last
        tasks of one do not leave the cluster idle.
        """
        version = f"v-{uuid.uuid4().hex}"
        folder = f"{self.path}/data/version={version}"
        try:
            with ThreadPoolExecutor(len(tables)) as pool:
                parts = list(pool.map(lambda t: self._lay_out(t, tables[t](), folder), tables))
            every = {name: None for name in touched} | {name: at for part in parts for name, at in part.items()}
            return commits.commit(self.spark, self.path, version, sorted(every.items()), read)
        except Exception:
            commits.remove(self.spark, folder)
            raise

    # ---- writing -------------------------------------------------------------

    def start(self, orders: DataFrame) -> int:
        """The first version, from all orders; returns its commit."""
        own = orders.select(*self._no_orders().columns)
        with ThreadPoolExecutor(1) as pool, ExitStack() as stack:
            # Both sums wait for their common rows, the orders do not.
            sums = pool.submit(lambda: stack.enter_context(staged(contributions(own.withColumn("sign", F.lit(1))), "sums")))
            return self._write({"orders": lambda: own, "sales": sums.result, "customers": sums.result}, set(), 0)

    def refresh(self, changes: DataFrame, deleted: str = "deleted", version: str = "updated_at") -> int:
        """Apply a change set: full new rows, and ``deleted`` (true or false); returns its commit.

        Of several changes to a key the newest counts; one that is older than the
        stored row is left out; a key that is deleted but not stored changes nothing.
        Applying a change set again leaves everything as it is.
        """
        columns = self._no_orders().columns
        gone = F.coalesce(F.col(deleted), F.lit(False)).alias("_gone")
        with staged(latest_per_key(changes.where("id IS NOT NULL").select(*columns, gone), "id", version), "changes") as latest:
            ranges = self._named("orders", latest)
            for _ in range(commits.TRIES):
                folders, number = self._current()

                def read(table: str, names: set[str], folders: dict[str, str] = folders) -> DataFrame:
                    return self._read(table, [folders[n] for n in sorted(names) if n in folders])

                stored = read("orders", ranges)
                marks = stored.select("id", F.col(version).alias("_stored"), F.lit(True).alias("_known"))
                wins = F.col("_known").isNull() | newer(F.col(version), F.col("_stored"))
                effective = latest.join(marks, "id", "left").where(wins).drop("_stored", "_known")
                with staged(effective, "effective") as news:
                    new = news.where("NOT _gone").select(*columns)
                    old = stored.join(news.select("id"), "id", "left_semi").select(*columns)
                    signed = new.withColumn("sign", F.lit(1)).unionByName(old.withColumn("sign", F.lit(-1)))
                    with staged(contributions(signed), "delta") as delta:
                        touched = {t: self._named(t, delta) for t in ("sales", "customers")}
                        made = {t: _summed(read(t, names).unionByName(delta)) for t, names in touched.items()}
                        made["orders"] = stored.join(news.select("id"), "id", "left_anti").select(*columns).unionByName(new)
                        try:
                            return self._write({t: lambda t=t: made[t] for t in made}, ranges | touched["sales"] | touched["customers"], number)
                        except commits.Overlap:
                            continue
        raise RuntimeError(f"other writers kept changing the same splits of {self.path}")

    # ---- reading -------------------------------------------------------------

    def _whole(self, table: str) -> DataFrame:
        folders, _ = self._current()
        return self._read(table, [folders[n] for n in sorted(folders) if n.startswith(f"{table}/")])

    def orders(self) -> DataFrame:
        return self._whole("orders")

    def daily_sales(self) -> DataFrame:
        return daily_sales_of(self._whole("sales"))

    def customer_360(self, customers: DataFrame, as_of: date) -> DataFrame:
        return customer_360_of(customers, purchase_behaviour_of(self._whole("customers"), as_of))
