"""Star schema: dimensions, history, facts, business codes.

Surrogate keys are hashes of the source key: stable between runs, computed
wherever a row is, so facts need no lookup join and no global numbering. A NULL
key is never hashed: it is the key of the unknown member every dimension has.
``fact_dim_integrity`` counts fact rows without a dimension row and dimension keys
that occur twice, be it by a copy or by a collision.
"""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions.dates import accounting_period
from ..functions.money import ZERO, line_total
from ..functions.text import business_code, full_name
from ..workspace import sized, stage
from .views import paid_per_order

UNKNOWN = "Unknown"


UNKNOWN_KEY = -1


def surrogate_key(*natural: Column | str) -> Column:
    """A hash of the key columns, or the unknown key where one of them is NULL."""
    columns = [F.col(c) if isinstance(c, str) else c for c in natural]
    missing = reduce(lambda a, b: a | b, (c.isNull() for c in columns))
    return F.when(missing, F.lit(UNKNOWN_KEY).cast("bigint")).otherwise(F.xxhash64(*columns))


def id_key(column: Column | str) -> Column:
    """Key of a customer or product by its id, whatever integer type the source has."""
    return surrogate_key((F.col(column) if isinstance(column, str) else column).cast("bigint"))


def with_unknown(dimension: DataFrame, key: str, label: str) -> DataFrame:
    """The dimension and its unknown member: the unknown key, a label, all else NULL."""
    values = {key: UNKNOWN_KEY, label: UNKNOWN}
    row = [F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in dimension.schema.fields]
    return dimension.unionByName(dimension.sparkSession.range(1).select(*row))


def date_key(day: Column) -> Column:
    return F.year(day) * 10000 + F.month(day) * 100 + F.day(day)


def channel_name(channel: Column) -> Column:
    return F.coalesce(channel, F.lit(UNKNOWN))


# ---- dimensions --------------------------------------------------------------


def _calendar(days: DataFrame) -> DataFrame:
    d = F.col("date")
    return days.select(
        date_key(d).alias("date_key"),
        d,
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.day(d).alias("day"),
        (F.weekday(d) + 1).alias("iso_weekday"),
        F.weekofyear(d).alias("iso_week"),
        (F.weekday(d) >= 5).alias("is_weekend"),
        F.trunc(d, "month").alias("month_start"),
        accounting_period(d).alias("accounting_period"),
    )


def dim_date(spark: SparkSession, start: date, end: date) -> DataFrame:
    return _calendar(spark.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(end))).alias("date")))


def dim_date_of(df: DataFrame, column: str) -> DataFrame:
    """Calendar without gaps from the first to the last date of a column."""
    span = df.agg(F.min(column).alias("start"), F.max(column).alias("end"))
    return _calendar(span.select(F.explode(F.sequence("start", "end")).alias("date")))


def dim_customer(customers: DataFrame) -> DataFrame:
    found = customers.select(
        id_key("id").alias("customer_key"),
        F.col("id").alias("customer_id"),
        "customer_code",
        full_name(F.col("first_name"), F.col("last_name")).alias("customer_name"),
        "email",
        "segment",
        "city",
        "country",
        "registration_date",
        "is_active",
    )
    return with_unknown(found, "customer_key", "customer_name")


def dim_product(products: DataFrame, categories: DataFrame) -> DataFrame:
    c = categories.select(
        F.col("id").alias("category_id"), F.col("name").alias("category_name"), F.col("parent_id").alias("parent_category_id")
    )
    found = products.join(c, "category_id", "left").select(
        id_key(products.id).alias("product_key"),
        F.col("id").alias("product_id"),
        "sku",
        products.name.alias("product_name"),
        "category_id",
        "category_name",
        "parent_category_id",
        "unit_price",
        "cost_price",
        "is_active",
    )
    return with_unknown(found, "product_key", "product_name")


def dim_channel(orders: DataFrame) -> DataFrame:
    """Channels of the orders, and the one of rows whose channel or order is not known."""
    unknown = orders.sparkSession.range(1).select(F.lit(UNKNOWN).alias("channel"))
    named = orders.select(channel_name(F.col("channel")).alias("channel")).unionByName(unknown).distinct()
    return named.select(surrogate_key("channel").alias("channel_key"), "channel")


def dim_customer_scd2(snapshots: DataFrame, tracked: list[str], pk: str = "id", day: str = "snapshot_date") -> DataFrame:
    """Type-2 history out of dated snapshots.

    A version opens where a tracked column changes and closes at the next version,
    or at the first snapshot the key is missing from. Copies of a key within a
    snapshot collapse first, so a key has at most one row per snapshot day.
    """
    state = F.struct(*tracked)
    daily = snapshots.groupBy(pk, day).agg(F.max(state).alias("state"))
    # One row per snapshot day: bounded by the number of snapshots, not by rows.
    calendar = snapshots.select(day).distinct()
    following = calendar.select(F.col(day), F.lead(day).over(Window.orderBy(day)).alias("next_day"))
    by_key = Window.partitionBy(pk).orderBy(day)
    seen = daily.join(following, day).select(
        pk,
        day,
        "state",
        "next_day",
        F.lag("state").over(by_key).alias("before"),
        F.lag("next_day").over(by_key).alias("expected_day"),
    )
    # A gap since the previous sighting means the key was away: a new version.
    opens = F.col("before").isNull() | ~F.equal_null("before", "state") | (F.col("expected_day") < F.col(day))
    versions = (
        seen.withColumn("version", F.sum(F.when(opens, 1).otherwise(0)).over(by_key))
        .groupBy(pk, "version")
        .agg(F.min(day).alias("valid_from"), F.max_by("next_day", day).alias("valid_to"), F.max("state").alias("state"))
    )
    return versions.select(
        surrogate_key(F.col(pk), F.col("valid_from")).alias("version_key"),
        pk,
        *(F.col(f"state.{c}").alias(c) for c in tracked),
        "valid_from",
        "valid_to",
        F.col("valid_to").isNull().alias("is_current"),
    )


def scd2_apply(history: DataFrame, snapshot: DataFrame, day: date, tracked: list[str], pk: str = "id") -> DataFrame:
    """A stored type-2 history with the snapshot of one more day applied.

    The result equals a rebuild from all snapshots up to ``day``. Only open
    versions take part in the join; closed ones pass by.
    """
    state = F.struct(*tracked)
    today = snapshot.groupBy(pk).agg(F.max(state).alias("_today"))
    open_rows = history.where("is_current").select(F.col(pk), "version_key", state.alias("_state"), "valid_from")
    # Outer join on a key that may be NULL in neither: a key is one row on either side.
    both = open_rows.join(today, pk, "full")
    stays = F.col("version_key").isNotNull() & F.col("_today").isNotNull() & F.equal_null("_state", "_today")
    new_day = F.lit(day)

    def version(key: Column, of: Column, start: Column, end: Column) -> Column:
        return F.struct(key.alias("version_key"), of.alias("state"), start.alias("valid_from"), end.alias("valid_to"))

    never = F.lit(None).cast("date")
    old = F.when(
        F.col("version_key").isNotNull(),
        version(F.col("version_key"), F.col("_state"), F.col("valid_from"), F.when(~stays, new_day).otherwise(never)),
    )
    opened = F.when(
        F.col("_today").isNotNull() & ~stays,
        version(surrogate_key(F.col(pk), new_day), F.col("_today"), new_day, never),
    )
    now = both.select(pk, F.explode(F.array_compact(F.array(old, opened))).alias("v"))
    columns = ("version_key", pk, *tracked, "valid_from", "valid_to", "is_current")
    applied = now.select(
        "v.version_key", pk, *(F.col(f"v.state.{c}").alias(c) for c in tracked), "v.valid_from", "v.valid_to",
        F.col("v.valid_to").isNull().alias("is_current"),
    )
    return history.where(~F.col("is_current")).select(*columns).unionByName(applied.select(*columns))


def jn_scd2_lookup(facts: DataFrame, history: DataFrame, key: str, day: str, pk: str = "id") -> DataFrame:
    """Facts with the dimension version valid on their day; NULLs if there was none."""
    h = history.withColumnsRenamed({pk: "_pk", "valid_from": "version_from", "valid_to": "version_to"})
    valid = (facts[day] >= h.version_from) & (h.version_to.isNull() | (facts[day] < h.version_to))
    return facts.join(h, (facts[key] == h["_pk"]) & valid, "left").drop("_pk")


def jn_scd2_sweep(facts: DataFrame, history: DataFrame, key: str, day: str, pk: str = "id") -> DataFrame:
    """``jn_scd2_lookup`` by one sweep over facts and versions in the order of key and day.

    The join lets every version of a key meet all its facts; here each row is looked
    at once. Both kinds are range-partitioned together, so a key with a third of all
    facts lies in as many partitions as it fills. Within a partition the last version
    is carried forward; what a partition begins with comes from a pass over one row
    per partition. Versions of a key must not overlap, as ``dim_customer_scd2`` makes
    them; a version without key meets nothing, as does a fact without key or day.
    """
    versions = history.where(F.col(pk).isNotNull() & F.col("valid_from").isNotNull())
    named = versions.withColumnsRenamed({pk: "_pk", "valid_from": "version_from", "valid_to": "version_to"}).drop("_pk")
    carried_columns = named.columns
    fact = F.struct(*(facts[c] for c in facts.columns))
    events = (
        versions.select(F.col(pk).alias("_key"), F.col("valid_from").alias("_day"), F.lit(0).alias("_kind"), F.struct(
            *(F.col({"version_from": "valid_from", "version_to": "valid_to"}.get(c, c)).alias(c) for c in carried_columns)
        ).alias("_version"))
        .unionByName(
            facts.select(facts[key].alias("_key"), facts[day].alias("_day"), F.lit(1).alias("_kind"), fact.alias("_fact")),
            allowMissingColumns=True,
        )
    )
    # The salt lets facts of one key and day, and facts without key, lie in several partitions.
    salted = events.withColumn("_salt", F.when(F.col("_kind") == 1, F.xxhash64("_fact")).otherwise(F.lit(-(2**63))))
    order = ("_key", "_day", "_kind", "_salt")
    ranged = stage(salted.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "sweep")
    ends = ranged.where("_kind = 0").groupBy("_part").agg(F.max(F.struct("_key", "_day", "_version")).alias("_end"))
    parts = ranged.select("_part").distinct().join(ends, "_part", "left")
    # One row per partition: the last version before its first row.
    before = F.max("_end").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    begins = sized(stage(parts.select("_part", before.alias("_begin")), "sweep-begins"))
    own = Window.partitionBy("_part", "_key").orderBy("_day", "_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = ranged.withColumn("_last", F.last("_version", ignorenulls=True).over(own)).where("_kind = 1").join(begins, "_part", "left")
    last = F.coalesce("_last", F.when(F.col("_begin._key") == F.col("_key"), F.col("_begin._version")))
    found = swept.select("_fact", "_day", last.alias("_found"))
    valid = (F.col("_day") >= F.col("_found.version_from")) & (F.col("_found.version_to").isNull() | (F.col("_day") < F.col("_found.version_to")))
    return found.select(*(F.col("_fact")[c].alias(c) for c in facts.columns), *(F.when(valid, F.col("_found")[c]).alias(c) for c in carried_columns))


# ---- facts -------------------------------------------------------------------


def fact_order(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Orders with their keys, amounts and what has been paid."""
    paid = F.coalesce("paid_amount", F.lit(ZERO))
    return orders.join(paid_per_order(payments), orders.id == F.col("order_id"), "left").select(
        orders.id.alias("order_id"),
        "order_number",
        "customer_id",
        id_key("customer_id").alias("customer_key"),
        surrogate_key(channel_name(F.col("channel"))).alias("channel_key"),
        date_key(F.col("order_date")).alias("date_key"),
        "order_date",
        "channel",
        F.col("status").alias("order_status"),
        "subtotal",
        "discount_amount",
        "tax_amount",
        "shipping_fee",
        "total_amount",
        paid.alias("paid_amount"),
        F.coalesce("payment_count", F.lit(0)).alias("payment_count"),
    )


def fact_orderline(items: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """Every order line with its keys, the recomputed line total, cost and margin.

    A line whose order or product is not known keeps its amounts; what the order
    or product would add is NULL, and the keys are those of the unknown members.
    """
    o = orders.select(
        F.col("id").alias("order_id"), "order_number", "customer_id", "order_date", "channel", F.col("status").alias("order_status")
    )
    p = products.select(F.col("id").alias("product_id"), "cost_price")
    cost = (F.col("quantity") * F.col("cost_price")).cast("decimal(15,2)")
    return (
        items.join(o, "order_id", "left")
        .join(p, "product_id", "left")
        .select(
            items.id.alias("order_item_id"),
            "order_id",
            "order_number",
            "customer_id",
            "product_id",
            id_key("customer_id").alias("customer_key"),
            id_key("product_id").alias("product_key"),
            surrogate_key(channel_name(F.col("channel"))).alias("channel_key"),
            date_key(F.col("order_date")).alias("date_key"),
            "order_date",
            "channel",
            "order_status",
            "quantity",
            "unit_price",
            "discount_percent",
            "line_total",
            line_total(F.col("quantity"), F.col("unit_price"), F.col("discount_percent")).alias("recomputed_total"),
            cost.alias("cost_amount"),
            (F.col("line_total") - cost).alias("margin_amount"),
        )
    )


def fact_payment(payments: DataFrame, orders: DataFrame) -> DataFrame:
    o = orders.select(F.col("id").alias("order_id"), "customer_id", "order_date", "channel")
    return payments.join(o, "order_id", "left").select(
        payments.id.alias("payment_id"),
        "payment_code",
        "order_id",
        "customer_id",
        id_key("customer_id").alias("customer_key"),
        surrogate_key(channel_name(F.col("channel"))).alias("channel_key"),
        date_key(F.col("payment_date")).alias("date_key"),
        "payment_date",
        "payment_method",
        "payment_gateway",
        F.col("status").alias("payment_status"),
        "amount",
        F.datediff("payment_date", "order_date").alias("days_to_pay"),
        F.col("order_date").isNotNull().alias("has_order"),
    )


def fact_invoice(invoices: DataFrame, orders: DataFrame) -> DataFrame:
    o = orders.select(F.col("id").alias("order_id"), "order_date", "channel")
    return invoices.join(o, "order_id", "left").select(
        invoices.id.alias("invoice_id"),
        "invoice_number",
        "order_id",
        "customer_id",
        id_key("customer_id").alias("customer_key"),
        surrogate_key(channel_name(F.col("channel"))).alias("channel_key"),
        date_key(F.col("invoice_date")).alias("date_key"),
        "invoice_date",
        F.date_add("invoice_date", 30).alias("due_date"),
        accounting_period(F.col("invoice_date")).alias("accounting_period"),
        "subtotal",
        "tax_amount",
        "total_amount",
        F.col("status").alias("invoice_status"),
        F.datediff("invoice_date", "order_date").alias("days_to_invoice"),
    )


# ---- integrity ---------------------------------------------------------------


def fact_dim_integrity(facts: dict[str, DataFrame], dimensions: dict[str, DataFrame]) -> DataFrame:
    """Per fact and dimension: rows, rows of the unknown member, rows without dimension row, repeated keys.

    A dimension's first column is its key; facts carry it under the same name.
    Fact rows are counted per key before they meet the dimension.
    """
    parts = []
    for fact_name, fact in facts.items():
        for name, dimension in dimensions.items():
            key = dimension.columns[0]
            if key not in fact.columns:
                continue
            used = fact.groupBy(F.col(key).alias("k")).agg(F.count("*").alias("rows"))
            keys = dimension.groupBy(F.col(key).alias("k")).agg(F.count("*").alias("times"))
            parts.append(
                used.join(keys, "k", "full").agg(
                    F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
                    F.coalesce(F.sum(F.when(F.col("k") == UNKNOWN_KEY, F.col("rows"))), F.lit(0)).alias("unknown_rows"),
                    F.coalesce(F.sum(F.when(F.col("times").isNull(), F.col("rows"))), F.lit(0)).alias("rows_without_member"),
                    F.count_if(F.col("times") > 1).alias("repeated_keys"),
                ).select(F.lit(fact_name).alias("fact"), F.lit(name).alias("dimension"), "*")
            )
    return reduce(DataFrame.unionByName, parts)


# ---- codes -------------------------------------------------------------------


def util_code_sequence(df: DataFrame, prefix: str, year: int, order_by: list[str], start: int = 1, name: str = "code") -> DataFrame:
    """Number rows from ``start`` in the given order and format business codes.

    ``order_by`` must be unique. Rows are range-partitioned and sorted, staged
    with their place inside the partition, and shifted by the sizes of the
    partitions before: no step sees all rows in one task.
    """
    placed = (
        df.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .withColumns({"_part": F.spark_partition_id(), "_place": F.monotonically_increasing_id()})
    )
    placed = stage(placed, "sequence")
    sizes = placed.groupBy("_part").agg(F.count("*").alias("n"), F.min("_place").alias("_first"))
    # One row per partition.
    running = F.sum("n").over(Window.orderBy("_part")) - F.col("n")
    offsets = sizes.select("_part", "_first", running.alias("_before"))
    number = F.col("_place") - F.col("_first") + F.col("_before") + start
    return (
        placed.join(offsets, "_part")
        .withColumn(name, business_code(prefix, year, number))
        .drop("_part", "_place", "_first", "_before")
    )
