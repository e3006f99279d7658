"""Filters, projections, joins, groupings and top-k over the source tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.dates import accounting_period
from ..functions.money import ZERO
from ..functions.text import has_word, masked_digits, masked_email
from ..schemas import NON_REVENUE_STATUSES
from ..workspace import broadcastable, stage


def revenue_orders(orders: DataFrame) -> DataFrame:
    """Orders that count as revenue. A NULL status is dropped, as in SQL."""
    return orders.where(~F.col("status").isin(*NON_REVENUE_STATUSES))


# ---- filters and projections -------------------------------------------------


def flt_order_status(orders: DataFrame, statuses: Sequence[str], keep: bool = True) -> DataFrame:
    wanted = F.col("status").isin(*statuses)
    return orders.where(wanted if keep else ~wanted)


def flt_email_pattern(customers: DataFrame, pattern: str = "%@%") -> DataFrame:
    """Customers whose e-mail does not match; a NULL e-mail is neither."""
    return customers.where(~F.col("email").like(pattern))


def prj_order_projection(orders: DataFrame) -> DataFrame:
    date, discount = F.col("order_date"), F.coalesce("discount_amount", F.lit(ZERO))
    return orders.select(
        F.col("id").alias("order_id"),
        "order_number",
        F.substring("order_number", 10, 6).alias("order_suffix"),
        F.col("status").alias("order_status"),
        F.concat("channel", F.lit(" / "), "status").alias("channel_status"),
        F.col("total_amount").alias("order_total"),
        discount.alias("discount_amount"),
        (F.col("total_amount") - discount).alias("net_amount"),
        F.round("total_amount", -3).cast("decimal(15,2)").alias("total_in_thousands"),
        F.abs(F.col("total_amount") - F.col("subtotal")).alias("total_to_subtotal"),
        accounting_period(date).alias("order_period"),
        F.trunc(date, "month").alias("order_month"),
        F.year(date).alias("order_year"),
        F.weekday(date).alias("order_weekday"),
        F.hour("order_timestamp").alias("order_hour"),
        F.date_add(date, 30).alias("due_date"),
    )


def txt_product_keyword(products: DataFrame, term: str) -> DataFrame:
    """Products whose name has ``term`` as a whole word, in any case."""
    return products.where(has_word(F.col("name"), term))


def sec_mask_customer(customers: DataFrame) -> DataFrame:
    """The customer table as a reader without access to personal data sees it."""
    return customers.select(
        "id",
        "customer_code",
        F.sha2("email", 256).alias("email_hash"),
        masked_email(F.col("email")).alias("email_masked"),
        F.mask("last_name").alias("last_name_masked"),
        masked_digits(F.col("phone")).alias("phone_masked"),
        "segment",
        "country",
    )


def json_field(df: DataFrame, column: str, path: str, dtype: str, name: str) -> DataFrame:
    """One typed field out of a JSON text column; NULL where absent."""
    return df.withColumn(name, F.get_json_object(column, path).cast(dtype))


# ---- joins -------------------------------------------------------------------


KEYS_PER_TASK = 1_000_000


def unknown_keys(asked: DataFrame, known: DataFrame) -> DataFrame:
    """Distinct values of the only column of ``asked`` that the one of ``known``, of the same name, lacks.

    The number of tasks follows the number of keys, so that one task never holds more of
    them as the tables grow, whatever a shuffle has as its usual number of partitions.
    """
    key = asked.columns[0]
    tasks = -(-(asked.count() + known.count()) // KEYS_PER_TASK)
    if tasks > 1:
        tasks = max(tasks, asked.sparkSession.sparkContext.defaultParallelism)
        asked, known = asked.repartition(tasks, key), known.repartition(tasks, key)
    return asked.distinct().join(known, key, "left_anti")


def jn_anti_orphans(child: DataFrame, fk: str, parent: DataFrame, parent_key: str = "id") -> DataFrame:
    """Rows of ``child`` without a parent; a NULL key counts as without.

    Rows with a NULL key match nothing and go by the join, so no shuffle brings them to
    one task. Where the parents are too many to broadcast, only keys travel to meet them,
    a hot one as a single row of what is sorted, and the rows are then picked by the keys found.
    """
    keyed, without = child.where(F.col(fk).isNotNull()), child.where(F.col(fk).isNull())
    keys = parent.select(F.col(parent_key).alias("_key")).where("_key IS NOT NULL")
    if broadcastable(keys):
        return keyed.join(keys, keyed[fk] == keys["_key"], "left_anti").unionByName(without)
    unknown = stage(unknown_keys(keyed.select(F.col(fk).alias("_key")), keys), "unknown")
    return keyed.join(unknown, keyed[fk] == unknown["_key"], "left_semi").unionByName(without)


def jn_orders_without_invoice(orders: DataFrame, invoices: DataFrame, status: str = "Completed") -> DataFrame:
    invoiced = invoices.select(F.col("order_id").alias("id")).distinct()
    return orders.where(F.col("status") == status).join(invoiced, "id", "left_anti")


def jn_key_lookup(df: DataFrame, code: str, stored: DataFrame, stored_code: str, stored_key: str, name: str) -> DataFrame:
    """Add the stored key of each business code; NULL where the code is unknown."""
    lookup = stored.select(F.col(stored_code).alias(code), F.col(stored_key).alias(name))
    return df.join(lookup, code, "left")


def _climbed(nodes: DataFrame, with_path: bool) -> DataFrame:
    """(id, root_id, depth, up, path): every node as far up as its parents lead, doubling the way each round.

    ``up`` is NULL where the root was reached. What is left after the logarithm of
    the number of nodes in rounds leads into a cycle. Nodes that have arrived rest.
    """
    path = F.col("name") if with_path else F.lit("")
    state = stage(nodes.select("id", F.col("id").alias("root_id"), F.lit(0).alias("depth"), F.col("parent_id").alias("up"), path.alias("path")), "tree")
    for _ in range(nodes.count().bit_length() + 1):
        climbing = state.where("up IS NOT NULL")
        if climbing.isEmpty():
            break
        above = state.select(
            F.col("id").alias("up"), F.col("root_id").alias("_root"), F.col("depth").alias("_depth"), F.col("up").alias("_up"), F.col("path").alias("_path")
        )
        joined = F.concat("_path", F.lit(" > "), "path") if with_path else F.lit("")
        moved = climbing.join(above, "up").select("id", F.col("_root").alias("root_id"), (F.col("depth") + 1 + F.col("_depth")).alias("depth"), F.col("_up").alias("up"), joined.alias("path"))
        state = stage(state.where("up IS NULL").unionByName(moved), "tree")
    return state


def jn_category_tree(categories: DataFrame) -> DataFrame:
    """Root, depth and path of every category, however deep the tree.

    A category without parent, or with an unknown one, is a root. Categories on or
    below a cycle come out with status 'CYCLE' and no root: the first climb finds
    them without paths, which would grow round and round, the second one joins the
    names of all others.
    """
    nodes = categories.select("id", "name", "parent_id")
    known = nodes.select(F.col("id").alias("known_id"))
    nodes = nodes.join(known, nodes.parent_id == known.known_id, "left").select("id", "name", F.col("known_id").alias("parent_id"))
    nodes = stage(nodes, "nodes")
    rooted = _climbed(nodes, with_path=False).where("up IS NULL").select("id")
    placed = _climbed(stage(nodes.join(rooted, "id", "left_semi"), "nodes"), with_path=True)
    placed = placed.select(F.col("id").alias("_id"), "root_id", "depth", "path")
    return nodes.join(placed, nodes.id == placed["_id"], "left").select(
        "id",
        "name",
        "parent_id",
        "root_id",
        "depth",
        "path",
        F.when(F.col("root_id").isNull(), "CYCLE").otherwise("OK").alias("status"),
    )


# ---- groupings ---------------------------------------------------------------


def agg_distinct_counts(orders: DataFrame) -> DataFrame:
    return orders.groupBy("channel").agg(
        F.count("*").alias("row_count"),
        F.count_distinct("id").alias("order_count"),
        F.count_distinct("customer_id").alias("unique_customers"),
    )


def agg_string_agg_status(payments: DataFrame) -> DataFrame:
    """Distinct payment statuses per order, in alphabetical order.

    A set merges map-side and needs one shuffle; DISTINCT inside listagg needs two.
    """
    statuses = F.array_sort(F.collect_set("status"))
    return payments.groupBy("order_id").agg(
        F.when(F.size(statuses) > 0, F.array_join(statuses, ", ")).alias("payment_status"),
        F.count("*").alias("payment_count"),
    )


def agg_date_range(orders: DataFrame) -> DataFrame:
    return orders.agg(F.min("order_date").alias("min_date"), F.max("order_date").alias("max_date"))


def top_customers(customers: DataFrame, orders: DataFrame, k: int = 10) -> DataFrame:
    """Customers by total spend over all their orders, whatever the status."""
    spend = orders.groupBy("customer_id").agg(
        F.count("id").alias("order_count"), F.sum("total_amount").alias("total_spent")
    )
    return (
        customers.select(F.col("id").alias("customer_id"), "customer_code", "email")
        .join(spend, "customer_id")
        .orderBy(F.desc("total_spent"), "customer_id")
        .limit(k)
        .select("customer_code", "email", "order_count", "total_spent")
    )


def set_domain_diff(df: DataFrame, column: str, allowed: Sequence[str], ignore_null: bool = False) -> DataFrame:
    """Distinct values outside the allowed set; NULL is outside unless ignored."""
    value = F.col(column)
    outside = ~value.isin(*allowed)
    outside = outside if ignore_null else outside | value.isNull()
    return df.where(outside).select(F.lit(column).alias("column_name"), value.cast("string").alias("value")).distinct()
