"""One row per customer, and the segment summary built on it."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from ..functions.money import ZERO, ratio
from ..functions.text import full_name
from .relational import revenue_orders
from .rfm import rfm_score, rfm_segment, trailing_year


def purchase_behaviour(orders: DataFrame, as_of: date) -> DataFrame:
    """Purchase figures and channel use per customer.

    Grouped by customer and channel first, then by customer: the first step cuts
    every customer, however busy, to one row per channel.
    """
    completed = F.when(F.col("status") == "Completed", F.col("total_amount"))
    by_channel = (
        revenue_orders(orders)
        .where(F.col("order_date") <= F.lit(as_of))
        .groupBy("customer_id", "channel")
        .agg(
            F.count("*").alias("n"),
            F.count_if(trailing_year(F.col("order_date"), as_of)).alias("n_year"),
            F.sum("total_amount").alias("spent"),
            F.sum(completed).alias("completed"),
            F.min("order_date").alias("first"),
            F.max("order_date").alias("last"),
        )
    )
    return by_channel.groupBy("customer_id").agg(
        F.sum("n").alias("order_count"),
        F.sum("spent").alias("monetary"),
        F.sum("completed").alias("lifetime_value"),
        F.min("first").alias("first_order_date"),
        F.max("last").alias("last_order_date"),
        F.datediff(F.lit(as_of), F.max("last")).alias("recency_days"),
        F.sum("n_year").alias("frequency"),
        F.count("channel").alias("channel_count"),
        F.max_by("channel", F.struct("n", "channel")).alias("preferred_channel"),
    )


def mart_customer_360(customers: DataFrame, orders: DataFrame, as_of: date) -> DataFrame:
    """Identity, purchase behaviour, channels, RFM and lifetime value."""
    return customer_360_of(customers, purchase_behaviour(orders, as_of))


def customer_360_of(customers: DataFrame, behaviour: DataFrame) -> DataFrame:
    """The mart from purchase figures that are already there."""
    scored = rfm_segment(rfm_score(behaviour))
    who = customers.select(
        F.col("id").alias("customer_id"),
        "customer_code",
        full_name(F.col("first_name"), F.col("last_name")).alias("customer_name"),
        "email",
        "segment",
        "country",
        "registration_date",
        "is_active",
    )
    return who.join(scored, "customer_id", "left").select(
        *who.columns,
        F.coalesce("order_count", F.lit(0)).alias("order_count"),
        F.coalesce("monetary", F.lit(ZERO)).alias("total_spent"),
        F.coalesce("lifetime_value", F.lit(ZERO)).alias("lifetime_value"),
        ratio(F.col("monetary"), F.col("order_count")).alias("avg_order_value"),
        "first_order_date",
        "last_order_date",
        "recency_days",
        F.coalesce("frequency", F.lit(0)).alias("frequency_12m"),
        F.coalesce("channel_count", F.lit(0)).alias("channel_count"),
        "preferred_channel",
        "r_score",
        "f_score",
        "m_score",
        "rfm_code",
        F.coalesce("rfm_segment", F.lit("No purchase")).alias("rfm_segment"),
    )


def mart_segment_summary(customer_360: DataFrame) -> DataFrame:
    revenue, orders = F.sum("total_spent"), F.sum("order_count")
    return customer_360.groupBy("rfm_segment").agg(
        F.count("*").alias("customers"),
        orders.alias("orders"),
        revenue.alias("revenue"),
        ratio(revenue, orders).alias("avg_order_value"),
    )
