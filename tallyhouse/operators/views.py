"""The two reporting views."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.money import ZERO, ratio
from ..functions.text import full_name
from .relational import revenue_orders


def paid_per_order(payments: DataFrame) -> DataFrame:
    """Completed payments at order grain: the only shape that joins without fan-out."""
    return (
        payments.where(F.col("status") == "Completed")
        .groupBy("order_id")
        .agg(F.sum("amount").alias("paid_amount"), F.count("*").alias("payment_count"))
    )


def view_order_summary(orders: DataFrame, customers: DataFrame, payments: DataFrame) -> DataFrame:
    """Orders with their customer, the paid amount and the open balance."""
    o = orders.select(
        F.col("id").alias("order_id"),
        "order_number",
        "order_date",
        F.col("status").alias("order_status"),
        F.col("total_amount").alias("order_total"),
        "channel",
        "customer_id",
    )
    c = customers.select(
        F.col("id").alias("customer_id"),
        "customer_code",
        F.col("email").alias("customer_email"),
        full_name(F.col("first_name"), F.col("last_name")).alias("customer_name"),
        F.col("segment").alias("customer_segment"),
    )
    paid = F.coalesce("paid_amount", F.lit(ZERO))
    return (
        o.join(paid_per_order(payments), "order_id", "left")
        .join(c, "customer_id")
        .select(
            "order_id",
            "order_number",
            "order_date",
            "order_status",
            "order_total",
            "channel",
            "customer_id",
            "customer_code",
            "customer_email",
            "customer_name",
            "customer_segment",
            paid.alias("paid_amount"),
            (F.col("order_total") - paid).alias("balance_due"),
            # The list of distinct statuses of completed payments is one word;
            # gathering strings would turn the hash aggregate into a sorting one.
            F.when(F.col("payment_count") > 0, "Completed").alias("payment_status"),
        )
    )


def view_daily_sales(orders: DataFrame, unique_ids: bool = False) -> DataFrame:
    """Sales per day and channel without cancelled and refunded orders.

    ``net_revenue`` is total minus discount although totals already are net of
    it, because that is how the published view defines it. The figure without the
    double deduction is ``net_revenue_after_discount``.

    With ``unique_ids`` (the primary-key rule has passed) orders are counted
    instead of told apart: days collapse by customer before the only large
    shuffle, instead of one shuffle row per order and per customer.
    """
    day_channel = ("order_date", "channel")
    kept = revenue_orders(orders)
    if unique_ids:
        days = (
            kept.groupBy(*day_channel, "customer_id")
            .agg(
                F.count("id").alias("ids"),
                F.sum("total_amount").alias("total"),
                F.count("total_amount").alias("totals"),
                F.sum("discount_amount").alias("discount"),
            )
            .groupBy(*day_channel)
            .agg(
                F.sum("ids").alias("order_count"),
                F.count("customer_id").alias("unique_customers"),
                F.sum("total").alias("total"),
                F.sum("totals").alias("totals"),
                F.sum("discount").alias("discount"),
            )
        )
    else:
        days = kept.groupBy(*day_channel).agg(
            F.count_distinct("id").alias("order_count"),
            F.count_distinct("customer_id").alias("unique_customers"),
            F.sum("total_amount").alias("total"),
            F.count("total_amount").alias("totals"),
            F.sum("discount_amount").alias("discount"),
        )
    total, discount = F.col("total"), F.col("discount")
    return days.select(
        *day_channel,
        "order_count",
        "unique_customers",
        total.alias("gross_revenue"),
        discount.alias("total_discount"),
        (total - discount).alias("net_revenue"),
        total.alias("net_revenue_after_discount"),
        ratio(total, F.col("totals")).alias("avg_order_value"),
    )


def in_report_order(daily_sales: DataFrame) -> DataFrame:
    """Newest day first, then channel: presentation only, kept out of the view."""
    return daily_sales.orderBy(F.desc("order_date"), "channel")
