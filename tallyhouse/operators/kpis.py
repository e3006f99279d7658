"""Revenue, customer and operations key figures."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.dates import by_grains, months_spanned, period_start
from ..functions.money import ZERO, ratio
from .relational import revenue_orders

CHURN_DAYS = 90


def with_share(groups: DataFrame, measure: str, name: str = "share") -> DataFrame:
    """Each group's share of the total. The total is a scalar subquery over the
    grouped rows: no global window and no second pass over the input."""
    total = groups.select(F.sum(measure).cast("double")).scalar()
    return groups.withColumn(name, F.try_divide(F.col(measure).cast("double"), total))


# ---- revenue -----------------------------------------------------------------


def kpi_customer_ltv(orders: DataFrame) -> DataFrame:
    return (
        orders.where(F.col("status") == "Completed")
        .groupBy("customer_id")
        .agg(F.sum("total_amount").alias("lifetime_value"))
    )


def kpi_monthly_revenue(orders: DataFrame) -> DataFrame:
    return (
        orders.where(F.col("status") == "Completed")
        .groupBy(period_start(F.col("order_date"), "month").alias("month"))
        .agg(F.count("*").alias("orders"), F.sum("total_amount").alias("revenue"))
    )


def kpi_revenue_by_period(orders: DataFrame, grain: str = "month") -> DataFrame:
    return (
        revenue_orders(orders)
        .groupBy(period_start(F.col("order_date"), grain).alias("period"))
        .agg(F.count("*").alias("orders"), F.sum("total_amount").alias("revenue"))
    )


GRAINS = ("day", "week", "month", "all")


def daily_revenue(orders: DataFrame) -> DataFrame:
    """Orders and revenue per day and channel: what longer grains and totals add up."""
    return revenue_orders(orders).groupBy("order_date", "channel").agg(F.count("*").alias("orders"), F.sum("total_amount").alias("revenue"))


def kpi_revenue_grains(orders: DataFrame, grains: tuple[str, ...] = GRAINS) -> DataFrame:
    """Orders and revenue of every grain, per channel and over all, out of one scan: period, grain, channel, total_channel, …"""
    sums = [F.sum("orders").alias("orders"), F.sum("revenue").alias("revenue")]
    return by_grains(daily_revenue(orders), "order_date", grains, sums, [["channel"], []])


def kpi_revenue_by_periods(orders: DataFrame, grains: tuple[str, ...] = ("day", "week", "month")) -> DataFrame:
    """``kpi_revenue_by_period`` of several grains out of one scan, with the grain."""
    sums = [F.sum("orders").alias("orders"), F.sum("revenue").alias("revenue")]
    return by_grains(daily_revenue(orders), "order_date", grains, sums)


def customer_bitmaps(orders: DataFrame) -> DataFrame:
    """Who bought on which day, as bitmaps: order_date, bucket, bitmap, four kilobytes for 32,768 customer numbers.

    Bitmaps of several loads of a day are united by ``united_bitmaps``, so a kept
    table takes late orders; a customer counts once however often they come.
    """
    return (
        revenue_orders(orders)
        .where("customer_id IS NOT NULL")
        .groupBy("order_date", F.bitmap_bucket_number("customer_id").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("customer_id")).alias("bitmap"))
    )


def united_bitmaps(stored: DataFrame, more: DataFrame) -> DataFrame:
    """Two tables of bitmaps as one, a row per day and bucket."""
    return stored.unionByName(more).groupBy("order_date", "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def kpi_unique_customers(bitmaps: DataFrame, grains: tuple[str, ...] = GRAINS) -> DataFrame:
    """Distinct customers of every grain, exactly, from daily bitmaps: no order is read again."""
    united = by_grains(bitmaps, "order_date", grains, [F.bitmap_or_agg("bitmap").alias("bitmap")], [["bucket"]])
    return united.groupBy("period", "grain").agg(F.sum(F.bitmap_count("bitmap")).alias("unique_customers"))


def kpi_revenue_by_channel(orders: DataFrame, grain: str = "month") -> DataFrame:
    return (
        revenue_orders(orders)
        .groupBy(period_start(F.col("order_date"), grain).alias("period"), "channel")
        .agg(F.count("*").alias("orders"), F.sum("total_amount").alias("revenue"))
    )


def kpi_revenue_growth(orders: DataFrame) -> DataFrame:
    """Month-over-month and year-over-year growth in percent.

    Months without revenue appear with 0. Earlier months come by equal join on
    the shifted month, so nothing runs in one unpartitioned window.
    """
    monthly = kpi_revenue_by_period(orders, "month").select(F.col("period").alias("month"), "revenue")
    months = monthly.agg(F.min("month").alias("first"), F.max("month").alias("last")).select(
        F.explode(F.sequence("first", "last", F.make_ym_interval(months=F.lit(1)))).alias("month")
    )
    filled = months.join(monthly, "month", "left").select("month", F.coalesce("revenue", F.lit(ZERO)).alias("revenue"))

    def earlier(months_back: int, name: str) -> DataFrame:
        return filled.select(F.add_months("month", months_back).alias("month"), F.col("revenue").alias(name))

    def growth(before: str) -> Column:
        return ratio(F.col("revenue") - F.col(before), F.col(before)) * 100

    return (
        filled.join(earlier(1, "previous_month"), "month", "left")
        .join(earlier(12, "previous_year"), "month", "left")
        .select(
            "month",
            "revenue",
            "previous_month",
            "previous_year",
            growth("previous_month").alias("mom_percent"),
            growth("previous_year").alias("yoy_percent"),
        )
    )


def kpi_aov(orders: DataFrame) -> DataFrame:
    """Average order value over revenue orders."""
    total, n = F.sum("total_amount"), F.count_distinct("id")
    return revenue_orders(orders).agg(
        total.alias("revenue"), n.alias("orders"), ratio(total, n).alias("avg_order_value")
    )


def kpi_gross_revenue(orders: DataFrame) -> DataFrame:
    return revenue_orders(orders).agg(F.sum("total_amount").alias("gross_revenue"))


def kpi_net_revenue(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Sum of total - discount - refund over all orders; refunds are the
    payments in state Refunded that belong to an order."""
    refunds = (
        payments.where(F.col("status") == "Refunded").groupBy("order_id").agg(F.sum("amount").alias("refund_amount"))
    )
    refund = F.coalesce("refund_amount", F.lit(ZERO))
    discount = F.coalesce("discount_amount", F.lit(ZERO))
    return (
        orders.join(refunds, orders.id == refunds.order_id, "left")
        .agg(
            F.sum("total_amount").alias("order_total"),
            F.sum(discount).alias("discount"),
            F.sum(refund).alias("refund"),
        )
        .withColumn("net_revenue", F.col("order_total") - F.col("discount") - F.col("refund"))
    )


def kpi_gross_margin_by_category(items: DataFrame, products: DataFrame, categories: DataFrame) -> DataFrame:
    """Margin per category over lines with a known cost; the others are counted.

    Lines whose product or category is not known come out under the NULL category.
    Lines are summed per product before any join: a best-seller costs one row.
    """
    sold = items.groupBy("product_id").agg(
        F.sum("quantity").alias("quantity"), F.sum("line_total").alias("revenue"), F.count("*").alias("lines")
    )
    p = products.select(F.col("id").alias("product_id"), "category_id", "cost_price")
    c = categories.select(F.col("id").alias("category_id"), F.col("name").alias("category_name"))
    known = F.col("cost_price").isNotNull()
    revenue = F.sum(F.when(known, F.col("revenue")))
    cost = F.sum(F.when(known, (F.col("quantity") * F.col("cost_price")).cast("decimal(25,2)")))
    return (
        sold.join(p, "product_id", "left")
        .join(c, "category_id", "left")
        .groupBy("category_id", "category_name")
        .agg(
            revenue.alias("revenue"),
            cost.alias("cost"),
            (ratio(revenue - cost, revenue) * 100).alias("margin_percent"),
            F.sum(F.when(known, 0).otherwise(F.col("lines"))).alias("lines_without_cost"),
        )
    )


# ---- customers ---------------------------------------------------------------


def kpi_new_customers(customers: DataFrame) -> DataFrame:
    return customers.groupBy(period_start(F.col("registration_date"), "month").alias("month")).agg(
        F.count("*").alias("new_customers")
    )


def kpi_repeat_rate(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Customers with two or more orders over all customers."""
    counts = orders.groupBy(F.col("customer_id").alias("id")).agg(F.count("*").alias("n"))
    repeat, total = F.count_if(F.col("n") >= 2), F.count("*")
    return (
        customers.select("id")
        .join(counts, "id", "left")
        .agg(repeat.alias("repeat_customers"), total.alias("customers"), ratio(repeat, total).alias("repeat_rate"))
    )


def kpi_segment_distribution(customers: DataFrame) -> DataFrame:
    return with_share(customers.groupBy("segment").agg(F.count("*").alias("customers")), "customers")


def kpi_clv(orders: DataFrame, lifespan_months: int = 36) -> DataFrame:
    """Average order value x orders per active month x lifespan, per customer.

    Active months run from the first to the last order, both included, so the
    product is total spend / active months x lifespan.
    """
    per_customer = (
        revenue_orders(orders)
        .groupBy("customer_id")
        .agg(
            F.count("*").alias("orders"),
            F.sum("total_amount").alias("spent"),
            F.min("order_date").alias("first_order"),
            F.max("order_date").alias("last_order"),
        )
    )
    active = months_spanned(F.col("first_order"), F.col("last_order"))
    clv = F.round((F.col("spent") * lifespan_months).cast("decimal(27,2)") / active, 2)
    return per_customer.select(
        "customer_id",
        "orders",
        ratio(F.col("spent"), F.col("orders")).alias("avg_order_value"),
        active.alias("active_months"),
        ratio(F.col("orders"), active).alias("orders_per_month"),
        clv.cast("decimal(27,2)").alias("clv"),
    )


def kpi_average_clv(orders: DataFrame, lifespan_months: int = 36) -> DataFrame:
    """Mean lifetime value over customers with revenue."""
    total, n = F.sum("clv"), F.count("*")
    return kpi_clv(orders, lifespan_months).agg(n.alias("customers"), ratio(total, n).alias("avg_clv"))


def _last_orders(orders: DataFrame, as_of: date) -> DataFrame:
    return (
        revenue_orders(orders)
        .where(F.col("order_date") <= F.lit(as_of))
        .groupBy(F.col("customer_id").alias("id"))
        .agg(
            F.count("*").alias("orders"),
            F.min("order_date").alias("first_order"),
            F.max("order_date").alias("last_order"),
        )
    )


def kpi_churn_rate(customers: DataFrame, orders: DataFrame, as_of: date, days: int = CHURN_DAYS) -> DataFrame:
    """Active customers without a purchase in the last ``days`` days over all
    active customers; who never purchased counts as churned."""
    silent = F.col("last_order").isNull() | (F.datediff(F.lit(as_of), "last_order") > days)
    churned, total = F.count_if(silent), F.count("*")
    return (
        customers.where("is_active")
        .select("id")
        .join(_last_orders(orders, as_of).select("id", "last_order"), "id", "left")
        .agg(churned.alias("churned"), total.alias("active_customers"), ratio(churned, total).alias("churn_rate"))
    )


def kpi_churn_risk(customers: DataFrame, orders: DataFrame, as_of: date, days: int = CHURN_DAYS) -> DataFrame:
    """Days since the last order against the customer's usual gap.

    The mean gap between successive orders is (last - first) / (n - 1): no window
    over a customer's orders is needed. Customers without a usual gap are measured
    against the churn limit. Score below 1 is low, below 2 medium, else high.
    """
    since = F.datediff(F.lit(as_of), "last_order")
    gap = ratio(F.datediff("last_order", "first_order"), F.col("orders") - 1)
    score = F.coalesce(F.try_divide(F.col("days_since_last").cast("double"), F.col("mean_gap_days")),
                       F.col("days_since_last") / F.lit(float(days)))
    return (
        customers.select("id")
        .join(_last_orders(orders, as_of), "id", "left")
        .select(
            F.col("id").alias("customer_id"),
            F.coalesce("orders", F.lit(0)).alias("orders"),
            since.alias("days_since_last"),
            gap.alias("mean_gap_days"),
        )
        .withColumn("risk_score", score)
        .withColumn(
            "risk_band",
            F.when(F.col("orders") == 0, "No purchase")
            .when(F.col("risk_score") < 1, "Low")
            .when(F.col("risk_score") < 2, "Medium")
            .otherwise("High"),
        )
    )


def kpi_cac(spend: DataFrame, customers: DataFrame) -> DataFrame:
    """Marketing spend (given by the caller as month, spend) per new customer, for every month with either."""
    monthly = spend.groupBy("month").agg(F.sum("spend").alias("spend"))
    return (
        monthly.join(kpi_new_customers(customers), "month", "full")
        .select("month", F.coalesce("spend", F.lit(ZERO)).alias("spend"), F.coalesce("new_customers", F.lit(0)).alias("new_customers"))
        .withColumn("cac", ratio(F.col("spend"), F.col("new_customers")))
    )


# ---- operations --------------------------------------------------------------


def kpi_order_status_distribution(orders: DataFrame) -> DataFrame:
    groups = orders.groupBy("status").agg(F.count("*").alias("orders"), F.sum("total_amount").alias("amount"))
    return with_share(groups, "orders")


def kpi_top_products(items: DataFrame, products: DataFrame, k: int = 20, by: str = "quantity") -> DataFrame:
    """Best-sellers by ``quantity`` or ``revenue``; ties go to the lower id.

    A product nobody knows keeps its place, without name.
    """
    sold = items.groupBy("product_id").agg(F.sum("quantity").alias("quantity"), F.sum("line_total").alias("revenue"))
    names = products.select(F.col("id").alias("product_id"), "sku", "name")
    return sold.join(names, "product_id", "left").orderBy(F.desc(by), "product_id").limit(k)
