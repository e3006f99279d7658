"""Orders against payments against invoices.

Payments and invoices are brought to order grain before they meet anything, so
instalments never multiply orders. For the three-way match the two are stacked and
grouped together: one pre-aggregated shuffle of numbers, then one join in which
every key occurs at most once on either side.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.dates import by_grains
from ..functions.money import ZERO
from .relational import jn_anti_orphans
from .views import paid_per_order

TOLERANCE = Decimal("1")
MATERIAL = Decimal("100000")

# Payment states that agree with each order state; 'none' is no payment.
EXPECTED_PAYMENT = {
    "Pending": ("Pending", "none"),
    "Processing": ("Completed", "Processing"),
    "Shipped": ("Completed",),
    "Delivered": ("Completed",),
    "Completed": ("Completed",),
    "Cancelled": ("Failed", "none"),
    "Refunded": ("Refunded",),
}

CLASSES = (
    "MATCHED",
    "UNPAID",
    "UNDERPAID",
    "OVERPAID",
    "PAYMENT_WITHOUT_ORDER",
    "MISSING_INVOICE",
    "INVOICE_MISMATCH",
)


def order_balance(orders: DataFrame, payments: DataFrame) -> DataFrame:
    paid = F.coalesce("paid_amount", F.lit(ZERO))
    return (
        orders.select(F.col("id").alias("order_id"), "order_number", "order_date", F.col("total_amount").alias("order_amount"))
        .join(paid_per_order(payments), "order_id", "left")
        .select(
            "order_id",
            "order_number",
            "order_date",
            "order_amount",
            paid.alias("paid_amount"),
            (F.col("order_amount") - paid).alias("discrepancy"),
        )
    )


def recon_order_payment(orders: DataFrame, payments: DataFrame, tolerance: Decimal = TOLERANCE) -> DataFrame:
    return (
        order_balance(orders, payments)
        .where(F.abs("discrepancy") > F.lit(tolerance))
        .select("order_number", "order_amount", "paid_amount", "discrepancy")
    )


def recon_unpaid_orders(orders: DataFrame, payments: DataFrame) -> DataFrame:
    # Distinct keys: many payments on one order must not pile up on the join's right side.
    paid = payments.where(F.col("status") == "Completed").select(F.col("order_id").alias("id")).distinct()
    return (
        orders.select("id", "total_amount")
        .join(paid, "id", "left_anti")
        .agg(F.count("*").alias("unpaid_orders"), F.sum("total_amount").alias("unpaid_amount"))
    )


def recon_discrepancy_total(orders: DataFrame, payments: DataFrame, tolerance: Decimal = TOLERANCE) -> DataFrame:
    """Differences per order day, split into under- and overpayment."""
    diff = F.col("discrepancy")
    return (
        order_balance(orders, payments)
        .where(F.abs(diff) > F.lit(tolerance))
        .groupBy("order_date")
        .agg(
            F.count("*").alias("orders"),
            F.sum(F.greatest(diff, F.lit(ZERO))).alias("underpaid"),
            F.sum(F.greatest(-diff, F.lit(ZERO))).alias("overpaid"),
            F.sum(F.abs(diff)).alias("discrepancy"),
        )
    )


def recon_unmatched_payments(payments: DataFrame, orders: DataFrame) -> DataFrame:
    return jn_anti_orphans(payments, "order_id", orders).select(
        "id", "payment_code", "order_id", "amount", "status", "payment_date"
    )


def invoiced_per_order(invoices: DataFrame) -> DataFrame:
    return invoices.groupBy("order_id").agg(
        F.sum(F.col("subtotal") + F.coalesce("tax_amount", F.lit(ZERO))).alias("invoice_amount"),
        F.sum("total_amount").alias("invoice_total"),
        F.count("*").alias("invoice_count"),
    )


def recon_order_invoice(orders: DataFrame, invoices: DataFrame, tolerance: Decimal = TOLERANCE) -> DataFrame:
    """Invoices that differ from their order. An invoice carries subtotal and tax
    but neither order discount nor shipping, so that is what is compared; the
    difference of the totals is a column."""
    expected = F.col("subtotal") + F.coalesce("tax_amount", F.lit(ZERO))
    o = orders.select(
        F.col("id").alias("order_id"), "order_number", expected.alias("order_amount"), F.col("total_amount").alias("order_total")
    )
    return (
        o.join(invoiced_per_order(invoices), "order_id")
        .select(
            "order_number",
            "order_amount",
            "invoice_amount",
            (F.col("order_amount") - F.col("invoice_amount")).alias("discrepancy"),
            (F.col("order_total") - F.col("invoice_total")).alias("total_difference"),
        )
        .where(F.abs("discrepancy") > F.lit(tolerance))
    )


def _match_class(tolerance: Decimal) -> Column:
    short = F.col("order_amount") - F.col("paid_amount")
    off = F.abs(F.col("invoiceable_amount") - F.col("invoice_amount"))
    matched, unpaid, under, over, stray, missing, mismatch = CLASSES
    return (
        F.when((F.col("order_count") == 0) & (F.col("payment_count") > 0), stray)
        .when(F.col("order_count") == 0, mismatch)
        .when(F.col("payment_count") == 0, unpaid)
        .when(short > F.lit(tolerance), under)
        .when(short < F.lit(-tolerance), over)
        .when((F.col("order_status") == "Completed") & (F.col("invoice_count") == 0), missing)
        .when((F.col("invoice_count") > 0) & (off > F.lit(tolerance)), mismatch)
        .otherwise(matched)
    )


def _settled(stacked: DataFrame) -> DataFrame:
    """Payments and invoices at order grain; a missing column counts as none."""
    figures = {"paid_amount": ("payments", "payment_count"), "invoice_amount": ("invoices", "invoice_count")}
    kept = {a: v for a, v in figures.items() if a in stacked.columns}
    return stacked.groupBy("order_id").agg(
        *(F.sum(amount).alias(amount) for amount in kept), *(F.count(each).alias(many) for each, many in kept.values())
    )


def _without_shuffle(orders: DataFrame, paid: DataFrame, invoiced: DataFrame) -> DataFrame:
    """Orders with what settles them, and what settles no order: joins that keep the order key's partitioning.

    A full join of three tables would lose it after the first join.
    """
    keys = orders.select("order_id")
    known = orders.join(paid, "order_id", "left").join(invoiced, "order_id", "left")
    loose = [table.join(keys, "order_id", "left_anti") for table in (paid, invoiced)]
    return known.unionByName(loose[0].join(loose[1], "order_id", "full"), allowMissingColumns=True)


def fact_reconciliation(
    orders: DataFrame, payments: DataFrame, invoices: DataFrame, tolerance: Decimal = TOLERANCE, colocated: bool = False
) -> DataFrame:
    """Three-way match at order grain with one class per order key.

    ``colocated``: the tables are stored by the hash of the order key
    (``sources.colocated``); then no row moves. Else payments and invoices are
    brought to order grain in one shuffle and meet the orders in one join.
    """
    tax = F.coalesce("tax_amount", F.lit(ZERO))
    o = orders.select(
        F.col("id").alias("order_id"),
        "order_number",
        "order_date",
        F.col("status").alias("order_status"),
        F.col("total_amount").alias("order_amount"),
        (F.col("subtotal") + tax).alias("invoiceable_amount"),
        F.lit(1).alias("order_count"),
    )
    p = payments.where(F.col("status") == "Completed").select(
        "order_id", F.col("amount").alias("paid_amount"), F.lit(1).alias("payments")
    )
    i = invoices.select("order_id", (F.col("subtotal") + tax).alias("invoice_amount"), F.lit(1).alias("invoices"))
    if colocated:
        joined = _without_shuffle(o, _settled(p), _settled(i))
    else:
        joined = o.join(_settled(p.unionByName(i, allowMissingColumns=True)), "order_id", "full")
    zeros = {c: F.coalesce(c, F.lit(ZERO)) for c in ("order_amount", "invoiceable_amount", "paid_amount", "invoice_amount")}
    none = {c: F.coalesce(c, F.lit(0)) for c in ("order_count", "payment_count", "invoice_count")}
    matched = joined.withColumns({**zeros, **none})
    return matched.select(
        "order_id",
        "order_number",
        "order_date",
        "order_status",
        "order_amount",
        "paid_amount",
        "invoice_amount",
        (F.col("order_amount") - F.col("paid_amount")).alias("payment_difference"),
        F.when(F.col("invoice_count") > 0, F.col("invoiceable_amount") - F.col("invoice_amount")).alias("invoice_difference"),
        "payment_count",
        "invoice_count",
        _match_class(tolerance).alias("match_class"),
    )


def recon_class_summary(fact: DataFrame) -> DataFrame:
    return fact.groupBy("match_class").agg(
        F.count("*").alias("keys"), F.sum(F.abs("payment_difference")).alias("payment_difference")
    )


def recon_material_alerts(fact: DataFrame, threshold: Decimal = MATERIAL) -> DataFrame:
    """Every payment or invoice difference above the materiality limit."""
    limit = F.lit(threshold)
    off = F.coalesce(F.abs("invoice_difference"), F.lit(ZERO))
    return fact.where((F.abs("payment_difference") > limit) | (off > limit))


def daily_system_totals(orders: DataFrame, payments: DataFrame, invoices: DataFrame) -> DataFrame:
    """Count and amount per system and day, side by side; 0 where a system has none."""

    def source(df: DataFrame, day: str, amount: str, name: str) -> DataFrame:
        return df.select(F.col(day).alias("day"), F.col(amount).alias(name))

    stacked = (
        source(orders, "order_date", "total_amount", "order_amount")
        .unionByName(
            source(payments.where(F.col("status") == "Completed"), "payment_date", "amount", "payment_amount"),
            allowMissingColumns=True,
        )
        .unionByName(source(invoices, "invoice_date", "total_amount", "invoice_amount"), allowMissingColumns=True)
    )
    amounts = {"orders": "order_amount", "payments": "payment_amount", "invoices": "invoice_amount"}
    return stacked.groupBy("day").agg(
        *(c for n, a in amounts.items() for c in (F.count(a).alias(n), F.coalesce(F.sum(a), F.lit(ZERO)).alias(a)))
    )


def recon_system_totals_by(
    orders: DataFrame, payments: DataFrame, invoices: DataFrame, grains: tuple[str, ...] = ("day", "month")
) -> DataFrame:
    """The daily totals added up for several grains, each source read once: period, grain, counts and amounts."""
    days = daily_system_totals(orders, payments, invoices)
    return by_grains(days, "day", grains, [F.sum(c).alias(c) for c in days.columns if c != "day"])


def recon_system_totals(orders: DataFrame, payments: DataFrame, invoices: DataFrame, grain: str = "day") -> DataFrame:
    """Count and amount per system and period, side by side."""
    return recon_system_totals_by(orders, payments, invoices, (grain,)).drop("grain")


def _status_pairs(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """``orders`` with payment_status, one row per state of their payments ('none' without any),
    and whether the pair is expected. Payments collapse to one row per order and state first."""
    states = payments.groupBy(F.col("order_id").alias("_order"), F.col("status").alias("payment_status")).agg(
        F.count("*").alias("payments"), F.sum("amount").alias("paid")
    )
    expected = F.lit(False)
    for status, allowed in EXPECTED_PAYMENT.items():
        expected = F.when(F.col("status") == status, F.col("payment_status").isin(*allowed)).otherwise(expected)
    return (
        orders.join(states, orders["id"] == states["_order"], "left")
        .withColumn("payment_status", F.coalesce("payment_status", F.lit("none")))
        .withColumn("expected", expected)
    )


def recon_status_consistency(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Order state x payment state with the number of orders, and whether the pair is expected."""
    pairs = _status_pairs(orders, payments).groupBy(F.col("status").alias("order_status"), "payment_status")
    return pairs.agg(F.count("*").alias("orders"), F.first("expected").alias("expected"))


def recon_status_violations(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Every order whose payments are in a state its own does not allow, a row per such state.

    An order of an unknown or no state is allowed none; no payment at all is the
    state 'none' with 0 payments.
    """
    return _status_pairs(orders, payments).where(~F.coalesce("expected", F.lit(False))).select(
        F.col("id").alias("order_id"),
        "order_date",
        F.col("status").alias("order_status"),
        "payment_status",
        "total_amount",
        F.coalesce("payments", F.lit(0)).alias("payments"),
        F.coalesce("paid", F.lit(ZERO)).alias("paid"),
    )
