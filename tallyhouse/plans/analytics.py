"""Named queries: filters, joins, views, key figures, marts, reconciliation."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from ..operators import customer360, kpis, maintained, reconciliation as recon, relational as rel, rfm, views
from ..schemas import PAYMENT_METHODS, SEGMENTS
from ..sources import colocated
from ..sources.binding import Tables
from ..workspace import fresh_path, stage
from .registry import AS_OF, query, stack

# ---- filters, projections, text ----------------------------------------------


@query
def flt_order_status(t: Tables) -> DataFrame:
    kept = rel.flt_order_status(t.orders, ("Cancelled", "Refunded"), keep=False)
    return kept.select("id", "status", "order_date", "total_amount")


@query
def flt_email_pattern(t: Tables) -> DataFrame:
    return rel.flt_email_pattern(t.customers, "%7@example.com").select("id", "email")


@query
def prj_order_projection(t: Tables) -> DataFrame:
    return rel.prj_order_projection(t.orders)


@query
def txt_product_keyword(t: Tables) -> DataFrame:
    return rel.txt_product_keyword(t.products, "Ring").select("id", "sku", "name")


@query
def sec_mask_customer(t: Tables) -> DataFrame:
    return rel.sec_mask_customer(t.customers)


@query
def json_gateway_response(t: Tables) -> DataFrame:
    parsed = rel.json_field(t.payments, "gateway_response", "$.k", "int", "response_code")
    return parsed.where("response_code IS NOT NULL").select("id", "payment_gateway", "response_code")


# ---- joins, groupings, sets --------------------------------------------------


@query
def jn_anti_orphans(t: Tables) -> DataFrame:
    relations = (
        ("orders", "customer_id", "customers"),
        ("order_items", "order_id", "orders"),
        ("order_items", "product_id", "products"),
        ("payments", "order_id", "orders"),
    )
    return stack(
        [
            rel.jn_anti_orphans(t[child], fk, t[parent]).select(
                F.lit(child).alias("child_table"), F.lit(fk).alias("fk_column"), F.col("id").alias("child_id"), F.col(fk).alias("fk_value")
            )
            for child, fk, parent in relations
        ]
    )


@query
def jn_orders_without_invoice(t: Tables) -> DataFrame:
    return rel.jn_orders_without_invoice(t.orders, t.invoices).select("id", "order_number", "status", "total_amount")


@query
def jn_key_lookup(t: Tables) -> DataFrame:
    coded = t.payments.select(
        F.col("id").alias("payment_id"), F.format_string("ORD-2024-%06d", "order_id").alias("order_number")
    )
    return rel.jn_key_lookup(coded, "order_number", t.orders, "order_number", "id", "order_id")


@query
def jn_category_tree(t: Tables) -> DataFrame:
    return rel.jn_category_tree(t.categories)


@query
def agg_distinct_counts(t: Tables) -> DataFrame:
    return rel.agg_distinct_counts(t.orders)


@query
def agg_string_agg_status(t: Tables) -> DataFrame:
    return rel.agg_string_agg_status(t.payments)


@query
def agg_date_range(t: Tables) -> DataFrame:
    return rel.agg_date_range(t.orders)


@query
def top_customers(t: Tables) -> DataFrame:
    return rel.top_customers(t.customers, t.orders, 10)


@query
def top_customers_100(t: Tables) -> DataFrame:
    return rel.top_customers(t.customers, t.orders, 100)


@query
def set_domain_diff(t: Tables) -> DataFrame:
    return stack(
        [
            rel.set_domain_diff(t.customers, "segment", SEGMENTS, ignore_null=True),
            rel.set_domain_diff(t.payments, "payment_method", PAYMENT_METHODS),
            rel.set_domain_diff(t.payments, "payment_gateway", ("VNPay",)),
        ]
    )


# ---- views and key figures ---------------------------------------------------


@query
def view_order_summary(t: Tables) -> DataFrame:
    return views.view_order_summary(t.orders, t.customers, t.payments)


@query
def view_daily_sales(t: Tables) -> DataFrame:
    return views.view_daily_sales(t.orders)


@query
def view_daily_sales_unique_ids(t: Tables) -> DataFrame:
    return views.view_daily_sales(t.orders, unique_ids=True)


def _kept(t: Tables) -> maintained.SalesViews:
    """The kept views after three change sets."""
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in t.orders.schema.fields)
    kept = maintained.SalesViews(t.spark, fresh_path(t.spark, "kept"), schema)
    kept.start(t.orders)
    for changes in t.change_sets:
        kept.refresh(changes)
    return kept


@query
def view_daily_sales_kept(t: Tables) -> DataFrame:
    return _kept(t).daily_sales()


@query
def kpi_customer_ltv(t: Tables) -> DataFrame:
    return kpis.kpi_customer_ltv(t.orders)


@query
def kpi_monthly_revenue(t: Tables) -> DataFrame:
    return kpis.kpi_monthly_revenue(t.orders)


@query
def kpi_revenue_by_period(t: Tables) -> DataFrame:
    return kpis.kpi_revenue_by_periods(t.orders)


@query
def kpi_revenue_grains(t: Tables) -> DataFrame:
    return kpis.kpi_revenue_grains(t.orders)


@query
def kpi_unique_customers(t: Tables) -> DataFrame:
    """Bitmaps of the orders before June, kept; those of the later ones come to them."""
    early = F.col("order_date") < F.lit(date(2001, 6, 1))
    kept = stage(kpis.customer_bitmaps(t.orders.where(early)), "bitmaps")
    return kpis.kpi_unique_customers(kpis.united_bitmaps(kept, kpis.customer_bitmaps(t.orders.where(~early))))


@query
def kpi_revenue_by_channel(t: Tables) -> DataFrame:
    return kpis.kpi_revenue_by_channel(t.orders, "week")


@query
def kpi_monthly_revenue_by_channel(t: Tables) -> DataFrame:
    return kpis.kpi_revenue_by_channel(t.orders, "month")


@query
def kpi_revenue_growth(t: Tables) -> DataFrame:
    return kpis.kpi_revenue_growth(t.orders)


@query
def kpi_aov(t: Tables) -> DataFrame:
    return kpis.kpi_aov(t.orders)


@query
def kpi_gross_revenue(t: Tables) -> DataFrame:
    return kpis.kpi_gross_revenue(t.orders)


@query
def kpi_net_revenue(t: Tables) -> DataFrame:
    return kpis.kpi_net_revenue(t.orders, t.payments)


@query
def kpi_gross_margin_by_category(t: Tables) -> DataFrame:
    return kpis.kpi_gross_margin_by_category(t.order_items, t.products, t.categories)


@query
def kpi_new_customers(t: Tables) -> DataFrame:
    return kpis.kpi_new_customers(t.customers)


@query
def kpi_repeat_rate(t: Tables) -> DataFrame:
    return kpis.kpi_repeat_rate(t.customers, t.orders)


@query
def kpi_segment_distribution(t: Tables) -> DataFrame:
    return kpis.kpi_segment_distribution(t.customers)


@query
def kpi_clv(t: Tables) -> DataFrame:
    return kpis.kpi_clv(t.orders)


@query
def kpi_average_clv(t: Tables) -> DataFrame:
    return kpis.kpi_average_clv(t.orders)


@query
def kpi_churn_rate(t: Tables) -> DataFrame:
    return kpis.kpi_churn_rate(t.customers, t.orders, AS_OF)


@query
def kpi_churn_risk(t: Tables) -> DataFrame:
    return kpis.kpi_churn_risk(t.customers, t.orders, AS_OF)


@query
def kpi_cac(t: Tables) -> DataFrame:
    return kpis.kpi_cac(t.marketing_spend, t.customers)


@query
def kpi_order_status_distribution(t: Tables) -> DataFrame:
    return kpis.kpi_order_status_distribution(t.orders)


@query
def kpi_top_products(t: Tables) -> DataFrame:
    return kpis.kpi_top_products(t.order_items, t.products, 20, "quantity")


@query
def kpi_top_products_by_revenue(t: Tables) -> DataFrame:
    return kpis.kpi_top_products(t.order_items, t.products, 20, "revenue")


# ---- customer marts ----------------------------------------------------------


@query
def rfm_base(t: Tables) -> DataFrame:
    return rfm.rfm_base(t.orders, AS_OF)


@query
def rfm_score(t: Tables) -> DataFrame:
    return rfm.rfm_score(rfm.rfm_base(t.orders, AS_OF))


@query
def rfm_segment(t: Tables) -> DataFrame:
    return rfm.rfm_segment(rfm.rfm_score(rfm.rfm_base(t.orders, AS_OF)))


@query
def agg_percentiles(t: Tables) -> DataFrame:
    return rfm.exact_percentiles(t.orders, "total_amount", ["0.25", "0.50", "0.75", "0.90"])


@query
def mart_customer_360(t: Tables) -> DataFrame:
    return customer360.mart_customer_360(t.customers, t.orders, AS_OF)


@query
def mart_customer_360_kept(t: Tables) -> DataFrame:
    return _kept(t).customer_360(t.customers, AS_OF)


@query
def mart_segment_summary(t: Tables) -> DataFrame:
    return customer360.mart_segment_summary(customer360.mart_customer_360(t.customers, t.orders, AS_OF))


# ---- reconciliation ----------------------------------------------------------


@query
def recon_order_payment(t: Tables) -> DataFrame:
    return recon.recon_order_payment(t.orders, t.payments)


@query
def recon_unpaid_orders(t: Tables) -> DataFrame:
    return recon.recon_unpaid_orders(t.orders, t.payments)


@query
def recon_discrepancy_total(t: Tables) -> DataFrame:
    return recon.recon_discrepancy_total(t.orders, t.payments)


@query
def recon_unmatched_payments(t: Tables) -> DataFrame:
    return recon.recon_unmatched_payments(t.payments, t.orders)


@query
def recon_order_invoice(t: Tables) -> DataFrame:
    return recon.recon_order_invoice(t.orders, t.invoices)


@query
def fact_reconciliation(t: Tables) -> DataFrame:
    return recon.fact_reconciliation(t.orders, t.payments, t.invoices)


@query
def recon_class_summary(t: Tables) -> DataFrame:
    return recon.recon_class_summary(recon.fact_reconciliation(t.orders, t.payments, t.invoices))


@query
def recon_material_alerts(t: Tables) -> DataFrame:
    return recon.recon_material_alerts(recon.fact_reconciliation(t.orders, t.payments, t.invoices))


def _colocated(t: Tables) -> dict[str, DataFrame]:
    """Orders and what hangs on them, stored side by side."""
    root = fresh_path(t.spark, "colocated")
    tables = {name: t[name] for name in colocated.ORDER_KEYS}
    return colocated.colocate(tables, f"side_by_side_{root.rsplit('-', 1)[-1]}", root, buckets=8)


@query
def fact_reconciliation_colocated(t: Tables) -> DataFrame:
    s = _colocated(t)
    return recon.fact_reconciliation(s["orders"], s["payments"], s["invoices"], colocated=True)


@query
def recon_order_payment_colocated(t: Tables) -> DataFrame:
    s = _colocated(t)
    return recon.recon_order_payment(s["orders"], s["payments"])


@query
def recon_system_totals(t: Tables) -> DataFrame:
    return recon.recon_system_totals_by(t.orders, t.payments, t.invoices, ("day", "month"))


@query
def recon_status_consistency(t: Tables) -> DataFrame:
    return recon.recon_status_consistency(t.orders, t.payments)


@query
def recon_status_violations(t: Tables) -> DataFrame:
    return recon.recon_status_violations(t.orders, t.payments)
