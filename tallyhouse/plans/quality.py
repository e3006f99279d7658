"""Named queries: data-quality rules, profiles, drift, gates and history."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, functions as F

from ..operators import quality as dq, sketches, warehouse as wh
from ..schemas import TABLES
from ..sources import sinks, snapshots as snap
from ..sources.binding import Tables
from ..workspace import fresh_path
from .loading import RUN_AT, bound, snapshot_root
from .registry import AS_OF, query

# Window the order dates are checked against: all but the newest day of the test tables.
DATES = (date(1995, 1, 1), date(2001, 7, 31))


def rules() -> list[dq.Rule]:
    return dq.all_rules(*DATES)


def _rules(t: Tables, suffix: str) -> DataFrame:
    return dq.dq_run(bound(t), dq.select_rules(rules(), suffix))


@query
def dq_run(t: Tables) -> DataFrame:
    return dq.dq_run(bound(t), rules())


@query
def dq_pk(t: Tables) -> DataFrame:
    return _rules(t, "pk")


@query
def dq_fk(t: Tables) -> DataFrame:
    return _rules(t, "fk")


@query
def dq_unique(t: Tables) -> DataFrame:
    return _rules(t, "unique")


@query
def dq_not_null(t: Tables) -> DataFrame:
    return _rules(t, "not_null")


@query
def dq_accepted_values(t: Tables) -> DataFrame:
    return _rules(t, "accepted_values")


@query
def dq_range(t: Tables) -> DataFrame:
    return _rules(t, "range")


@query
def dq_format(t: Tables) -> DataFrame:
    return dq.dq_run(bound(t), dq.select_rules(rules(), "format") + dq.select_rules(rules(), "length"))


@query
def dq_min_rows(t: Tables) -> DataFrame:
    return _rules(t, "min_rows")


@query
def dq_sum_match(t: Tables) -> DataFrame:
    return dq.sum_mismatches(t.orders, t.order_items).where("differs").drop("differs")


@query
def dq_consistency(t: Tables) -> DataFrame:
    return _rules(t, "owner")


@query
def dq_date_range(t: Tables) -> DataFrame:
    return dq.dq_date_range(t.orders, *DATES)


@query
def dq_tables_present(t: Tables) -> DataFrame:
    return dq.dq_tables_present(bound(t, *(n for n in TABLES if n != "invoice_items")))


@query
def dq_required_columns(t: Tables) -> DataFrame:
    tables = bound(t)
    tables["customers"] = tables["customers"].drop("segment")
    return dq.dq_required_columns(tables)


@query
def dq_profile(t: Tables) -> DataFrame:
    return dq.dq_profile(t.payments, exact=t.payments.columns)


@query
def dq_schema_drift(t: Tables) -> DataFrame:
    """Two staged versions of the customers: a column gone, one retyped, one new."""
    old, new = fresh_path(t.spark, "customers-old"), fresh_path(t.spark, "customers-new")
    sinks.snk_parquet(t.customers, old)
    changed = t.customers.drop("gender").withColumns(
        {"id": F.col("id").cast("string"), "loyalty_tier": F.when(F.col("is_active"), "basic")}
    )
    sinks.snk_parquet(changed, new)
    return dq.dq_schema_drift(t.spark.read.parquet(old), t.spark.read.parquet(new), fills=True)


@query
def dq_agg_match(t: Tables) -> DataFrame:
    """Order lines against the fact built from them, and a fact with rows missing."""
    fact = wh.fact_orderline(t.order_items, t.orders, t.products)
    whole = dq.dq_agg_match(t.order_items, fact, ["line_total", "quantity"]).withColumn("target_name", F.lit("fact_orderline"))
    part = dq.dq_agg_match(t.order_items, fact.where("order_status <> 'Pending'"), ["line_total", "quantity"])
    return whole.unionByName(part.withColumn("target_name", F.lit("without_pending")))


@query
def dq_timeliness(t: Tables) -> DataFrame:
    root = snapshot_root(t)
    tables = bound(t, "customers", "orders")
    snap.snap_write(tables, root, AS_OF, run_timestamp=RUN_AT)
    snap.snap_write(tables, root, AS_OF + timedelta(days=1), run_timestamp=RUN_AT + timedelta(hours=26))
    return dq.dq_timeliness(snap.snap_manifest(t.spark, root))


@query
def dq_column_drift(t: Tables) -> DataFrame:
    """Orders of the last month against all before, by sketches kept with either."""
    root, columns = snapshot_root(t), ["order_date", "total_amount", "customer_id", "status", "channel"]
    for run, rows in (("before", t.orders.where("order_date < DATE '2001-07-02'")), ("after", t.order_changes)):
        sketches.keep_sketches(root, run, sketches.column_sketches(rows, "orders", columns))
    drift = sketches.column_drift(*(sketches.kept_sketches(t.spark, root, run) for run in ("before", "after")))
    return drift.select("table_name", "column_name", "kind", "status")


@query
def dq_snapshot_gate(t: Tables) -> DataFrame:
    """A snapshot without invoice items, whose customers lost a column and whose
    orders shrank to a month against the day before."""
    root = snapshot_root(t)
    tables = bound(t)
    snap.snap_write(tables, root, AS_OF - timedelta(days=1), run_timestamp=RUN_AT - timedelta(days=1))
    less = {**tables, "orders": t.order_changes}
    less.pop("invoice_items")
    snap.snap_write(less, root, AS_OF, run_timestamp=RUN_AT)
    staged = snap.snap_latest(t.spark, root, "customers").drop("snapshot_date", "gender")
    return dq.dq_snapshot_gate(
        snap.snap_manifest(t.spark, root),
        snap.snap_row_recon(tables, root, AS_OF),
        dq.dq_schema_drift(t.customers, staged),
        AS_OF,
        sizes=snap.snap_size_change(t.spark, root, AS_OF).where("bytes IS NOT NULL"),
        profile=dq.dq_profile(staged),
        sample=snap.snap_sample_compare(t.orders, snap.snap_latest(t.spark, root, "orders"), "id", 64),
    )


@query
def dq_history(t: Tables) -> DataFrame:
    """Order rules on two days: on the whole table, then on the change feed."""
    chosen = [r for r in rules() if r.table == "orders" and r.kind in ("row", "rows", "unique")]
    path = fresh_path(t.spark, "dq-history")
    dq.dq_append_history(dq.dq_run({"orders": t.orders}, chosen), path, AS_OF - timedelta(days=1))
    dq.dq_append_history(dq.dq_run({"orders": t.order_changes}, chosen), path, AS_OF)
    return dq.dq_history(t.spark.read.parquet(path))
