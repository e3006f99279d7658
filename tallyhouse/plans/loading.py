"""Named queries: sources, sinks, snapshots, increments, warehouse, streaming.

Queries about writing write below a fresh path of the shared folder and return
what they read back.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, functions as F

from ..operators import warehouse as wh
from ..schemas import INVOICES, ORDERS, PAYMENTS, PRODUCTS, TABLES
from ..sources import clustered, digests, incremental as inc, sinks, snapshots as snap, tables as src, versions
from ..sources.binding import Tables
from ..streaming import refresh, windows
from ..workspace import fresh_path, stage
from .registry import AS_OF, query, stack

BEFORE = date(2001, 6, 1)
RUN_AT = datetime(2001, 8, 2, 7, 30)


def bound(t: Tables, *names: str) -> dict[str, DataFrame]:
    return {name: t[name] for name in names or TABLES}


def snapshot_root(t: Tables) -> str:
    return fresh_path(t.spark, "staging")


def schema_of(df: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)


# ---- sources and sinks -------------------------------------------------------


@query
def src_table_scan(t: Tables) -> DataFrame:
    return src.src_table_scan(t.orders, "orders")


@query
def src_row_count(t: Tables) -> DataFrame:
    return src.src_row_count(t.order_items, "order_items")


@query
def src_row_count_summary(t: Tables) -> DataFrame:
    return src.src_row_count_summary(bound(t))


@query
def src_csv_scan(t: Tables) -> DataFrame:
    path = fresh_path(t.spark, "payments-csv")
    sinks.snk_csv(t.payments, path)
    return src.src_csv_scan(t.spark, path, PAYMENTS.ddl)


@query
def src_parquet_scan(t: Tables) -> DataFrame:
    path = fresh_path(t.spark, "products-parquet")
    sinks.snk_parquet(t.products, path)
    return src.src_parquet_scan(t.spark, path, PRODUCTS.ddl)


@query
def snk_csv(t: Tables) -> DataFrame:
    path = fresh_path(t.spark, "orders-csv")
    sinks.snk_csv(t.orders, path)
    return src.src_csv_scan(t.spark, path, ORDERS.ddl)


@query
def snk_parquet(t: Tables) -> DataFrame:
    path = fresh_path(t.spark, "invoices-parquet")
    sinks.snk_parquet(t.invoices, path)
    return src.src_parquet_scan(t.spark, path, INVOICES.ddl)


@query
def snk_table_append(t: Tables) -> DataFrame:
    path = fresh_path(t.spark, "events-table")
    events = t.raw("events").select("event_id", "event_type", "value")
    failed = F.col("event_type") == "error"
    sinks.snk_table_append(events.where(~failed), path)
    sinks.snk_table_append(events.where(failed).withColumn("value", F.lit(float("nan"))), path)
    return t.spark.read.parquet(path)


@query
def snk_warehouse_write(t: Tables) -> DataFrame:
    root = fresh_path(t.spark, "warehouse")
    fact = wh.fact_invoice(t.invoices, t.orders).drop("channel_key", "customer_key")
    for rows in (fact.where("invoice_status <> 'Paid'"), fact):  # the second version replaces what the first had
        path = sinks.snk_warehouse_write(rows, root, "dw", "fact_invoice", partition_by="accounting_period")
    return versions.read_current(t.spark, path, schema_of(fact))


# ---- snapshots ---------------------------------------------------------------


@query
def snap_write(t: Tables) -> DataFrame:
    root = snapshot_root(t)
    snap.snap_write(bound(t), root, AS_OF, "parquet", RUN_AT)
    measures = {"order_items": "line_total", "payments": "amount", "invoice_items": "line_total",
                "orders": "total_amount", "invoices": "total_amount", "products": "unit_price"}

    def figures(name: str) -> DataFrame:
        df = snap.snap_as_of(t.spark, root, name, AS_OF)
        amount = F.sum(measures[name]) if name in measures else F.lit(None)
        return df.agg(F.count("*").alias("rows"), amount.cast("double").alias("amount")).select(
            F.lit(name).alias("table_name"), "rows", "amount"
        )

    return stack([figures(name) for name in TABLES])


@query
def snap_manifest(t: Tables) -> DataFrame:
    root = snapshot_root(t)
    snap.snap_write(bound(t), root, AS_OF, "csv", RUN_AT)
    manifest = snap.snap_manifest(t.spark, root)
    return manifest.where("table_name IS NOT NULL").select(
        "pipeline", "snapshot_date", "run_timestamp", "output_format", "table_name", "status", "rows"
    )


@query
def snap_runs(t: Tables) -> DataFrame:
    """The manifest nested by run, summed up inside the nested rows."""
    runs = snap.snap_runs(snap.snap_manifest(t.spark, _history(t)))
    exported = F.filter("tables", lambda x: x["status"] == "success")
    rows = F.aggregate(exported, F.lit(0).cast("bigint"), lambda total, x: total + x["rows"])
    return runs.select("snapshot_date", "status", F.size(exported).cast("bigint").alias("tables"), rows.alias("rows"))


@query
def snap_size_change(t: Tables) -> DataFrame:
    """Which tables take more room than the day before: rows came, went or stayed away."""
    root = snapshot_root(t)
    snap.snap_write({"customers": t.customers, "order_items": t.order_items.where("quantity <= 10")}, root, BEFORE)
    snap.snap_write({"customers": t.customers.where("is_active"), "order_items": t.order_items}, root, AS_OF)
    return snap.snap_size_change(t.spark, root, AS_OF).select("table_name", (F.col("ratio") > 1).alias("grown"))


@query
def snap_commit(t: Tables) -> DataFrame:
    root = snapshot_root(t)
    snap.snap_write(bound(t, "customers", "orders"), root, AS_OF, "parquet", RUN_AT)
    return snap.snap_commit(snap.snap_manifest(t.spark, root)).drop("run_id")


def _history(t: Tables) -> str:
    """Two complete snapshots and a failed one that left order files behind."""
    root = snapshot_root(t)
    early = t.orders.where(F.col("order_date") < F.lit(BEFORE))
    snap.snap_write({"customers": t.customers, "orders": early}, root, BEFORE)
    snap.snap_write({"customers": t.customers, "orders": t.orders}, root, AS_OF)
    broken = t.customers.withColumn("email", F.raise_error(F.lit("source went away")).cast("string"))
    try:
        snap.snap_write({"orders": t.orders, "customers": broken}, root, AS_OF + timedelta(days=1), parallel=1)
    except Exception:  # the manifest has the failure
        pass
    return root


@query
def snap_latest(t: Tables) -> DataFrame:
    return snap.snap_latest(t.spark, _history(t), "orders").select("snapshot_date", "id", "total_amount")


@query
def snap_as_of(t: Tables) -> DataFrame:
    root = _history(t)
    missing = snap.snap_as_of(t.spark, root, "orders", BEFORE + timedelta(days=1))
    found = snap.snap_as_of(t.spark, root, "orders", BEFORE)
    return found.unionByName(missing).select("snapshot_date", "id", "total_amount")


@query
def snap_complete(t: Tables) -> DataFrame:
    orders = snap.snap_complete(t.spark, _history(t), "orders")
    return orders.groupBy("snapshot_date").agg(F.count("*").alias("orders"), F.sum("total_amount").alias("amount"))


@query
def snap_rerun(t: Tables) -> DataFrame:
    """A whole run, one of a single table and a failed one on the same day."""
    root = snapshot_root(t)
    snap.snap_write(bound(t, "customers", "orders", "payments"), root, AS_OF)
    snap.snap_write({"customers": t.customers.where("is_active")}, root, AS_OF)
    broken = t.customers.withColumn("email", F.raise_error(F.lit("source went away")).cast("string"))
    try:
        snap.snap_write({"orders": t.orders.where("status = 'Pending'"), "customers": broken}, root, AS_OF, parallel=1)
    except Exception:  # the manifest has the failure
        pass
    by_day = [snap.snap_as_of(t.spark, root, n, AS_OF) for n in ("customers", "orders", "payments")]
    newest = [snap.snap_latest(t.spark, root, n) for n in ("customers", "orders", "payments")]
    named = zip(("customers", "orders", "payments") * 2, by_day + newest)
    return stack([src.src_row_count(df, name) for name, df in named]).groupBy("table_name").agg(
        F.min("row_count").alias("fewest"), F.max("row_count").alias("most")
    )


@query
def snap_row_recon(t: Tables) -> DataFrame:
    root = snapshot_root(t)
    tables = bound(t, "customers", "products", "orders", "payments")
    snap.snap_write({k: v for k, v in tables.items() if k != "products"}, root, AS_OF)
    return snap.snap_row_recon(tables, root, AS_OF)


@query
def snap_sample_compare(t: Tables) -> DataFrame:
    root = snapshot_root(t)
    snap.snap_write({"orders": inc.inc_merge_latest(t.orders, t.order_changes)}, root, AS_OF)
    return snap.snap_sample_compare(t.orders, snap.snap_latest(t.spark, root, "orders"), "id", 64)


@query
def snap_diff(t: Tables) -> DataFrame:
    return snap.snap_diff(*_two_states(t), "id")


def _two_states(t: Tables) -> tuple[DataFrame, DataFrame]:
    previous = t.orders.where(F.col("order_date") < F.lit(AS_OF - timedelta(days=10)))
    return previous, inc.inc_merge_latest(t.orders, t.order_changes).where(F.col("status") != "Pending")


@query
def snap_diff_tree(t: Tables) -> DataFrame:
    """The comparison by digest trees that were kept with each state."""
    root, trees = snapshot_root(t), []
    for n, df in enumerate(_two_states(t)):
        digests.keep_tree(root, "orders", f"run-{n}", df, "id", 256)
        trees.append(digests.kept_tree(t.spark, root, "orders", f"run-{n}"))
    return digests.tree_diff(*_two_states(t), "id", *trees, leaf_keys=256)


@query
def snap_recon_tree(t: Tables) -> DataFrame:
    """Sources against the trees of what was staged: the customers are as they were, the orders have changed."""
    root = snapshot_root(t)
    later = inc.inc_merge_latest(t.orders, t.order_changes)
    found = []
    for name, staged_rows, source in (("customers", t.customers, t.customers), ("orders", t.orders, later)):
        digests.keep_tree(root, name, "run-0", staged_rows, "id", 256)
        found.append(digests.source_matches(source, "id", digests.kept_tree(t.spark, root, name, "run-0"), name, 256))
    return stack(found)


@query
def snap_storage_stats(t: Tables) -> DataFrame:
    root = snapshot_root(t)
    tables = bound(t, "customers", "orders", "payments")
    snap.snap_write(tables, root, AS_OF, "csv")
    snap.snap_write(tables, root, AS_OF, "parquet")
    stats = snap.snap_storage_stats(t.spark, root)
    return stats.select(
        "table_name",
        (F.col("csv_files") > 0).alias("has_csv"),
        (F.col("parquet_files") > 0).alias("has_parquet"),
        F.col("percent_smaller").isNotNull().alias("compared"),
    )


@query
def snap_retention(t: Tables) -> DataFrame:
    newest = t.orders.agg(F.max("order_date")).first()[0]
    expired = snap.snap_retention(snap.snap_manifest(t.spark, _history(t)), newest)
    return expired.select("snapshot_date", "table_name", "rows", "age_days")


@query
def snap_compact(t: Tables) -> DataFrame:
    root = snapshot_root(t)
    snap.snap_write({"order_items": t.order_items.repartition(64), "customers": t.customers}, root, AS_OF)
    snap.snap_compact(t.spark, root, "order_items", AS_OF)
    compacted = snap.snap_latest(t.spark, root, "order_items")
    return compacted.select("snapshot_date", "id", "order_id", "product_id", "line_total")


# ---- increments --------------------------------------------------------------


@query
def inc_extract(t: Tables) -> DataFrame:
    changed = inc.inc_extract(t.orders, datetime(2001, 7, 1))
    return changed.select("id", "order_date", "updated_at", "total_amount")


def _clustered(t: Tables) -> clustered.Clustered:
    path, zones = fresh_path(t.spark, "clustered"), ["order_date", "customer_id", "updated_at"]
    clustered.write_clustered(t.orders, path, zones[:2], zones, files=64)
    return clustered.Clustered(t.spark, path, schema_of(t.orders))


@query
def inc_extract_clustered(t: Tables) -> DataFrame:
    changed = _clustered(t).after("updated_at", datetime(2001, 7, 1))
    return changed.select("id", "order_date", "updated_at", "total_amount")


@query
def clustered_customer_lookup(t: Tables) -> DataFrame:
    """All orders of the customer who has most."""
    busiest = t.orders.groupBy("customer_id").count().agg(F.max_by("customer_id", F.struct("count", "customer_id"))).first()[0]
    return _clustered(t).equal("customer_id", busiest).select("id", "customer_id", "order_date", "total_amount")


@query
def inc_high_water(t: Tables) -> DataFrame:
    return inc.inc_high_water(t.orders)


@query
def inc_latest_per_key(t: Tables) -> DataFrame:
    versions = t.orders.unionByName(t.order_changes.where("channel = 'Website'"))
    return inc.latest_per_key(versions, "id").select("id", "total_amount", "updated_at")


@query
def inc_merge_latest(t: Tables) -> DataFrame:
    return inc.inc_merge_latest(t.orders, t.order_changes).select("id", "status", "total_amount", "updated_at")


@query
def fact_merge(t: Tables) -> DataFrame:
    month = F.trunc("order_date", "month").alias("order_month")
    columns = ("id", "order_number", "customer_id", "order_date", "status", "total_amount", "updated_at")
    table, changes = t.orders.select(*columns, month), t.order_changes.select(*columns, month)
    path = sinks.snk_warehouse_write(table, fresh_path(t.spark, "warehouse"), "dw", "fact_order", partition_by="order_month")
    for check in (True, False):  # merging the same delta again changes nothing
        inc.merge_into_dates(t.spark, path, changes, "order_month", check_moved=check)
    return versions.read_current(t.spark, path, schema_of(table))


@query
def fact_merge_two_writers(t: Tables) -> DataFrame:
    """The same changes as two deltas of the same months, merged at the same time."""
    month = F.trunc("order_date", "month").alias("order_month")
    columns = ("id", "order_number", "customer_id", "order_date", "status", "total_amount", "updated_at")
    table, changes = t.orders.select(*columns, month), t.order_changes.select(*columns, month)
    path = sinks.snk_warehouse_write(table, fresh_path(t.spark, "warehouse"), "dw", "fact_order", partition_by="order_month")
    halves = [changes.where(F.col("id") % 2 == k) for k in (0, 1)]
    with ThreadPoolExecutor(2) as pool:
        list(pool.map(lambda delta: inc.merge_into_dates(t.spark, path, delta, "order_month"), halves))
    return versions.read_current(t.spark, path, schema_of(table))


@query
def inc_merge_deletes(t: Tables) -> DataFrame:
    """Three change sets with deletions, one after the other."""
    table = t.orders
    for changes in t.change_sets:
        table = stage(inc.inc_merge_latest(table, changes, deleted="deleted"), "merged")
    return table.select("id", "status", "total_amount")


@query
def fact_merge_deletes(t: Tables) -> DataFrame:
    month = F.trunc("order_date", "month").alias("order_month")
    columns = ("id", "order_number", "customer_id", "order_date", "status", "total_amount", "updated_at")
    table = t.orders.select(*columns, month)
    path = sinks.snk_warehouse_write(table, fresh_path(t.spark, "warehouse"), "dw", "fact_order", partition_by="order_month")
    for changes in t.change_sets:
        inc.merge_into_dates(t.spark, path, changes.select(*columns, month, "deleted"), "order_month", deleted="deleted")
    return versions.read_current(t.spark, path, schema_of(table)).drop("updated_at")


@query
def util_touch_updated_at(t: Tables) -> DataFrame:
    touched = inc.util_touch_updated_at(t.orders, t.order_changes, datetime(2001, 8, 2, 6, 0))
    return touched.select("id", "total_amount", "updated_at")


# ---- warehouse ---------------------------------------------------------------


@query
def dim_date(t: Tables) -> DataFrame:
    return wh.dim_date_of(t.orders, "order_date")


@query
def dim_customer(t: Tables) -> DataFrame:
    return wh.dim_customer(t.customers).drop("customer_key")


@query
def dim_product(t: Tables) -> DataFrame:
    return wh.dim_product(t.products, t.categories).drop("product_key")


@query
def dim_channel(t: Tables) -> DataFrame:
    return wh.dim_channel(t.orders).drop("channel_key")


def _customer_states(t: Tables) -> DataFrame:
    """Customers on three days: as they are, the inactive marked, one country gone."""
    marked = t.customers.withColumn("segment", F.when(~F.col("is_active"), "Churned").otherwise(F.col("segment")))
    states = (
        (date(2001, 6, 1), t.customers),
        (date(2001, 7, 1), marked),
        (date(2001, 8, 1), marked.where("country <> 'NATION_3'")),
    )
    return stack([df.select("id", "segment", "country", F.lit(day).alias("snapshot_date")) for day, df in states])


@query
def dim_customer_scd2(t: Tables) -> DataFrame:
    return wh.dim_customer_scd2(_customer_states(t), ["segment", "country"]).drop("version_key")


@query
def scd2_apply(t: Tables) -> DataFrame:
    """The history of the first two days with the third applied."""
    states, tracked, last = _customer_states(t), ["segment", "country"], date(2001, 8, 1)
    stored = wh.dim_customer_scd2(states.where(F.col("snapshot_date") < F.lit(last)), tracked)
    return wh.scd2_apply(stored, states.where(F.col("snapshot_date") == F.lit(last)), last, tracked).drop("version_key")


@query
def jn_scd2_lookup(t: Tables) -> DataFrame:
    history = wh.dim_customer_scd2(_customer_states(t), ["segment", "country"])
    orders = t.orders.select(F.col("id").alias("order_id"), "customer_id", "order_date")
    found = wh.jn_scd2_lookup(orders, history, "customer_id", "order_date")
    return found.select("order_id", "customer_id", "order_date", "segment", "version_from", "version_to")


@query
def jn_scd2_sweep(t: Tables) -> DataFrame:
    history = wh.dim_customer_scd2(_customer_states(t), ["segment", "country"])
    orders = t.orders.select(F.col("id").alias("order_id"), "customer_id", "order_date")
    found = wh.jn_scd2_sweep(orders, history, "customer_id", "order_date")
    return found.select("order_id", "customer_id", "order_date", "segment", "version_from", "version_to")


@query
def fact_order(t: Tables) -> DataFrame:
    return wh.fact_order(t.orders, t.payments).drop("channel_key", "customer_key")


@query
def fact_orderline(t: Tables) -> DataFrame:
    return wh.fact_orderline(t.order_items, t.orders, t.products).drop("product_key", "channel_key", "customer_key")


@query
def fact_payment(t: Tables) -> DataFrame:
    return wh.fact_payment(t.payments, t.orders).drop("channel_key", "customer_key")


@query
def fact_invoice(t: Tables) -> DataFrame:
    return wh.fact_invoice(t.invoices, t.orders).drop("channel_key", "customer_key")


@query
def fact_dim_integrity(t: Tables) -> DataFrame:
    """Facts over orders and products of which some are gone."""
    orders, products = t.orders.where("status <> 'Shipped'"), t.products.where("stock_quantity > 10")
    facts = {
        "fact_orderline": wh.fact_orderline(t.order_items, orders, products),
        "fact_payment": wh.fact_payment(t.payments, orders),
        "fact_invoice": wh.fact_invoice(t.invoices, orders),
        "fact_order": wh.fact_order(orders, t.payments),
    }
    dimensions = {
        "customer": wh.dim_customer(t.customers),
        "product": wh.dim_product(products, t.categories),
        "channel": wh.dim_channel(orders),
    }
    return wh.fact_dim_integrity(facts, dimensions)


@query
def util_code_sequence(t: Tables) -> DataFrame:
    payments = t.payments.select("id", "payment_date", "amount")
    return wh.util_code_sequence(payments, "PAY", 2024, ["payment_date", "id"], name="new_code")


# ---- streaming ---------------------------------------------------------------


def _staged_by_months(t: Tables, batches: int = 3) -> tuple[str, int]:
    """Orders in files of mixed months and the number of files that make a batch.

    One write per group of months, each from where its tasks read the orders: there are
    as many files as the orders have splits, none larger, and nothing is shuffled.
    """
    staged = fresh_path(t.spark, "orders-staged")
    group = F.coalesce(F.month("order_date") % batches, F.lit(0))
    for k in range(batches):
        sinks.snk_parquet(t.orders.where(group == k), staged, mode="append")
    files = len(t.spark.read.schema(schema_of(t.orders)).parquet(staged).inputFiles())
    return staged, max(1, -(-files // batches))


@query
def stream_sales_refresh(t: Tables) -> DataFrame:
    """Orders in files of mixed months, in three batches."""
    (staged, files), out = _staged_by_months(t), fresh_path(t.spark, "sales")
    stream = refresh.read_staged_stream(t.spark, staged, "orders", files_per_batch=files)
    refresh.stream_sales_refresh(stream, out, fresh_path(t.spark, "sales-checkpoint")).awaitTermination()
    return refresh.refreshed_sales(t.spark, out)


@query
def stream_sales_windows(t: Tables) -> DataFrame:
    """Orders in files of mixed months, in three batches; the second stream runs after the first, and batches are merged."""
    (staged, files), out = _staged_by_months(t), fresh_path(t.spark, "windows")
    stream = refresh.read_staged_stream(t.spark, staged, "orders", files_per_batch=files)
    windows.sort_arrivals(stream, out, fresh_path(t.spark, "arrivals-checkpoint")).awaitTermination()
    windows.close_windows(t.spark, out, fresh_path(t.spark, "windows-checkpoint")).awaitTermination()
    windows.merge_batches(t.spark, out)
    return windows.windowed_totals(t.spark, out)


@query
def stream_recon_alerts(t: Tables) -> DataFrame:
    orders, payments = fresh_path(t.spark, "orders-staged"), fresh_path(t.spark, "payments-staged")
    out = fresh_path(t.spark, "alerts")
    refresh.stage_by_order(t.orders, orders, "id")
    refresh.stage_by_order(t.payments, payments, "order_id")
    stream = refresh.read_staged_stream(t.spark, payments, "payments")
    checkpoint = fresh_path(t.spark, "alerts-checkpoint")
    refresh.stream_recon_alerts(stream, orders, payments, out, checkpoint).awaitTermination()
    return refresh.recon_alerts(t.spark, out)
