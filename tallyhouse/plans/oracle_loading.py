"""SQL counterparts: what sources, sinks, snapshots and loads must hold."""

from __future__ import annotations

from .oracle_tables import over

SQL: dict[str, str] = {}

DAY = "DATE '2001-08-01'"
ALL = ("categories", "products", "customers", "orders", "order_items", "payments", "invoices", "invoice_items")
MONEY = {
    "products": ("unit_price", "cost_price"),
    "orders": ("subtotal", "discount_amount", "tax_amount", "shipping_fee", "total_amount"),
    "payments": ("amount",),
    "invoices": ("subtotal", "tax_amount", "total_amount"),
}
AMOUNT = {"order_items": "line_total", "payments": "amount", "invoice_items": "line_total",
          "orders": "total_amount", "invoices": "total_amount", "products": "unit_price"}


def whole(table: str) -> str:
    casts = ", ".join(f"{c}::DOUBLE AS {c}" for c in MONEY[table])
    return over(f"c_{table}") + f" SELECT * REPLACE ({casts}) FROM c_{table}"


def counts(extra: str = "") -> str:
    return over(*(f"c_{n}" for n in ALL)) + " UNION ALL ".join(
        f" SELECT {extra}'{n}' AS table_name, count(*) AS rows FROM c_{n}" for n in ALL
    )


# ---- sources and sinks -------------------------------------------------------

SQL["src_table_scan"] = SQL["snk_csv"] = whole("orders")
SQL["src_csv_scan"] = whole("payments")
SQL["src_parquet_scan"] = whole("products")
SQL["snk_parquet"] = whole("invoices")
SQL["src_row_count"] = "SELECT 'order_items' AS table_name, count(*) AS row_count FROM lineitem"
SQL["src_row_count_summary"] = f"SELECT table_name, rows AS row_count FROM ({counts()}) x"
SQL["snk_table_append"] = """
SELECT event_id, event_type, CASE WHEN event_type <> 'error' THEN value END AS value FROM events"""

FACT_INVOICE = over("c_invoices", "c_orders") + """
SELECT i.id AS invoice_id, i.invoice_number, i.order_id, i.customer_id,
       strftime(i.invoice_date, '%Y%m%d')::INTEGER AS date_key, i.invoice_date,
       (i.invoice_date + 30)::DATE AS due_date, strftime(i.invoice_date, '%Y-%m') AS accounting_period,
       i.subtotal::DOUBLE AS subtotal, i.tax_amount::DOUBLE AS tax_amount, i.total_amount::DOUBLE AS total_amount,
       i.status AS invoice_status, (i.invoice_date - o.order_date)::INTEGER AS days_to_invoice
FROM c_invoices i LEFT JOIN c_orders o ON i.order_id = o.id"""
SQL["snk_warehouse_write"] = SQL["fact_invoice"] = FACT_INVOICE

# ---- snapshots ---------------------------------------------------------------

SQL["snap_write"] = over(*(f"c_{n}" for n in ALL)) + " UNION ALL ".join(
    f" SELECT '{n}' AS table_name, count(*) AS rows, {f'sum({AMOUNT[n]})' if n in AMOUNT else 'NULL'}::DOUBLE AS amount"
    f" FROM c_{n}"
    for n in ALL
)
SQL["snap_manifest"] = f"""
SELECT 'source_to_staging' AS pipeline, {DAY} AS snapshot_date, TIMESTAMP '2001-08-02 07:30:00' AS run_timestamp,
       'csv' AS output_format, table_name, 'success' AS status, rows FROM ({counts()}) x"""
SQL["snap_commit"] = f"""
SELECT {DAY} AS snapshot_date, 'COMPLETE' AS status, 2::BIGINT AS tables,
       (SELECT count(*) FROM customer) + (SELECT count(*) FROM orders) AS rows"""
SQL["snap_runs"] = """
WITH n AS (SELECT (SELECT count(*) FROM customer) AS c, (SELECT count(*) FROM orders) AS o,
                  (SELECT count(*) FROM orders WHERE o_orderdate < DATE '2001-06-01') AS early)
SELECT DATE '2001-06-01' AS snapshot_date, 'COMPLETE' AS status, 2::BIGINT AS tables, c + early AS rows FROM n
UNION ALL SELECT DATE '2001-08-01', 'COMPLETE', 2, c + o FROM n
UNION ALL SELECT DATE '2001-08-02', 'FAILED', 1, o FROM n"""
SQL["snap_size_change"] = over("c_customers", "c_order_items") + """
SELECT 'customers' AS table_name, count(*) FILTER (is_active) > count(*) AS grown FROM c_customers
UNION ALL SELECT 'order_items', count(*) > count(*) FILTER (quantity <= 10) FROM c_order_items"""
SQL["snap_storage_stats"] = over("c_customers", "c_orders", "c_payments") + " UNION ALL ".join(
    f" SELECT '{n}' AS table_name, count(*) > 0 AS has_csv, count(*) > 0 AS has_parquet, count(*) > 0 AS compared FROM c_{n}"
    for n in ("customers", "orders", "payments")
)
SQL["snap_rerun"] = over("c_customers", "c_orders", "c_payments") + """
SELECT 'customers' AS table_name, count(*) AS fewest, count(*) AS most FROM c_customers WHERE is_active
UNION ALL SELECT 'orders', count(*), count(*) FROM c_orders
UNION ALL SELECT 'payments', count(*), count(*) FROM c_payments"""
SQL["snap_latest"] = over("c_orders") + f"""
SELECT {DAY} AS snapshot_date, id, total_amount::DOUBLE AS total_amount FROM c_orders"""
SQL["snap_as_of"] = over("c_orders") + """
SELECT DATE '2001-06-01' AS snapshot_date, id, total_amount::DOUBLE AS total_amount
FROM c_orders WHERE order_date < DATE '2001-06-01'"""
SQL["snap_complete"] = over("c_orders") + f"""
SELECT DATE '2001-06-01' AS snapshot_date, count(*) AS orders, sum(total_amount)::DOUBLE AS amount
FROM c_orders WHERE order_date < DATE '2001-06-01'
UNION ALL SELECT {DAY}, count(*), sum(total_amount)::DOUBLE FROM c_orders"""
SQL["snap_row_recon"] = over("c_customers", "c_products", "c_orders", "c_payments") + """,
n AS (SELECT 'customers' AS table_name, count(*) AS n FROM c_customers
      UNION ALL SELECT 'products', count(*) FROM c_products
      UNION ALL SELECT 'orders', count(*) FROM c_orders
      UNION ALL SELECT 'payments', count(*) FROM c_payments)
SELECT table_name, n AS source_count, CASE WHEN table_name <> 'products' THEN n END AS staging_count,
       table_name <> 'products' AS match, CASE WHEN table_name <> 'products' THEN 'PASS' ELSE 'FAIL' END AS status
FROM n"""

MERGED = over("c_order_changes") + """,
merged AS (SELECT * FROM c_orders WHERE id NOT IN (SELECT id FROM c_order_changes)
           UNION ALL SELECT * FROM c_order_changes)"""

# The compared columns of the order table.
ORDER_COLUMNS = (
    "order_number", "customer_id", "order_date", "order_timestamp", "status", "subtotal", "discount_amount", "tax_amount",
    "shipping_fee", "total_amount", "channel", "shipping_address", "shipping_city", "shipping_phone", "customer_note",
    "internal_note", "created_at", "updated_at",
)
SQL["snap_sample_compare"] = MERGED + """,
both_sides AS (SELECT o.*, m.* FROM (SELECT c_orders AS o FROM c_orders) o JOIN (SELECT merged AS m FROM merged) m
               ON o.o.id = m.m.id
               WHERE ('0x' || substr(md5(o.o.id::VARCHAR), 1, 2))::INTEGER < 64)""" + " UNION ALL ".join(
    f"""
SELECT '{c}' AS column_name, count(*) AS compared, 0::BIGINT AS unpaired,
       count(*) FILTER (WHERE o.{c} IS DISTINCT FROM m.{c}) AS differing FROM both_sides"""
    for c in ORDER_COLUMNS
)
SQL["snap_diff"] = MERGED + """,
prev AS (SELECT * FROM c_orders WHERE order_date < DATE '2001-07-22'),
cur AS (SELECT * FROM merged WHERE status <> 'Pending')
SELECT coalesce(p.id, c.id) AS id,
       CASE WHEN p.id IS NULL THEN 'inserted' WHEN c.id IS NULL THEN 'deleted'
            WHEN p.total_amount IS DISTINCT FROM c.total_amount OR p.updated_at IS DISTINCT FROM c.updated_at
              OR p.status IS DISTINCT FROM c.status THEN 'updated' ELSE 'unchanged' END AS change
FROM prev p FULL OUTER JOIN cur c ON p.id = c.id"""
SQL["snap_retention"] = over("c_customers", "c_orders") + """,
newest AS (SELECT max(order_date) AS today FROM c_orders),
stored AS (SELECT DATE '2001-06-01' AS snapshot_date, 'customers' AS table_name, (SELECT count(*) FROM c_customers) AS rows
           UNION ALL SELECT DATE '2001-06-01', 'orders', (SELECT count(*) FROM c_orders WHERE order_date < DATE '2001-06-01'))
SELECT snapshot_date, table_name, rows, (today - snapshot_date)::INTEGER AS age_days FROM stored, newest
WHERE today - snapshot_date > 30"""
SQL["snap_compact"] = over("c_order_items") + """
SELECT DATE '2001-08-01' AS snapshot_date, id, order_id, product_id, line_total::DOUBLE AS line_total FROM c_order_items"""

# ---- increments --------------------------------------------------------------

SQL["inc_extract"] = over("c_orders") + """
SELECT id, order_date, updated_at, total_amount::DOUBLE AS total_amount
FROM c_orders WHERE updated_at > TIMESTAMP '2001-07-01'"""
SQL["inc_high_water"] = over("c_orders") + " SELECT max(updated_at) AS high_water FROM c_orders"
SQL["inc_latest_per_key"] = over("c_order_changes") + """,
versions AS (SELECT id, total_amount, updated_at FROM c_orders
             UNION ALL SELECT id, total_amount, updated_at FROM c_order_changes WHERE channel = 'Website')
SELECT id, total_amount::DOUBLE AS total_amount, updated_at FROM versions
QUALIFY row_number() OVER (PARTITION BY id ORDER BY updated_at DESC) = 1"""
SQL["inc_merge_latest"] = MERGED + " SELECT id, status, total_amount::DOUBLE AS total_amount, updated_at FROM merged"
SQL["fact_merge"] = SQL["fact_merge_two_writers"] = MERGED + """
SELECT id, order_number, customer_id, order_date, status, total_amount::DOUBLE AS total_amount, updated_at,
       date_trunc('month', order_date)::DATE AS order_month FROM merged"""
SQL["inc_merge_deletes"] = over("c_kept") + " SELECT id, status, total_amount::DOUBLE AS total_amount FROM c_kept"
SQL["fact_merge_deletes"] = over("c_kept") + """
SELECT id, order_number, customer_id, order_date, status, total_amount::DOUBLE AS total_amount,
       date_trunc('month', order_date)::DATE AS order_month FROM c_kept"""
SQL["util_touch_updated_at"] = over("c_order_changes") + """
SELECT n.id, n.total_amount::DOUBLE AS total_amount,
       CASE WHEN n.total_amount <> o.total_amount THEN TIMESTAMP '2001-08-02 06:00:00' ELSE o.updated_at END AS updated_at
FROM c_order_changes n JOIN c_orders o ON n.id = o.id"""

# ---- warehouse ---------------------------------------------------------------

SQL["dim_date"] = over("c_orders") + """,
span AS (SELECT min(order_date) AS a, max(order_date) AS b FROM c_orders),
days AS (SELECT unnest(generate_series(a::TIMESTAMP, b::TIMESTAMP, INTERVAL 1 DAY))::DATE AS date FROM span)
SELECT strftime(date, '%Y%m%d')::INTEGER AS date_key, date, year(date)::INTEGER AS year,
       quarter(date)::INTEGER AS quarter, month(date)::INTEGER AS month, day(date)::INTEGER AS day,
       isodow(date)::INTEGER AS iso_weekday, weekofyear(date)::INTEGER AS iso_week, isodow(date) >= 6 AS is_weekend,
       date_trunc('month', date)::DATE AS month_start, strftime(date, '%Y-%m') AS accounting_period FROM days"""
SQL["dim_customer"] = over("c_customers") + """
SELECT id AS customer_id, customer_code, first_name || ' ' || last_name AS customer_name, email, segment, city, country,
       registration_date, is_active FROM c_customers
UNION ALL SELECT NULL, NULL, 'Unknown', NULL, NULL, NULL, NULL, NULL, NULL"""
SQL["dim_product"] = over("c_products", "c_categories") + """
SELECT p.id AS product_id, p.sku, p.name AS product_name, p.category_id, c.name AS category_name,
       c.parent_id AS parent_category_id, p.unit_price::DOUBLE AS unit_price, p.cost_price::DOUBLE AS cost_price,
       p.is_active
FROM c_products p LEFT JOIN c_categories c ON p.category_id = c.id
UNION ALL SELECT NULL, NULL, 'Unknown', NULL, NULL, NULL, NULL, NULL, NULL"""
SQL["dim_channel"] = over("c_orders") + " SELECT coalesce(channel, 'Unknown') AS channel FROM c_orders UNION SELECT 'Unknown'"

SCD2 = over("c_customers", "c_orders") + """,
states AS (SELECT id, segment, country, DATE '2001-06-01' AS d FROM c_customers
           UNION ALL
           SELECT id, CASE WHEN is_active THEN segment ELSE 'Churned' END, country, DATE '2001-07-01' FROM c_customers
           UNION ALL
           SELECT id, CASE WHEN is_active THEN segment ELSE 'Churned' END, country, DATE '2001-08-01'
           FROM c_customers WHERE country <> 'NATION_3'),
opened AS (SELECT *, lag(segment) OVER w IS DISTINCT FROM segment AS opens FROM states
           WINDOW w AS (PARTITION BY id ORDER BY d)),
history AS (SELECT id, segment, country, d AS valid_from,
                   coalesce(lead(d) OVER (PARTITION BY id ORDER BY d),
                            CASE WHEN country = 'NATION_3' THEN DATE '2001-08-01' END) AS valid_to
            FROM opened WHERE opens)"""
SQL["dim_customer_scd2"] = SQL["scd2_apply"] = SCD2 + " SELECT *, valid_to IS NULL AS is_current FROM history"
SQL["jn_scd2_lookup"] = SCD2 + """
SELECT o.id AS order_id, o.customer_id, o.order_date, h.segment, h.valid_from AS version_from, h.valid_to AS version_to
FROM c_orders o LEFT JOIN history h ON o.customer_id = h.id AND o.order_date >= h.valid_from
     AND (h.valid_to IS NULL OR o.order_date < h.valid_to)"""

SQL["fact_order"] = over("c_orders", "c_paid") + """
SELECT o.id AS order_id, o.order_number, o.customer_id, strftime(o.order_date, '%Y%m%d')::INTEGER AS date_key,
       o.order_date, o.channel, o.status AS order_status, o.subtotal::DOUBLE AS subtotal,
       o.discount_amount::DOUBLE AS discount_amount, o.tax_amount::DOUBLE AS tax_amount,
       o.shipping_fee::DOUBLE AS shipping_fee, o.total_amount::DOUBLE AS total_amount,
       coalesce(p.paid, 0)::DOUBLE AS paid_amount, coalesce(p.n, 0) AS payment_count
FROM c_orders o LEFT JOIN c_paid p ON o.id = p.order_id"""
SQL["fact_orderline"] = over("c_order_items", "c_orders", "c_products") + """
SELECT i.id AS order_item_id, i.order_id, o.order_number, o.customer_id, i.product_id,
       strftime(o.order_date, '%Y%m%d')::INTEGER AS date_key, o.order_date, o.channel, o.status AS order_status,
       i.quantity, i.unit_price::DOUBLE AS unit_price, i.discount_percent::DOUBLE AS discount_percent,
       i.line_total::DOUBLE AS line_total,
       round(i.quantity * i.unit_price * (100 - i.discount_percent) * 0.01::DECIMAL(3,2), 2)::DOUBLE AS recomputed_total,
       (i.quantity * p.cost_price)::DOUBLE AS cost_amount,
       (i.line_total - i.quantity * p.cost_price)::DOUBLE AS margin_amount
FROM c_order_items i LEFT JOIN c_orders o ON i.order_id = o.id LEFT JOIN c_products p ON i.product_id = p.id"""
SQL["fact_payment"] = over("c_payments", "c_orders") + """
SELECT p.id AS payment_id, p.payment_code, p.order_id, o.customer_id,
       strftime(p.payment_date, '%Y%m%d')::INTEGER AS date_key, p.payment_date, p.payment_method, p.payment_gateway,
       p.status AS payment_status, p.amount::DOUBLE AS amount, (p.payment_date - o.order_date)::INTEGER AS days_to_pay,
       o.id IS NOT NULL AS has_order
FROM c_payments p LEFT JOIN c_orders o ON p.order_id = o.id"""
# One line per fact and dimension: what its key column refers to, and which rows of it exist.
INTEGRITY = (
    ("fact_orderline", "customer", "lines", "customer_id", "c_customers"),
    ("fact_orderline", "product", "lines", "product_id", "kept_products"),
    ("fact_orderline", "channel", "lines", None, None),
    ("fact_payment", "customer", "paid", "customer_id", "c_customers"),
    ("fact_payment", "channel", "paid", None, None),
    ("fact_invoice", "customer", "c_invoices", "customer_id", "c_customers"),
    ("fact_invoice", "channel", "c_invoices", None, None),
    ("fact_order", "customer", "kept_orders", "customer_id", "c_customers"),
    ("fact_order", "channel", "kept_orders", None, None),
)
SQL["fact_dim_integrity"] = over("c_customers", "c_orders", "c_products", "c_order_items", "c_payments", "c_invoices") + """,
kept_orders AS (SELECT * FROM c_orders WHERE status <> 'Shipped'),
kept_products AS (SELECT * FROM c_products WHERE stock_quantity > 10),
lines AS (SELECT i.product_id, o.customer_id FROM c_order_items i LEFT JOIN kept_orders o ON i.order_id = o.id),
paid AS (SELECT o.customer_id FROM c_payments p LEFT JOIN kept_orders o ON p.order_id = o.id)""" + " UNION ALL ".join(
    f"""
SELECT '{fact}' AS fact, '{dimension}' AS dimension, count(*) AS rows, count(*) FILTER ({column} IS NULL) AS unknown_rows,
       count(*) FILTER ({column} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {parent} d WHERE d.id = f.{column}))
         AS rows_without_member, 0::BIGINT AS repeated_keys FROM {source} f"""
    if column
    else f"""
SELECT '{fact}' AS fact, '{dimension}' AS dimension, count(*) AS rows, 0 AS unknown_rows, 0 AS rows_without_member,
       0::BIGINT AS repeated_keys FROM {source} f"""
    for fact, dimension, source, column, parent in INTEGRITY
)
SQL["util_code_sequence"] = over("c_payments") + """
SELECT id, payment_date, amount::DOUBLE AS amount,
       printf('PAY-2024-%06d', row_number() OVER (ORDER BY payment_date, id)) AS new_code FROM c_payments"""

# ---- streaming ---------------------------------------------------------------

SQL["stream_sales_refresh"] = over("c_orders") + """
SELECT time_bucket(INTERVAL 30 MINUTE, order_timestamp) AS window_start,
       time_bucket(INTERVAL 30 MINUTE, order_timestamp) + INTERVAL 30 MINUTE AS window_end, channel,
       count(*) AS orders, sum(total_amount)::DOUBLE AS revenue
FROM c_orders WHERE status NOT IN ('Cancelled', 'Refunded') GROUP BY 1, 2, 3"""
SQL["stream_recon_alerts"] = over("c_orders", "c_payments", "c_paid") + """
SELECT o.id AS order_id, o.order_number, o.order_date, o.total_amount::DOUBLE AS order_amount,
       coalesce(p.paid, 0)::DOUBLE AS paid_amount, (o.total_amount - coalesce(p.paid, 0))::DOUBLE AS discrepancy
FROM c_orders o LEFT JOIN c_paid p ON o.id = p.order_id
WHERE o.id IN (SELECT order_id FROM c_payments) AND abs(o.total_amount - coalesce(p.paid, 0)) > 100000"""

SQL["jn_scd2_sweep"] = SQL["jn_scd2_lookup"]
SQL["snap_diff_tree"] = SQL["snap_diff"]
SQL["snap_recon_tree"] = over("c_customers", "c_orders", "c_order_changes") + """
SELECT 'customers' AS table_name, count(*) AS source_count, count(*) AS staging_count, 0::BIGINT AS differing_ranges, 'PASS' AS status FROM c_customers
UNION ALL
SELECT 'orders', (SELECT count(*) FROM c_orders), (SELECT count(*) FROM c_orders), count(DISTINCT id // 256), 'FAIL'
FROM (SELECT * FROM c_order_changes EXCEPT SELECT * FROM c_orders) x"""

SQL["inc_extract_clustered"] = SQL["inc_extract"]
SQL["clustered_customer_lookup"] = over("c_orders") + """
SELECT id, customer_id, order_date, total_amount::DOUBLE AS total_amount FROM c_orders WHERE customer_id = (
  SELECT customer_id FROM c_orders GROUP BY customer_id ORDER BY count(*) DESC, customer_id DESC LIMIT 1)"""

SQL["stream_sales_windows"] = SQL["stream_sales_refresh"]
