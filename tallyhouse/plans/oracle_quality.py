"""SQL counterparts of the data-quality queries: one statement per rule."""

from __future__ import annotations

from .oracle_loading import ORDER_COLUMNS
from .oracle_tables import over

SQL: dict[str, str] = {}

ALL = ("categories", "products", "customers", "orders", "order_items", "payments", "invoices", "invoice_items")
TABLES = over(*(f"c_{n}" for n in ALL))


def rule(suffix: str, table: str, name: str, dimension: str, severity: str, checked: str, failed: str, allowed: int = 0,
         source: str | None = None) -> str:
    bad = "WARN" if severity == "minor" else "FAIL"
    return f"""
SELECT '{table}.{name}.{suffix}' AS rule_id, '{table}' AS table_name, '{dimension}' AS dimension,
       '{severity}' AS severity, checked, failed::BIGINT AS failed,
       CASE WHEN failed <= {allowed} THEN 'PASS' ELSE '{bad}' END AS status
FROM (SELECT {checked} AS checked, {failed} AS failed FROM {source or f'c_{table}'}) x"""


def violations(suffix, table, name, dimension, severity, condition, allowed=0):
    return rule(suffix, table, name, dimension, severity, "count(*)", f"count(*) FILTER (WHERE {condition})", allowed)


def keys(table: str, column: str, pk: bool) -> str:
    grouped = f"(SELECT {column} AS k, count(*) AS n FROM c_{table} GROUP BY 1) g"
    nulls = " + coalesce(sum(n) FILTER (WHERE k IS NULL), 0)" if pk else ""
    return rule("pk" if pk else "unique", table, column, "uniqueness", "blocker", "sum(n)::BIGINT",
                f"count(*) FILTER (WHERE n > 1 AND k IS NOT NULL){nulls}", 0, grouped)


def reference(table: str, column: str, parent: str, required: bool = True) -> str:
    extra = "" if required else f" AND c.{column} IS NOT NULL"
    source = f"c_{table} c LEFT JOIN (SELECT DISTINCT id FROM c_{parent}) p ON c.{column} = p.id"
    return rule("fk", table, column, "consistency", "blocker", "count(*)",
                f"count(*) FILTER (WHERE p.id IS NULL{extra})", 0, source)


PK = [keys(t, "id", True) for t in ALL]
UNIQUE = [
    keys(t, c, False)
    for t, c in (
        ("categories", "name"), ("products", "sku"), ("customers", "customer_code"), ("customers", "email"),
        ("orders", "order_number"), ("payments", "payment_code"), ("invoices", "invoice_number"),
    )
]
FK = [
    reference("categories", "parent_id", "categories", required=False),
    reference("products", "category_id", "categories"),
    reference("orders", "customer_id", "customers"),
    reference("order_items", "order_id", "orders"),
    reference("order_items", "product_id", "products"),
    reference("payments", "order_id", "orders"),
    reference("invoices", "order_id", "orders"),
    reference("invoices", "customer_id", "customers"),
    reference("invoice_items", "invoice_id", "invoices"),
    reference("invoice_items", "product_id", "products", required=False),
]
# The columns that must be set, by table.
MUST_BE_SET = {
    "categories": ("id", "name"),
    "products": ("id", "sku", "name", "category_id", "unit_price"),
    "customers": ("id", "customer_code", "email", "first_name", "last_name"),
    "orders": (
        "id", "order_number", "customer_id", "order_date", "order_timestamp", "status", "subtotal", "total_amount",
    ),
    "order_items": ("id", "order_id", "product_id", "quantity", "unit_price", "line_total"),
    "payments": ("id", "payment_code", "order_id", "amount", "payment_method", "status"),
    "invoices": (
        "id", "invoice_number", "order_id", "customer_id", "invoice_date", "subtotal", "total_amount", "status",
    ),
    "invoice_items": ("id", "invoice_id", "description", "quantity", "unit_price", "line_total"),
}
NOT_NULL = [
    violations("not_null", t, c, "completeness", "blocker", f"{c} IS NULL") for t, columns in MUST_BE_SET.items() for c in columns
]
DOMAINS = {
    ("customers", "gender"): "'Male', 'Female', 'Other'",
    ("customers", "segment"): "'VIP', 'Regular', 'Occasional', 'New', 'Churned'",
    ("orders", "status"): "'Pending', 'Processing', 'Shipped', 'Delivered', 'Completed', 'Cancelled', 'Refunded'",
    ("orders", "channel"): "'Website', 'Mobile App', 'Marketplace', 'Store'",
    ("payments", "payment_method"): "'Credit Card', 'Bank Transfer', 'COD', 'E-Wallet', 'Cash'",
    ("payments", "status"): "'Pending', 'Processing', 'Completed', 'Failed', 'Refunded'",
    ("invoices", "status"): "'Draft', 'Issued', 'Paid', 'Overdue', 'Cancelled', 'Closed'",
}
ACCEPTED = [
    violations("accepted_values", t, c, "validity", "major", f"{c} IS NOT NULL AND {c} NOT IN ({values})")
    for (t, c), values in DOMAINS.items()
]
RANGE = [
    violations("range", "products", "unit_price_positive", "validity", "major", "unit_price <= 0"),
    violations("range", "products", "cost_price_not_negative", "validity", "major", "cost_price < 0"),
    violations("range", "orders", "total_amount_not_negative", "validity", "major", "total_amount < 0"),
    violations("range", "orders", "total_amount_positive", "validity", "minor", "total_amount <= 0"),
    violations("range", "order_items", "quantity_positive", "validity", "major", "quantity <= 0"),
    violations("range", "order_items", "unit_price_positive", "validity", "major", "unit_price <= 0"),
    violations("range", "order_items", "discount_percent_0_100", "validity", "major",
               "discount_percent < 0 OR discount_percent > 100"),
]
LENGTH = [
    violations("length", t, c, "validity", "minor", f"length({c}) > {n}")
    for t, c, n in (
        ("categories", "name", 100), ("products", "sku", 50), ("products", "name", 255),
        ("customers", "customer_code", 20), ("customers", "email", 255), ("customers", "phone", 20),
        ("orders", "order_number", 20), ("orders", "shipping_phone", 20), ("payments", "payment_code", 20),
        ("payments", "transaction_ref", 100), ("invoices", "invoice_number", 20), ("invoices", "accounting_period", 7),
    )
]
FORMAT = [
    violations("format", t, c, "validity", "minor", f"NOT regexp_full_match({c}, '{p}-[0-9]{{4}}-[0-9]{{6,}}')")
    for t, c, p in (
        ("customers", "customer_code", "CUST"), ("orders", "order_number", "ORD"),
        ("payments", "payment_code", "PAY"), ("invoices", "invoice_number", "INV"),
    )
] + [violations("format", "customers", "email", "validity", "major", "position('@' IN email) = 0")]
MIN_ROWS = [
    rule("min_rows", t, "", "completeness", "major", "count(*)", f"(count(*) < {n})::BIGINT").replace(f"'{t}..", f"'{t}.")
    for t, n in (("categories", 10), ("products", 100), ("customers", 1000), ("orders", 10000))
]
DATES = [
    violations("date_range", "orders", "order_date", "validity", "major",
               "order_date NOT BETWEEN DATE '1995-01-01' AND DATE '2001-07-31'")
]
ITEMS = "c_orders o LEFT JOIN (SELECT order_id, sum(line_total) AS s FROM c_order_items GROUP BY 1) i ON o.id = i.order_id"
SUMS = [rule("sum_match", "orders", "subtotal", "accuracy", "major", "count(*)",
             "count(*) FILTER (WHERE abs(o.subtotal - coalesce(i.s, 0)) > 1)", 9, ITEMS)]
OWNER = [rule("owner", "invoices", "customer_id", "consistency", "major", "count(*)",
              "count(*) FILTER (WHERE i.customer_id IS DISTINCT FROM o.customer_id)", 0,
              "c_invoices i JOIN c_orders o ON i.order_id = o.id")]


def report(rules: list[str], tables: str = TABLES) -> str:
    return tables + " UNION ALL ".join(rules)


EVERY = PK + UNIQUE + FK + NOT_NULL + ACCEPTED + RANGE + LENGTH + FORMAT + MIN_ROWS + DATES + SUMS + OWNER

SQL["dq_run"] = report(EVERY)
SQL["dq_pk"] = report(PK)
SQL["dq_unique"] = report(UNIQUE)
SQL["dq_fk"] = report(FK)
SQL["dq_not_null"] = report(NOT_NULL)
SQL["dq_accepted_values"] = report(ACCEPTED)
SQL["dq_range"] = report(RANGE)
SQL["dq_format"] = report(FORMAT + LENGTH)
SQL["dq_min_rows"] = report(MIN_ROWS)
SQL["dq_consistency"] = report(OWNER)
SQL["dq_sum_match"] = over("c_orders", "c_order_items") + f"""
SELECT o.id AS order_id, o.subtotal::DOUBLE AS subtotal, coalesce(i.s, 0)::DOUBLE AS items_total,
       abs(o.subtotal - coalesce(i.s, 0))::DOUBLE AS diff FROM {ITEMS} WHERE abs(o.subtotal - coalesce(i.s, 0)) > 1"""
SQL["dq_date_range"] = over("c_orders") + """
SELECT min(order_date) AS min_date, max(order_date) AS max_date,
       CASE WHEN min(order_date) >= DATE '1995-01-01' AND max(order_date) <= DATE '2001-07-31' THEN 'PASS' ELSE 'FAIL' END
       AS status FROM c_orders"""
SQL["dq_tables_present"] = TABLES + " UNION ALL ".join(
    f" SELECT '{t}' AS table_name, TRUE AS present, count(*) AS rows, 'PASS' AS status FROM c_{t}"
    for t in ALL
    if t != "invoice_items"
) + " UNION ALL SELECT 'invoice_items', FALSE, 0, 'FAIL'"

# The columns the checks ask for, by table.
REQUIRED = {
    "categories": ("id", "name", "description", "parent_id", "is_active", "created_at", "updated_at"),
    "customers": ("id", "customer_code", "email", "first_name", "last_name", "segment"),
    "orders": ("id", "order_number", "customer_id", "order_date", "status", "total_amount", "channel"),
}
LOST = "segment"  # dropped from the customers the query looks at


def required(table: str, column: str) -> str:
    if column == LOST:
        return f" SELECT '{table}' AS table_name, '{column}' AS column_name, FALSE AS present, 0 AS filled, 'FAIL' AS status"
    return f" SELECT '{table}' AS table_name, '{column}' AS column_name, TRUE AS present, count({column}) AS filled, 'PASS' AS status FROM c_{table}"


SQL["dq_required_columns"] = over(*(f"c_{t}" for t in REQUIRED)) + " UNION ALL ".join(
    required(t, c) for t, columns in REQUIRED.items() for c in columns
)

# The columns of the payment table.
PAYMENT_COLUMNS = (
    "id", "payment_code", "order_id", "amount", "payment_method", "payment_gateway", "status", "payment_date", "paid_at",
    "transaction_ref", "gateway_response", "created_at", "updated_at",
)
SQL["dq_profile"] = over("c_payments") + " UNION ALL ".join(
    f"""
SELECT '{c}' AS column_name, count(*) AS rows, count(*) FILTER (WHERE {c} IS NULL) AS nulls,
       count(DISTINCT {c}) AS distinct_values, min({c})::VARCHAR AS min_value, max({c})::VARCHAR AS max_value
FROM c_payments"""
    for c in PAYMENT_COLUMNS
)

CUSTOMER_TYPES = {
    "id": "bigint", "customer_code": "string", "email": "string", "first_name": "string", "last_name": "string",
    "phone": "string", "date_of_birth": "date", "gender": "string", "address_line1": "string",
    "address_line2": "string", "city": "string", "state": "string", "postal_code": "string", "country": "string",
    "segment": "string", "registration_date": "date", "is_active": "boolean", "created_at": "timestamp_ntz",
    "updated_at": "timestamp_ntz",
}


def drift(column: str, kind: str) -> str:
    after = {"id": "'string'", "gender": "NULL"}.get(column, f"'{kind}'")
    change = {"id": "retyped", "gender": "removed"}.get(column, "unchanged")
    filled = "NULL" if column == "gender" else f"count({column})"
    return (
        f" SELECT '{column}' AS column_name, '{kind}' AS previous_type, count({column}) AS previous_filled, "
        f"{after} AS current_type, {filled} AS current_filled, '{change}' AS change FROM c_customers"
    )


SQL["dq_schema_drift"] = over("c_customers") + " UNION ALL ".join(
    [drift(c, k) for c, k in CUSTOMER_TYPES.items()]
    + [" SELECT 'loyalty_tier', NULL, NULL, 'string', count(*) FILTER (WHERE is_active), 'added' FROM c_customers"]
)

METRICS = {
    "row_count": "count(*)::DOUBLE",
    "sum_line_total": "sum(line_total)::DOUBLE",
    "count_line_total": "count(line_total)::DOUBLE",
    "avg_line_total": "sum(line_total)::DOUBLE / count(line_total)",
    "sum_quantity": "sum(quantity)::DOUBLE",
    "count_quantity": "count(quantity)::DOUBLE",
    "avg_quantity": "sum(quantity)::DOUBLE / count(quantity)",
}
SQL["dq_agg_match"] = over("c_order_items", "c_orders") + """,
part AS (SELECT i.* FROM c_order_items i JOIN c_orders o ON i.order_id = o.id WHERE o.status <> 'Pending'),
pairs AS (""" + " UNION ALL ".join(
    f"""
SELECT '{m}' AS metric, (SELECT {e} FROM c_order_items) AS source, (SELECT {e} FROM {target}) AS target,
       '{name}' AS target_name"""
    for m, e in METRICS.items()
    for name, target in (("fact_orderline", "c_order_items"), ("without_pending", "part"))
) + ") SELECT *, CASE WHEN source IS NOT DISTINCT FROM target THEN 'PASS' ELSE 'FAIL' END AS status FROM pairs"

SQL["dq_timeliness"] = over("c_orders") + """,
runs AS (SELECT max(order_date) AS day, TIMESTAMP '2001-08-02 07:30:00' AS done FROM c_orders
         UNION ALL SELECT (max(order_date) + 1)::DATE, TIMESTAMP '2001-08-03 09:30:00' FROM c_orders),
judged AS (SELECT day, done <= day::TIMESTAMP + INTERVAL 32 HOUR AS in_time FROM runs)
SELECT day AS snapshot_date, bool_and(in_time) AS every_run_on_time, bool_or(in_time) AS on_time, count(*) AS runs,
       CASE WHEN bool_or(in_time) THEN 'PASS' ELSE 'WARN' END AS status FROM judged GROUP BY day"""

# Staged rows per table: all of them, but the change feed for orders and nothing for invoice items.
STAGED = {t: {"orders": "c_order_changes", "invoice_items": None}.get(t, f"c_{t}") for t in ALL}
GATE = (
    ("row_counts", "blocker", "count(*)", "count(*) FILTER (n IS DISTINCT FROM whole)", "staged"),
    ("readable", "blocker", "count(*)", "count(*) FILTER (n IS NULL)", "staged"),
    ("all_tables", "blocker", "count(*)", "count(*) FILTER (n IS NULL)", "staged"),
    ("marker", "blocker", "1", "CASE WHEN count(n) = 0 THEN 1 ELSE 0 END", "staged"),
    ("export_time", "minor", "1", "0", "(SELECT 1) one"),
    ("schema", "minor", "count(*)", "count(*) FILTER (column_name = 'gender')", "customer_columns"),
    ("file_size", "minor", "count(n)", "count(*) FILTER (n < whole / 2)", "staged"),
    ("column_statistics", "info", "count(*)", "count(*) FILTER (filled = 0)", "customer_columns WHERE column_name <> 'gender'"),
    ("sample", "info", str(len(ORDER_COLUMNS)), f"CASE WHEN count(*) > 0 THEN {len(ORDER_COLUMNS)} ELSE 0 END", "unpaired"),
)
SQL["dq_snapshot_gate"] = over("c_order_changes", *(f"c_{t}" for t in ALL)) + ",\nstaged AS (" + " UNION ALL ".join(
    f" SELECT '{t}' AS table_name, {f'(SELECT count(*) FROM {kept})' if kept else 'NULL::BIGINT'} AS n,"
    f" (SELECT count(*) FROM c_{t}) AS whole"
    for t, kept in STAGED.items()
) + "),\ncustomer_columns AS (" + " UNION ALL ".join(
    f" SELECT '{c}' AS column_name, count({c}) AS filled FROM c_customers" for c in CUSTOMER_TYPES
) + """),
unpaired AS (SELECT id FROM c_orders WHERE ('0x' || substr(md5(id::VARCHAR), 1, 2))::INTEGER < 64
             EXCEPT SELECT id FROM c_order_changes),
gate AS (""" + " UNION ALL ".join(
    f" SELECT 'snapshot.{name}' AS rule_id, '{severity}' AS severity, ({checked})::BIGINT AS checked, "
    f"({failed})::BIGINT AS failed FROM {source}"
    for name, severity, checked, failed, source in GATE
) + """) SELECT *, CASE WHEN failed = 0 THEN 'PASS' WHEN severity = 'minor' THEN 'WARN' WHEN severity = 'info' THEN 'INFO'
                 ELSE 'FAIL' END AS status FROM gate"""

ORDER_RULES = [
    r for r in UNIQUE + NOT_NULL + ACCEPTED + RANGE + LENGTH + FORMAT + MIN_ROWS + DATES
    if "AS rule_id, 'orders' AS table_name" in r
]


def outcome(day: str, rules: list[str]) -> str:
    return f"""
SELECT DATE '{day}' AS run_date, severity, count(*) AS rules, count(*) FILTER (WHERE status = 'PASS') AS passed,
       count(*) FILTER (WHERE status = 'WARN') AS warned, count(*) FILTER (WHERE status = 'FAIL') AS failed,
       sum(failed)::BIGINT AS violations FROM ({' UNION ALL '.join(rules)}) r GROUP BY severity"""


SQL["dq_history"] = (
    over("c_orders", "c_order_changes")
    + outcome("2001-07-31", ORDER_RULES)
    + " UNION ALL "
    + outcome("2001-08-01", [r.replace("c_orders", "c_order_changes") for r in ORDER_RULES])
)


def shifted(column: str, number: bool) -> str:
    """Exact distance of a column's values: of the cumulative distributions, or of the shares of each text."""
    distance = "max(abs(fa - fb))" if number else "sum(abs(sa - sb)) / 2"
    return f"""
SELECT 'orders' AS table_name, '{column}' AS column_name, '{'number' if number else 'text'}' AS kind,
       CASE WHEN {distance} <= 0.1 THEN 'PASS' ELSE 'WARN' END AS status
FROM (SELECT *, sum(sa) OVER (ORDER BY v) AS fa, sum(sb) OVER (ORDER BY v) AS fb FROM (
        SELECT v, sum(a) / (SELECT count(*) FROM old) AS sa, sum(b) / (SELECT count(*) FROM c_order_changes) AS sb FROM (
          SELECT {column} AS v, 1 AS a, 0 AS b FROM old UNION ALL SELECT {column}, 0, 1 FROM c_order_changes) x GROUP BY v) y) z"""


SQL["dq_column_drift"] = over("c_orders", "c_order_changes") + ", old AS (SELECT * FROM c_orders WHERE order_date < DATE '2001-07-02')" + " UNION ALL ".join(
    shifted(c, c not in ("status", "channel")) for c in ("order_date", "total_amount", "customer_id", "status", "channel")
)
