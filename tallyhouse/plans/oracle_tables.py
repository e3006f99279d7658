"""The source tables in SQL, as common table expressions over the test tables.

Written independently of ``sources.binding``; both state the same stand-in rules.
"""

from __future__ import annotations

CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "c_categories": (
        (),
        """
        SELECT ('0x' || substr(md5(path), 1, 7))::BIGINT AS id, path AS name,
               'Products of type ' || path AS description,
               CASE WHEN parent IS NOT NULL THEN ('0x' || substr(md5(parent), 1, 7))::BIGINT END AS parent_id,
               TRUE AS is_active, TIMESTAMP '1994-01-01' AS created_at, TIMESTAMP '1994-01-01' AS updated_at
        FROM (SELECT DISTINCT p_type AS path, NULL::VARCHAR AS parent FROM part
              UNION ALL
              SELECT DISTINCT p_type || '/' || p_brand, p_type FROM part) n""",
    ),
    "c_products": (
        (),
        """
        SELECT p_partkey AS id, printf('SKU-%06d', p_partkey) AS sku, p_name AS name,
               p_brand || ' ' || p_type AS description,
               ('0x' || substr(md5(p_type || '/' || p_brand), 1, 7))::BIGINT AS category_id,
               p_retailprice::DECIMAL(15,2) AS unit_price,
               CASE WHEN p_size > 1
                    THEN round(p_retailprice::DECIMAL(15,2) * 0.70::DECIMAL(3,2), 2)::DECIMAL(15,2) END AS cost_price,
               p_size::INTEGER AS stock_quantity, TRUE AS is_active,
               TIMESTAMP '1994-01-01' AS created_at, TIMESTAMP '1994-01-01' AS updated_at
        FROM part""",
    ),
    "c_customers": (
        (),
        """
        SELECT id, customer_code, email, first_name, last_name, phone, NULL::DATE AS date_of_birth,
               NULL::VARCHAR AS gender, NULL::VARCHAR AS address_line1, NULL::VARCHAR AS address_line2,
               NULL::VARCHAR AS city, NULL::VARCHAR AS state, NULL::VARCHAR AS postal_code, country, segment,
               registration_date, is_active, registration_date::TIMESTAMP AS created_at,
               registration_date::TIMESTAMP AS updated_at
        FROM (SELECT c_custkey AS id, printf('CUST-2024-%06d', c_custkey) AS customer_code,
                     lower(replace(c_name, '#', '')) || '@example.com' AS email,
                     split_part(c_name, '#', 1) AS first_name, split_part(c_name, '#', 2) AS last_name,
                     printf('+84%09d', c_custkey) AS phone, n_name AS country, c_mktsegment AS segment,
                     DATE '1994-01-01' + (((floor(c_acctbal)::BIGINT % 730) + 730) % 730)::INTEGER AS registration_date,
                     c_acctbal >= 0 AS is_active
              FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey) c""",
    ),
    "c_orders": (
        (),
        """
        SELECT id, order_number, customer_id, order_date, order_timestamp, status,
               (total_amount + discount_amount)::DECIMAL(15,2) AS subtotal, discount_amount,
               0::DECIMAL(15,2) AS tax_amount, 0::DECIMAL(15,2) AS shipping_fee, total_amount, channel,
               NULL::VARCHAR AS shipping_address, NULL::VARCHAR AS shipping_city, NULL::VARCHAR AS shipping_phone,
               NULL::VARCHAR AS customer_note, NULL::VARCHAR AS internal_note,
               order_timestamp AS created_at, order_timestamp + INTERVAL 1 DAY AS updated_at
        FROM (SELECT o_orderkey AS id, printf('ORD-2024-%06d', o_orderkey) AS order_number,
                     o_custkey AS customer_id, o_orderdate::DATE AS order_date,
                     o_orderdate + to_minutes(floor(o_totalprice)::BIGINT % 1440) AS order_timestamp,
                     o_totalprice::DECIMAL(15,2) AS total_amount,
                     round(o_totalprice::DECIMAL(15,2)
                           * (CASE WHEN isodow(o_orderdate) >= 6 THEN 0.10 WHEN isodow(o_orderdate) = 5 THEN 0.05
                                   ELSE 0.00 END)::DECIMAL(3,2), 2)::DECIMAL(15,2) AS discount_amount,
                     CASE o_orderstatus
                       WHEN 'F' THEN 'Completed'
                       WHEN 'O' THEN CASE WHEN quarter(o_orderdate) = 1 THEN 'Delivered' ELSE 'Shipped' END
                       ELSE CASE quarter(o_orderdate) WHEN 1 THEN 'Pending' WHEN 2 THEN 'Processing'
                                 WHEN 3 THEN 'Cancelled' ELSE 'Refunded' END
                     END AS status,
                     CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'Website' WHEN '2' THEN 'Website'
                          WHEN '3' THEN 'Mobile App' WHEN '4' THEN 'Marketplace' ELSE 'Store' END AS channel
              FROM orders) o""",
    ),
    "c_order_items": (
        (),
        """
        SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS order_id, l_partkey AS product_id,
               l_quantity::INTEGER AS quantity,
               (((l_extendedprice::DECIMAL(15,2) * 100)::BIGINT // l_quantity::BIGINT)::DECIMAL(13,0)
                 * 0.01::DECIMAL(3,2))::DECIMAL(15,2) AS unit_price,
               (l_discount::DECIMAL(5,2) * 100)::DECIMAL(5,2) AS discount_percent,
               round(l_extendedprice::DECIMAL(15,2) * (1 - l_discount::DECIMAL(5,2)), 2)::DECIMAL(15,2) AS line_total,
               l_shipdate AS created_at
        FROM lineitem""",
    ),
    "c_payments": (
        ("c_orders",),
        """
        SELECT id * 3 + part AS id, printf('PAY-2024-%06d', id * 3 + part) AS payment_code, id AS order_id,
               CASE WHEN d = 14 THEN round(total_amount * 1.05::DECIMAL(3,2), 2)
                    WHEN d = 15 THEN round(total_amount * 0.95::DECIMAL(3,2), 2)
                    WHEN d = 20 AND part = 0 THEN round(total_amount * 0.60::DECIMAL(3,2), 2)
                    WHEN d = 20 THEN total_amount - round(total_amount * 0.60::DECIMAL(3,2), 2)
                    ELSE total_amount END::DECIMAL(15,2) AS amount,
               CASE WHEN w <= 2 THEN 'Bank Transfer' WHEN w = 3 THEN 'Credit Card' WHEN w = 4 THEN 'COD'
                    WHEN w = 5 THEN 'E-Wallet' ELSE 'Cash' END AS payment_method,
               CASE WHEN w <= 3 THEN 'VNPay' WHEN w = 5 THEN 'Momo' END AS payment_gateway,
               pay_status AS status,
               CASE WHEN pay_status = 'Completed' THEN order_date + d % 4 ELSE order_date END AS payment_date,
               CASE WHEN pay_status = 'Completed'
                    THEN (order_date + d % 4)::TIMESTAMP + INTERVAL 8 HOUR END AS paid_at,
               NULL::VARCHAR AS transaction_ref, NULL::VARCHAR AS gateway_response,
               order_timestamp AS created_at, order_timestamp AS updated_at
        FROM (SELECT o.*, unnest(CASE WHEN d = 20 THEN [0, 1] ELSE [0] END)::BIGINT AS part
              FROM (SELECT *, day(order_date)::INTEGER AS d, isodow(order_date) AS w,
                           CASE WHEN status IN ('Completed', 'Delivered', 'Shipped') THEN 'Completed'
                                WHEN status = 'Processing' THEN
                                     CASE WHEN day(order_date) <= 15 THEN 'Completed' ELSE 'Processing' END
                                WHEN status = 'Pending' THEN CASE WHEN day(order_date) > 15 THEN 'Pending' END
                                WHEN status = 'Cancelled' THEN CASE WHEN day(order_date) > 9 THEN 'Failed' END
                                ELSE 'Refunded' END AS pay_status
                    FROM c_orders) o
              WHERE pay_status IS NOT NULL AND d < 31) p
        UNION ALL
        SELECT event_id * 3 + 2, printf('PAY-2024-%06d', event_id * 3 + 2), event_id * 2, value::DECIMAL(15,2),
               'E-Wallet', 'Momo', 'Completed', ts::DATE, ts, printf('GTW-%d', event_id),
               props, ts, ts
        FROM events WHERE event_type = 'purchase'""",
    ),
    "c_invoices": (
        ("c_orders",),
        """
        SELECT id, printf('INV-2024-%06d', id) AS invoice_number, id AS order_id, customer_id,
               order_date + d % 6 AS invoice_date, order_date + d % 6 + 30 AS due_date, inv_subtotal AS subtotal,
               tax_amount, (inv_subtotal + tax_amount)::DECIMAL(15,2) AS total_amount,
               CASE WHEN d <= 25 THEN 'Paid' WHEN d <= 28 THEN 'Issued' ELSE 'Closed' END AS status,
               strftime(order_date + d % 6, '%Y-%m') AS accounting_period, NULL::VARCHAR AS notes,
               (order_date + d % 6)::TIMESTAMP AS created_at, (order_date + d % 6)::TIMESTAMP AS updated_at
        FROM (SELECT *, day(order_date)::INTEGER AS d,
                     CASE WHEN day(order_date) = 8 THEN round(subtotal * 1.03::DECIMAL(3,2), 2)
                          ELSE subtotal END::DECIMAL(15,2) AS inv_subtotal
              FROM c_orders WHERE status IN ('Completed', 'Delivered') AND day(order_date) <> 7) o""",
    ),
    "c_invoice_items": (
        ("c_order_items", "c_invoices"),
        """
        SELECT i.id, v.id AS invoice_id, i.product_id, 'Product #' || i.product_id AS description,
               i.quantity::DECIMAL(15,2) AS quantity, i.unit_price, 10.00::DECIMAL(5,2) AS tax_rate, i.line_total,
               i.created_at
        FROM c_order_items i JOIN c_invoices v ON i.order_id = v.id""",
    ),
    "c_order_changes": (
        ("c_orders",),
        """
        SELECT * REPLACE (
                 (CASE WHEN channel = 'Website' THEN round(total_amount * 1.10::DECIMAL(3,2), 2)
                       ELSE total_amount END)::DECIMAL(15,2) AS total_amount,
                 (CASE WHEN channel = 'Website' THEN updated_at + INTERVAL 1 DAY ELSE updated_at END) AS updated_at)
        FROM c_orders WHERE order_date >= (SELECT max(order_date) FROM c_orders) - 30""",
    ),
    # Three change sets after c_orders: the feed; its pending orders deleted; its shipped ones
    # cancelled and the web's deleted ones placed anew.
    "c_kept": (
        ("c_orders", "c_order_changes"),
        """
        SELECT * FROM c_orders WHERE id NOT IN (SELECT id FROM c_order_changes)
        UNION ALL
        SELECT * REPLACE (CASE status WHEN 'Shipped' THEN 'Cancelled' WHEN 'Pending' THEN 'Processing' ELSE status END AS status)
        FROM c_order_changes WHERE status <> 'Pending' OR channel = 'Website'""",
    ),
    "c_spend": (
        ("c_orders",),
        "SELECT date_trunc('month', order_date)::DATE AS month, sum(discount_amount) AS spend FROM c_orders GROUP BY 1",
    ),
    "c_paid": (
        ("c_payments",),
        """SELECT order_id, sum(amount) AS paid, count(*) AS n FROM c_payments
           WHERE status = 'Completed' GROUP BY order_id""",
    ),
}


def over(*tables: str) -> str:
    """WITH prefix that defines the named source tables and what they build on."""
    wanted: list[str] = []

    def add(name: str) -> None:
        for parent in CTES[name][0]:
            add(parent)
        if name not in wanted:
            wanted.append(name)

    for table in tables:
        add(table)
    return "WITH " + ",\n".join(f"{name} AS ({CTES[name][1]})" for name in wanted)
