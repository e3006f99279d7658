"""The eight source tables: columns, keys and constraints.

Schemas are DDL strings, usable as they are in ``spark.read.schema``.
Constraints are not enforced by Spark; ``operators.quality`` turns them into
data-quality rules.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import StructType

# The accepted values of the coded columns.
ORDER_STATUSES = ("Pending", "Processing", "Shipped", "Delivered", "Completed", "Cancelled", "Refunded")
CHANNELS = ("Website", "Mobile App", "Marketplace", "Store")
SEGMENTS = ("VIP", "Regular", "Occasional", "New", "Churned")
GENDERS = ("Male", "Female", "Other")
PAYMENT_METHODS = ("Credit Card", "Bank Transfer", "COD", "E-Wallet", "Cash")
PAYMENT_STATUSES = ("Pending", "Processing", "Completed", "Failed", "Refunded")
INVOICE_STATUSES = ("Draft", "Issued", "Paid", "Overdue", "Cancelled", "Closed")

# Orders in these states carry no revenue.
NON_REVENUE_STATUSES = ("Cancelled", "Refunded")
# Orders in these states are due an invoice.
INVOICEABLE_STATUSES = ("Completed", "Delivered")


@dataclass(frozen=True)
class Table:
    name: str
    ddl: str
    primary_key: str = "id"
    unique: tuple[str, ...] = ()
    foreign_keys: tuple[tuple[str, str], ...] = ()  # (column, parent table)
    domains: dict[str, tuple[str, ...]] = field(default_factory=dict)
    checks: dict[str, str] = field(default_factory=dict)  # rule name -> condition that must hold
    lengths: dict[str, int] = field(default_factory=dict)
    required: tuple[str, ...] = ()  # columns a source must deliver
    min_rows: int = 0

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.ddl)

    @property
    def not_null(self) -> list[str]:
        return [f.name for f in self.schema.fields if not f.nullable]


CATEGORIES = Table(
    name="categories",
    ddl="""id BIGINT NOT NULL, name STRING NOT NULL, description STRING, parent_id BIGINT,
        is_active BOOLEAN, created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ""",
    unique=("name",),
    foreign_keys=(("parent_id", "categories"),),
    lengths={"name": 100},
    required=("id", "name", "description", "parent_id", "is_active", "created_at", "updated_at"),
    min_rows=10,
)
PRODUCTS = Table(
    name="products",
    ddl="""id BIGINT NOT NULL, sku STRING NOT NULL, name STRING NOT NULL, description STRING,
        category_id BIGINT NOT NULL, unit_price DECIMAL(15,2) NOT NULL, cost_price DECIMAL(15,2),
        stock_quantity INT, is_active BOOLEAN, created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ""",
    unique=("sku",),
    foreign_keys=(("category_id", "categories"),),
    checks={"unit_price_positive": "unit_price > 0", "cost_price_not_negative": "cost_price >= 0"},
    lengths={"sku": 50, "name": 255},
    min_rows=100,
)
CUSTOMERS = Table(
    name="customers",
    ddl="""id BIGINT NOT NULL, customer_code STRING NOT NULL, email STRING NOT NULL,
        first_name STRING NOT NULL, last_name STRING NOT NULL, phone STRING, date_of_birth DATE,
        gender STRING, address_line1 STRING, address_line2 STRING, city STRING, state STRING,
        postal_code STRING, country STRING, segment STRING, registration_date DATE,
        is_active BOOLEAN, created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ""",
    unique=("customer_code", "email"),
    domains={"gender": GENDERS, "segment": SEGMENTS},
    lengths={"customer_code": 20, "email": 255, "phone": 20},
    required=("id", "customer_code", "email", "first_name", "last_name", "segment"),
    min_rows=1000,
)
ORDERS = Table(
    name="orders",
    ddl="""id BIGINT NOT NULL, order_number STRING NOT NULL, customer_id BIGINT NOT NULL,
        order_date DATE NOT NULL, order_timestamp TIMESTAMP_NTZ NOT NULL, status STRING NOT NULL,
        subtotal DECIMAL(15,2) NOT NULL, discount_amount DECIMAL(15,2), tax_amount DECIMAL(15,2),
        shipping_fee DECIMAL(15,2), total_amount DECIMAL(15,2) NOT NULL, channel STRING,
        shipping_address STRING, shipping_city STRING, shipping_phone STRING, customer_note STRING,
        internal_note STRING, created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ""",
    unique=("order_number",),
    foreign_keys=(("customer_id", "customers"),),
    domains={"status": ORDER_STATUSES, "channel": CHANNELS},
    checks={"total_amount_not_negative": "total_amount >= 0"},
    lengths={"order_number": 20, "shipping_phone": 20},
    required=("id", "order_number", "customer_id", "order_date", "status", "total_amount", "channel"),
    min_rows=10000,
)
ORDER_ITEMS = Table(
    name="order_items",
    ddl="""id BIGINT NOT NULL, order_id BIGINT NOT NULL, product_id BIGINT NOT NULL,
        quantity INT NOT NULL, unit_price DECIMAL(15,2) NOT NULL, discount_percent DECIMAL(5,2),
        line_total DECIMAL(15,2) NOT NULL, created_at TIMESTAMP_NTZ""",
    foreign_keys=(("order_id", "orders"), ("product_id", "products")),
    checks={
        "quantity_positive": "quantity > 0",
        "unit_price_positive": "unit_price > 0",
        "discount_percent_0_100": "discount_percent BETWEEN 0 AND 100",
    },
)
PAYMENTS = Table(
    name="payments",
    ddl="""id BIGINT NOT NULL, payment_code STRING NOT NULL, order_id BIGINT NOT NULL,
        amount DECIMAL(15,2) NOT NULL, payment_method STRING NOT NULL, payment_gateway STRING,
        status STRING NOT NULL, payment_date DATE, paid_at TIMESTAMP_NTZ, transaction_ref STRING,
        gateway_response STRING, created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ""",
    unique=("payment_code",),
    foreign_keys=(("order_id", "orders"),),
    domains={"payment_method": PAYMENT_METHODS, "status": PAYMENT_STATUSES},
    lengths={"payment_code": 20, "transaction_ref": 100},
)
INVOICES = Table(
    name="invoices",
    ddl="""id BIGINT NOT NULL, invoice_number STRING NOT NULL, order_id BIGINT NOT NULL,
        customer_id BIGINT NOT NULL, invoice_date DATE NOT NULL, due_date DATE,
        subtotal DECIMAL(15,2) NOT NULL, tax_amount DECIMAL(15,2), total_amount DECIMAL(15,2) NOT NULL,
        status STRING NOT NULL, accounting_period STRING, notes STRING,
        created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ""",
    unique=("invoice_number",),
    foreign_keys=(("order_id", "orders"), ("customer_id", "customers")),
    domains={"status": INVOICE_STATUSES},
    lengths={"invoice_number": 20, "accounting_period": 7},
)
INVOICE_ITEMS = Table(
    name="invoice_items",
    ddl="""id BIGINT NOT NULL, invoice_id BIGINT NOT NULL, product_id BIGINT,
        description STRING NOT NULL, quantity DECIMAL(15,2) NOT NULL, unit_price DECIMAL(15,2) NOT NULL,
        tax_rate DECIMAL(5,2), line_total DECIMAL(15,2) NOT NULL, created_at TIMESTAMP_NTZ""",
    foreign_keys=(("invoice_id", "invoices"), ("product_id", "products")),
)

# Parents before children: the order in which tables are exported and loaded.
TABLES = {
    t.name: t
    for t in (CATEGORIES, PRODUCTS, CUSTOMERS, ORDERS, ORDER_ITEMS, PAYMENTS, INVOICES, INVOICE_ITEMS)
}
