"""The source tables as stand-ins over the retail test tables.

The test tables know customers, parts, orders, order lines and an event feed, but
no channels, payments or invoices. This module derives what is missing from the
attributes of whole rows (dates, priorities, states, types) and always from whole
tables. In production the same tables come from ``sources.tables``.

Stand-in rules by day of month (so every reconciliation case occurs): the 7th has
no invoice, the 8th a 3 % higher one, the 14th is overpaid by 5 %, the 15th
underpaid by 5 %, the 20th paid in two instalments, the 31st not paid. Purchase
events act as a gateway feed that knows nothing of the order book.
"""

from __future__ import annotations

from decimal import Decimal
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.dates import accounting_period
from ..functions.money import MONEY, line_total, money
from ..functions.text import business_code
from ..schemas import INVOICEABLE_STATUSES

CODE_YEAR = 2024


def _category_id(path: Column) -> Column:
    return F.conv(F.substring(F.md5(path.cast("binary")), 1, 7), 16, 10).cast("bigint")


def _path(part: DataFrame) -> Column:
    return F.concat_ws("/", part.p_type, part.p_brand)


class Tables:
    """Lazily bound source tables of one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def __getitem__(self, name: str) -> DataFrame:
        return getattr(self, name)

    @cached_property
    def categories(self) -> DataFrame:
        part = self.raw("part")
        brands = part.select("p_type", "p_brand").distinct()
        nodes = brands.select(
            F.explode(
                F.array(
                    F.struct(F.col("p_type").alias("path"), F.lit(None).cast("string").alias("parent")),
                    F.struct(_path(brands).alias("path"), F.col("p_type").alias("parent")),
                )
            ).alias("n")
        ).select("n.*").distinct()
        return nodes.select(
            _category_id(F.col("path")).alias("id"),
            F.col("path").alias("name"),
            F.concat(F.lit("Products of type "), "path").alias("description"),
            F.when(F.col("parent").isNotNull(), _category_id(F.col("parent"))).alias("parent_id"),
            F.lit(True).alias("is_active"),
            F.lit("1994-01-01 00:00:00").cast("timestamp_ntz").alias("created_at"),
            F.lit("1994-01-01 00:00:00").cast("timestamp_ntz").alias("updated_at"),
        )

    @cached_property
    def products(self) -> DataFrame:
        part = self.raw("part")
        price = money(part.p_retailprice)
        return part.select(
            part.p_partkey.alias("id"),
            F.format_string("SKU-%06d", part.p_partkey).alias("sku"),
            part.p_name.alias("name"),
            F.concat_ws(" ", part.p_brand, part.p_type).alias("description"),
            _category_id(_path(part)).alias("category_id"),
            price.alias("unit_price"),
            # Unknown cost for the smallest size, 70 % of the price otherwise.
            F.when(part.p_size > 1, F.round(price * Decimal("0.70"), 2).cast(MONEY)).alias("cost_price"),
            part.p_size.cast("int").alias("stock_quantity"),
            F.lit(True).alias("is_active"),
            F.lit("1994-01-01 00:00:00").cast("timestamp_ntz").alias("created_at"),
            F.lit("1994-01-01 00:00:00").cast("timestamp_ntz").alias("updated_at"),
        )

    @cached_property
    def customers(self) -> DataFrame:
        c = self.raw("customer")
        nation = self.raw("nation").select("n_nationkey", F.col("n_name").alias("country"))
        c = c.join(nation, c.c_nationkey == nation.n_nationkey, "left")
        name = F.split("c_name", "#")
        registered = F.date_add(F.lit("1994-01-01").cast("date"), F.pmod(F.floor("c_acctbal"), F.lit(730)).cast("int"))
        none = F.lit(None)
        return c.select(
            F.col("c_custkey").alias("id"),
            business_code("CUST", CODE_YEAR, F.col("c_custkey")).alias("customer_code"),
            F.concat(F.lower(F.regexp_replace("c_name", "#", "")), F.lit("@example.com")).alias("email"),
            name[0].alias("first_name"),
            name[1].alias("last_name"),
            F.format_string("+84%09d", F.col("c_custkey")).alias("phone"),
            none.cast("date").alias("date_of_birth"),
            none.cast("string").alias("gender"),
            none.cast("string").alias("address_line1"),
            none.cast("string").alias("address_line2"),
            none.cast("string").alias("city"),
            none.cast("string").alias("state"),
            none.cast("string").alias("postal_code"),
            F.col("country"),
            F.col("c_mktsegment").alias("segment"),
            registered.alias("registration_date"),
            (F.col("c_acctbal") >= 0).alias("is_active"),
            registered.cast("timestamp_ntz").alias("created_at"),
            registered.cast("timestamp_ntz").alias("updated_at"),
        )

    @cached_property
    def orders(self) -> DataFrame:
        o = self.raw("orders")
        date = o.o_orderdate.cast("date")
        at = o.o_orderdate + F.make_dt_interval(mins=F.pmod(F.floor(o.o_totalprice), F.lit(1440)).cast("int"))
        total = money(o.o_totalprice)
        rate = (
            F.when(F.weekday(date) >= 5, F.lit(Decimal("0.10")))
            .when(F.weekday(date) == 4, F.lit(Decimal("0.05")))
            .otherwise(F.lit(Decimal("0.00")))
        )
        discount = F.round(total * rate, 2).cast(MONEY)
        quarter = F.quarter(date)
        status = (
            F.when(o.o_orderstatus == "F", "Completed")
            .when(o.o_orderstatus == "O", F.when(quarter == 1, "Delivered").otherwise("Shipped"))
            .when(quarter == 1, "Pending")
            .when(quarter == 2, "Processing")
            .when(quarter == 3, "Cancelled")
            .otherwise("Refunded")
        )
        priority = F.substring(o.o_orderpriority, 1, 1)
        channel = (
            F.when(priority.isin("1", "2"), "Website")
            .when(priority == "3", "Mobile App")
            .when(priority == "4", "Marketplace")
            .otherwise("Store")
        )
        none = F.lit(None).cast("string")
        return o.select(
            o.o_orderkey.alias("id"),
            business_code("ORD", CODE_YEAR, o.o_orderkey).alias("order_number"),
            o.o_custkey.alias("customer_id"),
            date.alias("order_date"),
            at.alias("order_timestamp"),
            status.alias("status"),
            (total + discount).cast(MONEY).alias("subtotal"),
            discount.alias("discount_amount"),
            F.lit(Decimal("0.00")).cast(MONEY).alias("tax_amount"),
            F.lit(Decimal("0.00")).cast(MONEY).alias("shipping_fee"),
            total.alias("total_amount"),
            channel.alias("channel"),
            none.alias("shipping_address"),
            none.alias("shipping_city"),
            none.alias("shipping_phone"),
            none.alias("customer_note"),
            none.alias("internal_note"),
            at.alias("created_at"),
            (at + F.make_dt_interval(days=F.lit(1))).alias("updated_at"),
        )

    @cached_property
    def order_items(self) -> DataFrame:
        i = self.raw("lineitem")
        cents = (money(i.l_extendedprice) * 100).cast("bigint")
        quantity = i.l_quantity.cast("int")
        unit_cents = F.floor(cents / quantity)  # exact: both are far below 2^53
        unit_price = (unit_cents.cast("decimal(13,0)") * Decimal("0.01")).cast(MONEY)
        percent = (i.l_discount.cast("decimal(5,2)") * 100).cast("decimal(5,2)")
        return i.select(
            (i.l_orderkey * 10 + i.l_linenumber).alias("id"),
            i.l_orderkey.alias("order_id"),
            i.l_partkey.alias("product_id"),
            quantity.alias("quantity"),
            unit_price.alias("unit_price"),
            percent.alias("discount_percent"),
            line_total(F.lit(1), money(i.l_extendedprice), percent).alias("line_total"),
            i.l_shipdate.alias("created_at"),
        )

    @cached_property
    def payments(self) -> DataFrame:
        o = self.orders
        day = F.day("order_date")
        first_half = day <= 15
        status = (
            F.when(F.col("status").isin("Completed", "Delivered", "Shipped"), "Completed")
            .when(F.col("status") == "Processing", F.when(first_half, "Completed").otherwise("Processing"))
            .when(F.col("status") == "Pending", F.when(~first_half, "Pending"))
            .when(F.col("status") == "Cancelled", F.when(day > 9, "Failed"))
            .otherwise("Refunded")
        )
        total = F.col("total_amount")
        due = (
            F.when(day == 14, F.round(total * Decimal("1.05"), 2))
            .when(day == 15, F.round(total * Decimal("0.95"), 2))
            .otherwise(total)
            .cast(MONEY)
        )
        deposit = F.round(total * Decimal("0.60"), 2).cast(MONEY)
        parts = F.when(
            day == 20,
            F.array(
                F.struct(F.lit(0).alias("part"), deposit.alias("amount")),
                F.struct(F.lit(1).alias("part"), (total - deposit).cast(MONEY).alias("amount")),
            ),
        ).otherwise(F.array(F.struct(F.lit(0).alias("part"), due.alias("amount"))))
        weekday = F.weekday("order_date")
        method = (
            F.when(weekday <= 1, "Bank Transfer")
            .when(weekday == 2, "Credit Card")
            .when(weekday == 3, "COD")
            .when(weekday == 4, "E-Wallet")
            .otherwise("Cash")
        )
        paid = o.select("*", status.alias("pay_status"), F.explode(parts).alias("p")).where(
            F.col("pay_status").isNotNull() & (day < 31)
        )
        completed = F.col("pay_status") == "Completed"
        number = F.col("id") * 3 + F.col("p.part")
        pay_date = F.when(completed, F.date_add("order_date", F.pmod(day, F.lit(4)))).otherwise(F.col("order_date"))
        from_orders = paid.select(
            number.alias("id"),
            business_code("PAY", CODE_YEAR, number).alias("payment_code"),
            F.col("id").alias("order_id"),
            F.col("p.amount").alias("amount"),
            method.alias("payment_method"),
            F.when(weekday <= 2, "VNPay").when(weekday == 4, "Momo").alias("payment_gateway"),
            F.col("pay_status").alias("status"),
            pay_date.alias("payment_date"),
            F.when(completed, pay_date.cast("timestamp_ntz") + F.make_dt_interval(hours=F.lit(8))).alias("paid_at"),
            F.lit(None).cast("string").alias("transaction_ref"),
            F.lit(None).cast("string").alias("gateway_response"),
            F.col("order_timestamp").alias("created_at"),
            F.col("order_timestamp").alias("updated_at"),
        )
        e = self.raw("events").where(F.col("event_type") == "purchase")
        number = e.event_id * 3 + 2
        strays = e.select(
            number.alias("id"),
            business_code("PAY", CODE_YEAR, number).alias("payment_code"),
            (e.event_id * 2).alias("order_id"),
            money(e.value).alias("amount"),
            F.lit("E-Wallet").alias("payment_method"),
            F.lit("Momo").alias("payment_gateway"),
            F.lit("Completed").alias("status"),
            e.ts.cast("date").alias("payment_date"),
            e.ts.cast("timestamp_ntz").alias("paid_at"),
            F.format_string("GTW-%d", e.event_id).alias("transaction_ref"),
            e.props.alias("gateway_response"),
            e.ts.cast("timestamp_ntz").alias("created_at"),
            e.ts.cast("timestamp_ntz").alias("updated_at"),
        )
        return from_orders.unionByName(strays)

    @cached_property
    def invoices(self) -> DataFrame:
        day = F.day("order_date")
        o = self.orders.where(F.col("status").isin(*INVOICEABLE_STATUSES) & (day != 7))
        subtotal = (
            F.when(day == 8, F.round(F.col("subtotal") * Decimal("1.03"), 2)).otherwise(F.col("subtotal")).cast(MONEY)
        )
        invoiced = F.date_add("order_date", F.pmod(day, F.lit(6)))
        return o.select(
            F.col("id"),
            business_code("INV", CODE_YEAR, F.col("id")).alias("invoice_number"),
            F.col("id").alias("order_id"),
            F.col("customer_id"),
            invoiced.alias("invoice_date"),
            F.date_add(invoiced, 30).alias("due_date"),
            subtotal.alias("subtotal"),
            F.col("tax_amount"),
            (subtotal + F.col("tax_amount")).cast(MONEY).alias("total_amount"),
            F.when(day <= 25, "Paid").when(day <= 28, "Issued").otherwise("Closed").alias("status"),
            accounting_period(invoiced).alias("accounting_period"),
            F.lit(None).cast("string").alias("notes"),
            invoiced.cast("timestamp_ntz").alias("created_at"),
            invoiced.cast("timestamp_ntz").alias("updated_at"),
        )

    @cached_property
    def invoice_items(self) -> DataFrame:
        invoice = self.invoices.select(F.col("id").alias("invoice_id"))
        items = self.order_items
        return items.join(invoice, items.order_id == invoice.invoice_id).select(
            F.col("id"),
            F.col("invoice_id"),
            F.col("product_id"),
            F.concat(F.lit("Product #"), F.col("product_id").cast("string")).alias("description"),
            F.col("quantity").cast("decimal(15,2)").alias("quantity"),
            F.col("unit_price"),
            F.lit(Decimal("10.00")).cast("decimal(5,2)").alias("tax_rate"),
            F.col("line_total"),
            F.col("created_at"),
        )

    @cached_property
    def order_changes(self) -> DataFrame:
        """A change feed: the last 31 days of orders, web totals raised by 10 %."""
        newest = self.orders.select(F.date_sub(F.max("order_date"), 30)).scalar()
        raised = F.round(F.col("total_amount") * Decimal("1.10"), 2).cast(MONEY)
        changed = F.col("channel") == "Website"
        return self.orders.where(F.col("order_date") >= newest).withColumns(
            {
                "total_amount": F.when(changed, raised).otherwise(F.col("total_amount")),
                "updated_at": F.when(changed, F.col("updated_at") + F.make_dt_interval(days=F.lit(1))).otherwise(
                    F.col("updated_at")
                ),
            }
        )

    @cached_property
    def change_sets(self) -> list[DataFrame]:
        """Three sets of changes with ``deleted``: the feed; its pending orders deleted;
        its shipped ones cancelled and the web's deleted ones placed anew."""

        def at(rows: DataFrame, days: int, status: str | None = None, deleted: bool = False) -> DataFrame:
            rows = rows.withColumn("status", F.lit(status)) if status else rows
            later = F.col("updated_at") + F.make_dt_interval(days=F.lit(days))
            return rows.withColumns({"updated_at": later, "deleted": F.lit(deleted)})

        feed = self.order_changes
        pending, shipped = feed.where("status = 'Pending'"), feed.where("status = 'Shipped'")
        placed = at(pending.where("channel = 'Website'"), 3, "Processing")
        return [at(feed, 0), at(pending, 2, deleted=True), at(shipped, 3, "Cancelled").unionByName(placed)]

    @cached_property
    def marketing_spend(self) -> DataFrame:
        """Discounts given per month, as a stand-in for marketing spend."""
        return self.orders.groupBy(F.trunc("order_date", "month").alias("month")).agg(
            F.sum("discount_amount").alias("spend")
        )
