from datetime import date

from pyspark.sql import functions as F

from tallyhouse.operators import relational as rel, views

from .conftest import d, rows


def test_daily_sales_excludes_cancelled_and_refunded(table):
    view = views.view_daily_sales(orders_money(table))
    by_channel = {r.channel: r for r in view.collect()}
    web = by_channel["Website"]
    assert (web.order_count, web.unique_customers) == (2, 1)
    assert (web.gross_revenue, web.total_discount, web.net_revenue) == (d("150.00"), d("10.00"), d("140.00"))
    assert web.net_revenue_after_discount == d("150.00") and web.avg_order_value == 75.0
    assert by_channel[None].gross_revenue == d("20.00")
    assert [r.channel for r in views.in_report_order(view).collect()] == [None, "Store", "Website"]


def orders_money(table):
    def order(id, customer, total, discount, status, channel):
        return {
            "id": id, "customer_id": customer, "total_amount": d(total), "status": status, "channel": channel,
            "discount_amount": None if discount is None else d(discount), "order_date": date(2024, 3, 1),
        }

    return table(
        "orders",
        order(1, 1, "100.00", "10.00", "Completed", "Website"),
        order(2, 1, "50.00", None, "Pending", "Website"),
        order(3, 2, "70.00", "0.00", "Cancelled", "Website"),
        order(4, 2, "30.00", "0.00", "Refunded", None),
        order(5, 2, "20.00", "0.00", "Shipped", None),
        order(6, 9, "20.00", "0.00", "Shipped", "Store"),
    )


def test_daily_sales_of_unique_ids_is_the_same(table):
    o = orders_money(table)
    assert rows(views.view_daily_sales(o, unique_ids=True)) == rows(views.view_daily_sales(o))


def test_order_summary_cases(table):
    payments = table(
        "payments",
        {"id": 1, "order_id": 1, "amount": d("60.00"), "status": "Completed"},
        {"id": 2, "order_id": 1, "amount": d("40.00"), "status": "Completed"},
        {"id": 3, "order_id": 2, "amount": d("50.00"), "status": "Failed"},
        {"id": 4, "order_id": 3, "amount": d("90.00"), "status": "Completed"},
    )
    customers = table(
        "customers",
        {"id": 1, "first_name": "An", "last_name": "Le"},
        {"id": 2, "first_name": "Bo", "last_name": None},
        {"id": 3},
    )
    view = views.view_order_summary(orders_money(table), customers, payments)
    found = {r.order_id: r for r in view.collect()}
    assert sorted(found) == [1, 2, 3, 4, 5]  # order 6 has no customer, customer 3 no order
    assert (found[1].paid_amount, found[1].balance_due, found[1].payment_status) == (d("100.00"), d("0.00"), "Completed")
    assert (found[2].paid_amount, found[2].balance_due, found[2].payment_status) == (d("0.00"), d("50.00"), None)
    assert found[3].balance_due == d("-20.00")
    assert found[1].customer_name == "An Le" and found[5].customer_name is None
    assert len(view.columns) == 14


def test_filters_and_projection(table):
    o = orders_money(table)
    assert rows(rel.flt_order_status(o, ["Cancelled", "Refunded"], keep=False).select("id")) == [(1,), (2,), (5,), (6,)]
    customers = table("customers", {"id": 1, "email": "a@b"}, {"id": 2, "email": "ab"}, {"id": 3, "email": None})
    assert rows(rel.flt_email_pattern(customers).select("id")) == [(2,)]
    projected = rel.prj_order_projection(o.where("id = 1")).first()
    assert projected.net_amount == d("90.00") and projected.order_period == "2024-03"
    assert projected.due_date == date(2024, 3, 31) and projected.order_weekday == 4


def test_product_search_matches_whole_words(table):
    p = table("products", {"id": 1, "name": "Ring-light"}, {"id": 2, "name": "Spring"}, {"id": 3, "name": "Áo RING"}, {"id": 4, "name": "áo"})
    assert rows(rel.txt_product_keyword(p, "ring").select("id")) == [(1,), (3,)]
    assert rows(rel.txt_product_keyword(p, "ÁO").select("id")) == [(3,), (4,)]


def test_masking_hides_personal_data(table):
    c = table("customers", {"id": 1, "email": "nam@mail.vn", "last_name": "Tran1", "phone": "0912345678"},
              {"id": 2, "phone": "12"})
    first, second = rel.sec_mask_customer(c).orderBy("id").collect()
    assert (first.email_masked, first.last_name_masked, first.phone_masked) == ("n***@mail.vn", "Xxxxn", "*******678")
    assert second.phone_masked == "12"


def test_orphans_count_null_keys(table, spark):
    parents = table("customers", {"id": 1}, {"id": 0})
    children = table("orders", {"id": 1, "customer_id": 1}, {"id": 2, "customer_id": 7}, {"id": 3, "customer_id": None}, {"id": 4, "customer_id": None})
    assert rows(rel.jn_anti_orphans(children, "customer_id", parents).select("id")) == [(2,), (3,), (4,)]


def test_orphans_among_more_keys_than_one_task_takes(spark, table, tmp_path, monkeypatch):
    monkeypatch.setattr(rel, "KEYS_PER_TASK", 100)
    table("customers", *({"id": i} for i in range(0, 400, 2))).write.parquet(str(tmp_path / "parents"))
    found = [{"id": i, "customer_id": None if i % 7 == 0 else 3 if i % 2 else i} for i in range(400)]  # 3 is unknown and hot
    table("orders", *found).write.parquet(str(tmp_path / "children"))
    parents, children = spark.read.parquet(str(tmp_path / "parents")), spark.read.parquet(str(tmp_path / "children"))
    # The shuffle has six tasks for the 342 keyed rows and 200 parents, not the usual four.
    unknown = rel.unknown_keys(children.where("customer_id IS NOT NULL").select("customer_id"), parents.select(F.col("id").alias("customer_id")))
    assert "REPARTITION_BY_NUM" in unknown._jdf.queryExecution().executedPlan().toString()
    assert len(unknown.rdd.glom().collect()) == 6 and rows(unknown) == [(3,)]
    wanted = sorted((r["id"],) for r in found if r["customer_id"] in (None, 3))
    assert rows(rel.jn_anti_orphans(children, "customer_id", parents).select("id")) == wanted
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert rows(rel.jn_anti_orphans(children, "customer_id", parents).select("id")) == wanted
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_category_tree_with_orphan_and_cycle(table):
    c = table(
        "categories",
        {"id": 1, "name": "a", "parent_id": None},
        {"id": 2, "name": "b", "parent_id": 1},
        {"id": 3, "name": "c", "parent_id": 2},
        {"id": 4, "name": "o", "parent_id": 99},
        {"id": 5, "name": "x", "parent_id": 6},
        {"id": 6, "name": "y", "parent_id": 5},
        {"id": 7, "name": "z", "parent_id": 6},
    )
    tree = {r.id: (r.root_id, r.depth, r.path, r.status) for r in rel.jn_category_tree(c).collect()}
    assert tree[3] == (1, 2, "a > b > c", "OK")
    assert tree[4] == (4, 0, "o", "OK")
    assert [tree[i] for i in (5, 6, 7)] == [(None, None, None, "CYCLE")] * 3


def test_key_lookup_uses_the_business_code(table, spark):
    coded = spark.createDataFrame([(1, "ORD-2"), (2, "ORD-9")], "payment_id INT, code STRING")
    stored = table("orders", {"id": 7, "order_number": "ORD-2"}, {"id": 8, "order_number": "ORD-1"})
    found = rel.jn_key_lookup(coded, "code", stored, "order_number", "id", "order_id")
    assert rows(found.select("payment_id", "order_id")) == [(1, 7), (2, None)]


def test_status_list_and_domain_difference(table):
    p = table("payments", {"id": 1, "order_id": 1, "status": "Failed"}, {"id": 2, "order_id": 1, "status": "Completed"},
              {"id": 3, "order_id": 1, "status": "Failed"}, {"id": 4, "order_id": 2, "status": None})
    assert rows(rel.agg_string_agg_status(p)) == [(1, "Completed, Failed", 3), (2, None, 1)]
    assert rows(rel.set_domain_diff(p, "status", ["Completed"])) == [("status", None), ("status", "Failed")]
    assert rows(rel.set_domain_diff(p, "status", ["Completed"], ignore_null=True)) == [("status", "Failed")]


def test_invoice_gap_and_top_customers(table):
    o = orders_money(table)
    invoices = table("invoices", {"id": 1, "order_id": 2}, {"id": 2, "order_id": 2})
    assert rows(rel.jn_orders_without_invoice(o, invoices).select("id")) == [(1,)]
    c = table("customers", {"id": 1, "customer_code": "A"}, {"id": 2, "customer_code": "B"}, {"id": 3, "customer_code": "C"})
    top = rel.top_customers(c, o, 2).select("customer_code", "order_count", "total_spent").collect()
    assert [tuple(r) for r in top] == [("A", 2, d("150.00")), ("B", 3, d("120.00"))]


def test_deep_category_chain_and_cycles(table):
    """5,000 categories in one chain, a cycle of 40 and a chain of 60 below it."""
    chain = [{"id": i, "name": f"n{i}", "parent_id": i - 1 if i else None} for i in range(5000)]
    cycle = [{"id": 6000 + i, "name": "c", "parent_id": 6000 + (i + 1) % 40} for i in range(40)]
    below = [{"id": 7000 + i, "name": "b", "parent_id": 7000 + i - 1 if i else 6000} for i in range(60)]
    tree = {r.id: r for r in rel.jn_category_tree(table("categories", *chain, *cycle, *below)).collect()}
    assert all(tree[i].depth == i and tree[i].root_id == 0 and tree[i].status == "OK" for i in range(5000))
    assert tree[4999].path == " > ".join(f"n{i}" for i in range(5000)) and tree[7].path == "n0 > n1 > n2 > n3 > n4 > n5 > n6 > n7"
    assert {tree[i].status for i in tree if i >= 6000} == {"CYCLE"} and len(tree) == 5100
