from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import quality as dq
from tallyhouse.schemas import TABLES

from .conftest import d, rows


def outcome(tables, rule_id, rules=None):
    rules = [r for r in rules or dq.all_rules() if r.rule_id == rule_id]
    assert len(rules) == 1, rule_id
    found = dq.dq_run(tables, rules).first()
    return found.checked, found.failed, found.status


def test_every_declared_constraint_has_a_rule(spark):
    ids = [r.rule_id for r in dq.all_rules()]
    assert len(ids) == len(set(ids))
    for name, spec in TABLES.items():
        for column in spec.not_null:
            assert f"{name}.{column}.not_null" in ids
        for column, _ in spec.foreign_keys:
            assert f"{name}.{column}.fk" in ids
        for column in spec.unique:
            assert f"{name}.{column}.unique" in ids


def test_primary_key_duplicates_and_nulls(table):
    o = table("orders", {"id": 1}, {"id": 1}, {"id": 2}, {"id": None}, {"id": None})
    assert outcome({"orders": o}, "orders.id.pk") == (5, 3, "FAIL")  # one key twice, two NULLs


def test_unique_lets_nulls_pass(table):
    o = table("orders", {"id": 1, "order_number": "A"}, {"id": 2, "order_number": None}, {"id": 3, "order_number": None})
    assert outcome({"orders": o}, "orders.order_number.unique") == (3, 0, "PASS")


def test_references(table):
    c = table("customers", {"id": 1})
    o = table("orders", {"id": 1, "customer_id": 1}, {"id": 2, "customer_id": 5}, {"id": 3, "customer_id": None})
    assert outcome({"orders": o, "customers": c}, "orders.customer_id.fk") == (3, 2, "FAIL")
    tree = table("categories", {"id": 1, "parent_id": None}, {"id": 2, "parent_id": 1})
    assert outcome({"categories": tree}, "categories.parent_id.fk") == (2, 0, "PASS")


def test_domains_ignore_null_and_mind_the_case(table):
    c = table("customers", {"id": 1, "segment": "VIP"}, {"id": 2, "segment": None}, {"id": 3, "segment": "vip"})
    assert outcome({"customers": c}, "customers.segment.accepted_values") == (3, 1, "FAIL")


def test_amount_rules(table):
    o = table("orders", *({"id": i, "total_amount": d(a)} for i, a in enumerate(("-1.00", "0.00", "0.01"))))
    assert outcome({"orders": o}, "orders.total_amount_not_negative.range") == (3, 1, "FAIL")
    assert outcome({"orders": o}, "orders.total_amount_positive.range") == (3, 2, "WARN")


def test_email_and_code_shape(table):
    c = table("customers", {"id": 1, "email": "a@b", "customer_code": "CUST-2024-000001"},
              {"id": 2, "email": "ab", "customer_code": "C1"}, {"id": 3, "email": None, "customer_code": "CUST-2024-1000000"})
    assert outcome({"customers": c}, "customers.email.format") == (3, 1, "FAIL")
    assert outcome({"customers": c}, "customers.email.not_null") == (3, 1, "FAIL")
    assert outcome({"customers": c}, "customers.customer_code.format") == (3, 1, "WARN")


def test_empty_string_is_not_null(table):
    c = table("customers", {"id": 1, "email": ""})
    assert outcome({"customers": c}, "customers.email.not_null") == (1, 0, "PASS")


def test_order_dates(table):
    days = (date(2023, 12, 31), date(2024, 1, 1), date(2024, 12, 31), date(2025, 1, 1))
    o = table("orders", *({"id": i, "order_date": day} for i, day in enumerate(days)))
    assert outcome({"orders": o}, "orders.order_date.date_range") == (4, 2, "FAIL")
    assert dq.dq_date_range(o).first().status == "FAIL"
    assert dq.dq_date_range(o.where("order_date BETWEEN '2024-01-01' AND '2024-12-31'")).first().status == "PASS"


def test_least_rows(table):
    at, below = (table("categories", *({"id": i} for i in range(n))) for n in (10, 9))
    assert outcome({"categories": at}, "categories.min_rows") == (10, 0, "PASS")
    assert outcome({"categories": below}, "categories.min_rows") == (9, 1, "FAIL")


def test_subtotals_against_lines(table):
    o = table("orders", *({"id": i, "subtotal": d(s)} for i, s in ((1, "10.00"), (2, "11.00"), (3, "11.01"), (4, "5.00"))))
    items = table("order_items", *({"id": i, "order_id": i, "line_total": d("10.00")} for i in (1, 2, 3)))
    assert rows(dq.sum_mismatches(o, items).select("order_id", "diff", "differs")) == [
        (1, d("0.00"), False), (2, d("1.00"), False), (3, d("1.01"), True), (4, d("5.00"), True)]
    tables = {"orders": o, "order_items": items}
    assert outcome(tables, "orders.subtotal.sum_match") == (4, 2, "PASS")  # fewer than ten
    many = table("orders", *({"id": 100 + i, "subtotal": d("9.00")} for i in range(10)))
    assert outcome({"orders": many, "order_items": items}, "orders.subtotal.sum_match") == (10, 10, "FAIL")


def test_invoice_owner(table):
    o = table("orders", {"id": 1, "customer_id": 1}, {"id": 2, "customer_id": 2})
    i = table("invoices", {"id": 1, "order_id": 1, "customer_id": 1}, {"id": 2, "order_id": 2, "customer_id": 1})
    assert outcome({"orders": o, "invoices": i}, "invoices.customer_id.owner") == (2, 1, "FAIL")


def test_tables_and_columns(table):
    c, empty = table("customers", {"id": 1, "segment": None}), table("orders", {"id": 1}).limit(0)
    present = {r.table_name: r.status for r in dq.dq_tables_present({"customers": c, "orders": empty}, ["customers", "orders", "payments"]).collect()}
    assert present == {"customers": "PASS", "orders": "FAIL", "payments": "FAIL"}
    columns = {r.column_name: (r.present, r.filled, r.status) for r in dq.dq_required_columns({"customers": c.drop("email")}).collect()}
    assert columns["email"] == (False, 0, "FAIL") and columns["segment"] == (True, 0, "PASS") and columns["id"] == (True, 1, "PASS")


def test_profile_exact_and_approximate(table):
    c = table("customers", {"id": 1, "city": "Huế"}, {"id": 2, "city": "Huế"}, {"id": 3, "city": None})
    exact = {r.column_name: tuple(r)[1:] for r in dq.dq_profile(c, ["id", "city", "phone"], exact=["id", "city", "phone"]).collect()}
    assert exact == {"id": (3, 0, 3, "1", "3"), "city": (3, 1, 1, "Huế", "Huế"), "phone": (3, 3, 0, None, None)}
    sketched = {r.column_name: tuple(r)[1:] for r in dq.dq_profile(c, ["id", "city"]).collect()}
    mixed = {r.column_name: r.distinct_values for r in dq.dq_profile(c, ["id", "city"], exact=["city"]).collect()}
    assert mixed == {"id": 3, "city": 1}
    assert sketched == {c: exact[c] for c in ("id", "city")}


def test_drift(spark):
    old = spark.createDataFrame([(1, "a", 1.0)], "id INT, name STRING, price DOUBLE")
    new = spark.createDataFrame([(1, "a", True)], "id BIGINT, name STRING, flag BOOLEAN")
    assert {r.column_name: r.change for r in dq.dq_schema_drift(old, new).collect()} == {
        "id": "retyped", "name": "unchanged", "price": "removed", "flag": "added"}
    assert {r.change for r in dq.dq_schema_drift(old, old).collect()} == {"unchanged"}


def test_aggregates_of_source_and_target(table):
    items = table("order_items", {"id": 1, "line_total": d("10.00")}, {"id": 2, "line_total": d("20.00")})
    assert {r.status for r in dq.dq_agg_match(items, items, ["line_total"]).collect()} == {"PASS"}
    found = {r.metric: r.status for r in dq.dq_agg_match(items, items.where("id = 1"), ["line_total"]).collect()}
    assert found["row_count"] == found["sum_line_total"] == found["avg_line_total"] == "FAIL"


def test_history_replaces_a_repeated_day(table, tmp_path, spark):
    path, good = str(tmp_path / "history"), table("orders", {"id": 1, "total_amount": d("1.00")})
    bad = table("orders", {"id": 1, "total_amount": d("-1.00")})
    rules = dq.select_rules(dq.all_rules(), "range")
    rules = [r for r in rules if r.table == "orders"]
    day = date(2024, 5, 1)
    for orders, when in ((bad, day), (good, day), (bad, day + timedelta(days=1))):
        dq.dq_append_history(dq.dq_run({"orders": orders}, rules), path, when)
    found = {(r.run_date, r.severity): (r.passed, r.warned, r.failed) for r in dq.dq_history(spark.read.parquet(path)).collect()}
    assert found == {(day, "major"): (1, 0, 0), (day, "minor"): (1, 0, 0),
                     (day + timedelta(days=1), "major"): (0, 0, 1), (day + timedelta(days=1), "minor"): (0, 1, 0)}


def test_one_scan_serves_all_row_rules(table, tmp_path, spark):
    table("orders", {"id": 1}).write.parquet(str(tmp_path / "o"))
    rules = [r for r in dq.all_rules() if r.table == "orders" and r.kind in ("row", "rows")]
    plan = dq.dq_run({"orders": spark.read.parquet(str(tmp_path / "o"))}, rules)._jdf.queryExecution().executedPlan().toString()
    assert len(rules) > 10 and plan.count("FileScan") == 1


def test_timeliness_and_gate(spark, table, tmp_path):
    from tallyhouse.sources import snapshots as snap

    root, day = str(tmp_path / "staging"), date(2024, 5, 1)
    tables = {"customers": table("customers", {"id": 1}), "orders": table("orders", {"id": 1})}
    snap.snap_write(tables, root, day, run_timestamp=datetime(2024, 5, 2, 7, 59))
    snap.snap_write(tables, root, day + timedelta(days=1), run_timestamp=datetime(2024, 5, 3, 8, 1))
    manifest = snap.snap_manifest(spark, root)
    assert [r.status for r in dq.dq_timeliness(manifest).orderBy("snapshot_date").collect()] == ["PASS", "WARN"]

    def gate(expected, when, recon):
        drift = dq.dq_schema_drift(tables["customers"], tables["customers"])
        return {r.rule_id.split(".")[1]: r.status for r in dq.dq_snapshot_gate(manifest, recon, drift, when, expected).collect()}

    recon = snap.snap_row_recon(tables, root, day)
    assert set(gate(["customers", "orders"], day, recon).values()) == {"PASS"}
    found = gate(["customers", "orders", "payments"], date(2020, 1, 1), recon)
    assert found["marker"] == found["all_tables"] == "FAIL"


def test_files_of_a_failed_run_do_not_pass_the_gate(spark, table, tmp_path):
    from tallyhouse.sources import snapshots as snap

    root, day = str(tmp_path / "staging"), date(2024, 5, 1)
    customers, orders = table("customers", {"id": 1}), table("orders", {"id": 1})
    broken = customers.withColumn("email", F.raise_error(F.lit("source went away")).cast("string"))
    with pytest.raises(Exception, match="source went away"):
        snap.snap_write({"orders": orders, "customers": broken}, root, day, parallel=1)
    snap.snap_write({"customers": customers}, root, day)
    tables = {"customers": customers, "orders": orders}
    gate = dq.dq_snapshot_gate(
        snap.snap_manifest(spark, root), snap.snap_row_recon(tables, root, day), dq.dq_schema_drift(customers, customers), day, list(tables),
        profile=dq.dq_profile(customers), sample=snap.snap_sample_compare(customers, customers, "id", 256),
    )
    found = {r.rule_id.split(".")[1]: (r.checked, r.failed, r.status) for r in gate.collect()}
    assert found["all_tables"] == (2, 1, "FAIL") and found["readable"] == (2, 1, "FAIL") and found["marker"][2] == "PASS"
    assert found["column_statistics"][2] == "INFO" and found["sample"][1:] == (0, "PASS")


def test_late_by_a_fraction_is_late(spark, table, tmp_path):
    manifest = spark.createDataFrame(
        [(date(2024, 5, 1), datetime(2024, 5, 2, 7, 59, 59), 1.4), (date(2024, 5, 2), datetime(2024, 5, 3, 7, 59, 59), 1.0)],
        "snapshot_date DATE, run_timestamp TIMESTAMP_NTZ, duration_seconds DOUBLE",
    ).selectExpr("*", "CAST(NULL AS STRING) AS table_name", "'COMPLETE' AS status")
    assert [r.status for r in dq.dq_timeliness(manifest).orderBy("snapshot_date").collect()] == ["WARN", "PASS"]


def test_all_key_rules_share_one_scan_per_table(spark):
    from tallyhouse.sources.binding import Tables

    bound = Tables(spark, "/root/testdata/sf0.001")
    results = dq.dq_run({name: bound[name] for name in TABLES}, dq.all_rules())
    plan = results._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") <= 22
