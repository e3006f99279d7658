"""Kept views against views that are built anew, and what a refresh reads."""

import random
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime, timedelta
from decimal import Decimal
from threading import Barrier

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import customer360, maintained, views
from tallyhouse.schemas import TABLES
from tallyhouse.sources import incremental as inc, versions

from .conftest import rows

AS_OF = date(2024, 6, 1)
STATUSES = ("Completed", "Pending", "Cancelled", "Refunded", "Shipped", None)


def order(draw, key, at):
    cents = draw.choice((None, draw.randint(0, 99999)))
    return {
        "id": key, "customer_id": draw.choice((None, *range(12))), "channel": draw.choice((None, "Website", "Store")), "status": draw.choice(STATUSES),
        "order_date": draw.choice((None, *(AS_OF - timedelta(days=k) for k in (0, 3, 40, 100, 400, -2)))), "updated_at": at,
        "total_amount": None if cents is None else Decimal(cents) / 100, "discount_amount": draw.choice((None, Decimal("1.25"))),
    }



@pytest.fixture
def customers(table):
    return table("customers", *({"id": i} for i in range(12)))


def build(spark, table, path, found, **widths):
    df = table("orders", *found)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)
    kept = maintained.SalesViews(spark, path, schema, **widths)
    kept.start(df)
    return kept


def equal(kept, table, customers, found):
    df = table("orders", *found)
    assert kept.orders().exceptAll(df.select(*kept.orders().columns)).isEmpty() and kept.orders().count() == len(found)
    assert rows(kept.daily_sales()) == rows(views.view_daily_sales(df))
    built, now = customer360.mart_customer_360(customers, df, AS_OF), kept.customer_360(customers, AS_OF)
    assert built.columns == now.columns and rows(now) == rows(built)


def test_change_sets_with_deletes_equal_the_rebuild(spark, table, customers, tmp_path):
    draw = random.Random(1)
    base = {k: order(draw, k, datetime(2024, 1, 5)) for k in range(80)}
    kept = build(spark, table, str(tmp_path / "kept"), list(base.values()), keys_per_range=25, customers_per_range=5)
    equal(kept, table, customers, list(base.values()))
    for step in range(3):
        changes = []
        for key in draw.sample(range(100), 25):
            at = datetime(2024, 1, draw.choice((4, 5, 6 + step)))
            change, gone = order(draw, key, at), draw.random() < 0.4
            changes.append((change, gone))
            old = base.get(key)
            if old is None or at >= old["updated_at"]:
                base.pop(key, None)
                if not gone:
                    base[key] = change
        gone_of = {c["id"]: g for c, g in changes}
        df = table("orders", *(c for c, _ in changes))
        marks = spark.createDataFrame(list(gone_of.items()), "id bigint, deleted boolean")
        change_set = df.join(marks, "id")
        for _ in range(2 if step == 1 else 1):  # applying a set again changes nothing
            kept.refresh(change_set)
        equal(kept, table, customers, list(base.values()))


def test_only_touched_splits_are_read_and_written(spark, table, tmp_path, monkeypatch):
    day = date(2024, 1, 1)
    found = [{"id": k, "customer_id": k % 40, "channel": "Store", "status": "Completed", "order_date": day + timedelta(days=k), "total_amount": 5} for k in range(200)]
    kept = build(spark, table, str(tmp_path / "kept"), found, keys_per_range=50, customers_per_range=10)
    before, read = kept._current()[0], []
    reading = maintained.SalesViews._read
    monkeypatch.setattr(maintained.SalesViews, "_read", lambda self, name, folders: read.extend(folders) or reading(self, name, folders))
    change = table("orders", {**found[7], "total_amount": 9, "updated_at": datetime(2025, 1, 1)}).withColumn("deleted", F.lit(False))
    kept.refresh(change)
    assert sorted(read) == sorted(before[n] for n in ("orders/key_range=0", "sales/month=2024-01-01", "customers/customer_range=0"))
    after = kept._current()[0]
    assert {n for n in after if after[n] != before.get(n)} == {"orders/key_range=0", "sales/month=2024-01-01", "customers/customer_range=0"}


def test_the_three_tables_are_written_at_the_same_time(spark, table, tmp_path, monkeypatch):
    together, writing = Barrier(3), maintained.SalesViews._lay_out

    def wait_for_all(self, name, found, folder):
        together.wait(timeout=60)
        return writing(self, name, found, folder)

    monkeypatch.setattr(maintained.SalesViews, "_lay_out", wait_for_all)
    found = [{"id": k, "customer_id": k, "channel": "Store", "status": "Completed", "order_date": date(2024, 1, 1), "total_amount": 5} for k in range(3)]
    kept = build(spark, table, str(tmp_path / "kept"), found)
    change = table("orders", {**found[1], "total_amount": 9, "updated_at": datetime(2025, 1, 1)}).withColumn("deleted", F.lit(False))
    kept.refresh(change)
    assert rows(kept.daily_sales().select("order_count", "gross_revenue")) == [(3, Decimal("19.00"))]


def test_a_split_that_loses_its_last_row(spark, table, customers, tmp_path):
    found = [{"id": k, "customer_id": k, "channel": "Store", "status": "Completed", "order_date": date(2024, k + 1, 1), "total_amount": 5} for k in range(2)]
    kept = build(spark, table, str(tmp_path / "kept"), found, keys_per_range=1, customers_per_range=1)
    gone = table("orders", {**found[1], "updated_at": datetime(2025, 1, 1)}).withColumn("deleted", F.lit(True))
    kept.refresh(gone)
    equal(kept, table, customers, found[:1])
    again = {**found[1], "updated_at": datetime(2025, 1, 2)}
    kept.refresh(table("orders", again).withColumn("deleted", F.lit(False)))
    equal(kept, table, customers, [found[0], again])


def test_refreshes_at_the_same_time(spark, table, customers, tmp_path):
    found = [{"id": k, "customer_id": k % 4, "channel": "Store", "status": "Completed", "order_date": date(2024, 1, 1 + k % 3), "total_amount": 5} for k in range(12)]
    kept = build(spark, table, str(tmp_path / "kept"), found)
    changed = [{**o, "total_amount": 7 + o["id"], "updated_at": datetime(2025, 1, 1)} for o in found]
    sets = [table("orders", *changed[i::3]).withColumn("deleted", F.lit(False)) for i in range(3)]
    with ThreadPoolExecutor(3) as pool:
        list(pool.map(kept.refresh, sets))
    equal(kept, table, customers, changed)


DATED = "id INT, v STRING, updated_at TIMESTAMP_NTZ, day DATE"
OLD, NEW = datetime(2024, 1, 1), datetime(2024, 1, 2)


def test_merges_with_deletions(spark, tmp_path):
    base = [(1, "a", OLD, OLD.date()), (2, "b", NEW, NEW.date()), (3, "c", OLD, None), (4, "d", OLD, NEW.date())]
    delta = spark.createDataFrame([(1, None, NEW, OLD.date(), True), (2, None, OLD, NEW.date(), True), (3, "C", NEW, None, None), (5, "e", OLD, NEW.date(), False), (6, "f", OLD, NEW.date(), True), (4, "x", NEW, NEW.date(), True), (4, "y", OLD, NEW.date(), False)], DATED + ", gone BOOLEAN")
    expected = [(2, "b"), (3, "C"), (5, "e")]
    merged = inc.inc_merge_latest(spark.createDataFrame(base, DATED), delta, deleted="gone")
    assert merged.columns == ["id", "v", "updated_at", "day"] and rows(merged.select("id", "v")) == expected
    path = str(tmp_path / "fact")
    versions.write_version(spark.createDataFrame(base, DATED), path, "day")
    for _ in range(2):
        inc.merge_into_dates(spark, path, delta, "day", deleted="gone")
        assert rows(versions.read_current(spark, path, DATED).select("id", "v")) == expected
