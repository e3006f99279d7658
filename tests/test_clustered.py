"""Clustered files: same rows, few files opened."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallyhouse.sources import clustered, incremental as inc

from .conftest import rows

SCHEMA = "id BIGINT, customer_id BIGINT, order_date DATE, updated_at TIMESTAMP_NTZ"
START = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    draw, found = random.Random(7), []
    for i in range(6000):
        day = draw.choice((None, *range(400)))
        customer = draw.choice((None, *range(300))) if i % 3 else 77  # a customer with a third of all rows
        at = None if day is None else START + timedelta(days=day, hours=draw.randrange(24))
        found.append((i, customer, None if at is None else at.date(), at))
    df = spark.createDataFrame(found, SCHEMA)
    path = str(tmp_path_factory.mktemp("clustered") / "t")
    clustered.write_clustered(df, path, ["order_date", "customer_id"], ["order_date", "customer_id", "updated_at"], files=64)
    return df, clustered.Clustered(spark, path, SCHEMA)


def opened(df):
    return len(df.inputFiles())


def test_all_rows_are_there(stored):
    df, table = stored
    assert rows(table.read()) == rows(df) and 50 <= opened(table.read()) <= 64
    biggest = table.zones.agg(F.max("rows")).first()[0]
    assert biggest < 6000 / 64 * 4  # the busy customer fills many files


def test_extract_opens_few_files(stored):
    df, table = stored
    last = START + timedelta(days=365)
    assert rows(table.after("updated_at", last)) == rows(inc.inc_extract(df, last))
    assert opened(table.after("updated_at", last)) < 0.2 * 64 + 4


def test_customer_lookup_opens_few_files(stored):
    df, table = stored
    assert rows(table.equal("customer_id", 250)) == rows(df.where("customer_id = 250"))
    assert opened(table.equal("customer_id", 250)) < 0.2 * 64 + 4
    assert rows(table.equal("customer_id", 77)) == rows(df.where("customer_id = 77"))
    assert table.equal("customer_id", 999).count() == 0 and rows(table.missing("customer_id")) == rows(df.where("customer_id IS NULL"))


def test_days_and_no_rows(spark, stored, tmp_path):
    df, table = stored
    low, high = date(2024, 3, 1), date(2024, 3, 20)
    assert rows(table.between("order_date", low, high)) == rows(df.where(F.col("order_date").between(low, high)))
    assert opened(table.between("order_date", low, high)) < 0.3 * 64
    path = str(tmp_path / "empty")
    clustered.write_clustered(df.limit(0), path, ["order_date", "customer_id"])
    assert clustered.Clustered(spark, path, SCHEMA).read().count() == 0


def test_interleaving(spark):
    found = spark.createDataFrame([(x, y) for x in range(8) for y in range(8)], "x int, y int")
    z = {(r.x, r.y): r.z for r in found.withColumn("z", clustered.interleaved([F.col("x"), F.col("y")], 3)).collect()}
    assert sorted(z.values()) == list(range(64))
    assert all(z[x, y] == int("".join(a + b for a, b in zip(f"{x:03b}", f"{y:03b}", strict=True)), 2) for x, y in z)
