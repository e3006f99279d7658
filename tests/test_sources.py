import gzip
from datetime import date, datetime

import pytest
from pyspark.sql import Row, functions as F

from tallyhouse.schemas import CUSTOMERS, ORDERS, TABLES
from tallyhouse.sources import sinks, tables as src, versions
from tallyhouse.sources.binding import Tables

from .conftest import d, rows

SF = "/root/testdata/sf0.001"


def test_bound_tables_have_the_declared_columns_and_types(spark):
    bound = Tables(spark, SF)
    for name, spec in TABLES.items():
        found = [(f.name, f.dataType) for f in bound[name].schema.fields]
        assert found == [(f.name, f.dataType) for f in spec.schema.fields], name


def test_csv_keeps_quotes_line_breaks_and_nulls(spark, table, tmp_path):
    notes = ['say "hi", then go', "two\nlines", "", None, "a\\b", " padded ", "cr\r\nlf", "#hash", '"']
    o = table("orders", *({"id": i, "customer_note": n, "total_amount": d("1234.50"), "order_timestamp": datetime(2024, 1, 2, 3, 4, 5)} for i, n in enumerate(notes)))
    path = str(tmp_path / "csv")
    sinks.snk_csv(o, path)
    back = src.src_csv_scan(spark, path, ORDERS.ddl)
    found = [r.customer_note for r in back.orderBy("id").collect()]
    assert found == ['say "hi", then go', "two\nlines", None, None, "a\\b", " padded ", "cr\r\nlf", "#hash", '"']  # '' and NULL are one in CSV
    first = back.where("id = 0").first()
    assert (first.total_amount, first.order_timestamp, first.order_date) == (d("1234.50"), datetime(2024, 1, 2, 3, 4, 5), date(2024, 1, 1))


def test_csv_text_form(spark, table, tmp_path):
    path = tmp_path / "csv"
    sinks.snk_csv(table("customers", {"id": 1, "email": "a,b", "created_at": datetime(2024, 1, 2)}).coalesce(1), str(path))
    header, line = next(path.glob("*.csv")).read_text("utf-8").splitlines()
    assert header == ",".join(CUSTOMERS.schema.names)
    assert line.startswith('1,x,"a,b",x,x,,') and "2024-01-02 00:00:00" in line


def test_csv_keeps_fractions_unless_told_otherwise(spark, table, tmp_path):
    o = table("orders", {"id": 1, "order_timestamp": datetime(2024, 1, 2, 3, 4, 5, 678901)}, {"id": 2, "order_timestamp": datetime(2024, 1, 2, 3, 4, 5)})
    sinks.snk_csv(o, str(tmp_path / "exact"))
    assert rows(src.src_csv_scan(spark, str(tmp_path / "exact"), ORDERS.ddl).select("order_timestamp")) == rows(o.select("order_timestamp"))
    sinks.snk_csv(o, str(tmp_path / "cut"), whole_seconds=True)
    cut = src.src_csv_scan(spark, str(tmp_path / "cut"), ORDERS.ddl, multi_line=False)
    assert rows(cut.select("order_timestamp")) == [(datetime(2024, 1, 2, 3, 4, 5),)] * 2


def test_csv_with_a_bad_row_fails(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("id,row_count\nx,1\n")
    with pytest.raises(Exception):
        src.src_csv_scan(spark, str(path), "id INT, row_count INT").collect()


def test_csv_with_other_columns_fails(spark, tmp_path):
    path = tmp_path / "swapped.csv"
    path.write_text("name,id\n1,2\n")
    with pytest.raises(Exception):
        src.src_csv_scan(spark, str(path), "id INT, name STRING").collect()


def test_parquet_keeps_decimals(spark, table, tmp_path):
    path = str(tmp_path / "p")
    sinks.snk_parquet(table("orders", {"id": 1, "total_amount": d("0.10")}), path)
    back = src.src_parquet_scan(spark, path)
    assert back.schema["total_amount"].dataType.simpleString() == "decimal(15,2)"
    assert "snappy" in next((tmp_path / "p").glob("*.parquet")).name


def test_row_counts(table):
    found = src.src_row_count_summary({"customers": table("customers", {"id": 1}, {"id": 2}), "orders": table("orders", {"id": 1}).limit(0)})
    assert rows(found) == [("customers", 2), ("orders", 0)]


def test_append_stores_nan_as_null(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, float("nan")), (2, 1.5), (3, None)], "id INT, v DOUBLE")
    sinks.snk_table_append(df, path)
    sinks.snk_table_append(df, path)
    assert rows(spark.read.parquet(path).distinct()) == [(1, None), (2, 1.5), (3, None)]
    assert spark.read.parquet(path).count() == 6


def test_warehouse_layers(spark, tmp_path):
    df = spark.range(6).select("id", F.pmod("id", F.lit(2)).alias("part"))
    path = sinks.snk_warehouse_write(df, str(tmp_path), "mart", "t", partition_by="part")
    sinks.snk_warehouse_write(df.where("part = 1 AND id > 3"), str(tmp_path), "mart", "t", partition_by="part")
    assert rows(versions.read_current(spark, path, "id BIGINT, part BIGINT").select("id", "part")) == [(0, 0), (2, 0), (4, 0), (5, 1)]
    sinks.snk_warehouse_write(df.limit(1), str(tmp_path), "dw", "u")
    path = sinks.snk_warehouse_write(df.limit(2), str(tmp_path), "dw", "u")
    assert versions.read_current(spark, path, "id BIGINT, part BIGINT").count() == 2
    with pytest.raises(ValueError):
        sinks.snk_warehouse_write(df, str(tmp_path), "attic", "t")
    with pytest.raises(ValueError):
        sinks.write_as(df, str(tmp_path / "x"), "xlsx")


def test_staged_csv_is_compressed_and_comes_back_whole(spark, table, tmp_path):
    plain, staged = tmp_path / "plain", tmp_path / "staged"
    df = table("customers", *({"id": i, "email": f'a,"{i}"\nb', "address_line1": " x ", "created_at": datetime(2024, 1, 2, 3, 4, 5, 6)} for i in range(2000))).coalesce(1)
    sinks.snk_csv(df, str(plain))
    sinks.write_as(df, str(staged), "csv")
    (as_text,), (packed,) = plain.glob("*.csv"), staged.glob("*.csv.gz")
    assert gzip.decompress(packed.read_bytes()) == as_text.read_bytes() and packed.stat().st_size * 3 < as_text.stat().st_size
    found = src.src_csv_scan(spark, str(staged), TABLES["customers"].ddl)
    assert found.exceptAll(df).isEmpty() and df.exceptAll(found).isEmpty() and found.count() == 2000


class Reader:
    """Stands in for a session: records what a database read asks for."""

    def __init__(self, low, high):
        self.bounds, self.asked = (low, high), []

    @property
    def read(self):
        self.asked.append({})
        return self

    def format(self, name):
        assert name == "jdbc"
        return self

    def options(self, **options):
        self.asked[-1].update(options)
        return self

    def load(self):
        return self

    def first(self):
        return Row(lo=self.bounds[0], hi=self.bounds[1])


def test_database_scan_reads_key_ranges():
    reader = Reader(5, 900)
    src.src_jdbc_scan(reader, "orders", "jdbc:x", {"user": "u"}, partitions=16)
    asked = reader.asked[1]
    assert asked["dbtable"] == "ecommerce.orders" and asked["user"] == "u"
    assert (asked["partitionColumn"], asked["lowerBound"], asked["upperBound"], asked["numPartitions"]) == ("id", "5", "900", "16")
    empty = Reader(None, None)
    src.src_jdbc_scan(empty, "orders", "jdbc:x")
    assert "partitionColumn" not in empty.asked[1]


def test_database_options():
    assert src.jdbc_options("jdbc:x", {"user": "u"}, 5) == {"url": "jdbc:x", "fetchsize": "5", "user": "u"}
