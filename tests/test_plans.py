"""What the plans must look like for the jobs to hold at scale."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import reconciliation as recon, views
from tallyhouse.plans import REGISTRY, runnable
from tallyhouse.sources.binding import Tables
from tallyhouse.workspace import shared_root, sized, staged

FOLDER = "/root/testdata/sf0.001"
WRITES = re.compile(r"^(snap_|snk_|src_csv|src_parquet|stream_|fact_merge|dq_(timeliness|snapshot|history|schema))")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def scans(df) -> list[str]:
    return [line for line in plan_of(df).splitlines() if "FileScan" in line]


@pytest.fixture
def nothing_is_small(spark):
    """Plans as they come out when no side of a join is small enough to broadcast."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for key in keys:
        spark.conf.set(key, "-1")
    yield
    for key in keys:
        spark.conf.unset(key)


@pytest.mark.parametrize("name", [n for n in REGISTRY if not WRITES.match(n)])
def test_no_keyless_join_and_no_python_per_row(spark, nothing_is_small, name):
    plan = plan_of(runnable(REGISTRY[name])(spark, FOLDER))
    assert not re.search("CartesianProduct|BroadcastNestedLoop|Python|InPandas", plan)


def test_only_needed_columns_and_rows_are_read(spark):
    t = Tables(spark, FOLDER)
    (scan,) = scans(views.view_daily_sales(t.orders))
    assert "o_orderkey" in scan and "o_custkey" in scan
    scan = scans(recon.recon_unpaid_orders(t.orders, t.payments))
    assert any("EqualTo(event_type,purchase)" in s for s in scan)
    margin = " ".join(scans(t.order_items.groupBy("product_id").agg(F.sum("line_total"))))
    assert "l_extendedprice" in margin and "l_tax" not in margin and "l_shipdate" not in margin


def test_status_filter_reaches_the_scan(spark, table, tmp_path):
    path = str(tmp_path / "orders")
    table("orders", {"id": 1, "status": "Completed"}).write.parquet(path)
    (scan,) = scans(views.view_daily_sales(spark.read.parquet(path)))
    assert "Not(In(status, [Cancelled,Refunded]))" in scan
    read = re.search(r"ReadSchema: (\S+)", scan).group(1)
    assert "order_number" not in read


def test_three_way_match_sorts_no_strings_to_aggregate(spark, nothing_is_small):
    t = Tables(spark, FOLDER)
    plan = plan_of(recon.fact_reconciliation(t.orders, t.payments, t.invoices))
    assert "SortAggregate" not in plan
    assert plan.count("Exchange hashpartitioning") == 2


def test_one_customer_with_a_third_of_all_orders_is_split(spark, table, tmp_path, nothing_is_small):
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {key: spark.conf.get(key) for key in settings}
    n = 60_000
    hot = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))
    spark.range(0, n, numPartitions=8).selectExpr(
        "id", "sha2(string(id), 256) AS order_number", "DATE'2024-01-01' AS order_date", "'Completed' AS status",
        "CAST(1 AS DECIMAL(15,2)) AS total_amount", "'Store' AS channel",
    ).withColumn("customer_id", hot).write.parquet(str(tmp_path / "orders"))
    customers = spark.range(n).select(F.col("id"), *(F.lit("x").alias(c) for c in ("customer_code", "email", "first_name", "last_name", "segment")))
    customers.write.parquet(str(tmp_path / "customers"))
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        view = views.view_order_summary(spark.read.parquet(str(tmp_path / "orders")), spark.read.parquet(str(tmp_path / "customers")),
                                        table("payments", {"id": 1, "order_id": 3, "status": "Completed"}))
        taken = view.collect()
        assert len(taken) == n and len({r.order_id for r in taken}) == n
        assert "skew=true" in plan_of(view)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_shared_folder_comes_from_the_session():
    class Context:
        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        def __init__(self, **conf):
            self.settings = conf
            self.conf = self

        def get(self, key, default=None):
            return self.settings.get(key, default)

    assert shared_root(Session(**{"spark.checkpoint.dir": "hdfs://shared/x/"})) == "hdfs://shared/x"
    assert shared_root(Session(**{"spark.sql.warehouse.dir": "hdfs://w/"})) == "hdfs://w/_staging"


def test_staged_tables_go_when_they_are_done(spark):
    with staged(spark.range(5), "gone") as table:
        assert table.count() == 5
    with pytest.raises(Exception, match="(?i)not.exist|does not exist|not found"):
        table.count()


def test_small_means_at_most_so_many_rows(spark):
    assert "hint" in sized(spark.range(3), 3)._jdf.queryExecution().logical().toString().lower()
    assert "hint" not in sized(spark.range(4), 3)._jdf.queryExecution().logical().toString().lower()


def test_no_local_checkpoint_and_no_forced_broadcast():
    root = Path(__file__).resolve().parents[1] / "tallyhouse"
    text = "".join(p.read_text() for p in root.glob("**/*.py") if "llm" not in p.parts and p.name != "workspace.py")
    assert "localCheckpoint" not in text and "broadcast(" not in text and ".crossJoin(" not in text and "tempfile" not in text
