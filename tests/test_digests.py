"""Comparison by digest trees against the plain one, and what it reads."""

import random

import pytest
from pyspark.sql import functions as F

from tallyhouse.sources import digests
from tallyhouse.sources.snapshots import snap_diff
from tallyhouse.workspace import stage

from .conftest import rows

SCHEMA = "id bigint, a string, b int"


def pair(spark, draw, n, changes):
    before = {i: (i, draw.choice((None, "x", "y")), draw.choice((None, 1, 2))) for i in draw.sample(range(-n, 4 * n), n)}
    after = dict(before)
    for i in draw.sample(sorted(before), min(changes, n)):
        kind = draw.randrange(3)
        if kind == 0:
            del after[i]
        elif kind == 1:
            after[i] = (i, "changed", None)
        else:
            after[10 * n + i] = (10 * n + i, "new", 3)
    extra = [(None, "loose", 1)], [(None, "loose", 2)]
    copies = list(before.values())[:2]
    return (spark.createDataFrame(list(b.values()) + e + copies, SCHEMA) for b, e in zip((before, after), extra, strict=True))


@pytest.mark.parametrize("limit", [500, 0])
def test_equals_the_plain_comparison(spark, monkeypatch, limit):
    monkeypatch.setattr(digests, "MOST_RANGES", limit)
    draw = random.Random(5)
    for n, changes in ((40, 0), (200, 120)):
        old, new = pair(spark, draw, n, changes)
        trees = [stage(digests.digest_tree(df, "id", 7), "tree") for df in (old, new)]
        found = digests.tree_diff(old, new, "id", *trees, leaf_keys=7)
        plain = snap_diff(old, new, "id")
        key = lambda r: (r[0] is None, r[0] or 0, r[1])
        # Rows without key are listed by either; they never pair up.
        assert sorted((tuple(r) for r in found.collect()), key=key) == sorted((tuple(r) for r in plain.collect()), key=key)
        only = digests.tree_diff(old, new, "id", *trees, changes_only=True, leaf_keys=7)
        assert rows(only.where("id IS NOT NULL")) == rows(plain.where("change <> 'unchanged' AND id IS NOT NULL"))


def test_leaves_of_large_and_negative_keys(spark):
    keys = [2**53 + 1, 2**62 + 7, -1, -4096, -4097, 0, 4095]
    found = spark.createDataFrame([(k,) for k in keys], "id bigint").select(digests.leaf_of(F.col("id"))).collect()
    assert [r[0] for r in found] == [k // 4096 for k in keys]


def test_levels_add_up_and_order_does_not_matter(spark):
    df = spark.range(-500, 3000).selectExpr("id", "cast(id % 7 as string) a", "cast(id as int) b")
    tree = digests.digest_tree(df, "id", 5)
    totals = rows(tree.groupBy("level").agg(F.sum("rows"), F.sum("x"), F.sum("m")).drop("level"))
    assert len(totals) == digests.LEVELS + 1 and len(set(totals)) == 1 and totals[0][0] == 3500
    tree = stage(tree, "tree")
    other = stage(digests.digest_tree(df.select("b", "id", "a").orderBy(F.rand(1)).repartition(5), "id", 5), "tree")
    assert digests.same(tree, other) and digests.differing_leaves(tree, other).isEmpty()
    changed = stage(digests.digest_tree(df.where("id <> 1234"), "id", 5), "tree")
    assert rows(digests.differing_leaves(tree, changed)) == [(246,)] and not digests.same(tree, changed)


def read_rows(df):
    """Rows that the scans of a query hand on."""
    df.collect()
    total, stack = 0, [df._jdf.queryExecution().executedPlan()]
    while stack:
        node = stack.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            stack.append(node.executedPlan())
        elif "QueryStage" in node.nodeName():
            stack.append(node.plan())
        children = node.children()
        stack += [children.apply(i) for i in range(children.size())]
        if node.nodeName().startswith("Scan parquet"):
            total += node.metrics().apply("numOutputRows").value()
    return total


def test_unchanged_ranges_are_not_read(spark, tmp_path):
    base = spark.range(100_000).selectExpr("id", "cast(id as string) a", "1 b")
    base.repartitionByRange(20, "id").write.parquet(str(tmp_path / "old"))
    base.withColumn("b", F.when(F.col("id").isin(5, 70_001), 2).otherwise(1)).repartitionByRange(20, "id").write.parquet(str(tmp_path / "new"))
    old, new = (spark.read.parquet(str(tmp_path / n)) for n in ("old", "new"))
    trees = [stage(digests.digest_tree(df, "id", 1000), "tree") for df in (old, new)]
    found = digests.tree_diff(old, new, "id", *trees, changes_only=True, leaf_keys=1000)
    assert rows(found) == [(5, "updated"), (70_001, "updated")]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PushedFilters: [Or(") == 2
    assert read_rows(found) <= 60_000  # of 200,000


def test_kept_with_a_run(spark, tmp_path):
    root, df = str(tmp_path), spark.range(5000).selectExpr("id", "'x' a")
    digests.keep_tree(root, "t", "run-1", df, "id")
    kept = digests.kept_tree(spark, root, "t", "run-1")
    assert rows(digests.source_matches(df, "id", kept, "t")) == [("t", 5000, 5000, 0, "PASS")]
    moved = df.withColumn("a", F.when(F.col("id") == 4999, "y").otherwise("x"))
    assert rows(digests.source_matches(moved, "id", kept, "t")) == [("t", 5000, 5000, 1, "FAIL")]
