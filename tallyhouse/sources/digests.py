"""Digest trees over key ranges: what changed between two tables, without reading the rest.

A leaf covers a range of whole-number keys and holds the number of its rows and two
sums of row hashes. Sums do not depend on the order of rows, and a node above is the
sum of its children, so a tree is a small table made in one pass, kept beside the data
it describes. Two trees are compared from the root down, level by level, and only
below nodes that differ; rows are then read only from the key ranges of differing
leaves, which reach the scan as filters on the key.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..workspace import stage
from .snapshots import snap_diff

LEAF_KEYS = 4_096
FANOUT = 16
LEVELS = 5  # 4,096 x 16**4 keys to a node below the root
MOST_RANGES = 500  # runs of leaves from which on they are joined instead of listed in a filter

TREE_SCHEMA = "level INT, node BIGINT, rows BIGINT, x DECIMAL(38,0), m DECIMAL(38,0)"


def leaf_of(key: Column, leaf_keys: int = LEAF_KEYS) -> Column:
    """The leaf of a key, in whole numbers: a quotient in floating point would misplace keys beyond 2**53."""
    key = key.cast("bigint")
    return F.call_function("div", key - F.pmod(key, F.lit(leaf_keys).cast("bigint")), F.lit(leaf_keys).cast("bigint"))


def _row_hashes(df: DataFrame) -> tuple[Column, Column]:
    """Two hashes of a whole row; NULLs count as flags too, since hashes skip them."""
    parts = (*sorted(df.columns), *(F.col(c).isNull() for c in sorted(df.columns)))
    return F.xxhash64(*parts).cast("decimal(20,0)"), F.hash(*parts).cast("decimal(20,0)")


def digest_tree(df: DataFrame, pk: str, leaf_keys: int = LEAF_KEYS) -> DataFrame:
    """(level, node, rows, x, m): level 0 holds the leaves, ``LEVELS`` the root. Rows without key are in node NULL."""
    x, m = _row_hashes(df)
    leaves = (
        df.select(leaf_of(F.col(pk), leaf_keys).alias("leaf"), x.alias("x"), m.alias("m"))
        .groupBy("leaf")
        .agg(F.count("*").alias("rows"), F.sum("x").cast("decimal(38,0)").alias("x"), F.sum("m").cast("decimal(38,0)").alias("m"))
    )
    above = F.transform(
        F.sequence(F.lit(0), F.lit(LEVELS)),
        lambda level: F.struct(
            level.cast("int").alias("level"),
            F.when(level < LEVELS, F.floor(F.col("leaf") / F.pow(F.lit(FANOUT), level)).cast("bigint")).otherwise(F.lit(0).cast("bigint")).alias("node"),
        ),
    )
    nodes = leaves.select(F.explode(above).alias("at"), "rows", "x", "m").select("at.*", "rows", "x", "m")
    return nodes.groupBy("level", "node").agg(
        F.sum("rows").alias("rows"), F.sum("x").cast("decimal(38,0)").alias("x"), F.sum("m").cast("decimal(38,0)").alias("m")
    )


def _parent(level: int, node: Column) -> Column:
    return F.lit(0).cast("bigint") if level + 1 >= LEVELS else F.floor(node / FANOUT).cast("bigint")


def differing_nodes(before: DataFrame, after: DataFrame, level: int, within: DataFrame | None = None) -> DataFrame:
    """Nodes of a level whose digests differ or that one tree lacks; only children of ``within``."""

    def side(tree: DataFrame, name: str) -> DataFrame:
        own = tree.where(F.col("level") == level)
        if within is not None:
            own = own.withColumn("parent", _parent(level, F.col("node")))
            above = within.select(F.col("node").alias("above"))
            own = own.join(above, F.equal_null("parent", "above"), "left_semi")
        return own.select("node", F.struct("rows", "x", "m").alias(name))

    old, new = side(before, "old"), side(after, "new").withColumnRenamed("node", "node_new")
    both = old.join(new, F.col("node").eqNullSafe(F.col("node_new")), "full")
    return both.where(~F.equal_null("old", "new")).select(F.coalesce("node", "node_new").alias("node"))


def differing_leaves(before: DataFrame, after: DataFrame) -> DataFrame:
    """Leaves that differ, found from the root down: (node)."""
    return reduce(lambda found, level: differing_nodes(before, after, level, found), range(LEVELS - 1, -1, -1), differing_nodes(before, after, LEVELS))


def same(before: DataFrame, after: DataFrame) -> bool:
    """Do two tables hold the same rows? Two roots are read."""
    return differing_nodes(before, after, LEVELS).isEmpty()


def _runs(leaves: Iterable[int]) -> list[tuple[int, int]]:
    """Neighbouring leaves as (first, last)."""
    found: list[tuple[int, int]] = []
    for leaf in sorted(leaves):
        if found and leaf == found[-1][1] + 1:
            found[-1] = (found[-1][0], leaf)
        else:
            found.append((leaf, leaf))
    return found


class Ranges:
    """Where two tables differ, as filters on their key."""

    def __init__(self, spark: SparkSession, pk: str, leaves: DataFrame, leaf_keys: int = LEAF_KEYS):
        self.pk, self.leaf_keys = pk, leaf_keys
        # A leaf is a few thousand rows: the list is bounded by the size of the trees, a run of leaves is one entry.
        known = [r.node for r in leaves.collect()]
        self.null_key = None in known
        self.runs = _runs(n for n in known if n is not None)
        self.leaves = spark.createDataFrame([(n,) for a, b in self.runs for n in range(a, b + 1)], "leaf bigint")

    def _filter(self) -> Column:
        key = F.col(self.pk)
        inside = [(key >= a * self.leaf_keys) & (key < (b + 1) * self.leaf_keys) for a, b in self.runs]
        inside += [key.isNull()] if self.null_key else []
        return reduce(lambda a, b: a | b, inside, F.lit(False))

    def inside(self, df: DataFrame) -> DataFrame:
        """Rows in differing leaves."""
        if len(self.runs) <= MOST_RANGES:
            return df.where(self._filter())
        leaf = leaf_of(F.col(self.pk), self.leaf_keys)
        listed = df.join(self.leaves, leaf == F.col("leaf"), "left_semi")
        return listed.unionByName(df.where(F.col(self.pk).isNull())) if self.null_key else listed

    def outside_keys(self, df: DataFrame) -> DataFrame:
        """Keys of all other rows; no other column is read."""
        keys = df.select(self.pk)
        if len(self.runs) <= MOST_RANGES:
            return keys.where(~F.coalesce(self._filter(), F.lit(False)))
        leaf = leaf_of(F.col(self.pk), self.leaf_keys)
        rest = keys.join(self.leaves, leaf == F.col("leaf"), "left_anti")
        return rest.where(F.col(self.pk).isNotNull()) if self.null_key else rest


def tree_diff(
    previous: DataFrame, current: DataFrame, pk: str, before: DataFrame, after: DataFrame, changes_only: bool = False, leaf_keys: int = LEAF_KEYS
) -> DataFrame:
    """``snapshots.snap_diff`` by the trees of both tables: only differing ranges are read whole.

    Both trees must cover the same columns. Of the rest only the keys are read, to
    list them as unchanged, or nothing with ``changes_only``.
    """
    where = Ranges(current.sparkSession, pk, differing_leaves(before, after), leaf_keys)
    changes = snap_diff(where.inside(previous), where.inside(current), pk)
    if changes_only:
        return changes.where("change <> 'unchanged'")
    rest = where.outside_keys(current).distinct().withColumn("change", F.lit("unchanged"))
    return changes.unionByName(rest)


# ---- kept with a run ---------------------------------------------------------


def _tree_path(root: str, table: str, run_id: str) -> str:
    return f"{root}/digests/{table}/{run_id}"


def keep_tree(root: str, table: str, run_id: str, df: DataFrame, pk: str, leaf_keys: int = LEAF_KEYS) -> None:
    """Store the tree of a table as a run exported it; a run's tree is written once."""
    digest_tree(df, pk, leaf_keys).coalesce(1).write.parquet(_tree_path(root, table, run_id))


def kept_tree(spark: SparkSession, root: str, table: str, run_id: str) -> DataFrame:
    return spark.read.schema(TREE_SCHEMA).parquet(_tree_path(root, table, run_id))


def source_matches(source: DataFrame, pk: str, tree: DataFrame, table: str, leaf_keys: int = LEAF_KEYS) -> DataFrame:
    """One row: does the source still hold what a run exported? With the rows on both sides and the ranges that differ."""
    own = stage(digest_tree(source, pk, leaf_keys), "tree")
    rows = [t.where(F.col("level") == LEVELS).agg(F.coalesce(F.max("rows"), F.lit(0))).scalar() for t in (own, tree)]
    ranges = differing_leaves(tree, own).select(F.count("*")).scalar()
    status = F.when(F.col("differing_ranges") == 0, "PASS").otherwise("FAIL")
    figures = source.sparkSession.range(1).select(
        F.lit(table).alias("table_name"), rows[0].alias("source_count"), rows[1].alias("staging_count"), ranges.alias("differing_ranges")
    )
    return figures.withColumn("status", status)
