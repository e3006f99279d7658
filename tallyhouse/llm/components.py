"""Connected components of an edge table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..workspace import discard, stage


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); the component is its smallest node.

    Every round points each node at its smallest neighbour (an aggregate that
    merges map-side, so a node with a third of all edges does no harm), follows
    one more step, and replaces the ends of all edges by what they point at;
    edges inside one node vanish. Pointers only ever lead to smaller nodes, and
    every round at least halves the nodes that still have edges, so the rounds
    grow with the logarithm of the longest chain. What a round makes is written
    to the shared folder. Null ends and loops are no edges; an empty table has
    no components.
    """
    edges = stage(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    labels = None
    while not edges.isEmpty():
        both = edges.select(F.col("a").alias("node"), F.col("b").alias("to")).union(edges.select("b", "a"))
        nearest = both.groupBy("node").agg(F.min("to").alias("to")).select("node", F.least("node", "to").alias("to"))
        step = stage(nearest, "nearest")
        further = step.select(F.col("node").alias("to"), F.col("to").alias("beyond"))
        points = stage(step.join(further, "to").select("node", F.col("beyond").alias("to")), "points")
        for end in ("a", "b"):
            moved = points.select(F.col("node").alias(end), F.col("to").alias(f"new_{end}"))
            edges_moved = (edges if end == "a" else edges_moved).join(moved, end)
        smaller = stage(
            edges_moved.where("new_a <> new_b")
            .select(F.greatest("new_a", "new_b").alias("a"), F.least("new_a", "new_b").alias("b"))
            .distinct(),
            "edges",
        )
        if labels is None:  # every node still has edges
            relabelled, done = points.select("node", F.col("to").alias("component")), (edges, step)
        else:
            moved = points.select(F.col("node").alias("component"), "to")
            relabelled = stage(
                labels.join(moved, "component", "left").select("node", F.coalesce("to", "component").alias("component")),
                "labels",
            )
            done = (edges, step, points, labels)
        for old in done:
            discard(old)
        edges, labels = smaller, relabelled
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    discard(edges)
    return labels
