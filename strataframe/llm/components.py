"""Connected components of an edge table by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataframe.llm.tables import cut_lineage

JUMPS = 3


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every end of an edge ``(a, b)``; a component is its smallest node.

    Each round hooks every node to the smallest of its neighbours and itself, follows these hooks a few
    steps, and replaces the ends of all edges by where they lead, until no edge is left. All steps are
    joins and grouped minima, so no neighbourhood is gathered in one place; every round is written to
    the shared folder.
    """
    both = edges.select("a", "b").where("a <> b")
    now = cut_lineage(both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    labels = None
    while not now.isEmpty():
        ends = now.select(F.col("a").alias("node"), F.col("b").alias("near")).union(now.select("b", "a"))
        hook = cut_lineage(ends.groupBy("node").agg(F.min("near").alias("near")).select("node", F.least("node", "near").alias("up")))
        for _ in range(JUMPS):
            over = hook.select(F.col("node").alias("up"), F.col("up").alias("top"))
            hook = hook.join(over, "up", "left").select("node", F.coalesce("top", "up").alias("up"))
        hook = cut_lineage(hook)
        if labels is None:
            labels = hook.select("node", F.col("up").alias("component"))
        else:
            step = hook.select(F.col("node").alias("component"), "up")
            labels = cut_lineage(
                labels.join(step, "component", "left").select("node", F.coalesce("up", "component").alias("component"))
            )
        moved = (
            now.join(hook.select(F.col("node").alias("a"), F.col("up").alias("x")), "a")
            .join(hook.select(F.col("node").alias("b"), F.col("up").alias("y")), "b")
        )
        now = cut_lineage(
            moved.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        )
    if labels is None:
        return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels
