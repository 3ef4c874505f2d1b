"""Connected components of a graph given by its edges, with bounded work in every task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialoom.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every end of `edges` (a, b: long), the label being the smallest node it is joined to.

    Each round hooks every node that has a smaller neighbour to the smallest of them, follows these hooks four
    steps down, and draws the edges anew between where their ends have got. Edges whose ends meet go, so the
    graph shrinks until none is left. Only pairs of numbers are moved, and they are written once a round.
    """
    edges = written(_drawn(edges.select("a", "b")), "edges")
    ends = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    labels = ends.select("node", F.col("node").alias("label"))
    while not edges.isEmpty():
        hooks = edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("up"))
        for _ in range(2):
            further = hooks.select(F.col("node").alias("up"), F.col("up").alias("top"))
            hooks = hooks.join(further, "up", "left").select("node", F.coalesce("top", "up").alias("up"))
        hooks = written(hooks, "hooks")
        labels = written(_moved(labels, hooks, "label"), "labels")
        edges = written(_drawn(_moved(_moved(edges, hooks, "a"), hooks, "b")), "edges")
    return labels


def _drawn(edges: DataFrame) -> DataFrame:
    low, high = F.least("a", "b"), F.greatest("a", "b")
    return edges.where("a <> b").select(low.alias("a"), high.alias("b")).distinct()


def _moved(df: DataFrame, hooks: DataFrame, column: str) -> DataFrame:
    """`df` with the nodes in `column` moved to where they are hooked."""
    at = hooks.select(F.col("node").alias(column), "up")
    return df.join(at, column, "left").select(
        *[F.coalesce("up", column).alias(column) if c == column else F.col(c) for c in df.columns]
    )
