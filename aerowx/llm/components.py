"""Connected components of a distributed edge list."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import durable


def _roots(edges: DataFrame) -> DataFrame:
    """Hang every node on its smallest neighbour, then jump to the tops of these trees."""
    both = edges.union(edges.select("b", "a")).toDF("node", "other")
    parent = durable(
        both.groupBy("node").agg(F.min("other").alias("up")).select("node", F.least("node", "up").alias("up"))
    )
    while True:
        above = parent.toDF("up", "top")
        parent = durable(
            parent.join(above, "up").select("node", F.col("top").alias("up"), (F.col("top") != F.col("up")).alias("moved"))
        )
        moved = parent.where("moved").limit(1).count()
        parent = parent.select("node", "up")
        if not moved:
            return parent


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b), the smallest node naming a component.

    Each round contracts trees of smallest neighbours and keeps the edges between them, so
    the number of rounds grows with the logarithm of the longest path. Rows are narrow, and
    both sides of every join are written tables whose hot keys adaptive execution can split.
    NULL ends and loops are ignored; no edges give an empty table.
    """
    pairs = edges.toDF("a", "b").where("a <> b")
    left = durable(pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    rounds = []
    while left.limit(1).count():
        roots = _roots(left)
        rounds.append(roots)
        top_a, top_b = roots.toDF("a", "top_a"), roots.toDF("b", "top_b")
        ends = left.join(top_a, "a").join(top_b, "b").where("top_a <> top_b")
        left = durable(
            ends.select(F.greatest("top_a", "top_b").alias("a"), F.least("top_a", "top_b").alias("b")).distinct()
        )
    if not rounds:
        return left.select(F.col("a").alias("node"), F.col("b").alias("component"))

    def higher(labels: DataFrame, roots: DataFrame) -> DataFrame:
        return labels.join(roots.toDF("component", "top"), "component", "left").select(
            "node", F.coalesce("top", "component").alias("component")
        )

    return reduce(higher, rounds[1:], rounds[0].toDF("node", "component"))
