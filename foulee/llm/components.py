"""Connected components of a graph of longs by alternating large and small stars.

Each step is an aggregate and a lookup over the edges, and no step gathers a node's neighbours: a hub
collapses in partial aggregates, and the lookup lets adaptive execution split it. Every step is
written to the shared folder, so the lineage stays short and a lost executor costs one step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foulee.operators.lookup import left_lookup
from foulee.session import staged


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the smallest node that the node sees."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    moved = left_lookup(both.filter("b > a"), least, ["a"], unique=True)
    return moved.select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    moved = left_lookup(edges, least, ["a"], unique=True).filter("b > least")
    return moved.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(
        least.select("a", F.col("least").alias("b"))
    ).distinct()


def components(edges: DataFrame) -> DataFrame:
    """node and root, the smallest node reachable, for every node of ``edges`` (a, b) but the roots."""
    edges = staged(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "edges",
    )
    seen = None
    while True:
        # Sums over the set of edges: equal sums mean that a round changed nothing.
        state = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.sum(F.col("b").cast("decimal(38,0)"))
        ).first()
        if state == seen or not state[0]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = state
        edges = staged(_small_star(staged(_large_star(edges), "large_star")), "small_star")
