"""Connected components of a graph given by its edges, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deedmill.llm.common import checkpoint, shuffles_removed


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour instead."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    larger = both.where("b > a")
    return larger.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).where("a != b")


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of these. Here a > b in every edge."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    linked = edges.join(least, "a")
    return linked.select(F.explode(F.array(F.col("a"), F.col("b"))).alias("a"), F.col("least").alias("b")).where("a != b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node and root, the smallest node of its component, for every node but the roots themselves.

    `edges` has two long columns a and b. Nulls and loops are ignored. Each round gathers minima with partial
    aggregation and joins them back, so no neighbour list is ever collected, and is checkpointed; the number
    of rounds grows with the logarithm of the longest chain.
    """
    kept = edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    current, before = checkpoint(kept), None
    while True:
        with shuffles_removed(current.sparkSession):
            state = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state
        current = checkpoint(_small_star(_large_star(current)))
