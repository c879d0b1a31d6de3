"""Connected components of an edge table, by alternating large and small stars.

Each round replaces edges by edges to the smallest neighbour: first every larger neighbour of a node is tied to the
node's minimum, then every smaller one. Rounds end when the edges no longer change; each component is then a star around
its smallest node. Rounds are written to the checkpoint folder, so the plan stays short and lost executors repeat one
round only. The minimum is pre-aggregated before its shuffle and written, so that the join that follows is one of two
plain exchanges, in which adaptive execution splits a node with very many edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprep.session import materialise


def _sum(edges: DataFrame) -> tuple:
    total = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count(F.lit(1)), total).first())


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """`edges` holds (a, b) with a > b, without repeats."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    least = materialise(both.groupBy("a").agg(F.min("b").alias("least")).withColumn("least", F.least("a", "least")))
    met = both.join(least, "a")
    if large:
        tied = met.where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        tied = met.where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b")).union(
            least.select("a", F.col("least").alias("b")))
    return materialise(tied.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node with an edge; `root` is the smallest node that can be reached. Nodes are bigints."""
    pairs = edges.select(F.greatest(a, b).cast("bigint").alias("a"), F.least(a, b).cast("bigint").alias("b"))
    current = materialise(pairs.where("a <> b").distinct())
    seen = _sum(current)
    while seen[0]:
        current = _star(_star(current, large=True), large=False)
        now = _sum(current)
        if now == seen:
            break
        seen = now
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
