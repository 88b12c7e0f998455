"""Connected components by alternating large and small stars, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.store import checkpointed


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Point every neighbour at the least one: the larger neighbours, or the smaller and the node itself."""
    around = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    least = around.groupBy("a").agg(F.min("b").alias("least"))
    least = least.select("a", F.least("a", "least").alias("least"))
    # One side has a row for each node: adaptive execution splits a hot node's edges.
    joined = around.join(least, "a")
    moved = joined.filter(F.col("b") > F.col("a") if large else F.col("b") != F.col("least")).select(
        F.col("b").alias("a"), F.col("least").alias("b")
    )
    if not large:
        moved = moved.unionByName(least.select("a", F.col("least").alias("b")))
    return moved.filter("a <> b").distinct()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node, root`` for every node of the undirected edges; the root is the least node of its component."""
    pairs = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter("a <> b").distinct()
    pairs = checkpointed(pairs)
    mark = None
    while True:
        pairs = checkpointed(_star(_star(pairs, large=True), large=False))
        seen = pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(seen) == mark:
            break
        mark = tuple(seen)
    roots = pairs.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
