"""Connected components of an edge table, by alternating large-star and
small-star steps with a written table between rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverbed.llm.common import written


def _both(edges: DataFrame) -> DataFrame:
    return edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Join every neighbour larger than the node to the smallest one near it."""
    near = _both(edges)
    least = near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return (near.where(F.col("b") > F.col("a")).join(least, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).where(F.col("a") != F.col("b")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Join every neighbour not larger than the node, and the node, to the
    smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    joined = down.join(least, "a")
    return (joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(least.select("a", F.col("m").alias("b"))).where(F.col("a") != F.col("b")).distinct())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b; comparable, not null):
    root is the smallest node reachable.  Each round writes its edges to the
    shared folder; rounds grow with the logarithm of the node count, as the
    steps halve distances however long a chain is."""
    now = written(edges.where(F.col("a") != F.col("b")).distinct(), "components")
    seen = None
    while True:
        now = written(_small_star(_large_star(now)), "components")
        # a fixed point is a set of stars: the same edges again
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).cast("string")).first()
        if state == seen:
            break
        seen = state
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
