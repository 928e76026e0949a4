"""Connected components of an edge table by alternating large-star and small-star rounds.

Each round joins the edges with the smallest neighbour of each node, so a hub is an ordinary
skewed join key and its smallest neighbour is combined in each task before the shuffle. The
rounds a graph needs grow with the logarithm of its size. Every round is written to the shared
folder; the driver sees a count and a checksum only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from orderpulse.llm.common import saved


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node gives its larger neighbours to the smallest of its neighbours and itself."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"),
                                                     F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("low"))
    joined = both.join(least, "a")
    low = F.least("a", "low")
    return (joined.filter(F.col("b") > F.col("a"))
            .select(F.col("b").alias("a"), low.alias("b")).filter("a != b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node gives itself and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("low"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.filter("a != b").union(least.select("a", F.col("low").alias("b"))).distinct()


def connected(edges: DataFrame) -> DataFrame:
    """(node, low) for every node of ``edges`` (a, b): the smallest node it is linked with.

    Edges have no direction; loops and nulls are ignored, repeated edges count once. No edge
    gives no row.
    """
    ordered = edges.filter("a != b").select(F.greatest("a", "b").alias("a"),
                                            F.least("a", "b").alias("b")).distinct()
    now, before = saved(ordered, "edges"), None
    while True:
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == before:
            break
        before = seen
        now = saved(_small_star(_large_star(now)), "edges")
    return now.select(F.col("a").alias("node"), F.col("b").alias("low")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("low")).distinct())
