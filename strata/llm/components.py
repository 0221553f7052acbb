"""Connected components by alternating large-star and small-star steps.

Every step is a grouped minimum (partially aggregated before the shuffle) and a
join back; no neighbour list is ever collected, so a hub costs no task its rows.
Rounds grow with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.session import stage


def components(edges: DataFrame, a: str = "x", b: str = "y") -> DataFrame:
    """``node`` and ``root`` (its component's smallest node) for every node that has a link."""
    edges, n = stage(edges.select(F.col(a).alias("x"), F.col(b).alias("y")).filter("x != y").distinct(), "cc")
    if not n:
        return edges.select(F.col("x").alias("node"), F.col("y").alias("root"))
    last = None
    while True:
        both = edges.unionByName(edges.select(F.col("y").alias("x"), F.col("x").alias("y")))
        low = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        # large star: larger neighbours link to the smallest of the neighbourhood
        big = both.filter("y > x").join(low, "x").select(F.col("y").alias("x"), F.col("m").alias("y")).filter("x != y").distinct()
        down = big.select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y"))
        down, _ = stage(down, "cc")
        # small star: smaller neighbours and the node itself link to the smallest
        low = down.groupBy("x").agg(F.min("y").alias("m"))
        near = down.join(low, "x").select(F.col("y").alias("x"), F.col("m").alias("y")).unionByName(low.select("x", F.col("m").alias("y")))
        edges, n = stage(near.filter("x != y").distinct(), "cc")
        # a forest of stars repeats itself: compare the edge sets by count and sum of hashes
        mark = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("x", "y").cast("decimal(38,0)"))).first()
        if mark == last:
            return edges.select(F.col("x").alias("node"), F.col("y").alias("root")).unionByName(
                edges.select(F.col("y").alias("node"), F.col("y").alias("root")).distinct())
        last = mark
