"""Connected components by alternating large and small stars, every step a distributed aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.session import cut


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link every neighbour on one side of a node to the smallest node next to it.

    Only the minimum of each node is aggregated (map-side combined) and joined back; a node with many neighbours is never
    gathered in one task, and the join's skew is left to adaptive execution, which splits such partitions.
    """
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    side = both if large else both.filter("v < u")
    least = side.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    if large:
        out = both.filter("v > u").join(least, "u").select(F.col("v").alias("b"), F.col("m").alias("a"))
    else:
        out = side.join(least, "u").select(F.col("v").alias("b"), F.col("m").alias("a")).union(least.select(F.col("u").alias("b"), F.col("m").alias("a")))
    return out.filter("a < b").select("a", "b").distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, root)`` for every node of ``edges``: root is the smallest node that it is linked to, itself included.

    Nulls and loops are ignored; the result is empty for an empty table.  Each round is written to reliable storage, so
    an executor that is lost costs one round at most.  The number of rounds grows with the logarithm of the longest path.
    """
    links = edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).filter("a < b").distinct()
    links, seen = cut(links), None
    while True:
        after = cut(_star(_star(links, large=True), large=False))
        mark = after.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        links = after
        if mark == seen:
            break
        seen = mark
    roots = links.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root"))
    return roots.union(links.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
