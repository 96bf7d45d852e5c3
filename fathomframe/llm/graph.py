"""Connected components by alternating star steps; edges shuffle, none is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _star(edges: DataFrame) -> DataFrame:
    """Large star, then small star: neighbours point to the smallest one they can see."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    lowest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    large = both.join(lowest, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    down = large.where("a <> b").distinct()
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    small = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    return small.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """a, b (vertices, either order) to vertex, component (its smallest vertex); lone vertices have no row.

    Each round is a written table; the number of rounds grows with the logarithm of the longest path.
    """
    now = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    now = written(now, "links")
    mark = None
    while True:
        after = written(_star(now), "star")
        seen = after.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == mark:
            break
        now, mark = after, seen
    return after.select(F.col("a").alias("vertex"), F.col("b").alias("component"))
