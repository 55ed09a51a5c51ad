"""Connected components of a graph given as links, by alternating large-star and small-star steps.

Both steps hang vertices on the smallest neighbour they know; the links shrink to one star per
component, whose centre is its smallest vertex.  A step is an aggregate with map-side combine and
a join, so a vertex with very many links is never gathered anywhere, and Spark can split its partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rolelake.operators.durable import stored


def _hung(links: DataFrame) -> DataFrame:
    """Each link's start with the smallest vertex among itself and its ends."""
    nearest = links.groupBy("a").agg(F.min("b").alias("_least")).withColumnRenamed("a", "_a")
    return links.join(nearest, F.col("a") == F.col("_a")).select("a", "b", F.least("a", "_least").alias("m"))


def _large_star(links: DataFrame) -> DataFrame:
    # Not as a union, which would have the driver plan the links twice.
    both = links.select(F.inline(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))))
    return _hung(both).filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    # Links come from a large-star step, so a is above m, and only ends can hang on themselves.
    both = F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))
    return _hung(links).select(F.inline(both)).filter("a <> b")


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Columns vertex and component (the smallest vertex reachable), for vertices that are not the smallest.

    ``links``: pairs of numbers, either way round and repeated as they may be; a link with itself counts for nothing.
    """
    ordered = links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter("a <> b").distinct()
    current = stored(ordered)
    seen = None
    while True:
        current = stored(_small_star(_large_star(current).distinct()).distinct())
        mark = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen:
            return current.select(F.col("a").alias("vertex"), F.col("b").alias("component"))
        seen = mark
