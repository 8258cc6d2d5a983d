"""Connected components of a stored table of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stored


def _large_star(links: DataFrame) -> DataFrame:
    """Every node tells its larger neighbours the smallest node it knows."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("least"))
    moved = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.filter("a <> b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Every node tells its smaller neighbours and itself the smallest of them. ``a`` is the larger end."""
    least = links.groupBy("a").agg(F.min("b").alias("least"))
    told = links.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).union(least.select("a", "least"))
    return told.filter("a <> b").distinct()


def components(links: DataFrame, label: str = "links") -> DataFrame:
    """(node, component) of every node of ``links`` (a, b): the smallest node it is connected with.

    Each round is two grouped minima and joins; groups are never gathered. The number of rounds grows
    with the logarithm of the longest path. Each round is stored, so a lost executor repeats one round.
    """
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    links = stored(links, label)
    state = None
    while True:
        links = stored(_small_star(_large_star(links)), label)
        found = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(found) == state:
            return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        state = tuple(found)
