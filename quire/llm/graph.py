"""Connected components of a link table, as alternating star steps.

After Kiveris et al., "Connected Components in MapReduce and Beyond" (2014):
each step links the neighbours of a node to the least of them, until every
component is a star around its least node. A step is two aggregations and two
joins; links are never gathered. A node with very many links is summed before
the shuffle, and as the sums are checkpointed, the join can split it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("low"))
    least = cut(least.select("a", F.least("a", "low").alias("low")))
    return (both.join(least, "a").where(F.col("b") > F.col("a"))
            .select(F.col("b").alias("a"), F.col("low").alias("b")))


def _small_star(links: DataFrame) -> DataFrame:
    least = cut(links.groupBy("a").agg(F.min("b").alias("low")))
    moved = (links.join(least, "a").where(F.col("b") != F.col("low"))
             .select(F.col("b").alias("a"), F.col("low").alias("b")))
    return moved.union(least.select("a", F.col("low").alias("b"))).distinct()


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every linked node; ``root`` is the least of its component.

    ``links``: two columns of one type; links to itself and null ends are
    ignored, direction and repeats don't matter. Each step is checkpointed.
    """
    a, b = links.columns
    links = links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"), F.col(a).alias("x"),
                         F.col(b).alias("y"))
    links = cut(links.where("x is not null and y is not null and x <> y").select("a", "b").distinct())
    state = _state(links)
    while state[0]:
        links = cut(_small_star(cut(_large_star(links))))
        before, state = state, _state(links)
        if before == state:
            break
    stars = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.union(links.select(F.col("b"), F.col("b")).distinct())
