"""Connected components of a graph given as links, by alternating star contraction. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogsync.llm.common import stage


def components(links: DataFrame) -> DataFrame:
    """``vertex`` and ``component`` (its smallest vertex) for every vertex of the links ``a``, ``b``."""
    found = hung(links)
    return found.unionByName(found.select(F.col("component").alias("vertex"), "component").distinct())


def hung(links: DataFrame) -> DataFrame:
    """``components`` without the smallest vertex of each, which is its own.

    Each round hangs every vertex's larger neighbours, then all its smaller
    ones, on the smallest vertex it sees; the rounds needed grow with the
    logarithm of the longest path. Minima are taken before the shuffle, so a
    vertex with very many links is no single group; nothing is collected but
    whether a round was the last. Self links and nulls are left out.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct()
    edges = stage(edges, "edges")
    while not _stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = joined.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        edges = stage(small.distinct(), "edges")
    return edges.select(F.col("u").alias("vertex"), F.col("v").alias("component"))


def _stars(edges: DataFrame) -> bool:
    """Does every vertex hang on one other at most, and only such that hang on none?"""
    up = edges.select("u", F.lit(1).alias("up"), F.lit(0).alias("down"))
    down = edges.select(F.col("v").alias("u"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    seen = up.unionByName(down).groupBy("u").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not seen.where("up > 1 or (up = 1 and down = 1)").take(1)
