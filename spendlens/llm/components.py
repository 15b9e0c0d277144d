"""Connected components over a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlens.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them; ``u > v`` on entry."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    met = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return met.unionByName(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node it is connected to, for all nodes but roots.

    ``edges`` has ``u`` and ``v``. Every round is written to the shared folder,
    so a lost executor repeats one round at most; the number of rounds grows
    with the logarithm of the longest chain. Only sums reach the driver. Minima
    are combined before the shuffle and joins are plain equi-joins, so a hub
    with very many links is split like any skewed join.
    """

    def ordered(links: DataFrame) -> DataFrame:
        return links.select(
            F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
        ).where("u <> v").distinct()

    def state(links: DataFrame):
        return links.agg(
            F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.hash("v", "u"))
        ).first()

    current = stored(ordered(edges), "links")
    before = state(current)
    while before[0]:
        current = stored(ordered(_small_star(ordered(_large_star(current)))), "links")
        after = state(current)
        if after == before:
            break
        before = after
    return current.select(F.col("u").alias("node"), F.col("v").alias("root"))
