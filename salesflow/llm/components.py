"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesflow.session import stage


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b); a component is its smallest node.

    Large star: every larger neighbour of a node is linked to the smallest one. Small star: every
    smaller neighbour is. Both keep components whole, and repeated they end in one star per component,
    after a number of rounds that grows with the logarithm of its size. A node with very
    many links is only aggregated (per task first) and joined, where skew is split.
    """
    edges = stage(_ordered(links.select("a", "b")), "stars")
    before = None
    while True:
        both = edges.union(edges.select(F.col("low").alias("high"), F.col("high").alias("low")))
        both = both.toDF("u", "v")
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter(F.col("v") > F.col("u"))
        large = stage(_ordered(large.select(F.col("v").alias("a"), F.col("m").alias("b"))), "stars")
        least = large.groupBy(F.col("high").alias("u")).agg(F.min("low").alias("m"))
        small = large.join(least, large["high"] == least["u"])
        small = (small.select(F.col("low").alias("a"), F.col("m").alias("b"))
                 .union(least.select(F.col("u").alias("a"), F.col("m").alias("b"))))
        edges = stage(_ordered(small), "stars")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    stars = edges.select(F.col("high").alias("node"), F.col("low").alias("component"))
    roots = edges.select(F.col("low").alias("node"), F.col("low").alias("component")).distinct()
    return stars.union(roots)


def _ordered(pairs: DataFrame) -> DataFrame:
    """(high, low), each once, without loops."""
    ends = pairs.select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low"))
    return ends.filter("high <> low").distinct()
