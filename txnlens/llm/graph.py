"""Connected components by alternating large-star and small-star steps, each step stored in the scratch folder.

A step replaces the links of a node by links to its smallest neighbour, so the number of links never grows; the rounds grow
with the logarithm of the number of nodes. Minimums are combined before the shuffle, and the joins on the node are plain
joins of two exchanges, which adaptive execution splits where a node has very many links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlens.llm.common import discard, stored


def large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour (or the node, if smaller)."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("low_")).select("a", F.least("a", "low_").alias("low_"))
    return both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low_").alias("b")).where("a <> b").distinct()


def small_star(links: DataFrame) -> DataFrame:
    """Links point from larger to smaller; a node and its smaller neighbours are linked to the smallest of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("low_"))
    moved = down.join(low, "a").select(F.col("b").alias("a"), F.col("low_").alias("b"))
    return moved.union(low.select("a", F.col("low_").alias("b"))).where("a <> b").distinct()


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """(a, b): every node with a link, and the smallest node of its component, itself for the smallest.

    ``links`` has the comparable columns ``a`` and ``b``; loops, both directions and repeats are allowed, links with a null
    are ignored. No links give no rows.
    """
    now = stored(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), label)
    mark = None
    while True:
        before, now = now, stored(small_star(large_star(now)), label)
        discard(before)
        # stars have settled when every smaller end is a root; the sums tell it without a join of two rounds
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(seen) == mark:
            break
        mark = tuple(seen)
    return now.union(now.select(F.col("b").alias("a"), "b").distinct())
