"""Connected components of a graph given as links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import staged


def _large_star(links: DataFrame) -> DataFrame:
    """Each node's greater neighbours are tied to the least of its neighbours and itself."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """Each node and its lesser neighbours are tied to the least of those."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    tied = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return tied.unionByName(least.select("a", F.col("m").alias("b")))


def components(links: DataFrame) -> DataFrame:
    """``node``, ``root`` (the least node reachable) for every node of ``links`` (``a``, ``b``).

    Every round is written to shared storage, so a lost executor costs one round at most.
    Nodes without links are not listed; loops and repeated links change nothing.
    """
    links, mark = staged(links.filter("a <> b").distinct(), "links"), None
    while True:
        for star in (_large_star, _small_star):
            links = star(links).filter("a <> b").distinct()
        links = staged(links, "links")
        state = tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())
        if state == mark:
            break
        mark = state
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
