"""Connected components of a link table by alternating large and small stars.

Each round keeps the components and pulls every node towards the smallest
node it can see; the rounds grow with the logarithm of the longest chain.
All tables are written between steps and no link or label reaches the driver
(only a row count and a checksum do). Minima are joined back through written
tables, so both sides of each join are plain exchanges that AQE can split
when one node holds most links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqprep.llm.common import written


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = written(both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low")), "low")
    return both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    # links point from the larger node a to the smaller node b
    low = written(links.groupBy("a").agg(F.min("b").alias("low")), "low")
    moved = links.join(low, "a").filter("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.unionByName(low.select("a", F.col("low").alias("b"))).distinct()


def _mark(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected_components(links: DataFrame) -> DataFrame:
    """``node, root`` (the smallest node of its component) for every node of
    ``links`` (columns ``a``, ``b``; any direction, repeats and loops allowed)."""
    links = written(
        links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    mark = _mark(links)
    while mark[0]:
        links = written(_large_star(links), "links")
        links = written(_small_star(links), "links")
        now = _mark(links)
        if now == mark:
            break
        mark = now
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return roots.unionByName(links.select(F.col("a").alias("node"), F.col("b").alias("root")))
