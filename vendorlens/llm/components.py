"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vendorlens.llm.common import stored


def _is_settled(edges: DataFrame) -> bool:
    """Whether every node hangs on one smaller node that hangs on none."""
    ends = edges.select(F.col("u").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select("v", F.lit(0), F.lit(1)))
    odd = ends.groupBy("n").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 OR up + down > 1")
    return odd.isEmpty()


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, for every node of ``links`` (u, v).

    Each round groups by node with a minimum (combined before the shuffle) and joins it
    back; rounds grow with the logarithm of the number of nodes. Nothing but whether the
    edges are settled reaches the driver.
    """
    edges = stored(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    while not _is_settled(edges):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        edges = stored(small.union(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
