"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.runtime import cut_lineage


def components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """``node, root`` for every node of ``edges``; the root is the smallest node of the component.

    A step only takes minima per node (combined before the shuffle) and joins them back, so a node with
    very many edges is never gathered. Steps double the reach of the minima; their copies are written
    to the shared folder.
    """
    current = edges.select(
        F.greatest(left, right).alias("u"), F.least(left, right).alias("v")
    ).where("u <> v").distinct()
    current, before = cut_lineage(current), None
    while True:
        both = current.union(current.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        hooked = large.join(smallest, "u")
        small = hooked.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        current = cut_lineage(small.union(smallest.select("u", F.col("m").alias("v"))).distinct())
        state = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
