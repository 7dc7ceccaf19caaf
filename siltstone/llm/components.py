"""Connected components of a link table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.scratch import Scratch


def components(links: DataFrame, scratch: Scratch, tag: str) -> DataFrame:
    """Rows (node, component) for every node of links (a, b); component is the smallest node reachable.

    Each round is two aggregations with map-side combine and two equi-joins, whose hot keys the
    optimizer may split. The link table never leaves the executors. Empty input gives an empty table.
    """
    edges = scratch.save(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), f"{tag}-0")
    before, step = _state(edges), 0
    while before[0]:
        step += 1
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
        large = both.join(least, both.u == least.k).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), "m")
        small = large.join(least, large.u == least.k)
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("k", "m")).where("u <> v").distinct()
        edges = scratch.save(small.toDF("u", "v"), f"{tag}-{step}")
        after = _state(edges)
        if after == before:
            break
        before = after
    star = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return star.union(edges.select("v", "v")).distinct()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)
