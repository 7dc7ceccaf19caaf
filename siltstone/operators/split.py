"""Deterministic splits, samples and batches."""

from __future__ import annotations

import random
from array import array

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siltstone.scratch import Scratch


def bucket(seed: int, *columns: str, buckets: int = 100) -> Column:
    """A bucket from the first 32 bits of SHA-256 over seed and columns."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.col(c).cast("string") for c in columns])
    return (F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("long") % buckets).cast("int")


def hash_split(rows: DataFrame, group: str, seed: int, train: int = 80, val: int = 10) -> DataFrame:
    """rows with ``split``; rows of one group never part."""
    b = bucket(seed, group)
    return rows.withColumn("split", F.when(b < train, "train").when(b < train + val, "val").otherwise("test"))


def hash_sample(rows: DataFrame, group: str, key: str, n: int, seed: int) -> DataFrame:
    """The n rows of each group that come first by the hash of seed, group and key.

    Groups are first thinned inside salted shares, so that a hot group never meets in one task whole.
    """
    rank = F.sha2(F.concat_ws(":", F.lit(str(seed)), group, F.col(key).cast("string")), 256)
    ranked = rows.withColumn("_rank", rank).withColumn("_salt", F.pmod(F.xxhash64(key), F.lit(64)))
    for by in ([group, "_salt"], [group]):
        ranked = ranked.withColumn("_n", F.row_number().over(Window.partitionBy(*by).orderBy("_rank", key))).where(F.col("_n") <= n)
    return ranked.drop("_rank", "_salt", "_n")


def batches(rows: DataFrame, key: str, size: int, start: int = 0, limit: int | None = None) -> DataFrame:
    """rows from ``start`` on, at most ``limit``, numbered in batches of ``size`` by key order.

    Ranks come from a sort with per-range counts, not from one global window.
    """
    n = "_rank"
    ranked = global_rank(rows, key, n)
    ranked = ranked.where(F.col(n) >= start)
    if limit is not None:
        ranked = ranked.where(F.col(n) < start + limit)
    return ranked.withColumn("batch_index", F.floor((F.col(n) - start) / size)).drop(n)


def global_rank(rows: DataFrame, key: str, name: str) -> DataFrame:
    """rows with their 0-based place by key, of any type that sorts; equal keys come in any order, nulls first.

    Rows are dealt by ranges of the key, sorted inside them and written with their place; the counts of
    the ranges, one number each, shift the places.
    """
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sorted_ = rows.repartitionByRange(parts, key).sortWithinPartitions(key)
    placed = Scratch(spark, "rank").save(sorted_.withColumn("_range", F.spark_partition_id()).withColumn("_place", F.monotonically_increasing_id()), "placed")
    total, shifts = 0, []
    for r in placed.groupBy("_range").agg(F.min("_place").alias("lo"), F.count("*").alias("n")).orderBy("_range").collect():  # one per range
        shifts.append((r["_range"], total - r.lo))
        total += r.n
    table = spark.createDataFrame(shifts, "_range int, _shift long")
    return placed.join(F.broadcast(table), "_range").withColumn(name, F.col("_place") + F.col("_shift")).select(*rows.columns, name)


def shuffled_places(n: int, draw: random.Random) -> array:
    """The place of each of n rows after a shuffle by ``draw``: 16 bytes a row on the driver, of numbers alone."""
    order = array("q", range(n))
    draw.shuffle(order)
    places = array("q", bytes(8 * n))
    for place, row in enumerate(order):
        places[row] = place
    return places


def shuffled(spark: SparkSession, n: int, draw: random.Random, row: str, place: str) -> DataFrame:
    """(row, place) of ``shuffled_places``, to be joined with ranked rows; the rows themselves stay on the executors."""
    return spark.createDataFrame(pd.DataFrame({row: range(n), place: shuffled_places(n, draw)}), f"{row} long, {place} long")


def largest_remainder(groups: DataFrame, size: str, ratios: list[tuple[str, int]]) -> DataFrame:
    """(group columns, split, n_rows): whole shares of ``size`` by percent, leftovers by largest remainder, then order."""
    shares = F.array(*[F.struct(F.lit(k).alias("o"), F.lit(s).alias("split"), F.floor(F.col(size) * r / 100).alias("f"), (F.col(size) * r % 100).alias("rem")) for k, (s, r) in enumerate(ratios)])
    g = groups.withColumn("_s", shares).withColumn("_short", F.col(size) - F.aggregate("_s", F.lit(0).cast("long"), lambda a, x: a + x["f"]))
    ordered = F.transform(F.array_sort(F.transform("_s", lambda x: F.struct((-x["rem"]).alias("r"), x["o"].alias("o"), x["split"].alias("split"), x["f"].alias("f")))), lambda x, i: F.struct(x["split"].alias("split"), (x["f"] + F.when(i < F.col("_short"), 1).otherwise(0)).cast("long").alias("n_rows")))
    return g.withColumn("_o", ordered).select(*groups.columns, F.inline("_o"))
