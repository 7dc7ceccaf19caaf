"""Keyed row sets: reconciliation, first wins, best wins, what is still to do."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def reconcile(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """(key, status): matched, missing (left only) or extra (right only). Keys count once."""
    a = left.select(key).distinct().withColumn("_l", F.lit(1))
    b = right.select(key).distinct().withColumn("_r", F.lit(1))
    status = F.when(F.col("_r").isNull(), "missing").when(F.col("_l").isNull(), "extra").otherwise("matched")
    return a.join(b, key, "full_outer").select(key, status.alias("status"))


def first_wins(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The first row of each key, with columns of any type. An aggregate with map-side combine, so a hot key stays small."""
    best = rows.groupBy(F.col(key).alias("_key")).agg(F.min_by(F.struct(*rows.columns), F.struct(*order)).alias("_row"))
    return best.select("_row.*")


def place_number(file_ord: str, line: str) -> Column:
    """A row's place among all files as one number, so that aggregates over it need no sort: up to 2**23 files of 2**40 lines."""
    return F.shiftleft(F.col(file_ord).cast("long"), 40) + F.col(line)


def first_seen(rows: DataFrame, kinds: dict[str, str], place: Column, extra: list[str]) -> DataFrame:
    """rows with, for each kind of key that also occurs in another row: ``<kind>_first``, the least place that has it, and that row's ``extra`` columns.

    One aggregation over (kind, key) pairs with numbers for buffers; only keys that repeat go on, and are
    joined to the rows. Null keys repeat nothing. ``place`` tells rows apart.
    """
    each = F.array(*[F.struct(F.lit(kind).alias("_kind"), F.col(c).alias("_key")) for kind, c in kinds.items()])
    keyed = rows.select(place.alias("_place"), F.inline(each)).where("_key IS NOT NULL")
    firsts = keyed.groupBy("_kind", "_key").agg(F.min("_place").alias("_first"), F.count("*").alias("_n")).where("_n > 1").drop("_n")
    told = rows.select(place.alias("_place"), *[F.col(c).alias(f"_x_{c}") for c in extra])
    firsts = firsts.join(told, F.col("_first") == F.col("_place")).drop("_place")
    out = rows
    for kind, c in kinds.items():
        mine = firsts.where(F.col("_kind") == kind).select(F.col("_key").alias(f"_{kind}"), F.col("_first").alias(f"{kind}_first"), *[F.col(f"_x_{x}").alias(f"{kind}_{x}") for x in extra])
        out = out.join(mine, out[c] == mine[f"_{kind}"], "left").drop(f"_{kind}")
    return out


def duplicate_keys(rows: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their number."""
    return rows.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")


def tag_best(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """rows with ``size`` of their group and whether they are ``kept``: the least by ``order``.

    The best of each key comes from an aggregate and is joined back, where a hot key can be split.
    """
    best = rows.groupBy(key).agg(F.min(F.struct(*order)).alias("_best"), F.count("*").alias("size"))
    best = best.withColumnRenamed(key, "_key")
    joined = rows.join(best, rows[key].eqNullSafe(best["_key"]))
    return joined.withColumn("kept", F.struct(*order) == F.col("_best")).drop("_best", "_key")


def pending(selected: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Selected rows whose key is not done yet."""
    return selected.join(done.select(key).distinct(), key, "left_anti")
