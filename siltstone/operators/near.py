"""Near-duplicate texts by the matching-blocks ratio, which is asymmetric: the earlier row is first.

A ratio of r means that the blocks that match, and so a common subsequence, hold at least r * T / 2 of the T
letters of both texts. The rest are deletions and insertions, and one such edit takes at most Q of the distinct
runs of Q letters out of a text. A text of n letters therefore shares all but D(n) of its runs with any partner, and
among its D(n) + 1 rarest runs, one is among the rarest of the partner: only these are joined.
"""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siltstone.scratch import Scratch

SCHEMA = "left_id long, right_id long, ratio double"
TEXTS = "left_rep long, right_rep long, ratio double, back double"


def ratio(a: str, b: str) -> float:
    return SequenceMatcher(None, a, b).ratio()


def run_length(least: float) -> int:
    """Letters of a run: the longest of which fewer than four in five may go."""
    for q in (4, 3, 2):
        if max(q * (1 - least / (2 - least)), (q - 1) * ((2 - least) / least - 1)) < 0.8:
            return q
    return 1


def most_lost(n: Column, least: float, q: int) -> Column:
    """D(n): the most runs of a text of n letters that a partner may lack; linear in the partner's length, so its largest at an end."""
    at = lambda m: n * q + m * (q - 1) - (n + m) * (2 * q - 1) * least / 2
    return F.floor(F.greatest(at(n * least / (2 - least)), at(n * (2 - least) / least)) + 1e-6)


def first_pair(least: float) -> int:
    """The least total length of two different texts whose ratio can reach ``least``."""
    t = 1
    while t < 10_000 and 2 * ((t - 1) // 2) < least * t - 1e-9:
        t += 1
    return t


def near_texts(rows: DataFrame, key: str, text: str, least: float) -> tuple[DataFrame, DataFrame]:
    """(members, pairs). members: (id, rep), each row's class of equal texts, by its smallest id. pairs: different texts
    (left_rep < right_rep) with the ``ratio`` in this order and ``back`` in the other, where either reaches ``least``.

    Ids are unique; null texts are in no class. Rows of one text never meet each other, so a text that
    a third of the rows share costs no more than one. Texts of which no run need be kept (a few letters, or the
    same over and over) are compared with all of a length that fits.
    """
    if not 0 < least <= 1:
        raise ValueError("least must be above 0 and at most 1")
    scratch = Scratch(rows.sparkSession, "near")
    q = run_length(least)
    d = rows.where(F.col(text).isNotNull()).select(F.col(key).cast("long").alias("id"), F.col(text).alias("t"), F.sha2(text, 256).alias("fp"))
    classes = d.groupBy("fp").agg(F.min("id").alias("rep"), F.count("*").alias("size"))
    members = scratch.save(d.select("id", "fp").join(classes, "fp").select("id", "rep", "size"), "members")
    reps = members.where("id = rep").select("id", F.col("size").alias("many"))
    texts = d.select("id", "t").join(reps, "id")
    letters = F.split("t", "")
    parts = F.when(F.size("w") >= q, F.sequence(F.lit(1), F.size("w") - (q - 1)))
    runs = F.coalesce(F.array_distinct(F.transform(parts, lambda i: F.xxhash64(F.slice("w", i, q)))), F.array().cast("array<bigint>"))
    texts = texts.withColumn("n", F.length("t")).withColumn("w", letters).withColumn("runs", runs).drop("w")
    texts = texts.withColumn("lost", most_lost(F.col("n"), least, q)).where(F.col("n") * 2 / least >= first_pair(least))
    texts = scratch.save(texts, "texts")
    bare = F.size("runs") <= F.col("lost")
    each = texts.where(~bare).select("id", "n", "lost", F.explode("runs").alias("h"))
    often = each.groupBy("h").agg(F.count("*").alias("often")).where("often > 1")  # a run of one text finds no partner, but counts among its rarest
    ranked = each.join(often, "h", "left").withColumn("k", F.row_number().over(Window.partitionBy("id").orderBy(F.coalesce("often", F.lit(1)), "h")))
    rare = scratch.save(ranked.where("k <= lost + 1 AND often IS NOT NULL").select("h", "id", "n"), "rare")
    x, y = rare.toDF("h", "a", "n"), rare.toDF("h", "b", "m")
    fits = 2 * F.least("n", "m") >= least * (F.col("n") + F.col("m")) - 1e-9
    pairs = x.join(y, "h").where((F.col("a") < F.col("b")) & fits).select("a", "b").distinct()
    if texts.where(bare).limit(1).count():
        pairs = pairs.union(_banded(texts.where(bare).select("id", "n"), texts.select("id", "n"), least)).distinct()
    told = texts.select("id", "t", "many")
    pairs = pairs.join(told.toDF("a", "x", "many_a"), "a").join(told.toDF("b", "y", "many_b"), "b")

    def check(batches):
        for p in batches:
            kept = []
            for a, b, x, y, many in zip(p.a, p.b, p.x, p.y, (p.many_a > 1) | (p.many_b > 1)):
                s = SequenceMatcher(None, x, y)
                if s.quick_ratio() >= least:
                    forth = s.ratio()
                    back = ratio(y, x) if many else None
                    if forth >= least or (back or 0) >= least:
                        kept.append((a, b, forth, back))
            yield pd.DataFrame(kept, columns=["left_rep", "right_rep", "ratio", "back"])

    return members.select("id", "rep"), scratch.save(pairs.mapInPandas(check, TEXTS), "pairs")


def _banded(few: DataFrame, all_: DataFrame, least: float) -> DataFrame:
    """(a, b), a < b, of few x all whose lengths fit; bands of lengths on a logarithmic scale are the keys."""
    import math

    step = -math.log(least / (2 - least)) or 1e-9  # lengths of a pair differ by this factor at most
    band = F.floor(F.log(F.greatest("n", F.lit(1))) / step)
    x = few.select("id", "n", F.explode(F.array(band - 1, band, band + 1)).alias("band")).toDF("u", "n", "band")
    y = all_.select("id", "n", band.alias("band")).toDF("v", "m", "band")
    fits = 2 * F.least("n", "m") >= least * (F.col("n") + F.col("m")) - 1e-9
    return x.join(y, "band").where((F.col("u") != F.col("v")) & fits).select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")).distinct()


def near_pairs(rows: DataFrame, key: str, text: str, least: float) -> DataFrame:
    """(left_id, right_id, ratio) of pairs of rows, smaller id first, whose ratio reaches ``least``.

    ``near_texts``, with the copies of each text written out: as many rows as there are such pairs.
    """
    members, pairs = near_texts(rows, key, text, least)
    left, right = members.toDF("i", "left_rep"), members.toDF("j", "right_rep")
    met = pairs.join(left, "left_rep").join(right, "right_rep")
    forth = F.col("i") < F.col("j")
    found = met.select(F.least("i", "j").alias("left_id"), F.greatest("i", "j").alias("right_id"), F.when(forth, F.col("ratio")).otherwise(F.col("back")).alias("ratio")).where(F.col("ratio") >= least)
    same = members.toDF("left_id", "rep").join(members.toDF("right_id", "rep"), "rep").where("left_id < right_id").select("left_id", "right_id", F.lit(1.0).alias("ratio"))
    return found.union(same)
