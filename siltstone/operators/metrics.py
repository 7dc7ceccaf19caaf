"""Rates, run comparison and acceptance gates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_OPS = {">=": lambda a, b: a >= b, "<=": lambda a, b: a <= b, "==": lambda a, b: a == b}


def tri_state_rates(rows: DataFrame, by: str, ok: str) -> DataFrame:
    """n_pass, n_fail, total and rate of a nullable boolean; null counts in none, an empty total has no rate."""
    total, passed = F.count(ok), F.count_if(F.col(ok))
    return rows.groupBy(by).agg(passed.alias("n_pass"), F.count_if(~F.col(ok)).alias("n_fail"), total.alias("total"), F.when(total > 0, passed / total).alias("rate"))


def changes(before: DataFrame, after: DataFrame, keys: list[str], ok: str) -> DataFrame:
    """Keys whose outcome differs between two runs, as improvement or regression."""
    b = before.select(*keys, F.col(ok).alias("_before"))
    a = after.select(*keys, F.col(ok).alias("_after"))
    kind = F.when(F.col("_after"), "improvement").otherwise("regression")
    return b.join(a, keys).where("_before <> _after").select(*keys, kind.alias("kind"))


def gates(metrics: DataFrame, limits: dict[str, tuple[str, float]]) -> DataFrame:
    """(gate, value, passed) of a one-row table of metrics; a missing value fails."""
    each = [F.struct(F.lit(k).alias("gate"), F.col(k).cast("double").alias("value"), F.coalesce(_OPS[op](F.col(k), F.lit(x)), F.lit(False)).alias("passed")) for k, (op, x) in limits.items()]
    return metrics.select(F.inline(F.array(*each)))
