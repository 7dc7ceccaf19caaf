"""Composition of a dataset: counts by field, claim levels, missing checks, duplicate ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone import vocab as V
from siltstone.functions.variant import Node
from siltstone.operators.keys import duplicate_keys

FIELDS = ("split", "source", "task_family", "design_family", "review_status")
MISSING = "missing"


def counts(rows: DataFrame, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """AGG-1 and AGG-2: (field, value, n), all fields in one pass."""
    v = Node("v")
    each = F.array(*[F.struct(F.lit(f).alias("field"), F.coalesce(v[f].text(), F.lit(MISSING)).alias("value")) for f in fields])
    return rows.select(F.inline(each)).groupBy("field", "value").agg(F.count("*").alias("n"))


def claim_levels(rows: DataFrame) -> DataFrame:
    """(domain, level, n), with "missing" where a row has none."""
    levels = Node("v")["messages"][2]["content"]["claim_levels"]
    each = F.array(*[F.struct(F.lit(d).alias("domain"), F.coalesce(levels[d].text(), F.lit(MISSING)).alias("level")) for d in V.CLAIM_DOMAINS])
    return rows.select(F.inline(each)).groupBy("domain", "level").agg(F.count("*").alias("n"))


def missing_checks(rows: DataFrame) -> DataFrame:
    """(tool, n): rows whose check of the tool is null or absent."""
    checks = Node("v")["tool_checks"]
    each = F.array(*[F.struct(F.lit(t).alias("tool"), checks[t].nonempty().alias("ok")) for t in V.TOOLS])
    return rows.select(F.inline(each)).groupBy("tool").agg(F.count_if(~F.col("ok")).alias("n"))


def inspect(rows: DataFrame) -> dict[str, DataFrame]:
    ids = rows.select(Node("v")["id"].text().alias("id")).where("id IS NOT NULL")
    return {"counts": counts(rows), "claim_levels": claim_levels(rows), "missing_checks": missing_checks(rows), "duplicate_ids": duplicate_keys(ids, "id")}
