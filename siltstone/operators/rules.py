"""Rules as data: a list of conditions evaluated in one scan into a table of violations."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass
class Rule:
    """A condition that reports a problem. ``guard``: the rule applies only where it holds."""

    rule: str
    field: str
    severity: str
    when: Column
    message: Column | str | None = None
    guard: Column | None = None


def found(rules: list[Rule]) -> Column:
    """The problems of a row, in the rules' order: an array of (rule, field, severity, message, ord)."""
    each = []
    for k, r in enumerate(rules):
        when = r.when if r.guard is None else F.coalesce(r.guard, F.lit(False)) & r.when
        message = r.message if isinstance(r.message, Column) else F.lit(r.message or r.rule)
        each.append(F.when(when, F.struct(F.lit(r.rule).alias("rule"), F.lit(r.field).alias("field"), F.lit(r.severity).alias("severity"), message.alias("message"), F.lit(k).alias("ord"))))
    return F.filter(F.array(*each), lambda x: x.isNotNull())


def violations(rows: DataFrame, rules: list[Rule], keys: list[str]) -> DataFrame:
    """One row per problem: the keys, rule, field, severity, message and the rule's place ``ord``.

    All rules are evaluated in one projection; a condition that is null reports nothing.
    """
    return rows.select(*keys, F.explode(found(rules)).alias("v")).select(*keys, "v.*")


def gate(rows: DataFrame, rules: list[Rule]) -> DataFrame:
    """rows with ``problems`` (rule names that report an error) and ``accepted``."""
    names = [F.when(r.when if r.guard is None else F.coalesce(r.guard, F.lit(False)) & r.when, F.lit(r.rule)) for r in rules if r.severity == "error"]
    out = rows.withColumn("problems", F.filter(F.array(*names) if names else F.array().cast("array<string>"), lambda x: x.isNotNull()))
    return out.withColumn("accepted", F.size("problems") == 0)
