"""Priority assembly of answers kept in files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions.variant import Node

# Tiers of answer files, best first, and what in a path makes one; every path is of tier other too.
PRIORITY = ("repaired", "combined", "batch", "other")
MARKERS = {
    "repaired": ("repaired",),
    "combined": ("assembled", "combined", "clean", "merged"),
    "batch": ("batch_", "teacher_answer_returns", "teacher_answer_batches", "answer"),
}


def priority(path: Column, order: tuple[str, ...] = PRIORITY) -> Column:
    """The rank of the first tier in ``order`` that the path belongs to; one more than the last if none."""
    p, out = F.lower(F.replace(path, F.lit("\\"), F.lit("/"))), F.lit(len(order))
    for k in reversed(range(len(order))):
        mine = F.lit(order[k] == "other")
        for marker in MARKERS.get(order[k], ()):
            mine = mine | p.contains(marker)
        out = F.when(mine, k).otherwise(out)
    return out


def tier(path: Column, order: tuple[str, ...] = PRIORITY) -> Column:
    """The name of that tier, other if none."""
    return F.coalesce(F.try_element_at(F.array(*map(F.lit, order)), priority(path, order) + 1), F.lit("other"))


def parse_order(text: str) -> tuple[str, ...]:
    """Tiers from a comma-separated list, each once."""
    found = tuple(dict.fromkeys(x.strip().lower() for x in text.split(",") if x.strip()))
    if not found:
        raise ValueError("name at least one tier")
    return found


def assemble(answers: DataFrame, order: tuple[str, ...] = PRIORITY) -> tuple[DataFrame, DataFrame]:
    """(chosen, others) of answer rows: the best rank of each source_id; the others agree with it or conflict."""
    from siltstone.operators.keys import tag_best

    rows = answers.withColumn("source_id", Node("item")["source_id"].text()).where("source_id IS NOT NULL").withColumn("rank", priority(F.col("file"), order)).withColumn("text", F.to_json("item"))
    tagged = tag_best(rows, "source_id", ["rank", "file", "row_index"]).drop("size")
    best = tagged.where("kept").select("source_id", F.sha2("text", 256).alias("_best"))
    others = tagged.where("NOT kept").join(best, "source_id").withColumn("relation", F.when(F.sha2("text", 256) == F.col("_best"), "identical").otherwise("conflicting"))
    return tagged.where("kept").drop("kept"), others.drop("kept", "_best")
