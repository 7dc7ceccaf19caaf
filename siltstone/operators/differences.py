"""How two candidate answers to one row differ, and whether they speak of the row's mutation."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from siltstone.functions.json_text import masked_text
from siltstone.functions.variant import Node, object_json

# Words of a mutation's description that identify nothing.
STOP_WORDS = (
    "a", "an", "and", "are", "before", "candidate", "change", "changed", "for", "from", "into", "is", "of", "on", "or", "rtl",
    "signal", "signals", "synthetic", "task", "the", "to", "type", "using", "with",
)
NEAR = 0.95
FLAGS = (
    "issue_text", "signal_names", "claim_levels", "evidence_used", "limitations", "patch_provided", "mutation_mention", "mutated_signal_mention",
)


def _present(items: Column) -> Column:
    return F.filter(items, lambda x: x.isNotNull())


def issue_text(answer: Node) -> Column:
    """The issues' texts, trimmed, one a line."""
    texts = F.transform(answer["issue_summary"].items(), lambda x: F.trim(F.try_variant_get(x, "$.issue", "string")))
    return F.array_join(F.filter(texts, lambda x: F.coalesce(F.length(x) > 0, F.lit(False))), "\n")


def signal_names(answer: Node) -> Column:
    """Distinct signal names of all issues, in order."""
    each = F.transform(answer["issue_summary"].items(), lambda x: F.coalesce(F.try_variant_get(x, "$.evidence.signal_names", "array<string>"), F.array().cast("array<string>")))
    return F.array_distinct(_present(F.flatten(each)))


def patch_provided(answer: Node) -> Column:
    """The strict boolean, else null."""
    return F.when(answer["patch"]["provided"].is_true(), True).when(answer["patch"]["provided"].is_false(), False)


def phrases(source_id: Column, summary: Column) -> Column:
    """EXT-19, first part: the id's part after _synthetic_ in words, and the summary, in lower case."""
    after = F.when(F.contains(source_id, F.lit("_synthetic_")), F.substring(source_id, F.locate("_synthetic_", source_id) + 11, F.length(source_id)))
    both = F.array(F.lower(F.trim(F.replace(after, F.lit("_"), F.lit(" ")))), F.lower(F.trim(summary)))
    return F.filter(both, lambda x: F.coalesce(F.length(x) > 0, F.lit(False)))


def terms(found: Column, signals: Column) -> Column:
    """EXT-19, second part: distinct words of the phrases, of four letters or more, that are no stop words and no signals."""
    words = F.flatten(F.transform(found, lambda p: F.regexp_extract_all(p, F.lit("[a-z0-9_]+"), 0)))
    bare = F.array_distinct(F.transform(words, lambda w: F.regexp_replace(w, "^_+|_+$", "")))
    lowered = F.transform(F.coalesce(signals, F.array().cast("array<string>")), F.lower)
    return F.filter(bare, lambda w: (F.length(w) >= 4) & ~w.isin(*STOP_WORDS) & ~F.array_contains(lowered, w))


def mentions_mutation(answer: Node, found: Column, words: Column) -> Column:
    """EXT-20: a whole phrase, or two of the words (the only one, if there is one)."""
    text = F.lower(object_json(F.map_filter(answer.fields(), lambda k, v: k != "source_id")))
    n = F.size(F.filter(words, lambda w: text.contains(w)))
    return F.exists(found, lambda p: text.contains(p)) | ((F.size(words) > 0) & (n >= F.least(F.lit(2), F.size(words))))


def mentions_signals(answer: Node, signals: Column) -> Column:
    """EXT-21: any mutated signal, as a part of the text."""
    text = F.lower(answer.json())
    return F.coalesce(F.exists(signals, lambda s: text.contains(F.lower(s))), F.lit(False))


@F.pandas_udf(BooleanType())
def near(a: pd.Series, b: pd.Series) -> pd.Series:
    """Whether two texts match to ``NEAR``; the cheap bounds are asked first."""

    def one(x, y):
        s = SequenceMatcher(None, x, y)
        return s.real_quick_ratio() >= NEAR and s.quick_ratio() >= NEAR and s.ratio() >= NEAR

    return pd.Series([x == y or one(x, y) for x, y in zip(a, b)])


def row_differences(rows: DataFrame, a: DataFrame, b: DataFrame) -> DataFrame:
    """DUP-11 for ids in all three: rows (id, v), a and b (id, answer).

    Eight flags of what changed, their sum, and whether the answers are equal, or nearly so when masked.
    """
    d = rows.select("id", "v").join(a.select("id", F.col("answer").alias("a")), "id").join(b.select("id", F.col("answer").alias("b")), "id")
    task = Node("v")["messages"][1]["content"]
    source = F.coalesce(task["source_id"].text(), Node("v")["source_id"].text(), F.col("id"))
    signals = F.when(task["mutated_signal_names"].is_list(), task["mutated_signal_names"].strings())
    d = d.withColumn("_phrases", phrases(source, task["mutation_summary"].text())).withColumn("_signals", signals).withColumn("_terms", terms(F.col("_phrases"), F.col("_signals")))
    x, y = Node("a"), Node("b")
    typed = lambda n, f, test, other: F.when(getattr(n[f], test)(), n[f].json()).otherwise(other)
    mention = lambda n: mentions_mutation(n, F.col("_phrases"), F.col("_terms"))
    spoken = lambda n: mentions_signals(n, F.col("_signals"))
    changed = {
        "issue_text": issue_text(x) != issue_text(y),
        "signal_names": signal_names(x) != signal_names(y),
        "claim_levels": typed(x, "claim_levels", "is_object", "{}") != typed(y, "claim_levels", "is_object", "{}"),
        "evidence_used": typed(x, "evidence_used", "is_list", "[]") != typed(y, "evidence_used", "is_list", "[]"),
        "limitations": typed(x, "limitations", "is_list", "[]") != typed(y, "limitations", "is_list", "[]"),
        "patch_provided": ~patch_provided(x).eqNullSafe(patch_provided(y)),
        "mutation_mention": mention(x) != mention(y),
        "mutated_signal_mention": spoken(x) != spoken(y),
    }
    d = d.withColumns({f"{k}_changed": c for k, c in changed.items()}).withColumns({"mentions_mutation_a": mention(x), "mentions_mutation_b": mention(y), "mentions_signals_a": spoken(x), "mentions_signals_b": spoken(y)})
    d = d.withColumn("difference_score", sum((F.col(f"{k}_changed").cast("int") for k in FLAGS), F.lit(0)))
    d = d.withColumn("exact_same", F.to_json("a") == F.to_json("b")).withColumn("near_duplicate", near(masked_text(F.to_json("a")), masked_text(F.to_json("b"))))
    return d.drop("v", "a", "b", "_phrases", "_signals", "_terms")


def inspect(rows: DataFrame, a: DataFrame, b: DataFrame) -> dict[str, DataFrame]:
    """JOIN-10: differences of the shared ids, and the ids that a side misses or has beside."""
    ids = rows.select("id")
    out = {"differences": row_differences(rows, a, b)}
    for name, side in (("a", a), ("b", b)):
        out[f"missing_in_{name}"] = ids.join(side.select("id"), "id", "left_anti")
        out[f"extra_in_{name}"] = side.select("id").join(ids, "id", "left_anti")
    return out


def exact_groups(candidates: DataFrame) -> DataFrame:
    """(n, ids) of answers given more than once, the largest group first."""
    g = candidates.groupBy(F.sha2(F.to_json("answer"), 256).alias("fp")).agg(F.count("*").alias("n"), F.sort_array(F.collect_list("id")).alias("ids"))
    return g.where("n > 1").orderBy(F.desc("n"), "ids").drop("fp")


def near_answers(candidates: DataFrame) -> DataFrame:
    """DUP-7: pairs of (ord, id, answer), earlier first, whose masked texts match to ``NEAR``."""
    from siltstone.operators.near import near_pairs

    texts = candidates.select("ord", masked_text(F.to_json("answer")).alias("t"))
    names = candidates.select("ord", "id")
    p = near_pairs(texts, "ord", "t", NEAR)
    p = p.join(names.select(F.col("ord").alias("left_id"), F.col("id").alias("left")), "left_id").join(names.select(F.col("ord").alias("right_id"), F.col("id").alias("right")), "right_id")
    return p.select("left", "right", F.round("ratio", 6).alias("similarity")).orderBy(F.desc("similarity"), "left", "right")
