"""Extra columns that bear the operators' own internal names change no result."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from siltstone.llm import decontaminate, html, minhash, ngram, packing, periodic, quality, rules, substring, token_counts, toxicity, warc, whitening

HERE = Path(rules.__file__).parent
SF = "/root/testdata/sf0.001"
GIVEN = {"doc_id", "text", "lang", "source", "n_chars", "page_id", "url", "html", "item_id", "toxic", "quality", "passage", "vec_id", "embedding"}
NAMES = sorted(set(re.findall(r'(?:alias|withColumn|withColumns|drop|select)\("([a-z_0-9]+)"', "".join(p.read_text() for p in HERE.glob("*.py")))) - GIVEN) + ["a.b", "with space", "tick`s"]


def clashing(table):
    have = {c.lower() for c in table.columns}
    return table.select("*", *(F.lit(f"x{k}").alias(c) for k, c in enumerate(NAMES) if c not in have))


def rows(table, columns=None):
    table = table.select(*columns) if columns else table
    return sorted(map(repr, table.collect()))


@pytest.fixture(scope="module")
def tables(spark):
    read = lambda name: spark.read.parquet(f"{SF}/{name}.parquet")
    return {n: read(n) for n in ("documents", "pages", "labels", "benchmark", "embeddings")}


OPERATORS = {
    "op1": lambda t: minhash.near_duplicates(t["documents"]),
    "op2": lambda t: html.extract(t["pages"]),
    "op3": lambda t: warc.round_trip(t["pages"]),
    "op4": lambda t: substring.remove_repeats(t["documents"]),
    "op5": lambda t: quality.score(t["documents"], t["labels"]),
    "op6": lambda t: rules.apply(t["documents"], t["labels"]),
    "op7": lambda t: decontaminate.overlaps(t["documents"], t["benchmark"]),
    "op8": lambda t: toxicity.score(t["documents"], t["labels"]),
    "op9": lambda t: packing.pack(t["documents"]),
    "op10": lambda t: ngram.score(t["documents"]),
    "op11": lambda t: whitening.whiten(t["embeddings"]),
    "op12": lambda t: periodic.find_runs(t["documents"], rewrite=True),
    "op13": lambda t: token_counts.token_counts(t["documents"]),
}
STAGES = {
    "quality_rules": lambda t: rules.select(t["documents"], t["labels"]),
    "near_dedup": lambda t: minhash.keep_first(t["documents"], threshold_percent=80),
    "substring_dedup": lambda t: substring.cut_repeats(t["documents"]),
    "benchmark_decontamination": lambda t: decontaminate.clean(t["documents"], t["benchmark"]),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_operators(tables, name):
    plain = OPERATORS[name](tables)
    assert rows(OPERATORS[name]({k: clashing(v) for k, v in tables.items()})) == rows(plain)


@pytest.mark.parametrize("name", STAGES)
def test_stages(tables, name):
    given = {k: clashing(v) for k, v in tables.items()}
    got = STAGES[name](given)
    assert got.columns == given["documents"].columns
    assert rows(got, tables["documents"].columns) == rows(STAGES[name](tables))
    extra = [f"`{c.replace('`', '``')}`" for c in NAMES]
    assert got.select(*extra).distinct().count() <= 1
