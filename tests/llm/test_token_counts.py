import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest_llm import SF
from siltstone.llm import token_counts as C
from siltstone.llm.packing import vocabulary_path
from siltstone.llm.queries import QUERIES

ODD = [
    "it's", "they'll've", "'re're", "don't've", "'l", "'lx", "'lll", "!'s", "''s", "'s's", "1'2'", "<|endoftext|>x<|startoftext|>", "<|endoftext|>'s", "'<|endoftext|>s",
    "İstanbul", "éé'ŕ", "'š", "日本語テキスト", "한국어", "한ᄀ", "a　b", "ﬁ", "😀👍🏽", "\x85\x1cz", "ΑΣΣ", "a" * 300, "ab" * 150, "....!!!", "12345", "ß", "Å", "̈́x",
]


@pytest.fixture(scope="module")
def counter():
    return C.counter(vocabulary_path())


def direct(counter, text):
    return len(counter.base.encode(text, add_special_tokens=False).ids)


def test_every_prefix(counter):
    for text in ODD:
        got = counter.counts(text)
        for k in range(len(text) + 1) if len(text) < 50 else (0, 1, 77, len(text)):
            assert got[k] == direct(counter, text[:k]), (text, k)


@settings(max_examples=200, deadline=None)
@given(st.text("abeinrstABÄéß'.,!1 \ń　<|>endoftext", max_size=40))
def test_prefixes_of_any_text(text):
    counter = C.counter(vocabulary_path())
    import pyarrow as pa

    steps, off = counter.steps(pa.array([text, None, "x", text]))
    table = C.unpacked(C._packed(steps[off[0] : off[1]]))
    assert table.tolist() == [direct(counter, text[:k]) for k in range(len(text) + 1)]
    assert (steps[off[3] : off[4]] == steps[off[0] : off[1]]).all() and off[1] == off[2]


def test_many_at_once_equals_one_by_one(spark, counter):
    words = sorted({w for r in spark.read.parquet(f"{SF}/documents.parquet").collect() for w in (r.text or "").split()} | {x for x in ODD if "　" not in x})
    words = random.Random(1).sample(words, min(4000, len(words)))
    steps, off, fine = counter._usual(words)
    assert fine.mean() > 0.99
    for k, w in enumerate(words):
        if fine[k]:
            assert [0, *steps[off[k] : off[k + 1]].cumsum().tolist()] == counter.counts(w), w


def test_neighbours_by_trees_as_by_definition(counter):
    import numpy as np

    r, names = random.Random(2), sorted(counter.pairs.tokens)
    ids = counter.base.get_vocab()
    left = [t for t in names if not t.endswith("</w>")]
    pairs = [(r.choice(left), r.choice(names)) for _ in range(3000)] + [(a, b) for a in ["a", "aa", "aaa", "aaaa"] for b in ["a", "aa", "a</w>", "aa</w>"] if a in ids and b in ids]
    got = counter.grid.fit(np.array([ids[a] for a, _ in pairs]), np.array([ids[b] for _, b in pairs]))
    assert got.tolist() == [counter.pairs.fit(a, b) for a, b in pairs]


def test_caches_start_over(counter, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(C, "CACHE", 3)
    text = pa.array(["one two three four five", "one two six seven eight nine", "one two three"])
    for _ in range(3):
        steps, off = counter.steps(text)
        assert [int(steps[a:b].sum()) for a, b in zip(off[:-1], off[1:])] == [direct(counter, t) for t in text.to_pylist()]


def test_edges(spark, make_docs, counter):
    rows = [(k, t) for k, t in enumerate(ODD)] + [(100, None), (101, ""), (102, "word " * 5000), (103, "w" * 30_000), (104, " \t"), (None, "a b"), (7, "other"), (7, "other")]
    got = C.token_counts(make_docs(rows)).collect()
    want = [(i, len((t or "").encode()), direct(counter, t or ""), direct(counter, t or "") > 2048) for i, t in rows]
    assert sorted(map(repr, (tuple(r)[:4] for r in got))) == sorted(map(repr, want))
    assert next(r.keep_chars for r in got if r.doc_id == 102) == 2048 * 5
    assert C.prefix_counts(make_docs([])).count() == 0


def test_questions(spark, make_docs, counter):
    texts = {1: "the quick brown foxes jumped over it's lazydogs " * 20, 2: "", 3: "Überraschungsmoment " * 9, 4: None, 5: "x" * 400}
    docs = make_docs(list(texts.items()))
    table = C.prefix_counts(docs)
    for limit in (0, 1, 7, 30, 10_000):
        for r in table.select("doc_id", C.truncation(limit).alias("k")).collect():
            t = texts[r.doc_id] or ""
            assert r.k == max(k for k in range(len(t) + 1) if direct(counter, t[:k]) <= limit)
    at = [0, 3, 50, -1, 10_000, None]
    for r in table.withColumn("at", F.array(*map(F.lit, at))).select("doc_id", C.counts_at("at").alias("c")).collect():
        t = texts[r.doc_id] or ""
        assert r.c == [None if k is None else direct(counter, t[: max(k, 0)]) for k in at]
    for limit in (1, 5, 40):
        got = {}
        for r in C.chunks(docs, table, limit).orderBy("doc_id", "chunk").collect():
            t = texts[r.doc_id][r.start : r.start + r.n_chars]
            assert direct(counter, t) == r.n_tokens and (r.n_tokens <= limit or len(t.split()) == 1)
            got.setdefault(r.doc_id, []).extend(t.split())
        assert got == {k: t.split() for k, t in texts.items() if t}
    with pytest.raises(ValueError):
        C.truncation(-1)


def test_query(spark, counter):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = QUERIES["op13_tokens"](spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        n = direct(counter, docs[r.doc_id] or "")
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((docs[r.doc_id] or "").encode()), n, n > 2048)
