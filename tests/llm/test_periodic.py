import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest_llm import SF
from siltstone.llm import periodic
from siltstone.llm.queries import QUERIES


def brute(words):
    """Every run by its definition: (start, length, period), periods from the smallest."""
    n, spans = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i + q - s >= max(6, 4 * q):
                spans.setdefault((s, i + q - s), q)
    return sorted((s, n, q) for (s, n), q in spans.items())


def expected(doc_id, text, rewrite=True):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if rewrite and n and doc_id is not None:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    spans = brute(words)
    gone = {i for s, m, q in spans for i in range(s + q, s + m)}
    best = min(spans, key=lambda x: (-x[1], x[0], x[2]), default=(None,) * 3)
    return (
        doc_id, n, len(spans), *best, None if best[0] is None else 1000 * best[1] // best[2],
        hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in spans).encode()).hexdigest(),
        hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in gone).encode()).hexdigest(),
    )


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=70), max_size=4), st.integers(0, 5), st.integers(1, 9))
def test_runs(texts, where, times):
    texts = [t[:where] + t[where:] * times for t in texts]
    rows = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    word = np.array([w for t in texts for w in t], np.uint64)
    row, start, length, period = periodic.runs(word, rows)
    got = [[] for _ in texts]
    for r, s, m, q in zip(row.tolist(), start.tolist(), length.tolist(), period.tolist()):
        got[r].append((s, m, q))
    assert got == [brute(t) for t in texts]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 1), min_size=1, max_size=60), min_size=1, max_size=3), st.randoms())
def test_extensions(texts, rnd):
    word = np.array([w for t in texts for w in t], np.uint64)
    first = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    end = np.repeat(first[1:], np.diff(first))
    lce = periodic.Extension(word, end)
    order = sorted(range(len(word)), key=lambda i: (word[i : end[i]].tolist(), i))
    assert lce.order.tolist() == order
    for _ in range(30):
        k = rnd.randrange(len(texts))
        if len(texts[k]) > 1:
            i, j = rnd.sample(range(int(first[k]), int(first[k + 1])), 2)
            n = next((d for d in range(int(end[i])) if max(i, j) + d >= end[i] or word[i + d] != word[j + d]), 0)
            assert lce.of(np.array([i]), np.array([j])).tolist() == [n]


def test_slices_of_the_grid(monkeypatch):
    monkeypatch.setattr(periodic, "GRID", 7)
    r = random.Random(3)
    text = [r.randrange(3) for _ in range(40)] * 5 + [1] * 30
    row, start, length, period = periodic.runs(np.array(text, np.uint64), np.array([0, len(text)]))
    assert list(zip(start.tolist(), length.tolist(), period.tolist())) == brute(text)


def test_edges(spark, make_docs):
    r = random.Random(5)
    ten = [i for i in range(400) if zlib.crc32(str(i).encode()) % 10 == 0][:25]
    rows = [(i, " ".join(r.choice("abcdefgh") for _ in range(r.randrange(1, 90)))) for i in ten]
    rows += [
        (1000, None), (1001, ""), (1002, " \t\n"), (1003, "a " * 5), (1004, "a " * 6), (1005, "x " + "a b\x0b" * 4), (1006, "a b c\x0c" * 3 + "a b"),
        (1007, "a b c " * 4), (1008, "\x1c \x85 " * 9), (1009, ("lorem ipsum " * 7 + "dolor ") * 9), (1009, "other text"), (1009, "other text"),
        (None, "z " * 50), (1010, "ä ö " * 30), (1011, " ".join(map(str, range(3000))) + " tail" * 3000), (1012, "w" * 100_000),
    ]
    for rewrite in (True, False):
        got = periodic.find_runs(make_docs(rows), rewrite=rewrite).collect()
        plain = [expected(i, t, rewrite) for i, t in rows if i != 1011]
        assert sorted(map(repr, (tuple(r)[:9] for r in got if r.doc_id != 1011))) == sorted(map(repr, plain))
        for g in got:
            assert g.n_runs == len(g.runs)
    assert [(g.start, g.length, g.period) for g in got if g.doc_id == 1011] == [(3000, 3000, 1)]
    assert periodic.find_runs(make_docs([])).count() == 0


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = QUERIES["op12_periodic"](spark, SF).collect()
    short = {r.doc_id for r in docs if len((r.text or "").split()) < 2500}
    want = {r.doc_id: expected(r.doc_id, r.text) for r in docs if r.doc_id in short}
    assert len(got) == len(docs)
    names = ["doc_id", "n_words", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    for r in got:
        if r.doc_id in want:
            assert tuple(r[n] for n in names) == want[r.doc_id]
    assert any(r.n_runs for r in got)
