import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest_llm import SF
from siltstone.llm import packing


def direct(text):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(packing.vocabulary_path())
    return [*t.encode(text or "", add_special_tokens=False).ids, 0]


def check(rows, got, capacity=2048):
    want = Counter()
    for i, text in rows:
        ids = np.array(direct(text), "<u4")
        for k in range(0, len(ids), capacity):
            part = ids[k : k + capacity]
            want[(i, k // capacity, k, len(part), zlib.crc32(part.tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    by = defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for s in by.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by), -(-sum(r.length for r in got) // capacity)


def test_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    used, bound = check([(r.doc_id, r.text) for r in docs.collect()], packing.pack(docs).collect())
    assert used <= bound * 1.02 + 1


def test_edges(spark, make_docs):
    rows = [
        (1, None), (2, ""), (3, "a\x0bb\x0c c d e"), (4, "x<|endoftext|>y <|startoftext|> ABC É it's 123"), (5, "word " * 2047), (6, "word " * 2048),
        (7, "w" * 5000), (8, "tail " * 9000), (None, "a"), (3, "b"), (3, "b"), (9, "ΑΣ ΣΑ ß İ ﬁ é"), (10, "\x1c \x85 \x00 z"),
    ]
    check(rows, packing.pack(make_docs(rows)).collect())
    assert packing.pack(make_docs([])).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 9), min_size=1, max_size=15))
def test_patterns_hold_every_piece(counts):
    left = dict(counts)
    fixed = packing.reduce(left, 40)
    patterns = fixed + packing.best_fit(left, 40)
    held = Counter()
    for many, inside in patterns:
        assert many > 0 and sum(x * k for x, k in inside) <= 40
        for x, k in inside:
            held[x] += many * k
    assert held == Counter(counts)


def least_bins(items, capacity):
    best = [len(items)]

    def go(k, bins):
        if len(bins) >= best[0]:
            return
        if k == len(items):
            best[0] = len(bins)
            return
        for i, room in enumerate(bins):
            if room >= items[k] and room not in bins[:i]:
                go(k + 1, [*bins[:i], room - items[k], *bins[i + 1 :]])
        go(k + 1, [*bins, capacity - items[k]])

    go(0, [])
    return best[0]


@settings(max_examples=120, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=9))
def test_reduction_keeps_the_optimum(items):
    left = dict(Counter(items))
    fixed = sum(n for n, _ in packing.reduce(left, 20))
    rest = sorted((x for x, n in left.items() for _ in range(n)), reverse=True)
    assert fixed + least_bins(rest, 20) == least_bins(sorted(items, reverse=True), 20)


def test_large_histogram_is_fast_and_tight():
    r = np.random.RandomState(5)
    counts = {int(k): int(n) for k, n in zip(range(1, 2048), r.randint(0, 10**6, 2047)) if n}
    total = sum(k * n for k, n in counts.items())
    left = dict(counts)
    patterns = packing.reduce(left, 2048) + packing.best_fit(left, 2048)
    assert sum(n for n, _ in patterns) <= 1.01 * total / 2048
    assert len(packing.slots(patterns)) < 50_000


def test_missing_vocabulary_is_an_error():
    with pytest.raises(Exception):
        packing.WordTokenizer("/nonexistent.json")
