import random
from itertools import combinations
from math import comb

import numpy as np
import pytest

from conftest_llm import SF
from siltstone.llm import decontaminate as D


def fixture():
    r = random.Random(3)
    words = [f"w{k}" for k in range(5000)]
    say = lambda n: [r.choice(words) for _ in range(n)]
    items = [(i, say(n)) for i, n in enumerate([14, 20, 37, 59, 5, 40, 30])]
    docs, want = [], set()
    for k in range(60):
        body = say(120)
        if k % 3 == 0:
            i, words_of = items[k // 3 % len(items)]
            leak = list(words_of)
            if k % 2 and len(leak) >= 30:  # one in ten words replaced
                for j in range(3, len(leak), 10):
                    leak[j] = "sub"
            if k % 4 == 0 and len(leak) >= 30:  # a word lost and one gained
                del leak[15]
                leak.insert(5, "ins")
            at = r.randrange(100)
            body[at:at] = [w.upper() + "," for w in leak]
            want.add((k, i))
        docs.append((k, " ".join(body)))
    return items, docs, want


def test_planted_leaks_are_found_and_nothing_else(spark, make_docs):
    items, docs, want = fixture()
    table = spark.createDataFrame([(i, " ".join(w), 1) for i, w in items], "item_id long, text string, doc_id long")
    got = D.overlaps(make_docs(docs), table).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want
    kept = D.clean(make_docs([*docs, (None, None)]), table)
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in docs} - {i for i, _ in want} | {None}
    assert "extra" in kept.columns


def test_partial_overlap_needs_enough_tokens(spark, make_docs):
    item = [f"t{i}" for i in range(40)]
    table = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    rows = [(1, "x " * 20 + " ".join(item[5:20]) + " y" * 20), (2, "x " * 20 + " ".join(item[5:15]) + " y" * 20), (3, None), (4, " ".join(item) * 1), (5, "z " * 50000 + " ".join(item))]
    assert {r.doc_id for r in D.overlaps(make_docs(rows), table).collect()} == {1, 4, 5}


@pytest.mark.parametrize("n", range(1, 17))
def test_masks_hit_every_overlap_that_verification_takes(n):
    item = [f"t{i}" for i in range(n)]
    index, taken = D.Index([1], [" ".join(item)]), 0
    for size in range(4):
        for wrong in combinations(range(n), size):
            w = D.T.words(D.pa.array([" ".join("x" if i in wrong else t for i, t in enumerate(item))]), lower=True, spans=False, alphanumeric=True)
            if D.verify(index, w, 0, 0, np.array([0])):
                taken += 1
                assert [0, 0, 0] in index.hits(w, D.seeds_of(w, index.masks)).tolist(), wrong
    assert n > 12 and taken or taken == sum(comb(max(n - 2, 0), k) for k in range(n // 5 + 1))


def test_masks_hit_every_window_with_two_differing_tokens():
    for wrong in combinations(range(D.SPAN), 2):
        assert any(all(c == "0" or at + i not in wrong for i, c in enumerate(m)) for m in D.MASKS for at in range(D.SPAN - len(m) + 1)), wrong


def test_every_fifth_word_and_short_items(spark, make_docs):
    items, docs, want = [], [], set()
    for n in (20, 30, 60, 100):
        for phase in range(5):
            k = 10 * n + phase
            item = [f"i{k}w{j}" for j in range(n)]
            items.append((k, " ".join(item)))
            docs.append((k, "a b c " + " ".join("sub" if j % 5 == phase else t for j, t in enumerate(item)) + " d e f"))
            want.add((k, k))
    for n in range(5, 12):
        for at in range(1, n - 1):
            k = 5000 + 100 * n + at
            item = [f"i{k}w{j}" for j in range(n)]
            items.append((k, " ".join(item)))
            docs.append((k, "a b c " + " ".join("sub" if j == at else t for j, t in enumerate(item)) + " d e f"))
            want.add((k, k))
    table = spark.createDataFrame(items, "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in D.overlaps(make_docs(docs), table).collect()} == want


def test_blocks_give_the_same_result(spark, make_docs, monkeypatch):
    items, docs, want = fixture()
    table = spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")
    monkeypatch.setattr(D, "INDEX", 300)
    assert {(r.doc_id, r.item_id) for r in D.overlaps(make_docs(docs), table).collect()} == want


def test_table_contains_verbatim_passages(spark):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    got = {(r.doc_id, r.item_id) for r in D.overlaps(docs, items).collect()}
    texts = items.collect()
    want = {(d.doc_id, i.item_id) for d in docs.collect() for i in texts if d.text and i.text in d.text}
    assert want and want <= got
    assert len(got) <= len(want) + 3


def brute(docs, items):
    """Every diagonal of every document and item, place by place."""
    import re

    tokens = lambda t: [x for x in re.split(r"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")) if x]
    out = set()
    for doc, text in docs:
        words = tokens(text)
        for item, wanted in items:
            sought = tokens(wanted)
            if not sought or not words:
                continue
            least, need, places = min(12, len(sought)), min(13, len(sought)), []
            for d in range(-len(sought), len(words)):
                at = [i for i in range(len(sought)) if 0 <= i + d < len(words)]
                same = {i for i in at if words[i + d] == sought[i]}
                inside = set()
                for i in at:
                    window = range(i, i + least)
                    if i + least - 1 <= at[-1] and sum(j in same for j in window) >= 0.8 * least:
                        inside |= set(window)
                if inside & same:
                    places.append((d, sorted(inside & same)))
            best, k = None, 0
            while k < len(places):
                group = [places[k]]
                while k + 1 < len(places) and places[k + 1][0] - places[k][0] <= len(sought):
                    k += 1
                    group.append(places[k])
                k += 1
                n = len({i for _, at in group for i in at})
                lo, hi = min(d + at[0] for d, at in group), max(d + at[-1] + 1 for d, at in group)
                if n >= 0.8 * need and (n >= need or hi - lo >= need) and (best is None or n > best[0]):
                    best = n, lo, hi
            if best:
                out.add((doc, item, best[0], len(sought), best[1], best[2]))
    return out


def test_equals_all_diagonals(spark, make_docs):
    r = random.Random(11)
    say = lambda n, k: [f"w{r.randrange(k)}" for _ in range(n)]
    items = [(i, say(n, 400)) for i, n in enumerate([1, 2, 4, 5, 7, 9, 10, 11, 12, 13, 18, 30, 64])] + [(50, say(15, 2)), (51, ["a"] * 20)]
    docs = []
    for k in range(60):
        body = say(50, 400)
        for i, item in r.sample(items, 2):
            leak = [w if r.random() > 0.12 else "sub" for w in item]
            if r.random() < 0.3:
                leak = leak[r.randrange(len(leak)) :]
            at = r.randrange(len(body))
            body[at:at] = leak
        docs.append((k, " ".join(body)))
    docs += [(100, "a " * 50), (101, "w0 w1 " * 30), (102, ""), (103, None), (None, docs[0][1]), (104, docs[1][1]), (104, docs[1][1] + " x")]
    texts = [(i, " ".join(w)) for i, w in items]
    table = spark.createDataFrame(texts, "item_id long, text string")
    got = [tuple(x)[:6] for x in D.overlaps(make_docs(docs), table).collect()]
    assert set(got) == brute(docs, texts) and any(x[0] is None for x in got)


@pytest.mark.parametrize("index", [2_000_000, 40, 300])
def test_items_without_a_token_and_blocks_of_any_size(spark, make_docs, monkeypatch, index):
    monkeypatch.setattr(D, "INDEX", index)
    schema = "item_id long, text string"
    long_ = " ".join(f"q{i}" for i in range(200))
    docs = make_docs([(1, "x " + long_ + " y"), (2, "!!!"), (3, ""), (4, "one two three four five six")])
    for texts in ([""], ["!!!"], ["", "!!!", " \t", None]):
        assert D.overlaps(docs, spark.createDataFrame(list(enumerate(texts)), schema)).count() == 0
    some = spark.createDataFrame([(1, long_), (2, ""), (3, "!!!"), (4, "one two three four five six"), (None, long_), (5, None)], schema)
    got = {(r.doc_id, r.item_id, r.n_matched) for r in D.overlaps(docs, some).collect()}
    assert got == {(1, 1, 200), (1, None, 200), (4, 4, 6)}
    assert D.clean(docs, some).count() == 2


def test_slices_of_hits(spark, make_docs, monkeypatch):
    items, docs = [(1, "a " * 40), (2, "a b " * 20)], [(k, "a " * 90 + "a b " * 50) for k in range(3)]
    table = spark.createDataFrame(items, "item_id long, text string")
    before = {tuple(r) for r in D.overlaps(make_docs(docs), table).collect()}
    w = D.T.words(D.pa.array([t for _, t in docs]), lower=True, spans=False, alphanumeric=True)
    index = D.Index([1, 2], [t for _, t in items])
    whole = index.hits(w, D.seeds_of(w, index.masks))
    monkeypatch.setattr(D, "HITS", 50)
    assert index.hits(w, D.seeds_of(w, index.masks)).tolist() == whole.tolist() and len(before) == 6


def test_empty(spark, make_docs):
    items = spark.createDataFrame([(1, None)], "item_id long, text string")
    assert D.overlaps(make_docs([(1, "a b")]), items).count() == 0
    assert D.overlaps(make_docs([]), items).count() == 0
