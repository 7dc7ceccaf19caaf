import re
import zlib
from collections import Counter, defaultdict
from math import log10

import numpy as np
import pyarrow as pa
import pytest

from conftest_llm import SF
from siltstone.llm import _exchange as X
from siltstone.llm import ngram

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def tokens(text):
    return [*WORD.findall(lower(text)), None]


def brute(rows):
    train = [tokens(t) for i, t in rows if i is not None and zlib.crc32(str(i).encode()) % 7 != 2]
    count = Counter(w for t in train for w in t)
    pairs = Counter(p for t in train for p in zip(["<s>", *t], t))
    total, vocabulary = sum(count.values()), len(count)
    contexts, follows = defaultdict(Counter), Counter()
    for (a, b), c in pairs.items():
        contexts[a][b] = c
        follows[b] += 1
    of = lambda values: [sum(v == k for v in values) for k in (1, 2, 3, 4)]
    upper, low = ngram.discounts(of(pairs.values())), ngram.discounts(of(follows.values()))
    less = lambda c, d: max(c - (0, *d)[min(c, 3)], 0)
    spare = sum((0, *low)[min(n, 3)] for n in follows.values()) / len(pairs) if pairs else 1

    def one(w):
        return less(follows[w], low) / max(len(pairs), 1) + spare / (vocabulary + 1)

    def p(a, w):
        if a not in contexts:
            return one(w)
        c = sum(contexts[a].values())
        weight = sum((0, *upper)[min(x, 3)] for x in contexts[a].values()) / c
        return less(contexts[a][w], upper) / c + weight * one(w)

    out = []
    for i, t in rows:
        t = tokens(t)
        held = i is not None and zlib.crc32(str(i).encode()) % 7 == 2
        base = sum(log10((count[w] + 1) / (total + 1 * (vocabulary + 1))) for w in t)
        out.append((i, held, len(t), sum(count[w] > 0 for w in t), total, base, sum(log10(p(a, w)) for a, w in zip(["<s>", *t], t))))
    if train:
        for a in list(contexts)[:50]:
            mass = sum(p(a, w) for w in count) + p(a, "never seen")
            assert mass == pytest.approx(1, abs=1e-9)
    return out


def same(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[6])
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    np.testing.assert_allclose([g[5:] for g in got], [w[5:] for w in want], rtol=1e-9)


def test_table_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = ngram.score(docs).collect()
    same(got, brute([(r.doc_id, r.text) for r in docs.collect()]))
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_edges(spark, make_docs):
    rows = [(1, None), (2, ""), (3, "A a A a B"), (3, "A a A a B"), (None, "a b"), (4, " x\x0by\x0c z "), (5, "the " * 5000), (6, "the cat " * 3), (17, "É é")]
    same(ngram.score(make_docs(rows)).collect(), brute(rows))
    assert ngram.score(make_docs([])).count() == 0


def test_pack_round_trip():
    a = np.array([3, 3, 9], np.uint64)
    b = np.array([1, 2, 2**63 + 5], np.uint64)
    c = np.array([1, 300, 255])
    for x, y in zip(X.unpack(X.pack(a, b, c)), (a, b, c)):
        assert (x == y).all()
    x, none, z = X.unpack(X.pack(a[1:], None, c[1:]))
    assert none is None and (x == a[1:]).all() and (z == c[1:]).all()


def test_sender_splits_and_merges():
    r = np.random.RandomState(1)
    a = r.randint(0, 500, 20_000).astype(np.uint64) << np.uint64(50)
    b = r.randint(0, 9, 20_000).astype(np.uint64)
    send, batches = X.Sender(4, True, most=1000), []
    for i in range(0, len(a), 700):
        batches += send.add(a[i : i + 700], b[i : i + 700])
    batches += send.flush()
    got = Counter()
    for p in range(4):
        mine = [x.filter(pa.array(np.asarray(x.column("part")) == p)) for x in batches]
        for part, (x, y, n) in X.received(mine, most=500):
            assert part == p
            got.update({(int(i), int(j)): int(k) for i, j, k in zip(x, y, n)})
    assert got == Counter(zip(a.tolist(), b.tolist()))
