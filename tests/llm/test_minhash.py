import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from conftest_llm import SF
from siltstone.llm import minhash


def shingles(text):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[j : j + 5]) for j in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)] if words else [])


def brute(rows):
    sets = {i: shingles(t) for i, t in rows if i is not None}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    posting, both = defaultdict(list), Counter()
    for i, s in sets.items():
        for g in s:
            both.update((j, i) for j in posting[g])
            posting[g].append(i)
    for (a, b), n in both.items():
        if 100 * n >= 85 * (len(sets[a]) + len(sets[b]) - n):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return sorted((i or 0, len(shingles(t)), root(i) if i is not None else None, i is None or root(i) == i) for i, t in rows)


def result(frame):
    return sorted((r.doc_id or 0, r.n_shingles, r.component_id, r.kept) for r in frame.collect())


def family(r, n, words, base, ids):
    """Copies of one text with growing numbers of changed words, so that links are partial."""
    out = []
    for k, i in enumerate(ids):
        text = list(base)
        for _ in range(r.randrange(0, n)):
            text[r.randrange(len(text))] = r.choice(words)
        out.append((i, " ".join(text)))
    return out


def test_families_match_brute_force(spark, make_docs):
    r = random.Random(4)
    words = [f"w{k}" for k in range(3000)]
    rows = []
    for f, size in enumerate((40, 400, 12)):
        base = [r.choice(words) for _ in range((150, 120, 30)[f])]
        rows += family(r, (6, 8, 3)[f], words, base, range(1000 * f, 1000 * f + size))
    rows += [(9000 + k, " ".join(r.choice(words) for _ in range(80))) for k in range(30)]
    r.shuffle(rows)
    assert result(minhash.near_duplicates(make_docs(rows))) == brute(rows)


def bridged(r):
    """Texts w, x, y, z of which z alone is near x and y (85.0 %; x and y: 83.6 %) and w is near none of them."""
    x = [f"t{r.random()}" for _ in range(60)]
    y, w = list(x), list(x)
    y[30], w[10], w[50] = "other", "one", "two"
    return [" ".join(t) for t in (w, x, y, x[:30] + x[31:])]


def test_a_rejected_pair_hides_no_link(spark, make_docs):
    r, rows = random.Random(6), []
    while len(rows) < 80:
        texts = bridged(r)
        sets, off = minhash.shingle_sets(pa.array(texts), 5)
        s = minhash.signatures(sets, off, 4)
        if (s == s[0]).all():  # in every band w is the pivot of the others
            n = len(rows)
            rows += zip([n, *r.sample(range(n + 1, n + 4), 3)], texts)
    want = brute(rows)
    assert sum(not x[3] for x in want) == 40
    assert result(minhash.near_duplicates(make_docs(rows), bands=4, rows=1)) == want


def test_spanning_forest_has_true_links_only():
    sets, off = minhash.shingle_sets(pa.array(bridged(random.Random(8))), 5)
    names = [sets[off[i] : off[i + 1]] for i in range(4)]
    a, b = np.triu_indices(4, 1)
    assert list(minhash._spanning(a, b, np.arange(4), names, 85)) == [(1, 3), (2, 3)]


def test_edges(spark, make_docs):
    long = " ".join(f"x{k}" for k in range(20000))
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a b"), (5, "A  B"), (6, "a b c"), (7, long), (8, long.upper() + " end"), (None, "a b"), (7, long), (9, "a b c d e"), (10, "É b c d e"), (11, "é b c d e")]
    got = result(minhash.near_duplicates(make_docs(rows)))
    assert got == brute(rows)
    assert minhash.near_duplicates(make_docs([])).count() == 0
    kept = sorted(r.doc_id or 0 for r in minhash.keep_first(make_docs(rows)).collect())
    assert kept == [0, 1, 2, 3, 4, 6, 7, 9, 10, 11]


def test_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert result(minhash.near_duplicates(docs)) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_sequential_test_loses_little():
    r = np.random.RandomState(1)
    a = np.zeros((20000, 160), np.uint32)
    b = (r.rand(20000, 160) > 0.85).astype(np.uint32)
    assert len(minhash.survives(a, b, 32, 0.85, 1e-9)) == 20000
    b = (r.rand(2000, 160) > 0.4).astype(np.uint32)
    assert len(minhash.survives(a[:2000], b, 32, 0.85, 1e-9)) < 20


def test_signatures_estimate_similarity():
    r = np.random.RandomState(2)
    pool = r.randint(0, 2**63, 3000).astype(np.uint64)
    x, y = np.unique(pool[:2000]), np.unique(pool[1000:])
    s = minhash.signatures(np.concatenate([x, y]), np.array([0, len(x), len(x) + len(y)]), 4096)
    assert abs((s[0] == s[1]).mean() - 1 / 3) < 0.04


def test_word_class_is_ascii_white_space():
    assert len(re.findall(r"[^\x20\x09-\x0D]+", "a\x1cb c d")) == 2 and len("a\x1cb c d".encode().split()) == 2
