import math
from fractions import Fraction

import numpy as np
import pytest

from conftest_llm import SF
from siltstone.llm import whitening
from siltstone.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, x string, component int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", 3) for i, v in rows], SCHEMA)


def expected(rows, most=16):
    """The definition in whole numbers and fractions: n, S, deviations, the covariance."""
    kept = [(i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in kept})
    n, d = len(fit), len(fit[0])
    s = [sum(x[j] for x in fit) for j in range(d)]
    z = [[n * x[j] - s[j] for j in range(d)] for x in fit]
    v = np.array([[float(Fraction(sum(a[i] * a[j] for a in z), n**3)) for j in range(d)] for i in range(d)])
    return kept, n, s, v


def check(got, rows, most=16):
    kept, n, s, v = expected(rows)
    d = len(s)
    k = min(d, most)
    e = np.sort(np.linalg.eigvalsh(v))[::-1][:k]
    assert len(got) == len(kept) * k
    by = {}
    for r in got:
        by.setdefault(r.vec_id, {}).setdefault(r.component, []).append(r)
    points, back = [], []
    for i, x in kept:
        mine = by[i]
        assert sorted(mine) == list(range(1, k + 1))
        deviation = sum((n * a - b) ** 2 for a, b in zip(x, s))
        for c, found in mine.items():
            for r in found:
                assert r.n == n and r.deviation == deviation and 0 <= r.identity_error <= 1e-4
                assert r.explained == pytest.approx(max(e[c - 1], 0) / np.trace(v), rel=1e-9, abs=1e-12)
        points.append([float(Fraction(n * a - b, n)) for a, b in zip(x, s)])
        back.append([mine[c][0].whitened for c in range(1, k + 1)])
    return np.array(points), np.array(back, dtype=float), e, v


def test_given_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = QUERIES["op11_whitening"](spark, SF).collect()
    points, back, e, v = check(got, rows)
    # the projections are those on unit eigenvectors of the covariance: they give them back
    w = np.linalg.lstsq(points, back * np.sqrt(e), rcond=None)[0]
    assert np.abs(np.linalg.norm(w, axis=0) - 1).max() < 1e-9
    assert np.abs(v @ w - w * e).max() < 1e-9 * e[0]


def test_copies_weigh_once_and_bad_rows_go(spark):
    r = np.random.RandomState(4)
    good = [(i, [float(x) for x in r.normal(0, 1 + np.arange(5))]) for i in range(60)]
    bad = [(900, None), (901, []), (902, [1.0, None, 2.0, 0.0, 0.0]), (903, [float("nan")] + [0.0] * 4), (904, [float("inf")] + [0.0] * 4), (905, [1.0, 2.0])]
    copies = [(1000 + i, good[0][1]) for i in range(200)] + [(None, good[1][1]), (5, good[5][1])]
    got = whitening.whiten(table(spark, good + copies + bad)).collect()
    assert {r.n for r in got} == {60} and not {r.vec_id for r in got} & set(range(900, 906))
    assert sum(r.vec_id == 5 for r in got) == 10 and sum(r.vec_id is None for r in got) == 5
    check(got, good + copies)
    columns = {c: [r.whitened for r in got if r.component == c and r.vec_id is not None and r.vec_id < 60] for c in range(1, 6)}
    assert all(abs(np.var([x for k, x in enumerate(v) if k != 6]) - 1) < 0.2 for v in columns.values())


def test_no_variance(spark):
    one = whitening.whiten(table(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect()
    assert [(r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in sorted(one, key=lambda r: (r.vec_id, r.component))] == [(1, 1, 0, None, None, 0.0), (2, 1, 0, None, None, 0.0)] * 2
    flat = whitening.whiten(table(spark, [(1, [1.0, 5.0, 0.0]), (2, [2.0, 5.0, 0.0]), (3, [4.0, 5.0, 0.0])])).collect()
    assert all((r.whitened is None) == (r.component > 1) for r in flat)
    assert sorted(r.explained for r in flat) == [0.0] * 6 + [1.0] * 3
    assert whitening.whiten(table(spark, [])).count() == 0
    assert whitening.whiten(table(spark, [(1, None), (2, [None])])).columns == [c.split()[0] for c in whitening.EMPTY.split(", ")]


def test_large_entries_stay_exact(spark):
    rows = [(1, [3e38, 1.0]), (2, [-3e38, 2.0]), (3, [0.0, 4.0])]
    got = whitening.whiten(table(spark, rows)).collect()
    assert len(got) == 6 and {r.deviation for r in got if r.vec_id != 3} == {None}
    assert all(math.isfinite(r.whitened) for r in got if r.component == 1)
    x, n = np.array([[2**40, 5]]), 2**30
    assert whitening.centred(x, n, [7, 1]).tolist() == [[2**70 - 7, 5 * 2**30 - 1]]
    assert whitening._squares(np.array([[2**30, 2**30]])) == [2**61] and whitening._squares(np.array([[2**32, 1]])) == [None]
