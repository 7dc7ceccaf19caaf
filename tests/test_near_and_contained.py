import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from siltstone.operators import duplicates, near

SF = "/root/testdata/sf0.001"


def brute(rows, least):
    good = sorted((i, t) for i, t in rows if t is not None)
    return {(i, j) for k, (i, a) in enumerate(good) for j, b in good[k + 1 :] if SequenceMatcher(None, a, b).ratio() >= least}


def edited(r, t, n):
    t = list(t)
    for _ in range(n):
        at = r.randrange(len(t) + 1)
        if r.random() < 0.5 and at < len(t):
            del t[at]
        else:
            t.insert(at, r.choice("abcdef gß"))
    return "".join(t)


@pytest.mark.parametrize("least", [0.95, 0.9, 0.8, 0.6])
def test_near_pairs_equal_brute_force(spark, least):
    r = random.Random(int(least * 100))
    rows = [(9, None), (10, ""), (11, ""), (12, "a"), (13, "ab"), (14, "abc"), (15, "abd"), (16, "a" * 60), (17, "a" * 61), (18, "ab" * 31), (19, "ab" * 30 + "a")]
    for k in range(14):
        base = "".join(r.choice("abcdefgh ijklmno") for _ in range(r.choice([6, 19, 20, 25, 60, 150, 260])))
        for _ in range(4):
            rows.append((100 + len(rows), edited(r, base, r.randrange(0, 2 + len(base) // 12))))
    rows += [(500 + k, rows[-1][1]) for k in range(3)]
    r.shuffle(rows)
    table = spark.createDataFrame(rows, "id long, t string")
    got = near.near_pairs(table, "id", "t", least).collect()
    want = brute(rows, least)
    assert {(x.left_id, x.right_id) for x in got} == want and len(got) == len(want) > 10
    texts = dict(rows)
    assert all(abs(x.ratio - near.ratio(texts[x.left_id], texts[x.right_id])) < 1e-12 for x in got)


def test_candidates_are_few_and_copies_meet_once(spark):
    r = random.Random(2)
    rows = [(k, "".join(r.choice("abcdefghijklmnop qrst") for _ in range(120))) for k in range(300)]
    rows += [(1000 + k, edited(r, t, 3)) for k, t in rows[:20]] + [(2000 + k, rows[0][1]) for k in range(400)]
    members, pairs = near.near_texts(spark.createDataFrame(rows, "id long, t string"), "id", "t", 0.95)
    assert pairs.count() == 20 and members.where("rep = 0").count() == 401
    plan = pairs._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_bounds(spark):
    assert near.first_pair(0.95) == 21 and near.run_length(0.95) == 4 and near.run_length(0.5) == 1
    lost = spark.range(1, 400).select(F.col("id").alias("n"), near.most_lost(F.col("id"), 0.95, 4).alias("d")).collect()
    for x in lost[::37]:
        worst = 0
        for m in range(1, 500):
            if 2 * min(x.n, m) >= 0.95 * (x.n + m):
                common = -(-0.95 * (x.n + m) // 2)
                worst = max(worst, 4 * (x.n - common) + 3 * (m - common))
        assert x.d >= worst


def passages(seed=1):
    r = random.Random(seed)
    words = ["ab", "abc", "b", "xy", "z", "wörd", "k9", "lorem", "ipsum"]
    say = lambda n: "".join(r.choice(words) + r.choice([" ", ", ", "-", "\n", " ... "]) for _ in range(n))
    docs = [(k if k % 7 else None, say(60)) for k in range(40)] + [(100, None), (101, ""), (102, "only")]
    items = []
    for k in range(60):
        t = r.choice(docs[:40])[1]
        a = r.randrange(len(t) - 50)
        items.append((k if k % 5 else None, t[a : a + r.randrange(1, 50)]))
    items += [(200, None), (201, ""), (202, "nowhere to be found in any of them"), (203, "ab"), (203, "z z"), (204, "on"), (205, say(30))]
    return docs, items


@pytest.mark.parametrize("sizes", [(2_000_000, 2_000_000), (50, 0)])
def test_contained_equals_brute_force(spark, monkeypatch, sizes):
    monkeypatch.setattr(duplicates, "BLOCK_CHARS", sizes[0])
    monkeypatch.setattr(duplicates, "BROADCAST_GRAMS", sizes[1])
    docs, items = passages()
    d, s = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = sorted(map(repr, map(tuple, duplicates.contained(d, s, "doc_id", "item_id").collect())))
    want = sorted(repr((i, k)) for i, t in docs for k, x in items if t is not None and x and x in t)
    assert got == want and len(want) > 60


def test_contained_plan_and_empty_tables(spark):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    found = duplicates.contained(docs, items, "doc_id", "item_id")
    plan = found._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    want = {(d.doc_id, i.item_id) for d in docs.collect() for i in items.collect() if d.text and i.text in d.text}
    assert {tuple(r) for r in found.collect()} == want and want
    assert duplicates.contained(docs.limit(0), items, "doc_id", "item_id").count() == 0
    assert duplicates.contained(docs, items.limit(0), "doc_id", "item_id").count() == 0
