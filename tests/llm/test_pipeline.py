import random
from itertools import combinations

import pytest

import corpus_pipeline
from conftest_llm import SF
from test_minhash import shingles
from test_packing import check


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    """A folder of small tables: documents, labels, benchmark."""
    out = str(tmp_path_factory.mktemp("sf"))
    for t in ("documents", "labels", "benchmark"):
        rows = spark.read.parquet(f"{SF}/{t}.parquet")
        (rows.where("doc_id < 70") if "doc_id" in rows.columns else rows).write.parquet(f"{out}/{t}.parquet")
    return out


def test_stages_in_order_keep_their_columns(spark, small, tmp_path):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns, seen = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, small).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        assert docs.columns == columns, name
        now = docs.count()
        assert 0 < now <= seen, name
        seen = now
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    check(rows, corpus_pipeline.STAGES[-1][1](spark, docs, small).collect())


def test_quality_stage_agrees_with_its_query(spark, small):
    from siltstone.llm import rules

    docs, labels = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "labels"))
    want = {r.doc_id for r in rules.apply(docs, labels).where("kept").collect()}
    assert {r.doc_id for r in corpus_pipeline.quality_rules(spark, docs, small).collect()} == want


def first_of_groups(rows):
    """Ids of the smallest member of each group of documents linked at 0.8, by brute force."""
    sets = {i: shingles(t) for i, t in rows}
    group = {i: i for i in sets}
    for a, b in combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both) and group[a] != group[b]:
            lo, hi = sorted((group[a], group[b]))
            group = {i: lo if g == hi else g for i, g in group.items()}
    return {i for i, g in group.items() if i == g}


def near_copies(r, n):
    """Texts of which some are near copies of an earlier one: one word of 44 to 60 replaced (0.78 to 0.84), or two."""
    rows = []
    for k in range(n):
        base = [f"w{r.randrange(10**6)}" for _ in range(44 + k % 17)]
        rows.append((len(rows), " ".join(base)))
        for swaps in ((10,), (30,), (12, 32))[: k % 4]:
            rows.append((len(rows), " ".join("new" if j in swaps else w for j, w in enumerate(base))))
    return rows


def test_near_stage_matches_brute_force_at_its_threshold(spark, make_docs):
    rows = near_copies(random.Random(5), 60)
    docs = make_docs(rows)
    got = corpus_pipeline.near_dedup(spark, docs, "")
    assert got.columns == docs.columns
    want = first_of_groups(rows)
    assert 60 < len(want) < len(rows)
    assert {r.doc_id for r in got.collect()} == want


def test_stages_after_the_rules_match_brute_force(spark, make_docs, tmp_path):
    r = random.Random(9)
    say = lambda n: [f"v{r.randrange(10**6)}" for _ in range(n)]
    rows = near_copies(r, 24)
    want = {i: t.split() for i, t in rows if i in first_of_groups(rows)}
    for n in (50, 64, 90):  # a passage in two documents stays in the first
        passage = say(n)
        for first in (True, False):
            head, tail = say(70), say(40)
            want[len(rows)] = head + (passage if first else []) + tail
            rows.append((len(rows), " ".join(head + passage + tail)))
    items = [(k, say(n)) for k, n in enumerate((20, 45, 9))]
    for k, item in items:  # every fifth word replaced; such documents go
        leak = ["sub" if j % 5 == 2 else w for j, w in enumerate(item)] if len(item) > 9 else item[:4] + ["sub"] + item[5:]
        rows.append((len(rows), " ".join(say(60) + leak + say(30))))
    spark.createDataFrame([(k, " ".join(w)) for k, w in items], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = make_docs(rows)
    for name, stage in corpus_pipeline.STAGES[1:-1]:
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
    left = [(x.doc_id, x.text) for x in docs.collect()]
    assert {i: t.split() for i, t in left} == want
    check(left, corpus_pipeline.STAGES[-1][1](spark, docs, "").collect())
