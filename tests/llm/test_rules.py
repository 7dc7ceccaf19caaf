import re
from collections import Counter

from conftest_llm import SF
from siltstone.llm import rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    seen = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + j for i in range(len(words) - 2) if seen[tuple(words[i : i + 3])] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
    }


CASES = [
    (1, None), (2, ""), (3, " \n\t "), (4, "a"), (5, "a b"), (6, "a b c a b c"), (7, "x x x x x x"), (8, "l1\nl1\n\nl1 \nl1"), (9, "é#ü| a\x0bb\x0cc\rd"),
    (10, "a b c " * 400), (11, " ".join(f"w{i}" for i in range(20000))), (12, " ".join(f"w{i % 7}" for i in range(3000))), (None, "a b c"), (6, "a b c a b c"), (13, "nb sp one two"),
]


def test_measures_match_brute_force(spark, make_docs):
    got = rules.measures(make_docs(CASES)).collect()
    assert len(got) == len(CASES)
    want = sorted(tuple([i or 0, *brute(t).values()]) for i, t in CASES)
    assert sorted((r.doc_id or 0, *(r[k] for k in brute(""))) for r in got) == want


def test_measures_on_the_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r.doc_id: r for r in rules.measures(docs).collect()}
    for r in docs.collect():
        assert {k: got[r.doc_id][k] for k in brute("")} == brute(r.text)


def test_tail_is_exact():
    assert abs(rules.tail(2, 5, 0.5) - 0.5) < 1e-12
    assert rules.tail(5, 5, 0.3) == 1.0


def test_cutoffs_bound_false_rejection(spark, make_docs):
    good = [(i, " ".join(f"w{(i * 13 + j) % 997}" for j in range(60))) for i in range(1500)]
    bad = [(5000 + i, " ".join(f"w{(i * 31 + j) % 997}###" for j in range(60))) for i in range(200)]
    labels = spark.createDataFrame([(i, 1, 0) for i, _ in good] + [(i, 0, 0) for i, _ in bad[:50]], "doc_id long, quality int, toxic int")
    out = {r.doc_id: r for r in rules.apply(make_docs(good + bad), labels).collect()}
    assert all(out[i].kept for i, _ in good)
    assert not any(out[i].kept for i, _ in bad)


def test_few_labels_switch_rules_off(spark, make_docs):
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    out = rules.apply(make_docs([(1, "a### " * 3), (2, " ".join(f"w{i}###" for i in range(60))), (3, None)]), labels).collect()
    assert {r.doc_id: (r.base_failed, r.kept) for r in out} == {1: (True, False), 2: (False, True), 3: (True, False)}


def test_empty_tables(spark, make_docs):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert rules.apply(make_docs([]), labels).count() == 0


def test_windows_that_share_a_value_are_told_apart(spark, make_docs):
    # a window's value keeps only the low bits of its hash beside many places: with one bit of hash left, all clash
    docs = make_docs([(1, "a b c d a b c e"), (2, "a b c d e f g h i"), (3, "x x x x")])
    real = rules.F.expr
    try:
        rules.F.expr = lambda e: real(e.replace("xxhash64(words[i], words[i + 1], words[i + 2])", "xxhash64(words[i], words[i + 1], words[i + 2]) % 2"))
        got = {r.doc_id: r.n_repeat_words for r in rules.measures(docs).collect()}
    finally:
        rules.F.expr = real
    assert got == {1: 6, 2: 0, 3: 4}


def test_select_keeps_rows_whole(spark):
    body = " ".join(f"w{i}" for i in range(60))
    schema = "doc_id long, text string, row string, words string, stratum string, reason string, `of` int, `starts` int"
    rows = [(1, body, "r", "w", "s", "x", 1, 2), (None, body, None, None, None, None, None, None), (2, None, "r", "w", "s", "x", 1, 2), (1, body, "r", "w", "s", "x", 1, 2)]
    docs = spark.createDataFrame(rows, schema)
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    got = rules.select(docs, labels)
    assert got.columns == docs.columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted([rows[0], rows[1], rows[3]], key=str)
    assert rules.select(docs.limit(0), labels).count() == 0
    assert rules.apply(docs, labels).count() == 4


def test_rules_reject_on_the_larger_table(spark):
    """Cutoffs are admitted in each language with labels enough, and good documents of the labels mostly stay."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    rows = rules.apply(docs, labels).select("doc_id", "reason").collect()
    assert {"symbols", "base"} <= {r.reason for r in rows}
    good = {r.doc_id for r in labels.where("quality = 1").collect()}
    held = [r for r in rows if r.doc_id in good and r.reason != "base"]
    assert sum(r.reason is not None for r in held) <= 0.1 * len(held)
