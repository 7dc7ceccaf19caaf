import hashlib
import random

from conftest_llm import SF
from siltstone.llm import substring


def brute(rows, size=50):
    words = [(i, (t or "").encode().split()) for i, t in rows]
    first = {}
    for i, w in words:
        if i is not None:
            for s in range(len(w) - size + 1):
                key = tuple(w[s : s + size])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, w in words:
        gone = [False] * len(w)
        for s in range(len(w) - size + 1):
            if i is not None and first[tuple(w[s : s + size])] < i:
                gone[s : s + size] = [True] * size
        kept = [x for x, g in zip(w, gone) if not g]
        out.append((i or 0, len(w), sum(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(out)


def result(frame):
    return sorted((r.doc_id or 0, r.n_words, r.n_removed, r.kept_sha256) for r in frame.collect())


def test_passages_of_every_alignment(spark, make_docs):
    r = random.Random(8)
    say = lambda n, k=4000: [f"w{r.randrange(k)}" for _ in range(n)]
    passages = [say(n) for n in (49, 50, 51, 64, 90, 300)] + [["run"] * 70, ["ha", "ho"] * 60, say(120, 3)]
    rows = []
    for k in range(120):
        body = say(r.randrange(0, 200))
        for _ in range(r.randrange(0, 4)):
            p = r.choice(passages)
            at = r.randrange(len(body) + 1)
            a = r.randrange(0, 12)
            body[at:at] = p[a:] if r.random() < 0.3 else p
        rows.append((k, " \n"[k % 2].join(body)))
    rows += [(200 + k, rows[k][1]) for k in range(0, 40, 3)] + [(300, "  " + rows[5][1].replace(" ", "\t") + "\n")]
    r.shuffle(rows)
    assert result(substring.remove_repeats(make_docs(rows))) == brute(rows)


def test_edges(spark, make_docs):
    same = " ".join(f"k{j}" for j in range(60))
    rows = [(1, None), (2, ""), (3, same), (3, same), (4, same + " tail"), (None, same), (5, "é " * 49), (6, "é " * 49), (7, "x " * 20000), (8, "x " * 300), (9, "y " * 300)]
    assert result(substring.remove_repeats(make_docs(rows))) == brute(rows)
    assert substring.remove_repeats(make_docs([])).count() == 0


def test_cut_keeps_other_text_and_columns(spark, make_docs):
    same = " ".join(f"k{j}" for j in range(60))
    rows = [(1, same), (2, f"head one\n\n{same}\n  tail two "), (3, same), (4, None), (5, "a  b")]
    got = {r.doc_id: r for r in substring.cut_repeats(make_docs(rows)).collect()}
    assert set(got) == {1, 2, 4, 5}
    assert got[2].text == "head one\n\ntail two " and got[2].n_chars == len(got[2].text) and got[2].extra == "x"
    assert got[1].text == same and got[4].text is None and got[5].text == "a  b"


def test_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert result(substring.remove_repeats(docs)) == brute([(r.doc_id, r.text) for r in docs.collect()])
