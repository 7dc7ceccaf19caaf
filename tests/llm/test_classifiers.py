import random
import zlib

import numpy as np
import pytest

from conftest_llm import SF
from siltstone.llm import quality, toxicity


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 0


def auc(rows, truth):
    good = [r.score for r in rows if truth[r.doc_id]]
    bad = [r.score for r in rows if not truth[r.doc_id]]
    return np.mean([[g > b for b in bad] for g in good])


def check(rows, docs, threshold):
    assert len(rows) == len(docs)
    for r in rows:
        assert r.held_out == held(r.doc_id) and 0 <= r.score <= 1 and r.predicted == int(r.score >= threshold)


def corpus(n=600):
    r = random.Random(6)
    parts = ["ba", "ko", "ri", "tu", "se", "mo", "la", "ne"]
    word = lambda: "".join(r.choice(parts) for _ in range(r.randrange(1, 4)))
    docs, toxic, good = [], {}, {}
    for i in range(n):
        body = [word() for _ in range(r.randrange(60, 200))]
        toxic[i] = r.random() < 0.2
        if toxic[i]:
            for _ in range(3):
                body.insert(r.randrange(len(body)), "zwurk" + r.choice(parts) + r.choice(parts))
        good[i] = r.random() > 0.2
        if not good[i]:
            body = [w.upper() + "!!" for w in body] if i % 2 else [w + "###" for w in body]
        docs.append((i, " ".join(body)))
    return docs, toxic, good


def test_held_out_accuracy(spark, make_docs):
    docs, toxic, good = corpus()
    labels = spark.createDataFrame([(i, int(good[i]), int(toxic[i])) for i, _ in docs], "doc_id long, quality int, toxic int")
    rows = toxicity.score(make_docs(docs), labels).collect()
    check(rows, docs, 0.5)
    assert auc([r for r in rows if r.held_out], toxic) > 0.97
    rows = quality.score(make_docs(docs), labels).collect()
    check(rows, docs, 0.3)
    assert auc([r for r in rows if r.held_out], good) > 0.97


@pytest.mark.parametrize("module,threshold", [(toxicity, 0.5), (quality, 0.3)])
def test_edges(spark, make_docs, module, threshold):
    docs = [(1, None), (2, ""), (3, " \n"), (None, "a b"), (4, "a " * 20000), (4, "x"), (6, "x" * 100_000)]
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    check(module.score(make_docs(docs), none).collect(), docs, threshold)
    some = spark.createDataFrame([(1, 0, 1), (2, 1, 0), (4, None, None), (None, 1, 1), (6, 1, 0), (6, 0, 1)], "doc_id long, quality int, toxic int")
    check(module.score(make_docs(docs), some).collect(), docs, threshold)
    assert module.score(make_docs([]), some).count() == 0


def test_labels_of_the_held_out_fold_do_not_matter(spark, make_docs):
    docs, toxic, _ = corpus(200)
    a = spark.createDataFrame([(i, 1, int(toxic[i])) for i, _ in docs], "doc_id long, quality int, toxic int")
    b = spark.createDataFrame([(i, 1, 1 - int(toxic[i]) if held(i) else int(toxic[i])) for i, _ in docs], "doc_id long, quality int, toxic int")
    x, y = ({r.doc_id: r.score for r in toxicity.score(make_docs(docs), t).collect()} for t in (a, b))
    assert x == y


def test_table_quality(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    truth = {r.doc_id: r.quality == 1 for r in labels.collect()}
    rows = [r for r in quality.score(docs, labels).collect() if r.doc_id in truth]
    assert auc(rows, truth) > 0.9


def test_toxic_documents_of_the_held_out_fold(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    truth = {r.doc_id: r.toxic == 1 for r in labels.where("toxic IS NOT NULL").collect()}
    rows = [r for r in toxicity.score(docs.join(labels.select("doc_id"), "doc_id"), labels).collect() if r.held_out and r.doc_id in truth]
    hit = sum(truth[r.doc_id] and r.predicted for r in rows)
    recall, precision = hit / sum(truth[r.doc_id] for r in rows), hit / sum(r.predicted for r in rows)
    assert recall >= 0.8 and precision >= 0.9 and auc(rows, truth) > 0.94


def test_features_are_by_row():
    r = np.random.RandomState(1)
    sizes = np.array([0, 1, 2, 30, 0, 5])
    each, rows = r.normal(size=sizes.sum()), np.concatenate([[0], np.cumsum(sizes)])
    got = toxicity.features(each, rows)
    for k, n in enumerate(sizes):
        w = each[rows[k] : rows[k + 1]]
        if not n:
            assert not got[k].any()
            continue
        up = np.sort(np.maximum(w, 0))[::-1]
        want = [w.mean(), *(max(w[i : i + s].sum() for i in range(max(n - s + 1, 1))) / min(s, n) for s in toxicity.STRETCHES), *(up[:s].sum() / s for s in toxicity.LEADING), up.sum() / np.sqrt(n + 1)]
        assert np.allclose(got[k], want)
