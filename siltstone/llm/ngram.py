"""Interpolated modified Kneser-Ney bigram model, counted in Spark and read by memory map.

Words and one end token per text are named by 64-bit hashes. Two passes count words and then pairs
(context, word); shards write sorted arrays to the shared folder: pairs with counts, contexts with
their backoff weights, words with counts and with numbers of distinct contexts. Workers map these
files and look whole batches up by binary search. Nothing is pruned, so the model grows with the text.

P(w | h) = max(c(h, w) - D, 0) / c(h) + g(h) P1(w), P1(w) = max(n(w) - D', 0) / n + g' / (V + 1), where
n(w) counts the distinct contexts of w, the discounts D depend on the count (1, 2, 3 or more), and a
word never seen gets the uniform share. Order two keeps the counts within four times the input.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm import _exchange as X
from siltstone.llm import _text as T
from siltstone.scratch import Scratch

_U = np.uint64
END, START = _U(0x0E0D0E0D0E0D0E0D), _U(0x57A2757A2757A275)
#: A word with more than this share of all tokens (so at most 1,000 words) is a hot context: its pairs are dealt by both words.
HOT_SHARE = 1e-3


def token_stream(column: pa.Array):
    """(context, word, offsets): every word and the end of each row, with what comes before."""
    w = T.words(column, lower=True, spans=False)
    n = len(w.rows) - 1
    rows = w.rows + np.arange(n + 1)
    word = np.empty(len(w.hash) + n, _U)
    inner = np.ones(len(word), bool)
    inner[rows[1:] - 1] = False
    word[inner] = w.hash
    word[~inner] = END
    context = np.empty_like(word)
    context[1:] = word[:-1]
    context[rows[:-1]] = START
    return context, word, rows


def pair_name(a, b):
    return T.mix(a * _U(0x9E3779B97F4A7C15) + T.mix(b))


def _pair_shard(parts: int, hot: np.ndarray):
    def shard(a, b):
        part = X.shard_of(a, parts)
        spread = np.isin(a, hot)
        part[spread] = X.shard_of(pair_name(a[spread], b[spread]), parts)
        return part

    return shard


def discounts(n: list[int]) -> tuple[float, float, float]:
    """D1, D2, D3+ from the numbers of items that occur 1, 2, 3 and 4 times."""
    n1, n2, n3, n4 = (float(x) for x in n)
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    raw = (1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5)
    return tuple(min(max(d, 0.05), k - 0.05) for k, d in enumerate(raw, 1))


def fit(texts: DataFrame, scratch: Scratch) -> dict:
    """Count ``texts`` (column text) and write the model; returns its place and global figures."""
    spark = texts.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder = f"{scratch.path}/model"
    texts = texts.select("text")

    def send_words(batches):
        out = X.Sender(parts, False)
        for b in T.slices(batches):
            yield from out.add(token_stream(b.column("text"))[1])
        yield from out.flush()

    def take_words(batches):
        for part, (a, _, c) in X.received(batches):
            X.put(folder, f"word-{part}", a)
            X.put(folder, f"count-{part}", c)
            top = np.flatnonzero(c > HOT_SHARE * c.sum())
            rows = [("all", int(c.sum()), len(c)), *(("hot", int(x), int(k)) for x, k in zip(T.signed(a[top]), c[top]))]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows)], ["kind", "x", "n"])

    found = scratch.save(X.deal(texts.mapInArrow(T.frugal(send_words), X.BLOBS), parts).mapInArrow(T.frugal(take_words), "kind string, x long, n long"), "words")
    total, vocabulary = found.where("kind = 'all'").agg(F.coalesce(F.sum("x"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    hot = [r.x for r in found.where((F.col("kind") == "hot") & (F.col("n") > HOT_SHARE * total)).select("x").collect()]
    hot = np.append(np.array(hot, np.int64).view(_U), START)
    shard = _pair_shard(parts, hot)

    def send_pairs(batches):
        out = X.Sender(parts, True, shard=shard)
        for b in T.slices(batches):
            yield from out.add(*token_stream(b.column("text"))[:2])
        yield from out.flush()

    def take_pairs(batches):
        for part, (a, b, c) in X.received(batches):
            key = pair_name(a, b)
            order = np.argsort(key)
            X.put(folder, f"pair-{part}", key[order])
            X.put(folder, f"times-{part}", np.minimum(c[order], 255).astype(np.uint8))
            large = np.flatnonzero(c[order] >= 255)
            X.put(folder, f"large-{part}", np.stack([large, c[order][large]], 1).astype(np.int64))
            head = np.ones(len(a), bool)
            head[1:] = a[1:] != a[:-1]
            at = np.flatnonzero(head)
            figures = np.stack([np.add.reduceat(x.astype(np.int64), at) for x in (c, c == 1, c == 2, c >= 3)], 1)
            local = ~np.isin(a[at], hot)
            X.put(folder, f"context-{part}", a[at][local])
            X.put(folder, f"figures-{part}", figures[local])
            rows = [(0, k, int((c == k).sum()), 0, 0, 0) for k in (1, 2, 3, 4)] + [(1, int(x), *map(int, f)) for x, f in zip(T.signed(a[at][~local]), figures[~local])]
            yield pa.RecordBatch.from_arrays([*(pa.array(x) for x in zip(*rows)), pa.array([None] * len(rows), pa.int32()), pa.array([None] * len(rows), pa.binary())], ["kind", "x", "c", "n1", "n2", "n3", "part", "blob"])
            words, n = X.combine_one(b, np.ones(len(b), np.int64))
            back = X.Sender(parts, False, most=len(words) + 1)
            list(back.add(words, None, n))
            for batch in back.flush():
                none = [pa.array([None] * batch.num_rows, pa.int64())] * 6
                yield pa.RecordBatch.from_arrays([*none, batch.column("part"), batch.column("blob")], ["kind", "x", "c", "n1", "n2", "n3", "part", "blob"])

    pairs = X.deal(texts.mapInArrow(T.frugal(send_pairs), X.BLOBS), parts).mapInArrow(T.frugal(take_pairs), "kind long, x long, c long, n1 long, n2 long, n3 long, part int, blob binary")
    pairs = scratch.save(pairs, "pairs")
    ones = {r.x: r.c for r in pairs.where("kind = 0").groupBy("x").agg(F.sum("c").alias("c")).collect()}
    wide = pairs.where("kind = 1").groupBy("x").agg(*(F.sum(k).alias(k) for k in ("c", "n1", "n2", "n3"))).collect()
    order = sorted(wide, key=lambda r: r.x % 2**64)
    hot_names = np.array([r.x for r in order], np.int64).view(_U)
    hot_figures = np.array([[r.c, r.n1, r.n2, r.n3] for r in order], np.int64).reshape(-1, 4)

    def take_contexts(batches):
        for part, (a, _, n) in X.received(batches):
            X.put(folder, f"follows-{part}", a)
            X.put(folder, f"contexts-{part}", n)
            rows = [int((n == k).sum()) for k in (1, 2, 3, 4)] + [int((n >= 3).sum()), int(n.sum())]
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in rows], ["n1", "n2", "n3", "n4", "more", "total"])

    back = pairs.where("blob IS NOT NULL").select("part", "blob")
    follows = scratch.save(X.deal(back, parts).mapInArrow(T.frugal(take_contexts), "n1 long, n2 long, n3 long, n4 long, more long, total long"), "follows")
    f = follows.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in follows.columns)).first()
    scratch.drop("pairs")
    lower = discounts([f.n1, f.n2, f.n3, f.n4])
    return {
        "folder": folder, "parts": parts, "hot": hot, "hot_names": hot_names, "hot_figures": hot_figures, "tokens": int(total), "vocabulary": int(vocabulary),
        "upper": discounts([ones.get(k, 0) for k in (1, 2, 3, 4)]), "lower": lower, "pairs": int(f.total),
        "spare": (lower[0] * f.n1 + lower[1] * f.n2 + lower[2] * f.more) / f.total if f.total else 1.0,
    }


def _find(folder: str, parts: np.ndarray, query: np.ndarray, names: str, values: str, kind, width: int = 1, large: str = "") -> np.ndarray:
    """Values of the queried names, 0 where there are none; each shard is searched in order.

    ``large`` holds (place, value) of values of 255 and more, which ``values`` has as 255.
    """
    out = np.zeros((len(query), width) if width > 1 else len(query), np.int64)
    order = np.lexsort((query, parts))
    cut = np.flatnonzero(np.diff(parts[order])) + 1
    for at in np.split(order, cut) if len(order) else []:
        p = parts[at[0]]
        keys = X.get(folder, f"{names}-{p}", _U)
        if len(keys):
            i = np.minimum(np.searchsorted(keys, query[at]), len(keys) - 1)
            hit = keys[i] == query[at]
            found = X.get(folder, f"{values}-{p}", kind).reshape((-1, width) if width > 1 else -1)[i[hit]].astype(np.int64)
            if large and (big := found == 255).any():
                table = X.get(folder, f"{large}-{p}", np.int64).reshape(-1, 2)
                found[big] = table[np.searchsorted(table[:, 0], i[hit][big]), 1]
            out[at[hit]] = found
    return out


def _discounted(n: np.ndarray, d) -> np.ndarray:
    return np.maximum(n - np.array([0.0, *d])[np.minimum(n, 3)], 0.0)


def probabilities(model: dict, context: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(probability, training count) of each word after its context."""
    folder, parts = model["folder"], model["parts"]
    words, back = np.unique(word, return_inverse=True)
    home = X.shard_of(words, parts)
    count = _find(folder, home, words, "word", "count", np.int64)
    n = _find(folder, home, words, "follows", "contexts", np.int64)
    total = max(model["pairs"], 1)
    base = _discounted(n, model["lower"]) / total + model["spare"] / (model["vocabulary"] + 1)
    name, first, same = np.unique(pair_name(context, word), return_index=True, return_inverse=True)
    a, b = context[first], word[first]
    times = _find(folder, _pair_shard(parts, model["hot"])(a, b), name, "pair", "times", np.uint8, large="large")
    contexts, which = np.unique(a, return_inverse=True)
    figures = _find(folder, X.shard_of(contexts, parts), contexts, "context", "figures", np.int64, 4)
    if len(model["hot_names"]):
        at = np.minimum(np.searchsorted(model["hot_names"], contexts), len(model["hot_names"]) - 1)
        hit = model["hot_names"][at] == contexts
        figures[hit] = model["hot_figures"][at[hit]]
    c = np.maximum(figures[:, 0], 1)
    weight = np.where(figures[:, 0] > 0, (figures[:, 1:] * np.array(model["upper"])).sum(1) / c, 1.0)
    p = _discounted(times, model["upper"]) / c[which] + weight[which] * base[np.searchsorted(words, b)]
    return p[same], count[back]


def score(docs: DataFrame, folds: int = 7, held: int = 2) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from documents whose crc32(doc_id as text) modulo ``folds`` is not ``held``. Null or blank
    text: the end token alone. Null doc_id: scored, not learned from, held_out false. Repeated rows are
    learned from and scored one by one. Without training text every token is unknown. Other columns
    are ignored. Empty table: empty result.
    """
    scratch = Scratch(docs.sparkSession, "ngram")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds
    docs = docs.select("doc_id", "text", F.coalesce(fold == held, F.lit(False)).alias("held_out"), F.coalesce(fold != held, F.lit(False)).alias("learn"))
    model = fit(docs.where("learn"), scratch)
    tokens, vocabulary = model["tokens"], model["vocabulary"]

    def run(batches):
        for b in T.slices(batches):
            context, word, rows = token_stream(b.column("text"))
            p, c = probabilities(model, context, word)
            at = rows[:-1]
            base = np.add.reduceat(np.log10((c + 1) / (tokens + 1 * (vocabulary + 1))), at)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("held_out"), pa.array(np.diff(rows)), pa.array(np.add.reduceat((c > 0).astype(np.int64), at)), pa.array(np.full(len(at), tokens)), pa.array(base), pa.array(np.add.reduceat(np.log10(p), at))],
                ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    return docs.select("doc_id", "text", "held_out").mapInArrow(T.frugal(run), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
