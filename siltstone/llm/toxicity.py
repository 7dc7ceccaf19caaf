"""Toxic texts by class-conditional Kneser-Ney models of word spellings.

Two models, of toxic and of ordinary documents, predict each letter of a word from the letters before
it (up to ``ORDER`` - 1, beginning with the word). Discounted counts of a class back off to one shared
Kneser-Ney model, built from the continuation counts of both classes together. In letters that neither
class has seen after a context the shared part cancels, so an unseen inflection of a toxic stem keeps
the evidence of the stem and a rare word carries none.

A text is judged by length-normalised comparisons of the two log-likelihoods: of the whole text, of its
stretches of ``STRETCHES`` words, of which the most toxic one counts, of its ``LEADING`` most toxic words, and of
all words that speak for toxicity, by the root of the text's length. A logistic fit turns them into a probability;
it is made on labelled documents, each by a model that has not seen its third of them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm import _exchange as X
from siltstone.llm import _text as T
from siltstone.llm._labelled import held_out, logistic, logistic_score, sample_ids
from siltstone.scratch import Scratch

#: Letters of a gram, in bytes: a stem of ten, in scripts of one byte, is known with the word's start.
ORDER = 12
#: Labelled documents the models are fitted on, of each class at most.
PER_CLASS = 4000
THIRDS = 3
STRETCHES = (1, 3, 12)
LEADING = (2, 4, 8)
_U = np.uint64
_START, _STOP = 2, 3  # bytes that begin and end a word


def spell(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all words with their start and end marks, and the words' offsets."""
    flat = np.frombuffer(b"".join(b"\x02" + w + b"\x03" for w in words), np.uint8)
    return flat, np.concatenate([[0], np.cumsum([len(w) + 2 for w in words])]).astype(np.int64)


class Letters:
    """Names of the grams of every letter, order by order.

    A gram is the last ``order`` bytes up to a letter, or all since the word's start mark if these are fewer. It is
    named by the gram one shorter that ends before it, which is its context, and its own letter, so an order follows
    from the one below with one pass, and only neighbouring orders are held.
    """

    def __init__(self, flat: np.ndarray, off: np.ndarray):
        self.starts = off[:-1]
        self.letter = T.mix(flat.astype(_U) + _U(77))
        self.inner = np.ones(len(flat), bool)
        self.inner[self.starts] = False
        self.names = self.letter.copy()  # of all bytes, for the present order
        self.names[self.starts] = _U(1)
        self.context = np.zeros(len(flat), _U)  # order 1 has one context
        self.counts = np.diff(off) - 1

    def grams(self) -> tuple[np.ndarray, np.ndarray]:
        """(context, gram) of every letter for the present order."""
        return self.context[self.inner], self.names[self.inner]

    def rise(self) -> None:
        """Go on to the next order."""
        self.context[1:] = self.names[:-1]
        self.names = T.mix(self.context * _U(0x9E3779B97F4A7C15) + self.letter)  # the factor keeps ab and ba apart
        self.names[self.starts] = _U(1)

    def words(self) -> np.ndarray:
        """The word of every letter."""
        return np.repeat(np.arange(len(self.counts), dtype=np.int32), self.counts)


def _distinct(keys: np.ndarray, *values: np.ndarray):
    """(names, a place of each, the name of each key, and the sums of the values; their number where none are given)."""
    names, first, back = np.unique(keys, return_index=True, return_inverse=True)
    sums = [np.bincount(back, v, len(names)) for v in values] or [np.bincount(back, minlength=len(names)).astype(float)]
    return names, first, back, *sums


def fit(words: list[bytes], toxic: np.ndarray, ordinary: np.ndarray) -> dict[str, np.ndarray]:
    """Log ratios of seen letters by gram, and of unseen letters by context."""
    letters = Letters(*spell(words))
    # the shared model: continuation counts, order by order; below, here and above are the grams of three orders
    shared, below = None, None
    context, here = letters.grams()
    for _ in range(1, ORDER):
        letters.rise()
        context_above, above = letters.grams()
        first = np.unique(above, return_index=True)[1]  # distinct longer grams
        g, one, back, n = _distinct(here[first])
        one = first[one]
        c, _, home, total, types = _distinct(context[one], n, np.ones(len(g)))
        d = _discount(n)
        lower = 1 / 256 if shared is None else _look(shared, below[one])
        p = (np.maximum(n - d, 0) + d * types[home] * lower) / total[home]
        shared = (g, p)
        below, here, context = here, above, context_above
        del above, context_above, first, back, home
    word, gram = letters.words(), here
    del letters, here
    out = {}
    parts = []
    g, one, _, nt, no = _distinct(gram, toxic[word], ordinary[word])
    low, context = _look(shared, below[one]), context[one]
    for n in (nt, no):
        c, _, home, total, types = _distinct(context, n, (n > 0).astype(float))
        d = _discount(n[n > 0])
        gamma = np.where(total > 0, d * types / np.maximum(total, 1e-9), 1.0)
        top = np.where(total[home] > 0, np.maximum(n - d, 0) / np.maximum(total[home], 1e-9), 0)
        parts.append((top + gamma[home] * low, gamma))
    out["gram"], out["gram_ratio"] = g, np.log(parts[0][0] / parts[1][0]).astype(np.float32)
    out["context"], out["context_ratio"] = c, np.log(parts[0][1] / parts[1][1]).astype(np.float32)
    return out


def _discount(n: np.ndarray) -> float:
    n1, n2 = int((n == 1).sum()), int((n == 2).sum())
    return n1 / (n1 + 2 * n2) if n1 else 0.5


def _look(table, query: np.ndarray) -> np.ndarray:
    names, p = table
    return p[np.searchsorted(names, query)]


def _looked_up(names: np.ndarray, values: np.ndarray, query: np.ndarray):
    """(value, whether there is one) of each name."""
    if not len(names):
        return np.zeros(len(query)), np.zeros(len(query), bool)
    at = np.minimum(np.searchsorted(names, query), len(names) - 1)
    return values[at], names[at] == query


def ratios(model: dict[str, np.ndarray], words: list[bytes]) -> np.ndarray:
    """The log-likelihood ratio of each word alone."""
    letters = Letters(*spell(words))
    for _ in range(1, ORDER):
        letters.rise()
    word, (context, gram) = letters.words(), letters.grams()
    seen, hit = _looked_up(model["gram"], model["gram_ratio"], gram)
    rest, known = _looked_up(model["context"], model["context_ratio"], context)
    each = np.where(hit, seen, np.where(known, rest, 0.0))
    return np.bincount(word, each, len(words))


def distinct_words(column: pa.Array):
    """(words, which word each token is, offsets of the rows): alphanumeric words in lower case."""
    w = T.words(column, lower=True, alphanumeric=True)
    data, _ = T.utf8(column)
    _, first, which = np.unique(w.hash, return_index=True, return_inverse=True)
    return [data[w.start[i] : w.end[i]].tobytes().lower() for i in first], which, w.rows


FEATURES = 2 + len(STRETCHES) + len(LEADING)


def features(each: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Per row: the ratio of the two log-likelihoods by word, of all words, of the most toxic stretch of each length, of the
    most toxic words, and what speaks for toxicity by the root of the length."""
    n = np.diff(rows)
    out = np.zeros((len(n), FEATURES))
    full = np.flatnonzero(n > 0)
    if not len(full):
        return out
    total = np.concatenate([[0.0], np.cumsum(each)])
    first, last = rows[:-1][full], rows[1:][full]
    out[full, 0] = (total[last] - total[first]) / (last - first)
    for k, size in enumerate(STRETCHES, 1):
        many = np.maximum(last - first - size + 1, 1)
        start = T.spread(first, many)
        end = np.minimum(start + size, np.repeat(last, many))
        out[full, k] = np.maximum.reduceat(total[end] - total[start], np.concatenate([[0], np.cumsum(many)[:-1]])) / np.minimum(size, last - first)
    toxic = np.flatnonzero(each > 0)
    row = np.searchsorted(rows, toxic, "right") - 1
    order = np.lexsort((-each[toxic], row))
    value, row = each[toxic][order], row[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    for k, size in enumerate(LEADING, 1 + len(STRETCHES)):
        out[:, k] = np.bincount(row, np.where(place < size, value, 0.0), len(n)) / size
    out[:, -1] = np.bincount(row, value, len(n)) / np.sqrt(n + 1)
    return out


class Scorer:
    """Features of Arrow columns, by a model in the shared folder."""

    def __init__(self, folder: str, name: str = "all"):
        self.model = {k: X.get(folder, f"{name}-{k}", np.float32 if k.endswith("_ratio") else _U) for k in ("gram", "gram_ratio", "context", "context_ratio")}

    def features(self, column: pa.Array) -> np.ndarray:
        words, which, rows = distinct_words(column)
        each = ratios(self.model, words) if words else np.zeros(0)
        return features(each[which], rows)


def score(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, per_class: int = PER_CLASS) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Labels are learned from a bounded sample outside the held-out fold (crc32(doc_id as text) modulo 5
    is 0). Null, empty or blank text: the score of a text without evidence. Null doc_id: scored,
    held_out false. Repeated rows: scored each, equal texts alike. Texts of any length are scored whole. Without
    labels of both classes every score is the share of toxic labels (0.5 without any). Other columns are
    ignored. Empty table: empty result.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "toxicity")
    folder = f"{scratch.path}/model"
    docs = docs.select("doc_id", "text")
    ids = scratch.save(sample_ids(labels, "toxic", per_class), "ids")  # at most 2 * per_class rows
    chosen = docs.join(F.broadcast(ids), "doc_id").withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(THIRDS)).cast("int"))
    chosen = scratch.save(chosen, "chosen")

    def count(batches):
        for b in T.slices(batches):
            words, which, rows = distinct_words(b.column("text"))
            lengths, y, part = np.diff(rows), np.asarray(b.column("y")), np.asarray(b.column("part"))
            for k in range(THIRDS):
                mine = np.repeat(part == k, lengths)
                at = which[mine]
                total = np.bincount(at, minlength=len(words))
                toxic = np.bincount(at, np.repeat(y, lengths)[mine], len(words)).astype(np.int64)
                on = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(on), k, np.int32)), pa.array([words[i] for i in on], pa.binary()), pa.array(toxic[on]), pa.array((total - toxic)[on])], ["part", "word", "t", "o"])

    counted = chosen.mapInArrow(T.frugal(count), "part int, word binary, t long, o long").groupBy("part", "word").agg(F.sum("t").alias("t"), F.sum("o").alias("o"))
    table = counted.orderBy("word", "part").toArrow()  # the words of the bounded sample
    shares = {r.y: r["count"] for r in ids.groupBy("y").count().collect()}
    blank = shares.get(1, 0) / sum(shares.values()) if shares else 0.5
    weights = None
    if len(shares) == 2 and table.num_rows:
        part = table.column("part").to_numpy()
        for name, mine in (("all", part >= 0), *((str(k), part != k) for k in range(THIRDS))):
            some = table.filter(pa.array(mine)).group_by("word").aggregate([("t", "sum"), ("o", "sum")])
            if some.num_rows:
                model = fit(some.column("word").to_pylist(), some.column("t_sum").to_numpy().astype(float), some.column("o_sum").to_numpy().astype(float))
                for part_name, array in model.items():
                    X.put(folder, f"{name}-{part_name}", array)
                del model
        del table

        def look(batches):
            scorers = [Scorer(folder, str(k)) for k in range(THIRDS)]
            for b in T.slices(batches):
                part = np.asarray(b.column("part"))
                x = np.zeros((b.num_rows, FEATURES))
                for k, scorer in enumerate(scorers):
                    at = np.flatnonzero(part == k)
                    if len(at):
                        x[at] = scorer.features(b.column("text").take(pa.array(at)))
                yield pa.RecordBatch.from_arrays([b.column("y"), pa.array(list(x), pa.list_(pa.float64()))], ["y", "x"])

        fitted = chosen.select("y", "text", "part").mapInArrow(T.frugal(look), "y int, x array<double>").toArrow()
        x, y = np.array(fitted.column("x").to_pylist()).reshape(-1, FEATURES), fitted.column("y").to_numpy()
        if len(y) and 0 < y.sum() < len(y):
            weights = logistic(x, y)

    def run(batches):
        scorer = Scorer(folder) if weights is not None else None
        for b in T.slices(batches):
            p = logistic_score(weights, scorer.features(b.column("text"))) if scorer else np.full(b.num_rows, blank)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(p), pa.array((p >= threshold).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return docs.withColumn("held_out", held_out()).mapInArrow(T.frugal(run), "doc_id long, held_out boolean, score double, predicted int")
