"""Document quality by random-indexing word vectors and a small network.

Every token (a word bucket, and a bucket for its shape: case, digits, symbols, length, whether it
repeats) has a fixed sparse random index vector. One pass over all documents adds up, for each bucket,
the index vectors of its neighbours; these sums, centred and scaled to unit length, are the token
vectors. A document is the mean of its word vectors beside the mean of its shape vectors. A two-layer
network is trained on a bounded labelled sample, and its logit is divided by a temperature fitted on
labelled documents kept out of training.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm import _exchange as X
from siltstone.llm import _text as T
from siltstone.llm._labelled import held_out, sample_ids
from siltstone.scratch import Scratch

WORDS, SHAPES, DIMENSION, NONZERO = 8192, 512, 32, 2
BUCKETS = WORDS + SHAPES
#: Labelled documents the network is fitted on, of each class at most; a fifth of them sets the temperature.
PER_CLASS = 6000
HIDDEN, EPOCHS, BATCH, RATE = 24, 60, 64, 0.01
#: Parts in which the sums of tasks are added.
PARTS = 8
_U = np.uint64
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[i for i in range(33, 127) if not chr(i).isalnum() and chr(i) not in ".,;:'\"?-()"]] = True
_UPPER, _LOWER, _DIGIT = (np.array([chr(i) in s for i in range(256)]) for s in ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"))
_UPPER[128:] = _LOWER[128:] = _DIGIT[128:] = False


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the few non-zero entries of each bucket's index vector."""
    r = np.random.RandomState(11)
    return r.randint(0, DIMENSION, (BUCKETS, NONZERO)), r.choice([-1.0, 1.0], (BUCKETS, NONZERO))


def tokens(column: pa.Array):
    """(word bucket, shape bucket, offsets of the rows)."""
    w = T.words(column, lower=True)
    data, _ = T.utf8(column)
    n = len(w.hash)
    size = w.end - w.start

    def share(table):
        total = np.concatenate([[0], np.cumsum(table[data])])
        return total[w.end] - total[w.start]

    upper, lower, digit, symbol = map(share, (_UPPER, _LOWER, _DIGIT, _SYMBOL))
    row = np.repeat(np.arange(len(w.rows) - 1), w.counts)
    again = np.zeros(n, bool)
    again[1:] = (w.hash[1:] == w.hash[:-1]) & (row[1:] == row[:-1])
    _, first = np.unique(w.hash ^ T.mix(row.astype(_U)), return_index=True)
    old = np.ones(n, bool)
    old[first] = False
    shape = (upper > 1) * 1 + ((upper == 1) & (lower > 0)) * 2 + (digit > 0) * 3
    shape = shape * 3 + np.minimum(symbol, 2)
    shape = shape * 4 + np.searchsorted([4, 9, 16], size, "right")
    shape = shape * 2 + old
    shape = shape * 2 + again
    return (w.hash % _U(WORDS)).astype(np.int64), WORDS + shape % SHAPES, w.rows


def context_sums(word: np.ndarray, shape: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Sums of the neighbours' index vectors (BUCKETS x DIMENSION)."""
    place, sign = index_vectors()
    out = np.zeros(BUCKETS * DIMENSION)
    row = np.repeat(np.arange(len(rows) - 1), np.diff(rows))

    def add(target, neighbour):
        for k in range(NONZERO):
            out[:] += np.bincount(target * DIMENSION + place[neighbour, k], sign[neighbour, k], len(out))

    for step in (1, 2):
        ok = row[step:] == row[:-step]
        left, right = np.flatnonzero(ok), np.flatnonzero(ok) + step
        add(word[left], word[right])
        add(word[right], word[left])
        if step == 1:
            add(shape[left], shape[right])
            add(shape[right], shape[left])
    add(word, shape)
    add(shape, word)
    return out.reshape(BUCKETS, DIMENSION)


def token_vectors(sums: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(sums, axis=1, keepdims=True)
    unit = sums / np.maximum(norm, 1e-9)
    for part in (slice(0, WORDS), slice(WORDS, BUCKETS)):
        seen = norm[part, 0] > 0
        if seen.any():
            unit[part] -= unit[part][seen].mean(0)
    place, sign = index_vectors()
    own = np.zeros_like(unit)
    for k in range(NONZERO):
        np.add.at(own, (np.arange(BUCKETS), place[:, k]), sign[:, k])
    own[:WORDS] = 0  # shapes are few and keep an identity of their own
    return np.concatenate([unit, own], 1).astype(np.float32)


def pool(vectors: np.ndarray, word: np.ndarray, shape: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Mean word vector, mean shape vector (with its identity half), and the log length of each row."""
    n = np.diff(rows)
    d = DIMENSION
    out = np.zeros((len(n), 3 * d + 1), np.float32)
    # counts of the few shapes are exact and dense; words are gathered block by block
    at = 0
    full = np.flatnonzero(n > 0)
    while at < len(full):
        end = at + 1
        while end < len(full) and rows[full[end] + 1] - rows[full[at]] < 100_000:
            end += 1
        a, b = rows[full[at]], rows[full[end - 1] + 1]
        cut = rows[full[at:end]] - a
        out[full[at:end], :d] = np.add.reduceat(vectors[word[a:b], :d], cut, axis=0)
        out[full[at:end], d : 3 * d] = np.add.reduceat(vectors[shape[a:b]], cut, axis=0)
        at = end
    out[:, : 3 * d] /= np.maximum(n, 1)[:, None]
    out[:, 3 * d] = np.log1p(n)
    return out


class Network:
    """Input, one hidden layer of rectified units, one logit; trained by Adam on the log loss."""

    def __init__(self, x: np.ndarray, y: np.ndarray, seed: int = 5):
        r = np.random.RandomState(seed)
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-6
        z = (x - self.mean) / self.scale
        k = z.shape[1]
        self.p = [r.randn(k, HIDDEN) * np.sqrt(2 / k), np.zeros(HIDDEN), r.randn(HIDDEN) * np.sqrt(1 / HIDDEN), np.zeros(1)]
        m, v, t = [np.zeros_like(q) for q in self.p], [np.zeros_like(q) for q in self.p], 0
        for epoch in range(EPOCHS):
            order = r.permutation(len(z))
            for i in range(0, len(z), BATCH):
                at = order[i : i + BATCH]
                h = np.maximum(z[at] @ self.p[0] + self.p[1], 0)
                e = (1 / (1 + np.exp(-np.clip(h @ self.p[2] + self.p[3], -30, 30))) - y[at]) / len(at)
                back = np.outer(e, self.p[2]) * (h > 0)
                grads = [z[at].T @ back + 1e-4 * self.p[0], back.sum(0), h.T @ e + 1e-4 * self.p[2], np.array([e.sum()])]
                t += 1
                for q, g, a, b in zip(self.p, grads, m, v):
                    a += 0.1 * (g - a)
                    b += 0.001 * (g * g - b)
                    q -= RATE * (0.97**epoch) * (a / (1 - 0.9**t)) / (np.sqrt(b / (1 - 0.999**t)) + 1e-8)
        self.temperature = 1.0

    def logit(self, x: np.ndarray) -> np.ndarray:
        h = np.maximum((x - self.mean) / self.scale @ self.p[0] + self.p[1], 0)
        return h @ self.p[2] + self.p[3][0]

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> None:
        """The temperature of least log loss on a fixed ladder."""
        if len(y):
            z = self.logit(x)
            loss = lambda t: np.mean(np.logaddexp(0, np.where(y == 1, -z, z) / t))
            self.temperature = min(np.exp(np.linspace(-2, 3, 101)), key=loss)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x) / self.temperature, -30, 30)))


def score(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, per_class: int = PER_CLASS) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Labels are learned from a bounded sample outside the held-out fold (crc32(doc_id as text) modulo 5
    is 0); token vectors come from all documents. Null, empty or blank text: the score of the zero
    vector. Null doc_id: scored, held_out false. Repeated rows: scored each. Without labels of both
    classes every score is the share of good labels (0.5 without any). Other columns are ignored.
    Empty table: empty result.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "quality")
    docs = docs.select("doc_id", "text")

    def contexts(batches):
        total = None
        for b in T.slices(batches):
            one = context_sums(*tokens(b.column("text")))
            total = one if total is None else total + one
        if total is not None:
            blobs = [x.tobytes() for x in np.array_split(total, PARTS)]  # whole numbers, exact in a double
            yield pa.RecordBatch.from_arrays([pa.array(range(PARTS), pa.int32()), pa.array(blobs, pa.binary())], ["part", "blob"])

    def add(batches):
        total, part = None, None
        for b in batches:
            for p, blob in zip(b.column("part").to_pylist(), b.column("blob")):
                x = np.frombuffer(blob.as_buffer(), np.float64)
                total, part = (x if total is None else total + x), p
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["part", "blob"])

    summed = X.deal(docs.select("text").mapInArrow(T.frugal(contexts), X.BLOBS), PARTS).mapInArrow(T.frugal(add), X.BLOBS)
    blobs = {r.part: r.blob for r in summed.collect()}  # the fixed size of the vector table
    sums = np.concatenate([np.frombuffer(blobs[p], np.float64) for p in range(PARTS)]).reshape(BUCKETS, DIMENSION) if blobs else np.zeros((BUCKETS, DIMENSION))
    vectors = spark.sparkContext.broadcast(token_vectors(sums))

    def pooled(batches):
        for b in T.slices(batches):
            x = pool(vectors.value, *tokens(b.column("text")))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array([r.tobytes() for r in x], pa.binary())], ["doc_id", "held_out", "x"])

    known = scratch.save(docs.withColumn("held_out", held_out()).mapInArrow(T.frugal(pooled), "doc_id long, held_out boolean, x binary"), "pooled")
    ids = scratch.save(sample_ids(labels, "quality", per_class), "ids")  # at most 2 * per_class rows
    table = known.join(F.broadcast(ids), "doc_id").dropDuplicates(["doc_id"]).orderBy("doc_id").limit(2 * per_class).toArrow()
    y = table.column("y").to_numpy().astype(np.float64) if table.num_rows else np.zeros(0)
    network, blank = None, float(y.mean()) if len(y) else 0.5
    if len(y) and 0 < y.sum() < len(y):
        x = np.frombuffer(b"".join(table.column("x").to_pylist()), np.float32).reshape(len(y), -1).astype(np.float64)
        aside = np.random.RandomState(2).rand(len(y)) < 0.2
        if 0 < y[~aside].sum() < (~aside).sum():
            network = Network(x[~aside], y[~aside])
            network.calibrate(x[aside], y[aside])

    def run(batches):
        for b in batches:
            if b.num_rows:
                data, _ = T.utf8(b.column("x"))
                x = np.frombuffer(data.tobytes(), np.float32).reshape(b.num_rows, -1).astype(np.float64)
                p = network.score(x) if network else np.full(b.num_rows, blank)
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(p), pa.array((p >= threshold).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return known.mapInArrow(T.frugal(run), "doc_id long, held_out boolean, score double, predicted int")
