"""Packing of token sequences: dominance reduction, then best fit, over a histogram of lengths.

Documents are tokenized once; pieces of equal length are interchangeable, so the packing problem is a
histogram of at most ``capacity`` counts, whatever the number of documents. It is solved on the driver
into patterns (which lengths share a sequence) with multiplicities:

1. Martello-Toth reduction: sets of pieces that dominate every other way to fill a sequence are fixed
   for good: two that fill it exactly; a piece nothing fits with; a piece and the largest that fits
   where no two others fit; the same where no two that fit weigh more than that one.
2. What remains is packed by best fit in decreasing order, whole groups of equal sequences at a time.

Spark then ranks the pieces of each length (salted, so a common length is no hot key) and a rank finds
its sequence and offset by binary search among the patterns' slots.
"""

from __future__ import annotations

import itertools
import os
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siltstone.llm import _text as T
from siltstone.scratch import Scratch

CAPACITY = 2048
#: Words that a worker keeps with their ids; beyond, it starts over. No influence on results.
CACHE = 300_000


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class WordTokenizer:
    """Ids of whole texts for a tokenizer that drops white space, by way of its distinct words."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a worker has one core
        from tokenizers import Tokenizer

        self.base = Tokenizer.from_file(path)
        self.base.no_truncation()
        self.base.no_padding()
        vocabulary = self.base.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closes[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.special = [x.content.encode() for x in self.base.get_added_tokens_decoder().values()]
        self.plain = False
        self._clear()

    def _clear(self):
        self.index: dict[int, int] = {}
        self.start = np.zeros(1 << 16, np.int64)
        self.size = np.zeros(1 << 16, np.int64)
        self.flat = np.zeros(1 << 18, np.uint32)
        self.used = 0

    def _encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text. Plain words go through in one text: each ends in the one token that ends a word."""
        encode = getattr(self.base, "encode_batch_fast", self.base.encode_batch)
        if self.plain:
            ids = encode([" ".join(texts)], add_special_tokens=False)[0].ids
            ends = np.flatnonzero(self.closes[ids]) + 1
            if len(ends) == len(texts):
                return [ids[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]
        return [x.ids for x in encode(texts, add_special_tokens=False)]

    def _learn(self, names: list[int], texts: list[str]):
        ids = self._encode(texts)
        n, lengths = len(self.index), np.array([len(x) for x in ids], np.int64)
        while n + len(ids) > len(self.start):
            self.start, self.size = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.size))
        total = int(lengths.sum())
        while self.used + total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.used : self.used + total] = [i for x in ids for i in x]
        self.size[n : n + len(ids)] = lengths
        self.start[n : n + len(ids)] = self.used + np.concatenate([[0], np.cumsum(lengths)[:-1]])
        self.used += total
        self.index.update(zip(names, range(n, n + len(ids))))

    def ids(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the rows, and the offsets of the rows among them.

        Texts are cut at white space, and inside words between ASCII letters and ASCII punctuation,
        where the tokenizer cuts too; not so where a special token is spelled out.
        """
        if len(self.index) > CACHE:
            self._clear()
        data, _ = T.utf8(column)
        body = data.tobytes()
        w = T.words(column, runs=not any(x in body for x in self.special))
        names, first, which = np.unique(w.hash, return_index=True, return_inverse=True)
        at = np.fromiter(map(self.index.get, names.tolist(), itertools.repeat(-1)), np.int64, len(names))
        new = np.flatnonzero(at < 0)
        spans = [body[a:b].decode() for a, b in zip(w.start[first[new]].tolist(), w.end[first[new]].tolist())]
        plain = np.array([x.isascii() and x.isalpha() for x in spans], bool)
        for self.plain in (True, False):
            group = np.flatnonzero(plain == self.plain)
            for k in range(0, len(group), 2048):
                part = group[k : k + 2048]
                at[new[part]] = np.arange(len(self.index), len(self.index) + len(part))
                self._learn(names[new[part]].tolist(), [spans[i] for i in part])
        at = at[which] if len(names) else np.zeros(0, np.int64)
        sizes = self.size[at]
        return self.flat[T.spread(self.start[at], sizes)], np.concatenate([[0], np.cumsum(sizes)])[w.rows]


_loaded: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    if path not in _loaded:
        _loaded[path] = WordTokenizer(path)
    return _loaded[path]


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32): each text's ids and a final 0, cut at ``capacity``."""

    def run(batches):
        t = tokenizer(path)
        for b in T.slices(batches):
            ids, off = t.ids(b.column("text"))
            n = np.diff(off) + 1
            rows = [(i, k, min(capacity, int(n[i]) - k * capacity)) for i in range(b.num_rows) for k in range(-(-int(n[i]) // capacity))]
            crc = []
            for i, k, length in rows:
                at = off[i] + k * capacity
                body = ids[at : min(at + length, off[i + 1])].astype("<u4").tobytes()
                crc.append(zlib.crc32(body + b"\0\0\0\0" if k * capacity + length == n[i] else body))
            row, piece, length = (np.array(x, np.int64) for x in zip(*rows))
            yield pa.RecordBatch.from_arrays([b.column("doc_id").take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(piece * capacity), pa.array(length), pa.array(crc, pa.int64())], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select("doc_id", "text").mapInArrow(T.frugal(run), "doc_id long, piece int, start long, length long, ids_crc32 long")


Pattern = tuple[int, list[tuple[int, int]]]  # multiplicity; (length, times)


def reduce(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Fix dominating sets; ``counts`` keeps the rest."""
    out: list[Pattern] = []

    def fix(n: int, *lengths: int):
        out.append((n, [(x, 1) for x in lengths]))
        for x in lengths:
            counts[x] -= n
            if not counts[x]:
                del counts[x]

    for x in sorted(counts, reverse=True):
        y = capacity - x
        if x == capacity:
            fix(counts[x], x)
        elif y < x and y in counts and x in counts:
            fix(min(counts[x], counts[y]), x, y)
        elif y == x and counts.get(x, 0) > 1:
            n = counts[x] // 2
            out.append((n, [(x, 2)]))
            counts[x] -= 2 * n
            if not counts[x]:
                del counts[x]
    changed = True
    while changed:
        changed = False
        for x in sorted(counts, reverse=True):
            while x in counts:
                room = capacity - x
                others = dict(counts)
                others[x] -= 1
                order = sorted(k for k, n in others.items() if n)
                least = [k for k in order[:3] for _ in range(min(3, others[k]))][:3]
                if not least or least[0] > room:
                    fix(counts[x] if not least or x > room else 1, x)
                    changed = True
                    continue
                best = max(k for k in order if k <= room)
                single = len(least) < 2 or least[0] + least[1] > room
                if not single:
                    if len(least) == 3 and sum(least) <= room:
                        break
                    # at most two others fit: the best pair must not outweigh the best single piece
                    top, hi = 0, len(order) - 1
                    for lo, a in enumerate(order):
                        while hi >= 0 and a + order[hi] > room:
                            hi -= 1
                        if hi < lo:
                            break
                        if hi > lo or others[a] > 1:
                            top = max(top, a + order[hi])
                        elif hi - 1 > lo:
                            top = max(top, a + order[hi - 1])
                    if top > best:
                        break
                if best == x:
                    n = counts[x] // 2
                    out.append((n, [(x, 2)]))
                    counts[x] -= 2 * n
                    if not counts[x]:
                        del counts[x]
                else:
                    fix(min(counts[x], counts[best]), x, best)
                changed = True
    return out


def best_fit(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Best fit in decreasing order; a step moves whole groups of equal sequences."""
    groups: dict[int, list[Pattern]] = {}  # by room left
    for x in sorted(counts, reverse=True):
        left = counts[x]
        while left:
            room = next((r for r in range(x, capacity) if groups.get(r)), capacity)
            many, inside = groups[room].pop() if room < capacity else (left, [])
            each = room // x
            full = min(many, left // each)
            rest = []
            if full:
                rest.append((full, each))
            left -= full * each
            many -= full
            if many and 0 < left < each:
                rest.append((1, left))
                left, many = 0, many - 1
            for n, k in rest:
                groups.setdefault(room - k * x, []).append((n, [*inside, (x, k)]))
            if many and room < capacity:
                groups.setdefault(room, []).append((many, inside))
    return [g for r in sorted(groups) for g in groups[r]]


def slots(patterns: list[Pattern]) -> np.ndarray:
    """Rows (length, first rank, sequences, first sequence, offset), by length and rank."""
    rows, used, base = [], {}, 0
    for many, inside in patterns:
        offset = 0
        for length, times in inside:
            rows.append((length, used.get(length, 0), many, base, offset))
            used[length] = used.get(length, 0) + many * times
            offset += length * times
        base += many
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null or blank text: the single id 0. Null doc_id: packed like any other. Repeated rows: packed
    each. Ties between pieces of one length go by doc_id, piece and checksum. Other columns are
    ignored. Empty table: empty result. Only texts longer than ``capacity`` ids are cut.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "packing")
    cut = scratch.save(pieces(docs, path or vocabulary_path(), capacity), "pieces")
    counts = {r.length: r["count"] for r in cut.groupBy("length").count().collect()}  # at most ``capacity`` rows
    fixed = reduce(counts, capacity)
    table = spark.sparkContext.broadcast(slots(fixed + best_fit(counts, capacity)))
    # a rank among the pieces of each length: the place within a salted share, after the shares before it
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    salted = cut.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(parts)))
    before = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = before.withColumn("skip", F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n"))
    before = scratch.save(before.select("length", "salt", "skip"), "before")
    place = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")) - 1
    ranked = salted.withColumn("place", place).join(before, ["length", "salt"]).withColumn("rank", F.col("place") + F.col("skip"))

    def assign(batches):
        s = table.value
        key = (s[:, 0] << 48) + s[:, 1]
        for b in batches:
            if b.num_rows:
                length, rank = np.asarray(b.column("length")), np.asarray(b.column("rank"))
                at = np.searchsorted(key, (length << 48) + rank, "right") - 1
                turn, lane = np.divmod(rank - s[at, 1], s[at, 2])
                yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(s[at, 3] + lane), pa.array(s[at, 4] + turn * length)], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank")
    return ranked.mapInArrow(T.frugal(assign), "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
