"""Benchmark passages in training documents, found by spaced seeds.

A seed is a fixed mask of at most ``SPAN`` tokens; masked-out places may differ. The masks of a length
hit every stretch of it that ``verify`` takes, see ``masks_for``. Test items are indexed by the hash of
the kept tokens at every place and mask. Documents are scanned with the same hashes; a hit
fixes a diagonal (document place minus item place), along which the whole item is laid over the
document and compared token by token. Stretches with a share of equal tokens of at least ``IDENTITY``
count, and a document is contaminated by an item of which they cover ``COVER`` tokens (or all).

Tokens are alphanumeric words in lower case (A-Z). Tasks index the items in blocks of about ``INDEX`` seeds
each and write the blocks, sorted, to the shared folder; workers map them, so documents are read once for all
blocks and neither table passes through the driver.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm import _exchange as X
from siltstone.llm import _text as T
from siltstone.llm._columns import quoted
from siltstone.scratch import Scratch

SPAN, IDENTITY, COVER, INDEX = 12, 0.8, 13, 2_000_000
#: Pairs of equal seeds that are held at a time.
HITS = 4_000_000
# Each mask keeps 7 tokens; every window of 12 with up to 2 differing tokens holds one of them.
MASKS = ("11111011", "110101111", "11001100111", "11110010101")
# Fixed values for whole items of 10 and 11 tokens, of which up to 2 inner ones differ.
SHORT = {10: ("1110111", "11011011", "1111000011", "10111101", "110001111"), 11: ("1111011", "110001111", "1101100011")}
_U = np.uint64
MATCHES = "doc_id long, item_id long, n_matched long, n_item_words long, doc_start long, doc_end long, similarity double"


def _seed(h: np.ndarray, starts: np.ndarray, mask: str) -> np.ndarray:
    out = np.full(len(starts), sum(1 << i for i, c in enumerate(mask) if c == "1") + (len(mask) << 32), _U)
    for i, c in enumerate(mask):
        if c == "1":
            out = (out ^ h[starts + i]) * _U(0x9E3779B97F4A7C15)
            out ^= out >> _U(32)
    return T.mix(out)


def masks_for(n: int) -> tuple[str, ...]:
    """The masks of items of n tokens.

    Items shorter than SPAN count as a whole, so their outer tokens must agree: none of fewer than 5
    tokens may differ, one inner token of 5 to 9 and two of 10 and 11.
    """
    if n >= SPAN:
        return MASKS
    if n in SHORT:
        return SHORT[n]
    if n < 5:
        return ("1" * n,)
    step = min(n - 4, (n - 1) // 2)  # at least 4 tokens stay
    return tuple("".join("0" if at <= i < min(at + step, n - 1) else "1" for i in range(n)) for at in range(1, n - 1, step))


class Index:
    """Seeds of a block of items, with the masks of each item's length. Items without a token have no seed."""

    PARTS = {"ids": np.int64, "known": bool, "hash": _U, "rows": np.int64, "names": _U, "item": np.int64, "place": np.int64, "bits": bool}

    def __init__(self, ids: list[int | None], texts: list[str]):
        w = T.words(pa.array(texts, pa.string()), lower=True, spans=False, alphanumeric=True)
        self.ids, self.known = np.array([i or 0 for i in ids], np.int64), np.array([i is not None for i in ids], bool)
        self.hash, self.rows = w.hash, w.rows.astype(np.int64)
        size = np.minimum(w.counts, SPAN)
        lengths: dict[str, list[int]] = {}
        for n in sorted({int(n) for n in size if n}):
            for mask in masks_for(n):
                lengths.setdefault(mask, []).append(n)
        self.masks = list(lengths)
        names, item, place = [np.zeros(0, _U)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for mask, sought in lengths.items():
            starts = T.window_starts(w.rows, len(mask))
            row = np.searchsorted(w.rows, starts, "right") - 1
            ok = np.isin(size[row], sought)
            starts, row = starts[ok], row[ok]
            names.append(_seed(w.hash, starts, mask))
            item.append(row)
            place.append(starts - w.rows[row])
        names, item, place = (np.concatenate(x) for x in (names, item, place))
        order = np.argsort(names, kind="stable")
        self.names, self.item, self.place = names[order], item[order], place[order]
        self.shift = _U(max(64 - max(len(names) * 16, 1 << 10).bit_length(), 0))
        self.bits = np.zeros(1 << (64 - int(self.shift)), bool)
        self.bits[self.names >> self.shift] = True

    def put(self, folder: str, name: str) -> None:
        for part, kind in self.PARTS.items():
            X.put(folder, f"{name}-{part}", getattr(self, part).astype(kind))

    @classmethod
    def get(cls, folder: str, name: str, masks: list[str], shift: int) -> Index:
        out = cls.__new__(cls)
        for part, kind in cls.PARTS.items():
            setattr(out, part, X.get(folder, f"{name}-{part}", kind))
        out.masks, out.shift = masks, _U(shift)
        return out

    def id_of(self, item: int) -> int | None:
        return int(self.ids[item]) if self.known[item] else None

    def hits(self, w: T.Words, seeds: dict[str, tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Distinct (row, item, diagonal) of the seeds that occur in the words. ``seeds``: places and names by mask."""
        found = [np.zeros((0, 3), np.int64)]
        for mask in self.masks:
            starts, names = seeds[mask]
            at = np.flatnonzero(self.bits[names >> self.shift])
            names, starts = names[at], starts[at]
            a, b = np.searchsorted(self.names, names, "left"), np.searchsorted(self.names, names, "right")
            total = np.concatenate([[0], np.cumsum(b - a)])
            lo = 0
            while lo < len(a):  # a word repeated on both sides meets itself often: a slice at a time
                hi = max(int(np.searchsorted(total, total[lo] + HITS, "right")) - 1, lo + 1)
                entry = T.spread(a[lo:hi], (b - a)[lo:hi])
                at = np.repeat(starts[lo:hi], (b - a)[lo:hi])
                row = np.searchsorted(w.rows, at, "right") - 1
                found.append(np.unique(np.stack([row, self.item[entry], at - w.rows[row] - self.place[entry]], 1), axis=0))
                lo = hi
        return np.unique(np.concatenate(found), axis=0)


def seeds_of(w: T.Words, masks) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Places and names of the seeds of some words, by mask."""
    out = {}
    for mask in masks:
        starts = T.window_starts(w.rows, len(mask))
        out[mask] = starts, _seed(w.hash, starts, mask)
    return out


def _stretches(same: np.ndarray, least: int) -> np.ndarray:
    """Which places lie in a stretch of ``least`` or more whose share of equal tokens is high enough.

    Every window of ``least`` places with that share counts, cut back to its outer equal tokens.
    """
    n = len(same)
    covered = np.zeros(n, bool)
    if n < least:
        return covered
    total = np.concatenate([[0], np.cumsum(same)])
    for s in np.flatnonzero(total[least:] - total[:-least] >= IDENTITY * least):
        covered[s : s + least] = True
    return covered & same


def verify(index: Index, w: T.Words, row: int, item: int, diagonals: np.ndarray):
    """(matched item tokens, document range) of one item laid over one document, or None.

    Only diagonals with a stretch count, so more diagonals than the seeds name change nothing.
    """
    words, sought = w.hash[w.rows[row] : w.rows[row + 1]], index.hash[index.rows[item] : index.rows[item + 1]]
    need, least = min(COVER, len(sought)), min(SPAN, len(sought))
    places = []
    for d in np.sort(diagonals).tolist():
        a, b = max(0, -d), min(len(sought), len(words) - d)
        at = np.flatnonzero(_stretches(words[a + d : b + d] == sought[a:b], least)) + a
        if len(at):
            places.append((d, at))
    best, k = None, 0
    while k < len(places):
        covered, lo, hi = np.zeros(len(sought), bool), len(words), 0
        end = k
        while end < len(places) and (end == k or places[end][0] - places[end - 1][0] <= len(sought)):
            d, at = places[end]  # diagonals close by belong to one occurrence with insertions or deletions
            covered[at] = True
            lo, hi = min(lo, d + int(at[0])), max(hi, d + int(at[-1]) + 1)
            end += 1
        k = end
        n = int(covered.sum())
        if n >= IDENTITY * need and (n >= need or hi - lo >= need) and (best is None or n > best[0]):
            best = n, lo, hi
    return best


def index_items(items: DataFrame, scratch: Scratch) -> list[tuple[str, list[str], int]]:
    """Index the items in blocks of about ``INDEX`` seeds, in tasks; (name, masks, shift) of each block.

    The driver gets one row for each block. An item of more than ``INDEX`` seeds is a block of its own.
    """
    folder = scratch.path
    items = items.select("item_id", "text").where("text IS NOT NULL")
    most = max(len(MASKS), *map(len, SHORT.values()))
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-int(chars) * most // (2 * INDEX)))  # a token takes two characters at least
    limit = INDEX // most

    def build(batches):
        part, k = TaskContext.get().partitionId(), 0

        def put(ids, texts):
            nonlocal k
            index = Index(ids, texts)
            if len(index.names):
                index.put(folder, f"{part}-{k}")
                yield pa.RecordBatch.from_arrays([pa.array([f"{part}-{k}"]), pa.array([json.dumps(index.masks)]), pa.array([int(index.shift)])], ["name", "masks", "shift"])
                k += 1

        ids, texts, size = [], [], 0
        for b in batches:
            counts = T.words(b.column("text"), alphanumeric=True, spans=False).counts.tolist()
            for item, text, n in zip(b.column("item_id").to_pylist(), b.column("text").to_pylist(), counts):
                if size and size + n > limit:
                    yield from put(ids, texts)
                    ids, texts, size = [], [], 0
                if n:
                    ids.append(item)
                    texts.append(text)
                    size += n
        if size:
            yield from put(ids, texts)

    dealt = items.coalesce(1) if blocks == 1 else items.repartition(blocks, F.xxhash64("item_id", "text"))
    found = dealt.sortWithinPartitions("item_id", "text").mapInArrow(T.frugal(build), "name string, masks string, shift long").collect()
    return [(r.name, json.loads(r.masks), r["shift"]) for r in sorted(found)]


def overlaps(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row per contaminated document and item: doc_id, item_id, n_matched, n_item_words, doc_start,
    doc_end (words of the document), similarity.

    Null or empty text and text without a letter or digit, on either side: no match. Null ids pass through.
    Repeated rows are matched each; an item's best occurrence is reported, of equal ones the first. Texts of any
    length are taken whole. Other columns are ignored. Empty tables: empty result.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "decontaminate")
    folder = scratch.path
    blocks = index_items(items, scratch)
    if not blocks:
        return spark.createDataFrame([], MATCHES)
    masks = sorted({m for _, mine, _ in blocks for m in mine})

    def run(batches):
        for b in T.slices(batches):
            w = T.words(b.column("text"), lower=True, spans=False, alphanumeric=True)
            seeds, ids, rows = seeds_of(w, masks), b.column("doc_id"), []
            for name, mine, shift in blocks:
                x = Index.get(folder, name, mine, shift)
                found = x.hits(w, seeds)
                cut = np.flatnonzero((found[1:, :2] != found[:-1, :2]).any(1)) + 1
                for part in np.split(found, cut):
                    if len(part):
                        row, item = int(part[0, 0]), int(part[0, 1])
                        got = verify(x, w, row, item, part[:, 2])
                        if got:
                            n = int(x.rows[item + 1] - x.rows[item])
                            rows.append((ids[row].as_py(), x.id_of(item), got[0], n, got[1], got[2], got[0] / max(1, got[2] - got[1])))
            if rows:
                kinds = [pa.int64()] * 6 + [pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), kinds)], [c.split()[0] for c in MATCHES.split(", ")])

    return docs.select("doc_id", "text").mapInArrow(T.frugal(run), MATCHES)


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents without any match, with all their columns, texts unchanged.

    Null texts match nothing and stay; so do rows without doc_id. Rows that share a doc_id go together if one
    of them matches. Ties do not matter: one match is enough. Empty tables: the documents as they are.
    """
    scratch = Scratch(docs.sparkSession, "decontaminate")
    bad = scratch.save(overlaps(docs, items).select("doc_id").distinct(), "bad")
    return docs.join(bad, "doc_id", "left_anti").select(quoted(docs.columns))
