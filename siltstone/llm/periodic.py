"""Runs of periodic words in a text, on a harmonic grid of longest common extensions.

A run of period p has two neighbouring multiples of p in it, so each run shows at a pair jp, (j+1)p of the
grid: how far the words agree from there on forward, and how far backward, gives its ends. There are n/1 + n/2 +
... = O(n log n) such pairs. The extensions are minima over the longest common prefixes of neighbours in a suffix
array, one array of the words and one of the reversed words, with tables for range minima.

Two facts save work and lose nothing, since a run has at least four periods and six words. From the first
multiple of p in a run, at least four words agree, so only grid pairs whose four words agree are asked.
And a text in which no four words come twice has no run, so it needs no array.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from siltstone.llm import _text as T
from siltstone.scratch import Scratch

LEAST, PERIODS = 6, 4
#: Words that agree from the first grid point in a run (module docstring); LEAST - 2 and PERIODS allow for no more.
HEAD = 4
BLOCK = 32
#: Pairs of the grid that are asked at a time.
GRID = 1 << 20


def _dense(x: np.ndarray) -> np.ndarray:
    """Ranks 0, 1, ... of the values, equal for equal ones."""
    order = np.argsort(x, kind="stable")
    out = np.empty(len(x), np.int64)
    ordered = x[order]
    out[order] = np.cumsum(np.concatenate([[0], ordered[1:] != ordered[:-1]])) if len(x) else 0
    return out


def suffixes(word: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array and ranks of texts laid end to end; ``end``: for each word, the end of its text.

    Prefix doubling: a round sorts only suffixes that are not told apart yet. A suffix that ends sorts before
    longer ones it begins; those that end as equals are told apart by their place.
    """
    n = len(word)
    rank = _dense(word) + 1
    order = np.argsort(rank, kind="stable")
    # ranks become places: the first place of the group
    first = np.searchsorted(rank[order], rank[order])
    place = np.empty(n, np.int64)
    place[order] = first
    width = 1
    open_ = np.flatnonzero(_tied(first))  # places whose group has several
    while len(open_):
        at = order[open_]
        after = at + width
        inside = after < end[at]
        second = np.where(inside, place[np.minimum(after, n - 1)], -1)
        if not inside.any():  # all of them have ended
            second = at  # told apart by their place
        key = np.lexsort((at, second, place[at])) if not inside.any() else np.lexsort((second, place[at]))
        at, second, group = at[key], second[key], place[at][key]
        order[open_] = at
        fresh = np.ones(len(at), bool)
        fresh[1:] = (group[1:] != group[:-1]) | (second[1:] != second[:-1])
        head = np.flatnonzero(fresh)
        place[at] = open_[head][np.cumsum(fresh) - 1]
        open_ = open_[_tied(place[at])]
        width *= 2
    return order, place


def _tied(sorted_: np.ndarray) -> np.ndarray:
    """Which values of a sorted array have an equal neighbour."""
    same = sorted_[1:] == sorted_[:-1]
    return np.concatenate([same, [False]]) | np.concatenate([[False], same]) if len(sorted_) else np.zeros(0, bool)


class Extension:
    """Longest common extensions of two places of one text, by suffix array and range minima."""

    def __init__(self, word: np.ndarray, end: np.ndarray):
        self.order, self.place = suffixes(word, end)
        n = len(word)
        # common prefixes of neighbours, doubling widths over names of ranges
        names, a, b = T.Ranges(word), self.order[:-1], self.order[1:]
        room = np.minimum(end[a] - a, end[b] - b)
        low, high = np.zeros(len(a), np.int64), room.copy()
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                break
            middle = (low[open_] + high[open_] + 1) // 2
            same = names.names(a[open_], a[open_] + middle) == names.names(b[open_], b[open_] + middle)
            low[open_] = np.where(same, middle, low[open_])
            high[open_] = np.where(same, high[open_], middle - 1)
        self.common = np.append(low, 0)
        pad = -n % BLOCK
        grid = np.concatenate([self.common, np.full(pad, 1 << 40)]).reshape(-1, BLOCK)
        self.up = np.minimum.accumulate(grid, 1).ravel()  # from the block's begin
        self.down = np.minimum.accumulate(grid[:, ::-1], 1)[:, ::-1].ravel()  # to the block's end
        self.levels = [grid.min(1)]
        while len(self.levels[-1]) > 1 << (len(self.levels) - 1):
            t, half = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(t[: len(t) - half], t[half:]))

    def _least(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Minima of common[lo:hi], lo < hi."""
        last = hi - 1
        a, b = lo // BLOCK, last // BLOCK
        out = np.minimum(self.down[lo], self.up[last])
        wide = np.flatnonzero(b - a > 1)
        if len(wide):
            x, y = a[wide] + 1, b[wide]
            level = np.frexp((y - x).astype(np.float64))[1] - 1
            for k in np.unique(level):
                at = wide[level == k]
                t = self.levels[int(k)]
                out[at] = np.minimum(out[at], np.minimum(t[a[at] + 1], t[b[at] - (1 << int(k))]))
        near = np.flatnonzero(a == b)
        if len(near):
            least = self.common[lo[near]].copy()
            for step in range(1, BLOCK):
                least = np.minimum(least, self.common[np.minimum(lo[near] + step, last[near])])
            out[near] = least
        return out

    def of(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words agree from places i and j on; i != j, both in one text."""
        if not len(i):
            return np.zeros(0, np.int64)
        a, b = self.place[i], self.place[j]
        return self._least(np.minimum(a, b), np.maximum(a, b))


def runs(word: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, length, period) of every run, by row, start and period; ``rows``: offsets of the texts, n+1."""
    none = np.zeros(0, np.int64)
    sizes = np.diff(rows)
    # texts in which some HEAD words come twice
    starts = T.window_starts(rows, HEAD)
    owner = np.repeat(np.arange(len(sizes)), np.maximum(sizes - HEAD + 1, 0))
    head = T.Ranges(word).names(starts, starts + HEAD)
    key = T.mix(head) ^ T.mix(owner.astype(np.uint64))
    order = np.argsort(key, kind="stable")
    twice = np.zeros(len(sizes), bool)
    twice[owner[order[_tied(key[order])]]] = True
    which = np.flatnonzero(twice & (sizes >= LEAST))
    if not len(which):
        return none, none, none, none
    old = T.spread(rows[which], sizes[which])
    w, size = word[old], sizes[which]
    first = np.concatenate([[0], np.cumsum(size)])
    begin, end = np.repeat(first[:-1], size), np.repeat(first[1:], size)
    n = len(w)
    forward = Extension(w, end)
    back = Extension(w[::-1].copy(), n - begin[::-1])
    four = np.full(n, -1, np.int64)  # names of HEAD words; texts' last words have none
    spots = T.window_starts(first, HEAD)
    four[spots] = T.signed(T.Ranges(w).names(spots, spots + HEAD))
    ends = np.zeros(n, bool)
    ends[spots] = True
    # the grid: every text with every period, in slices of about GRID pairs jp, (j+1)p
    text = np.repeat(np.arange(len(size)), size // PERIODS)
    step = T.spread(np.ones(len(size), np.int64), size // PERIODS)
    points = -(-size[text] // step) - 1
    total = np.concatenate([[0], np.cumsum(points)])
    found, at = [], 0
    while at < len(step):
        to = max(int(np.searchsorted(total, total[at] + GRID, "right")) - 1, at + 1)
        p = np.repeat(step[at:to], points[at:to])
        i = np.repeat(first[text[at:to]], points[at:to]) + T.spread(np.zeros(to - at, np.int64), points[at:to]) * p
        at = to
        j = i + p
        same = ends[i] & ends[j] & (four[i] == four[j])
        i, j, p = i[same], j[same], p[same]
        ahead, behind = forward.of(i, j), np.zeros(len(i), np.int64)
        inner = np.flatnonzero(i > begin[i])
        behind[inner] = back.of(n - i[inner], n - j[inner])
        start, length = i - behind, p + ahead + behind
        long_ = length >= np.maximum(LEAST, PERIODS * p)
        if long_.any():
            found.append(np.unique(np.stack([start[long_], start[long_] + length[long_], p[long_]]), axis=1))
    if not found:
        return none, none, none, none
    start, stop, period = np.hstack(found)
    order = np.lexsort((period, stop, start))  # of equal stretches the smallest period stays
    start, stop, period = start[order], stop[order], period[order]
    fresh = np.ones(len(start), bool)
    fresh[1:] = (start[1:] != start[:-1]) | (stop[1:] != stop[:-1])
    start, stop, period = start[fresh], stop[fresh], period[fresh]
    order = np.lexsort((period, start))
    start, stop, period = start[order], stop[order], period[order]
    row = np.searchsorted(first, start, "right") - 1
    return which[row], start - first[row], stop - start, period


def rewritten(doc_id: int | None, n: int) -> tuple[int, int]:
    """(a, p) of a text of n words: words from a on repeat the p words there; (n, 1) for those left alone."""
    if doc_id is None or not n:
        return n, 1
    g, rest = divmod(zlib.crc32(str(doc_id).encode()), 10)
    if rest:
        return n, 1
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


def find_runs(docs: DataFrame, rewrite: bool = False) -> DataFrame:
    """Rows (doc_id, n_words, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256, runs).

    ``runs`` lists every run as (start, length, period), by start and then period; the columns before give the
    longest one (ties: smallest start, then period) and the digests. ``collapsed_sha256`` is of the words that
    stay when each run keeps its first period. With ``rewrite``, texts are first made periodic by their
    doc_id's checksum, as the query's contract says; a null doc_id leaves its text alone.

    Null and empty texts: no words, no run, nulls for the longest, digests of nothing. Texts of any length are
    worked through whole. Null and repeated doc_id and repeated rows: a row each. Other columns are ignored.
    Empty table: empty result. Words are told apart by their 64-bit names.
    """
    Scratch(docs.sparkSession, "periodic")  # batches that fit beside the heap

    def run(batches):
        for b in T.slices(batches):
            text, ids = b.column("text"), b.column("doc_id").to_pylist()
            w = T.words(text)
            data, _ = T.utf8(text)
            body, rows, count = data.tobytes(), w.rows.astype(np.int64), w.counts.astype(np.int64)
            source = np.arange(len(w.hash))
            if rewrite:
                for k, (doc, n) in enumerate(zip(ids, count.tolist())):
                    a, p = rewritten(doc, n)
                    if a < n:
                        source[rows[k] + a : rows[k + 1]] = rows[k] + a + np.arange(n - a) % p
            row, start, length, period = runs(w.hash[source], rows)
            # words after the first period of a run go
            edge = np.zeros(len(source) + 1, np.int64)
            np.add.at(edge, rows[row] + start + period, 1)
            np.add.at(edge, rows[row] + start + length, -1)
            kept = np.flatnonzero(np.cumsum(edge[:-1]) == 0)
            cut = np.searchsorted(kept, rows)
            first, last = w.start[source[kept]].tolist(), w.end[source[kept]].tolist()
            mine = np.searchsorted(row, np.arange(b.num_rows + 1))
            out = []
            for k in range(b.num_rows):
                lo, hi = mine[k], mine[k + 1]
                spans = list(zip(start[lo:hi].tolist(), length[lo:hi].tolist(), period[lo:hi].tolist()))
                best = min(spans, key=lambda x: (-x[1], x[0], x[2]), default=(None, None, None))
                words = b" ".join(map(body.__getitem__, map(slice, first[cut[k] : cut[k + 1]], last[cut[k] : cut[k + 1]])))
                out.append((
                    len(spans), *best, None if best[0] is None else 1000 * best[1] // best[2],
                    hashlib.sha256("".join(f"{s},{n},{p}\n" for s, n, p in spans).encode()).hexdigest(),
                    hashlib.sha256(words).hexdigest(), [{"start": s, "length": n, "period": p} for s, n, p in spans],
                ))
            kinds = [*[pa.int64()] * 5, pa.string(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))]
            columns = [pa.array([r[j] for r in out], t) for j, t in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(count), *columns], NAMES)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(T.frugal(run), SCHEMA.format(kind))


NAMES = ["doc_id", "n_words", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256", "runs"]
SCHEMA = (
    "doc_id {}, n_words long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, collapsed_sha256 string, runs array<struct<start: long, length: long, period: long>>"
)
