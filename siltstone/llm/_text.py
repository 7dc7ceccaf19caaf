"""Vectorised words and word windows over Arrow string columns.

A word is a run of bytes outside U+0020 and U+0009-U+000D; UTF-8 keeps these bytes out of all other
characters. Words are named by 64-bit hashes, computed for a whole block of text at once: eight bytes at a
time go through a bijective mixing, so a name is no linear function of the word, and words of up to eight
bytes and equal length never share one.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa

U = np.uint64
BLOCK = 1 << 20
_NONWS = np.ones(256, bool)
_NONWS[[9, 10, 11, 12, 13, 32]] = False
_ALNUM = np.ones(256, bool)
_ALNUM[:128] = [chr(i).isalnum() for i in range(128)]
_RUN = np.array([0 if i > 127 or i < 33 or i in (39, 127) else 1 if chr(i).isalnum() else 2 for i in range(256)], np.uint8)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SEEDS = [int(x) | 1 for x in np.random.RandomState(20240229).randint(1, 2**63 - 1, 64, dtype=np.int64)]
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], U)
#: Longer words are named by a digest of their bytes.
LANES = 256


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> U(33))
    x *= U(0xFF51AFD7ED558CCD)
    x ^= x >> U(33)
    x *= U(0xC4CEB9FE1A85EC53)
    x ^= x >> U(33)
    return x


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n+1 offsets of its rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, off - off[0]


def _cuts(data: np.ndarray, off: np.ndarray) -> Iterator[tuple[int, int]]:
    """Blocks of about BLOCK bytes that end at a row's end or at white space."""
    at, n = 0, len(data)
    while at < n:
        end = at + BLOCK
        if end >= n:
            yield at, n
            return
        row = int(off[np.searchsorted(off, end)])
        while end < row:
            part = np.flatnonzero(~_NONWS[data[end : min(row, end + 65536)]])
            if len(part):
                end += int(part[0])
                break
            end = min(row, end + 65536)
        yield at, end
        at = end


def _names(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit name for each byte range."""
    size = end - start
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    lanes = np.ndarray(len(data) + 1, "<u8", padded, 0, (1,))
    h = mix(size.astype(U) * U(0x2545F4914F6CDD1D) + U(1))
    left = np.flatnonzero(size <= LANES)
    for at in range(0, LANES, 8):
        left = left[size[left] > at]
        if not len(left):
            break
        h[left] = mix((h[left] * U(_SEEDS[41]) if at else h[left]) ^ (lanes[start[left] + at] & _MASKS[np.minimum(size[left] - at, 8)]))
    for i in np.flatnonzero(size > LANES):
        h[i] = int.from_bytes(blake2b(data[start[i] : end[i]], digest_size=8).digest(), "little")
    return h


@dataclass
class Words:
    """hash: one 64-bit name per word; rows: offsets of the rows in it; start, end: byte places."""

    hash: np.ndarray
    rows: np.ndarray
    start: np.ndarray | None = None
    end: np.ndarray | None = None

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.rows)


def words(column: pa.Array, lower: bool = False, spans: bool = True, alphanumeric: bool = False, runs: bool = False) -> Words:
    """All words of every row. lower: A-Z count as a-z. alphanumeric: ASCII punctuation separates words too.
    runs: a word is also cut between ASCII letters or digits and ASCII punctuation (but for apostrophes)."""
    data, off = utf8(column)
    kept = _ALNUM if alphanumeric else _NONWS
    hashes, starts, ends = [], [], []
    for lo, hi in _cuts(data, off):
        b = data[lo:hi]
        ok = kept[b]
        first, last = ok.copy(), ok.copy()
        first[1:] &= ~ok[:-1]
        last[:-1] &= ~ok[1:]
        a, z = np.searchsorted(off, lo, "right"), np.searchsorted(off, hi, "left")
        if runs:
            kind = _RUN[b]
            turn = (kind[1:] ^ kind[:-1]) == 3  # 1 beside 2
            first[1:] |= turn
            last[:-1] |= turn
        edge = off[a:z] - lo
        first[edge] = ok[edge]
        edge = edge[edge > 0]
        last[edge - 1] = ok[edge - 1]
        s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
        h = _names(_LOWER[b] if lower else b, s, e)
        hashes.append(h)
        starts.append(s + lo)
        ends.append(e + lo)
    h = np.concatenate(hashes) if hashes else np.zeros(0, U)
    s = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    e = np.concatenate(ends) if ends else np.zeros(0, np.int64)
    rows = np.searchsorted(s, off)
    return Words(h, rows, s if spans else None, e if spans else None)


def window_rows(rows: np.ndarray, n: int) -> np.ndarray:
    """Offsets of the rows among their windows of n words."""
    return np.concatenate([[0], np.cumsum(np.maximum(np.diff(rows) - n + 1, 0))])


def window_starts(rows: np.ndarray, n: int) -> np.ndarray:
    """The first word of every window of n words that lies in one row."""
    counts = np.maximum(np.diff(rows) - n + 1, 0)
    return spread(rows[:-1], counts)


def spread(first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """first[0], first[0]+1, ... counts[0] values, then from first[1] on."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(counts)
    return np.arange(total) + np.repeat(first - (ends - counts), counts)


def short_windows(h: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    """Names of windows of a few words."""
    out = np.zeros(len(starts), U)
    for j in range(n):
        out += h[starts + j] * U(_SEEDS[j])
        out ^= out >> U(29)
    return mix(out)


class Ranges:
    """Names of any word range of a batch: tables of the names of all ranges of 1, 2, 4, ... words, each mixed from two halves.

    A range is named by the two longest table entries that cover it, and its length.
    """

    def __init__(self, h: np.ndarray, salt: int = 0):
        self.salt = U(_SEEDS[42 + salt])
        self.tables = [mix(h + self.salt)]

    def _table(self, level: int) -> np.ndarray:
        while len(self.tables) <= level:
            t, half = self.tables[-1], 1 << (len(self.tables) - 1)
            self.tables.append(mix(t[: max(len(t) - half, 0)] * self.salt + t[half:]))
        return self.tables[level]

    def names(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        size = end - start
        level = np.frexp(size.astype(np.float64))[1] - 1  # floor of log2; -1 for none
        out = mix(size.astype(U) + self.salt)
        for k in np.unique(level):
            if k >= 0:
                t, at = self._table(int(k)), np.flatnonzero(level == k)
                out[at] = mix(mix(t[start[at]] ^ out[at]) * self.salt + t[end[at] - (1 << int(k))])
        return out


try:
    _libc = ctypes.CDLL("libc.so.6")
except OSError:  # another C library; its allocator is left alone
    _libc = None


def release() -> None:
    """Give memory that is free back to the system, so that a worker that waits for its next task holds little."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if _libc is not None and hasattr(_libc, "malloc_trim"):
        _libc.malloc_trim(0)


def frugal(run):
    """``run`` for mapInArrow, followed by ``release``."""

    def wrapped(batches):
        yield from run(batches)
        release()

    return wrapped


def slices(batches, most: int = 2 << 20, column: str = "text"):
    """Cut Arrow batches so that each holds about ``most`` bytes of text, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, off = utf8(batch.column(column))
        at = 0
        while at < batch.num_rows:
            end = int(np.searchsorted(off, off[at] + most, "right")) - 1
            end = min(max(end, at + 1), batch.num_rows)
            yield batch.slice(at, end - at)
            at = end


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
