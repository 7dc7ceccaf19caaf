"""Counts keyed by one or two 64-bit names, exchanged as packed arrays.

A map task combines its counts in memory and, whenever enough have gathered, sends each shard one
binary row: the sorted distinct pairs and their counts. A shard is a range of a name's upper bits, and
each shard is one partition; it merges what it gets with sorts of whole arrays. Hot keys cost one entry
per row sent, however often they occur.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

_U = np.uint64
BLOBS = "part int, blob binary"


def shard_of(name: np.ndarray, parts: int) -> np.ndarray:
    return ((name >> _U(32)) * _U(parts) >> _U(32)).astype(np.int32)


def combine(a: np.ndarray, b: np.ndarray, c: np.ndarray):
    """Sorted distinct pairs and the sums of their counts."""
    if not len(a):
        return a, b, c
    order = np.lexsort((b, a))
    a, b, c = a[order], b[order], c[order]
    head = np.ones(len(a), bool)
    head[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    at = np.flatnonzero(head)
    return a[at], b[at], np.add.reduceat(c, at)


def combine_one(a: np.ndarray, c: np.ndarray):
    """The same for single names."""
    if not len(a):
        return a, c
    order = np.argsort(a)
    a, c = a[order], c[order]
    head = np.ones(len(a), bool)
    head[1:] = a[1:] != a[:-1]
    at = np.flatnonzero(head)
    return a[at], np.add.reduceat(c, at)


def pack(a: np.ndarray, b: np.ndarray | None, c: np.ndarray) -> bytes:
    """Runs of equal a as (name, length); b whole; counts in one byte, larger ones listed."""
    head = np.ones(len(a), bool)
    head[1:] = a[1:] != a[:-1]
    at = np.flatnonzero(head)
    runs = np.diff(np.append(at, len(a))).astype(np.uint32)
    big = np.flatnonzero(c >= 255)
    sizes = np.array([len(a), len(at), len(big), b is not None], np.uint32)
    parts = [sizes.tobytes(), a[at].tobytes()]
    if b is not None:
        parts += [runs.tobytes(), b.tobytes()]
    parts += [np.minimum(c, 255).astype(np.uint8).tobytes(), big.astype(np.uint32).tobytes(), c[big].astype(np.int64).tobytes()]
    return b"".join(parts)


def unpack(blob: bytes):
    n, runs, big, pairs = np.frombuffer(blob, np.uint32, 4)
    at = 16

    def take(kind, count):
        nonlocal at
        x = np.frombuffer(blob, kind, int(count), at)
        at += x.nbytes
        return x

    a, b = take(np.uint64, runs), None
    if pairs:
        a = np.repeat(a, take(np.uint32, runs))
        b = take(np.uint64, n)
    c = take(np.uint8, n).astype(np.int64)
    where = take(np.uint32, big)
    c[where] = take(np.int64, big)
    return a, b, c


class Sender:
    """Gathers counts and yields rows (part, blob)."""

    def __init__(self, parts: int, pairs: bool, most: int = 2_000_000, shard=None):
        self.parts, self.pairs, self.most = parts, pairs, most
        self.shard = shard or (lambda a, b: shard_of(a, parts))
        self.held: list = []
        self.size = 0

    def add(self, a, b=None, c=None):
        c = np.ones(len(a), np.int64) if c is None else c
        if self.pairs:
            self.held.append(combine(a, b, c))
        else:
            a, c = combine_one(a, c)
            self.held.append((a, None, c))
        self.size += len(self.held[-1][0])
        if self.size > self.most:
            before = self.size
            self._merge()
            if self.size > before // 2:
                yield from self.flush()

    def _merge(self):
        self.held = [merged(self.held)] if self.held else []
        self.size = len(self.held[0][0]) if self.held else 0

    def flush(self):
        self._merge()
        if not self.size:
            return
        a, b, c = self.held[0]
        part = self.shard(a, b)
        order = np.argsort(part, kind="stable")
        cut = np.searchsorted(part[order], np.arange(self.parts + 1))
        ids, blobs = [], []
        for p in range(self.parts):
            at = order[cut[p] : cut[p + 1]]
            if len(at):
                ids.append(p)
                blobs.append(pack(a[at], None if b is None else b[at], c[at]))
        self.held, self.size = [], 0
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array(blobs, pa.binary())], ["part", "blob"])


def merged(parts: list):
    """One sorted table of several."""
    a = np.concatenate([x[0] for x in parts])
    c = np.concatenate([x[2] for x in parts])
    if parts[0][1] is None:
        a, c = combine_one(a, c)
        return a, None, c
    return combine(a, np.concatenate([x[1] for x in parts]), c)


def received(batches, most: int = 1_500_000):
    """(part, (a, b, c)) of a shard's partition: everything it was sent, merged as it comes."""
    part, held, size, base = None, [], 0, 0
    for batch in batches:
        for p, blob in zip(batch.column("part").to_pylist(), batch.column("blob")):
            part = p
            held.append(unpack(blob.as_buffer()))
            size += len(held[-1][2])
            if size > most + 2 * base:
                held = [merged(held)]
                size = base = len(held[0][2])
    if held:
        yield part, merged(held)


def deal(frame: DataFrame, parts: int) -> DataFrame:
    return frame.repartitionById(parts, frame["part"])


# files of arrays in the shared folder


def put(folder: str, name: str, array: np.ndarray) -> None:
    """Write an array; a task that runs twice replaces it by the same bytes."""
    from pyarrow import fs

    store, base = fs.FileSystem.from_uri(folder)
    store.create_dir(base, recursive=True)
    spare = f"{base}/.{name}-{uuid.uuid4().hex}"
    with store.open_output_stream(spare, compression=None) as out:
        out.write(memoryview(np.ascontiguousarray(array)).cast("B") if array.nbytes else b"")
    store.move(spare, f"{base}/{name}")


_open: dict[str, np.ndarray] = {}


def get(folder: str, name: str, kind) -> np.ndarray:
    """A read-only memory map of an array; empty if it was never written."""
    from pyarrow import fs

    key = f"{folder}/{name}"
    if key not in _open:
        store, base = fs.FileSystem.from_uri(folder)
        path = f"{base}/{name}"
        info = store.get_file_info(path)
        if info.type == fs.FileType.NotFound or not info.size:
            _open[key] = np.zeros(0, kind)
        else:
            if urlparse(folder).scheme not in ("", "file"):  # a store that cannot be mapped: this worker keeps a copy
                local = os.path.join(tempfile.mkdtemp(), name)
                with store.open_input_stream(path) as src, open(local, "wb") as dst:
                    while piece := src.read(1 << 22):
                        dst.write(piece)
                path = local
            _open[key] = np.memmap(path, kind, "r")
    return _open[key]
