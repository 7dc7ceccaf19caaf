"""Near-duplicate documents: banded MinHash, sequential Bayesian verification, exact confirmation.

1. Every document becomes a set of distinct word shingles and a signature of ``bands * rows`` minima.
   Documents with equal sets form one class and go on as a single representative.
2. Representatives that agree on a whole band are candidates. A bucket sends each member to a pivot
   (its smallest id), never all its pairs. Members that the pivot does not account for are compared
   with one another in later rounds, in blocks inside a task, see ``_rest``.
3. Signatures are compared batch by batch. After each batch the posterior of the similarity (uniform
   prior, so Beta(m+1, n-m+1) after m agreements out of n) decides: a pair whose probability to reach
   the threshold falls below ``miss`` is dropped.
4. Survivors are confirmed on their full sets; confirmed links give components.
"""

from __future__ import annotations

from functools import lru_cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm import _text as T
from siltstone.llm._columns import quoted
from siltstone.llm.components import components
from siltstone.scratch import Scratch

#: Ids are broadcast only up to this many (8 bytes each); beyond, the join is dealt by key.
BROADCAST_IDS = 1_000_000
#: Members of one block in the comparison of what pivots leave over.
BLOCK = 512


def _constants(k: int) -> tuple[np.ndarray, np.ndarray]:
    r = np.random.RandomState(7)
    return (r.randint(0, 2**32, k, dtype=np.uint64) | 1).astype(np.uint32), r.randint(0, 2**32, k, dtype=np.uint64).astype(np.uint32)


def shingle_sets(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle names of every row, and the offsets of the rows.

    A row of fewer words than ``size`` has its whole sequence as its only shingle; a row without words
    (or text) has none.
    """
    w = T.words(column, lower=True, spans=False)
    starts = T.window_starts(w.rows, size)
    names = T.short_windows(w.hash, starts, size)
    at = T.window_rows(w.rows, size)
    ranges = None
    out, counts = [], np.zeros(len(w.rows) - 1, np.int64)
    for i, n in enumerate(w.counts):
        if n >= size:
            one = np.unique(names[at[i] : at[i + 1]])
        elif n:
            ranges = ranges or T.Ranges(w.hash, 3)
            one = ranges.names(w.rows[i : i + 1], w.rows[i + 1 : i + 2])
        else:
            continue
        counts[i] = len(one)
        out.append(one)
    return np.concatenate(out) if out else np.zeros(0, np.uint64), np.concatenate([[0], np.cumsum(counts)])


def signatures(sets: np.ndarray, offsets: np.ndarray, k: int) -> np.ndarray:
    """A row of k 32-bit minima for every non-empty set."""
    starts = offsets[:-1][np.diff(offsets) > 0]
    a, b = _constants(k)
    out = np.empty((len(starts), k), np.uint32)
    x = (sets >> np.uint64(32)).astype(np.uint32)
    at, step = 0, 1 << 17
    while at < len(starts):  # blocks that stay in the cache
        end = max(at + 1, int(np.searchsorted(starts, starts[at] + step)))
        hi = starts[end] if end < len(starts) else len(x)
        part, cut = x[starts[at] : hi], starts[at:end] - starts[at]
        h = np.empty_like(part)
        for j in range(k):
            np.bitwise_xor(part, b[j], out=h)
            h *= a[j]
            out[at:end, j] = np.minimum.reduceat(h, cut)
        at = end
    return out


@lru_cache(maxsize=8)
def needed(batch: int, k: int, threshold: float, miss: float) -> list[tuple[int, int]]:
    """(n, m): after n compared minima a pair with fewer than m agreements is dropped."""
    out = []
    for n in [*range(batch, k, batch), k]:
        # P(S >= t) for Beta(m+1, n-m+1) is P(Binomial(n+1, t) <= m)
        total, m = 0.0, 0
        while m <= n:
            total += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if total >= miss:
                break
            m += 1
        out.append((n, m))
    return out


def survives(a: np.ndarray, b: np.ndarray, batch: int, threshold: float, miss: float) -> np.ndarray:
    """Indices of the signature pairs that the sequential test keeps."""
    left = np.arange(len(a))
    got, at = np.zeros(len(a), np.int32), 0
    for n, m in needed(batch, a.shape[1], threshold, miss):
        got[left] += (a[left, at:n] == b[left, at:n]).sum(1, dtype=np.int32)
        left, at = left[got[left] >= m], n
        if not len(left):
            break
    return left


def _matrix(column: pa.Array, k: int) -> np.ndarray:
    data, _ = T.utf8(column)
    return data.view(np.uint32).reshape(-1, k) if data.flags.aligned else data.copy().view(np.uint32).reshape(-1, k)


def near_duplicates(docs: DataFrame, threshold_percent: int = 85, shingle: int = 5, bands: int = 32, rows: int = 5, batch: int = 32, miss: float = 1e-9) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Linked are documents with ``100 * |A & B| >= threshold_percent * |A | B|`` on their shingle sets.
    A pair at the threshold shares no band with probability ``(1 - s**rows)**bands`` (7e-9 here).

    Null, empty or blank text: an empty set, linked with nothing, kept. Null doc_id: never linked,
    component_id null, kept. Repeated rows: each is answered; equal sets are one class. Ties do not
    arise, the smallest id names a component. Other columns are ignored. Empty table: empty result.
    """
    spark, k = docs.sparkSession, bands * rows
    scratch = Scratch(spark, "minhash")
    docs = docs.select("doc_id", "text")

    def sign(batches):
        for b in T.slices(batches):
            sets, off = shingle_sets(b.column("text"), shingle)
            n = np.diff(off)
            full = np.flatnonzero(n > 0)
            sig = signatures(sets, off, k)
            d1, d2 = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)
            if len(full):
                d1[full] = T.signed(T.mix(np.add.reduceat(T.mix(sets), off[:-1][full])))
                d2[full] = T.signed(T.mix(np.add.reduceat(T.mix(sets ^ np.uint64(0x5851F42D4C957F2D)), off[:-1][full])))
            where = np.full(len(n), -1)
            where[full] = np.arange(len(full))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n), pa.array(d1), pa.array(d2), pa.array([sig[i].tobytes() if i >= 0 else None for i in where], pa.binary())],
                ["doc_id", "n_shingles", "d1", "d2", "sig"],
            )

    signed = scratch.save(docs.mapInArrow(T.frugal(sign), "doc_id long, n_shingles long, d1 long, d2 long, sig binary"), "signed")
    classes = signed.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("n_shingles", "d1", "d2").agg(F.min("doc_id").alias("rep"), F.first("sig").alias("sig"))
    classes = scratch.save(classes, "classes")

    def banded(batches):
        for b in batches:
            if b.num_rows:
                sig = _matrix(b.column("sig"), k).reshape(b.num_rows, bands, rows).astype(np.uint64)
                h = np.zeros((b.num_rows, bands), np.uint64) + np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                for j in range(rows):
                    h = T.mix(h ^ sig[:, :, j])
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.asarray(b.column("rep")), bands)), pa.array(T.signed(h.ravel())), pa.array(np.tile(np.arange(bands, dtype=np.int32), b.num_rows))], ["rep", "bucket", "band"])

    member = scratch.save(classes.select("rep", "sig").mapInArrow(T.frugal(banded), "rep long, bucket long, band int"), "member")
    buckets = member.groupBy("bucket").agg(F.min("rep").alias("pivot"), F.count("*").alias("size")).where("size > 1")
    buckets = scratch.save(buckets, "buckets")
    shared = scratch.save(member.join(buckets, "bucket"), "shared")
    pairs = shared.where("rep <> pivot").select(F.col("pivot").alias("a"), F.col("rep").alias("b")).distinct()
    sigs = classes.select("rep", "sig")

    def compare(batches):
        for b in batches:
            if b.num_rows:
                keep = survives(_matrix(b.column("sig_a"), k), _matrix(b.column("sig_b"), k), batch, threshold_percent / 100, miss)
                yield b.select(["a", "b"]).take(pa.array(keep))

    near = pairs.join(sigs.select(F.col("rep").alias("a"), F.col("sig").alias("sig_a")), "a").join(sigs.select(F.col("rep").alias("b"), F.col("sig").alias("sig_b")), "b")
    near = scratch.save(near.select("a", "b", "sig_a", "sig_b").mapInArrow(T.frugal(compare), "a long, b long"), "near")
    links = scratch.save(confirmed(near, docs, shingle, threshold_percent, scratch, "first"), "links")
    found = scratch.save(components(links, scratch, "part"), "found")

    rest = _rest(shared, found, sigs, docs, shingle, k, bands, batch, threshold_percent, miss, scratch)
    if rest is not None and rest.limit(1).count():
        found = scratch.save(components(links.union(rest), scratch, "whole"), "found-all")

    named = classes.select("n_shingles", "d1", "d2", "rep").join(found, F.col("rep") == F.col("node"), "left")
    named = named.select("n_shingles", "d1", "d2", F.coalesce("component", "rep").alias("component"))
    named = scratch.save(named, "named")
    s, c = signed.alias("s"), named.alias("c")
    on = (F.col("s.n_shingles") == F.col("c.n_shingles")) & (F.col("s.d1") == F.col("c.d1")) & (F.col("s.d2") == F.col("c.d2"))
    component = F.when(F.col("s.doc_id").isNotNull(), F.coalesce("c.component", "s.doc_id"))
    out = s.join(c, on, "left").select("s.doc_id", "s.n_shingles", component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_first(docs: DataFrame, **options) -> DataFrame:
    """The rows of docs that ``near_duplicates`` keeps, one for each id, with their columns.

    Only the ids that go are joined with the texts. Rows that repeat an id count as copies of one
    another; rows without an id stay.
    """
    scratch = Scratch(docs.sparkSession, "keep-first")
    judged = scratch.save(near_duplicates(docs, **options).select("doc_id", "kept"), "judged")
    gone = scratch.save(judged.where("NOT kept").select("doc_id").distinct(), "gone")
    twice = scratch.save(judged.where("kept AND doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id"), "twice")
    out = docs.join(bounded(gone), "doc_id", "left_anti")
    if twice.limit(1).count():
        again = out.join(bounded(twice), "doc_id", "left_semi").dropDuplicates(["doc_id"])
        out = out.join(bounded(twice), "doc_id", "left_anti").unionByName(again)
    return out.select(quoted(docs.columns))


def bounded(ids: DataFrame) -> DataFrame:
    """Written ids, marked for broadcast if they are few enough."""
    return F.broadcast(ids) if ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS else ids


def whole_sets(ids: DataFrame, docs: DataFrame, shingle: int, scratch: Scratch, tag: str) -> DataFrame:
    """(doc_id, whole) for the given ids: the sorted 64-bit shingle names."""
    ids = scratch.save(ids.distinct(), f"ids-{tag}")

    def full(batches):
        for b in T.slices(batches):
            sets, off = shingle_sets(b.column("text"), shingle)
            flat = sets.view(np.uint8)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([flat[8 * off[i] : 8 * off[i + 1]].tobytes() for i in range(b.num_rows)], pa.binary())], ["doc_id", "whole"])

    texts = docs.join(bounded(ids), "doc_id", "left_semi")
    sets = texts.select("doc_id", "text").mapInArrow(T.frugal(full), "doc_id long, whole binary").groupBy("doc_id").agg(F.first("whole").alias("whole"))
    return scratch.save(sets, f"sets-{tag}")


def reaches(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets of 64-bit names reach the threshold."""
    small, large = (x, y) if len(x) <= len(y) else (y, x)
    if 100 * len(small) < percent * len(large):
        return False
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    both = int((large[at] == small).sum())
    return 100 * both >= percent * (len(x) + len(y) - both)


def confirmed(pairs: DataFrame, docs: DataFrame, shingle: int, percent: int, scratch: Scratch, tag: str) -> DataFrame:
    """The pairs (a, b) of ids whose full shingle sets reach the threshold."""
    sets = whole_sets(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")), docs, shingle, scratch, tag)

    def check(batches):
        for b in batches:
            keep = []
            for i, (x, y) in enumerate(zip(b.column("x"), b.column("y"))):
                if reaches(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), percent):
                    keep.append(i)
            yield b.select(["a", "b"]).take(pa.array(keep, pa.int64()))

    joined = pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("whole").alias("x")), "a").join(sets.select(F.col("doc_id").alias("b"), F.col("whole").alias("y")), "b")
    return joined.select("a", "b", "x", "y").mapInArrow(T.frugal(check), "a long, b long")


def _rest(shared, found, sigs, docs, shingle, k, bands, batch, percent, miss, scratch):
    """Links between documents that share a bucket but were compared with its pivot only; None if there are no such.

    A bucket whose members all lie in one component needs nothing more. In the others, members are
    dealt into blocks of about BLOCK by a hash; each pair of blocks is one unit of work, compared
    inside its task, so that neither a hot bucket nor its pairs ever form one row group. A pair is
    judged in the first band it shares, by the sequential test and then on the full sets, as in
    ``confirmed``; a unit reports a spanning forest, so a skipped pair is joined by true links.
    """
    named = shared.join(found, shared.rep == found.node, "left").select("bucket", "band", "rep", "pivot", "size", F.coalesce("component", "rep").alias("component"))
    named = scratch.save(named.where("size > 2"), "rest-named")
    torn = named.where("rep <> pivot").groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("members")).where("lo <> hi")
    torn = scratch.save(torn.select("bucket", F.ceil(F.col("members") / BLOCK).cast("int").alias("blocks")), "rest-torn")
    if not torn.limit(1).count():
        return None
    left = named.where("rep <> pivot").join(torn, "bucket").withColumn("block", F.pmod(F.xxhash64("rep", F.lit(17)), F.col("blocks")).cast("int"))
    left = left.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    unit = left.select("bucket", "band", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "rep", "component")
    # a unit is at most two blocks; units with the same members in several bands count once, in the first band
    unit = unit.groupBy("bucket", "band", "i", "j").agg(F.sort_array(F.collect_list(F.struct("rep", "component", "block"))).alias("members")).where("size(members) > 1")
    unit = unit.withColumn("key", F.xxhash64("members")).groupBy("key", "i", "j").agg(F.min("band").alias("band"), F.first("members").alias("members"))
    unit = scratch.save(unit.select(F.monotonically_increasing_id().alias("unit"), "band", "i", "j", "members"), "rest-units")
    rows = scratch.save(unit.select("unit", "band", "i", "j", F.explode("members").alias("m")).select("unit", "band", "i", "j", "m.rep", "m.component", "m.block"), "rest-rows")

    sets = whole_sets(rows.select(F.col("rep").alias("doc_id")), docs, shingle, scratch, "rest").select(F.col("doc_id").alias("rep"), F.col("whole").alias("names"))
    both = scratch.save(sets.join(sigs, "rep"), "rest-sets")
    rows = rows.join(both, "rep").select("unit", "band", "i", "j", "rep", "component", "block", "sig", "names")

    def blocks(batches):
        for band, i, j, rep, comp, block, sig, names in _groups(batches, k):
            # pairs still apart that share no earlier band, as one matrix of the unit
            ok = np.triu(comp[:, None] != comp[None, :], 1)
            if i != j:
                ok &= block[:, None] != block[None, :]
            part = sig.reshape(len(sig), bands, k // bands)
            for earlier in range(band):
                names_of = np.unique(part[:, earlier], axis=0, return_inverse=True)[1].ravel()
                ok &= names_of[:, None] != names_of[None, :]
            a, b = np.nonzero(ok)
            keep = [at + survives(sig[a[at : at + 65536]], sig[b[at : at + 65536]], batch, percent / 100, miss) for at in range(0, len(a), 65536)]
            keep = np.concatenate(keep) if keep else np.zeros(0, np.int64)
            found = [(rep[x], rep[y]) for x, y in _spanning(a[keep], b[keep], comp, names, percent)]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([min(p) for p in found], pa.int64()), pa.array([max(p) for p in found], pa.int64())], ["a", "b"])

    parts = int(scratch.spark.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(parts, "unit").sortWithinPartitions("unit")
    return scratch.save(rows.mapInArrow(T.frugal(blocks), "a long, b long").distinct(), "rest-pairs")


def _spanning(a, b, comp, names, percent):
    """The pairs that reach the threshold on their full sets and connect what is not connected yet."""
    parent = {int(c): int(c) for c in comp}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for x, y in zip(a.tolist(), b.tolist()):
        u, v = root(int(comp[x])), root(int(comp[y]))
        if u != v:
            if reaches(names[x], names[y], percent):
                parent[max(u, v)] = min(u, v)
                yield x, y


def _groups(batches, k):
    held = []
    for b in batches:
        if not b.num_rows:
            continue
        unit = np.asarray(b.column("unit"))
        cut = np.flatnonzero(np.diff(unit)) + 1
        at = 0
        for end in [*cut, len(unit)]:
            part = b.slice(at, end - at)
            if held and held[0].column("unit")[0].as_py() != unit[at]:
                yield _one(held, k)
                held = []
            held.append(part)
            at = end
    if held:
        yield _one(held, k)


def _one(held, k):
    t = pa.Table.from_batches(held).combine_chunks()
    n = lambda c: t.column(c).to_numpy()
    names = [np.frombuffer(x.as_buffer(), np.uint64) for x in t.column("names")]
    return n("band")[0], n("i")[0], n("j")[0], n("rep"), n("component"), n("block"), _matrix(t.column("sig"), k), names
