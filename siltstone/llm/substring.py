"""Repeated passages across documents, found by recompression.

Rounds of recompression rename the word sequence of every document: a run of one symbol becomes a
symbol, then a pair (left, right) becomes a symbol where a hash puts ``left`` in the left half and
``right`` in the right half of the alphabet. Names are 64-bit hashes of what they stand for, so a
round names globally without a dictionary: equal substrings get equal interior symbols in all
documents and tasks. Every symbol carries the word range on which its existence depends; where that
range lies inside a window, each equal window holds the same symbol at the same place. It is then
certified for the window, and known by its name and that of its range.

1. Each window of ``size`` words picks one certified symbol: of the highest round that has any, the
   least name. (Windows inside long runs have none and stand for themselves.) Equal windows pick alike.
2. Spark groups the picked names of all documents. Names of one document only are done with.
3. The windows that picked a shared name are named whole (two 64-bit names, each mixed through a tree
   over the window's words), grouped by both, and every window whose names start in a document with a
   smaller id marks its words.

Documents whose word sequences have equal SHA-256 are one class; only its smallest id takes part.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from siltstone.llm import _text as T
from siltstone.llm._columns import quoted
from siltstone.scratch import Scratch

ROUNDS = 4
#: Broadcasts hold at most so many 8-byte values; beyond, joins are dealt by key.
BROADCAST_VALUES = 2_000_000
_U = np.uint64
_NONE = _U(0xFFFFFFFFFFFFFFFF)


def _rounds(w: T.Words, rounds: int):
    """(name, lo, hi) of every symbol after each round; lo and hi bound the word range its existence depends on."""
    rows = w.rows
    n = len(w.hash)
    counts = np.diff(rows)
    first_word, last_word = np.repeat(rows[:-1], counts), np.repeat(rows[1:], counts)
    name = w.hash.copy()
    lo = np.arange(n)
    hi = lo + 1
    row_lo, row_hi = first_word, last_word  # of the symbol's row
    for k in range(rounds):
        m = len(name)
        if not m:
            return
        # runs
        same_row = row_lo[1:] == row_lo[:-1]
        head = np.ones(m, bool)
        head[1:] = ~(same_row & (name[1:] == name[:-1]))
        first = np.flatnonzero(head)
        last = np.concatenate([first[1:], [m]]) - 1
        edge_l, edge_r = row_lo[first], row_hi[first]
        new_lo = np.where(first > 0, lo[np.maximum(first - 1, 0)], -1)
        new_lo = np.where((first > 0) & (row_lo[np.maximum(first - 1, 0)] == edge_l), new_lo, edge_l - 1)
        after = np.minimum(last + 1, m - 1)
        new_hi = np.where((last + 1 < m) & (row_lo[after] == edge_l), hi[after], edge_r + 1)
        length = last - first + 1
        name = np.where(length > 1, T.mix(name[first] + length.astype(_U) * _U(0xD6E8FEB86659FD93)), name[first])
        lo, hi, row_lo, row_hi = new_lo, new_hi, edge_l, edge_r
        # pairs
        m = len(name)
        left = (T.mix(name ^ _U((k + 1) * 0x2545F4914F6CDD1D & 0xFFFFFFFFFFFFFFFF)) & _U(1)).astype(bool)
        same_row = row_lo[1:] == row_lo[:-1]
        joins = np.zeros(m, bool)
        joins[:-1] = same_row & left[:-1] & ~left[1:]
        joined = np.zeros(m, bool)
        joined[1:] = joins[:-1]
        nxt_ok = np.zeros(m, bool)
        nxt_ok[:-1] = same_row
        prv_ok = np.zeros(m, bool)
        prv_ok[1:] = same_row
        nxt, prv = np.minimum(np.arange(m) + 1, m - 1), np.maximum(np.arange(m) - 1, 0)
        new_hi = np.where(joins | left, np.where(nxt_ok, hi[nxt], row_hi + 1), hi)
        new_lo = np.where(~left, np.where(prv_ok, lo[prv], row_lo - 1), lo)
        name = np.where(joins, T.mix(name * _U(0x9FB21C651E98DF25) + (name[nxt] ^ (name[nxt] >> _U(31)))), name)
        keep = ~joined
        name, lo, hi, row_lo, row_hi = name[keep], new_lo[keep], new_hi[keep], row_lo[keep], row_hi[keep]
        yield name, lo, hi


def _least(values: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least of values[a:b] for each range; none is empty."""
    out = np.empty(len(a), _U)
    span = b - a
    table, width = values, 1
    order = np.frexp(span.astype(np.float64))[1] - 1  # floor of log2
    for level in range(int(order.max()) + 1 if len(order) else 0):
        if level:
            table = np.minimum(table[: len(table) - width], table[width:])
            width *= 2
        at = np.flatnonzero(order == level)
        out[at] = np.minimum(table[a[at]], table[b[at] - width])
    return out


def picks(w: T.Words, size: int, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """(first word, picked name) of every window of ``size`` words."""
    starts = T.window_starts(w.rows, size)
    out = np.zeros(len(starts), _U)
    todo = np.arange(len(starts))
    if len(starts):
        ranges = T.Ranges(w.hash)
        for symbol, lo, hi in reversed(list(_rounds(w, rounds))):
            s = starts[todo]
            a, b = np.searchsorted(lo, s, "left"), np.searchsorted(hi, s + size, "right")
            got = a < b
            if got.any():
                ok = (lo >= 0) & (hi <= len(w.hash)) & (hi - lo <= size)
                names = T.mix(symbol ^ ranges.names(np.where(ok, lo, 0), np.where(ok, hi, 0)))
                out[todo[got]] = _least(names, a[got], b[got])
                todo = todo[~got]
            if not len(todo):
                break
        if len(todo):
            out[todo] = T.mix(ranges.names(starts[todo], starts[todo] + size) ^ _U(0x71D67FFFEDA60000))
    return starts, out


def _rows_of(starts: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return np.searchsorted(rows, starts, "right") - 1


def _sha(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def repeated_windows(docs: DataFrame, scratch: Scratch, size: int = 50) -> tuple[DataFrame, DataFrame]:
    """(facts, removed): facts has a row per document with doc_id, n_words, sha256 and ``copy``;
    removed has (doc_id, starts): the windows to remove in documents that are not whole copies.

    A copy has the word sequence, of at least ``size`` words, of a document with a smaller id.
    """
    docs = docs.select("doc_id", "text")

    def read(batches):
        for b in T.slices(batches):
            w = T.words(b.column("text"))
            data, off = T.utf8(b.column("text"))
            starts, names = picks(w, size)
            row = _rows_of(starts, w.rows)
            change = np.ones(len(names), bool)
            change[1:] = (names[1:] != names[:-1]) | (row[1:] != row[:-1])
            row, names = row[change], names[change]
            order = np.lexsort((names, row))
            row, names = row[order], names[order]
            first = np.ones(len(names), bool)
            first[1:] = (names[1:] != names[:-1]) | (row[1:] != row[:-1])
            row, names = row[first], names[first]
            keys = pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(b.num_rows + 1)).astype(np.int32)), pa.array(T.signed(names)))
            sha = [_sha(data[off[i] : off[i + 1]].tobytes().split()) for i in range(b.num_rows)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(w.counts), pa.array(sha), keys], ["doc_id", "n_words", "sha256", "keys"])

    facts = scratch.save(docs.mapInArrow(T.frugal(read), "doc_id long, n_words long, sha256 string, keys array<long>"), "read")
    same = facts.where(f"n_words >= {size} AND doc_id IS NOT NULL").groupBy("sha256").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most")
    same = scratch.save(same, "same")
    joined = facts.join(same, "sha256", "left").withColumn("copy", F.coalesce(F.col("doc_id") > F.col("least"), F.lit(False)))
    named = scratch.save(joined.where("NOT copy AND doc_id IS NOT NULL").select("doc_id", F.explode("keys").alias("key")), "named")
    shared = named.groupBy("key").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most").select("key")
    back = named.join(scratch.save(shared, "shared"), "key").groupBy("doc_id").agg(F.collect_set("key").alias("keys"))
    back = scratch.save(back, "back")
    values = back.agg(F.sum(F.size("keys") + 4)).first()[0] or 0

    def name(batches):
        for b in T.slices(batches):
            w = T.words(b.column("text"), spans=False)
            starts, names = picks(w, size)
            row = _rows_of(starts, w.rows)
            keys = b.column("keys")
            wanted, cut = keys.flatten().to_numpy().view(_U), np.asarray(keys.offsets) - keys.offsets[0].as_py()
            ok = np.zeros(len(names), bool)
            at = np.searchsorted(row, np.arange(b.num_rows + 1))
            for i in range(b.num_rows):
                part = names[at[i] : at[i + 1]]
                mine = np.sort(wanted[cut[i] : cut[i + 1]])
                if len(mine):
                    ok[at[i] : at[i + 1]] = mine[np.minimum(np.searchsorted(mine, part), len(mine) - 1)] == part
            starts, row = starts[ok], row[ok]
            h1, h2 = (T.Ranges(w.hash, s).names(starts, starts + size) for s in (0, 1))
            starts = starts - w.rows[row]
            # a window that recurs inside its document is one row, with its further places beside it
            order = np.lexsort((starts, h2, h1, row))
            starts, row, h1, h2 = starts[order], row[order], h1[order], h2[order]
            head = np.ones(len(row), bool)
            head[1:] = (row[1:] != row[:-1]) | (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
            at = np.flatnonzero(head)
            extra = np.diff(np.append(at, len(row))) - 1
            cut = np.concatenate([[0], np.cumsum(extra)]).astype(np.int32)
            more = pa.ListArray.from_arrays(pa.array(cut), pa.array(starts[~head].astype(np.int32)), mask=pa.array(extra == 0))
            ids = np.asarray(b.column("doc_id"))[row[at]]
            out = pa.RecordBatch.from_arrays(
                [pa.array(ids), pa.array(starts[at].astype(np.int32)), more, pa.array(T.signed(h1[at])), pa.array(T.signed(h2[at]))],
                ["doc_id", "start", "more", "h1", "h2"],
            )
            for i in range(0, out.num_rows, 500_000):
                yield out.slice(i, 500_000)

    texts = docs.where("doc_id IS NOT NULL").join(F.broadcast(back) if values <= BROADCAST_VALUES else back, "doc_id")
    windows = scratch.save(texts.select("doc_id", "text", "keys").mapInArrow(T.frugal(name), "doc_id long, start int, more array<int>, h1 long, h2 long"), "windows")
    origin = windows.groupBy("h1", "h2").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most").select("h1", "h2", "least")
    hit = windows.join(origin, ["h1", "h2"]).where("doc_id > least")
    places = F.concat(F.array("start"), F.coalesce("more", F.array().cast("array<int>")))
    removed = scratch.save(hit.groupBy("doc_id").agg(F.flatten(F.collect_list(places)).alias("starts")), "removed")
    facts = scratch.save(joined.select("doc_id", "n_words", "sha256", "copy"), "facts")
    scratch.drop("windows")
    scratch.drop("read")
    scratch.drop("named")
    return facts, removed


def _kept(text: bytes, starts: np.ndarray, size: int) -> tuple[np.ndarray, list[bytes]]:
    words = text.split()
    mark = np.zeros(len(words) + 1, np.int64)
    starts = np.unique(starts)
    starts = starts[starts + size <= len(words)]
    mark[starts] += 1
    np.subtract.at(mark, starts + size, 1)
    gone = np.cumsum(mark[:-1]) > 0
    return gone, [w for w, g in zip(words, gone) if not g]


def _affected(docs: DataFrame, removed: DataFrame) -> DataFrame:
    ids = removed.select("doc_id")
    small = ids.limit(BROADCAST_VALUES + 1).count() <= BROADCAST_VALUES
    return docs.join(F.broadcast(ids), "doc_id", "left_semi") if small else docs


def remove_repeats(docs: DataFrame, size: int = 50) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256.

    Null or blank text: no words, nothing removed, the hash of the empty string. Null doc_id: nothing
    removed, and it is no origin. Repeated rows: equal ids are not smaller than one another, so neither
    row loses to the other. Other columns are ignored. Empty table: empty result.
    """
    scratch = Scratch(docs.sparkSession, "substring")
    docs = docs.select("doc_id", "text")
    facts, removed = repeated_windows(docs, scratch, size)

    def cut(batches):
        for b in T.slices(batches):
            counts, shas = [], []
            for text, starts in zip(b.column("text"), b.column("starts")):
                gone, kept = _kept(text.as_py().encode(), np.asarray(starts.values), size)
                counts.append(int(gone.sum()))
                shas.append(_sha(kept))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(counts, pa.int64()), pa.array(shas, pa.string())], ["doc_id", "n", "sha"])

    done = _affected(docs.where("doc_id IS NOT NULL"), removed).join(removed, "doc_id").select("doc_id", "text", "starts").mapInArrow(T.frugal(cut), "doc_id long, n long, sha string")
    done = scratch.save(done.select("doc_id", "n", "sha").groupBy("doc_id").agg(F.max("n").alias("n"), F.max("sha").alias("sha")), "done")
    out = facts.join(done, "doc_id", "left")
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    return out.select(
        "doc_id",
        "n_words",
        F.when(F.col("copy"), F.col("n_words")).otherwise(F.coalesce("n", F.lit(0))).alias("n_removed"),
        F.when(F.col("copy"), empty).otherwise(F.coalesce("sha", "sha256")).alias("kept_sha256"),
    )


def cut_repeats(docs: DataFrame, size: int = 50) -> DataFrame:
    """docs without the words that ``remove_repeats`` removes; other text stays as it is.

    A removed word takes the white space after it along. n_chars, where docs has it, follows the text.
    Documents that lose all their words go. Only changed documents are joined with what they lose.
    Null or blank text and null doc_id: the row stays as it is. Repeated rows: none is an earlier
    document than another, so they stay or change alike. Other columns keep their values, whatever
    their names. Empty table: empty result.
    """
    scratch = Scratch(docs.sparkSession, "cut")
    facts, removed = repeated_windows(docs, scratch, size)
    copies = facts.where("copy").select("doc_id")
    gone = scratch.save(copies.union(removed.select("doc_id")).distinct(), "gone")
    small = gone.limit(BROADCAST_VALUES + 1).count() <= BROADCAST_VALUES
    same = docs.join(F.broadcast(gone) if small else gone, "doc_id", "left_anti").select(quoted(docs.columns))
    columns = docs.columns
    text = columns.index("text")
    plain = [f"c{k}" for k in range(len(columns))]  # Arrow functions take no names with dots

    def cut(batches):
        for b in T.slices(batches, column=plain[text]):
            texts = [_cut(t.encode(), np.asarray(s.values), size) for t, s in zip(b.column(text).to_pylist(), b.column(len(columns)))]
            out = list(b.columns[: len(columns)])
            out[text] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(out, plain)

    lost = removed.select(F.col("doc_id").alias("of"), F.col("starts").alias("lost"))
    changed = _affected(docs.where("doc_id IS NOT NULL"), removed).select(quoted(columns)).toDF(*plain)
    changed = changed.join(lost, changed[plain[columns.index("doc_id")]] == lost["of"]).select(*plain, "lost")
    changed = changed.mapInArrow(T.frugal(cut), StructType([StructField(c, f.dataType) for c, f in zip(plain, docs.schema)])).toDF(*columns)
    changed = changed.where(F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    if "n_chars" in columns:
        changed = changed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return same.unionByName(changed.select(quoted(columns)))


def _cut(text: bytes, starts: np.ndarray, size: int) -> str:
    gone, _ = _kept(text, starts, size)
    w = T.words(pa.array([text.decode()], pa.string()))
    keep = np.ones(len(text), bool)
    ends = np.append(w.start[1:], len(text))
    for a, b in zip(w.start[gone], ends[gone]):
        keep[a:b] = False
    return np.frombuffer(text, np.uint8)[keep].tobytes().decode()
