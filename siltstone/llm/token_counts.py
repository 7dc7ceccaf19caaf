"""Exact token counts at every prefix of a text, by dynamic programming over prefixes.

A byte-pair encoding of a string is the one sequence of tokens in which every two neighbours encode their
own concatenation to themselves. So the encoding of each prefix is known from its last token and from the
encoding of the prefix before that token, and one pass over a string gives the count of all its prefixes:

    last(i)  = the token t that ends at i, with t and last(i - |t|) compatible
    count(i) = count(i - |t|) + 1

The tokenizer marks the end of a word, so two tables run along: the open one, where more letters may follow,
and the closed one, where the prefix ends. Counts of different words add up, so each distinct word is worked
out once by a worker, and a text's table is put together from its words.

``prefix_counts`` keeps the table as one small step for each character; ``truncation``, ``counts_at`` and
``chunks`` answer questions from it and never encode again.
"""

from __future__ import annotations

import itertools
import json
import unicodedata

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm import _text as T
from siltstone.llm._columns import quoted
from siltstone.llm.packing import vocabulary_path
from siltstone.scratch import Scratch

LIMIT = 2048
#: Words, and compatible pairs of tokens, that a worker keeps; beyond, it starts over. No influence on results.
CACHE, PAIRS = 300_000, 2_000_000
#: Fixed values of the tokenizer's pattern: an apostrophe and these letters make a piece of their own.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")
END = "</w>"


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, spare = [""] * 256, itertools.count(256)
    for b in range(256):
        out[b] = chr(b if b in plain else next(spare))
    return out


class Pairs:
    """Which token may follow which."""

    def __init__(self, vocabulary: dict[str, int], merges: list):
        rank = {}
        for k, m in enumerate(merges):
            rank[tuple(m.split(" ") if isinstance(m, str) else m)] = k
        self.rank = rank
        self.known: dict[tuple[str, str], bool] = {}
        self.tokens = {t for t in vocabulary if self.whole(t)}
        self.open_most = max((len(t) for t in self.tokens if not t.endswith(END)), default=1)
        self.closed_most = max((len(t) - len(END) for t in self.tokens if t.endswith(END)), default=1)

    def symbols(self, token: str) -> list[str]:
        if token.endswith(END) and len(token) > len(END):
            body = token[: -len(END)]
            return [*body[:-1], body[-1] + END]
        return list(token)

    def merged(self, symbols: list[str]) -> list[str]:
        """Byte-pair encoding by its definition: the pair of least rank first, the leftmost of equal ones."""
        parts = list(symbols)
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: self.rank.get((parts[i], parts[i + 1]), 1 << 60))
            if (parts[best], parts[best + 1]) not in self.rank:
                break
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        return parts

    def whole(self, token: str) -> bool:
        return len(token) == 1 or self.merged(self.symbols(token)) == [token]

    def fit(self, left: str, right: str) -> bool:
        found = self.known.get((left, right))
        if found is None:
            if len(self.known) > PAIRS:
                self.known.clear()
            found = self.known[left, right] = self.merged(self.symbols(left) + self.symbols(right)) == [left, right]
        return found


class Prefixes:
    """Counts of the prefixes of one string of normalised characters, fed one by one.

    A piece (letters, punctuation) is open while more of it may come. ``mark`` and ``back`` return to an
    earlier state, for characters that change when a combining mark follows.
    """

    def __init__(self, pairs: Pairs, kind, letters: list[str]):
        self.pairs, self.kind, self.letters = pairs, kind, letters
        self.base = 0  # tokens of the closed pieces
        self.now = 0  # tokens of the open piece, were it to end here
        self.open = ""  # kind of the open piece
        self.body: list[str] = []
        self.last: list[tuple[str, int] | None] = [None]
        self.apart: tuple[int, str] | None = None  # tokens before an apostrophe that may start a contraction, letters since

    def mark(self):
        return self.base, self.now, self.open, self.body, len(self.body), self.last, self.apart

    def back(self, state) -> None:
        self.base, self.now, self.open, self.body, n, self.last, self.apart = state
        del self.body[n:], self.last[n + 1 :]

    def count(self) -> int:
        return self.base + self.now

    def close(self) -> None:
        self.base += self.now
        self.now, self.open, self.body, self.last = 0, "", [], [None]

    def feed(self, char: str) -> None:
        kind = self.kind(char)
        apart, self.apart = self.apart, None
        if apart is not None:
            so_far = apart[1] + char
            if so_far in CONTRACTIONS:
                self.base = apart[0]
                self.now, self.open, self.body, self.last = 0, "L", [], [None]
                for c in "'" + so_far:
                    self._extend(c)
                self.close()
                return
            if any(c.startswith(so_far) for c in CONTRACTIONS):
                self.apart = (apart[0], so_far)
        if kind == "S":
            self.close()
            return
        if kind == "N" or kind != self.open:
            self.close()
            if char == "'":
                self.apart = (self.base, "")
        self.open = "" if kind == "N" else kind
        self._extend(char)
        if kind == "N":
            self.close()

    def _extend(self, char: str) -> None:
        fit, tokens = self.pairs.fit, self.pairs.tokens
        more = [self.letters[b] for b in char.encode()]
        for k, letter in enumerate(more):
            self.body.append(letter)
            n = len(self.body)
            if k == len(more) - 1:
                self.now = self._step(n, END, self.pairs.closed_most, fit, tokens)[1]
            self.last.append(self._step(n, "", self.pairs.open_most, fit, tokens))

    def _step(self, n: int, end: str, most: int, fit, tokens) -> tuple[str, int]:
        tail = "".join(self.body[max(n - most, 0) : n])
        for size in range(len(tail), 0, -1):
            token = tail[len(tail) - size :] + end
            if token in tokens:
                before = self.last[n - size]
                if before is None or fit(before[0], token):
                    return token, 1 + (before[1] if before else 0)
        raise ValueError(f"no token ends at {tail!r}: the vocabulary lacks a byte")


class Grid:
    """The same dynamic programming for many pieces at once, a byte offset at a time.

    Whether two tokens may be neighbours is read off their merge trees: going back from the finished tokens,
    no symbol at the end of the left one may merge with the symbol that then begins the right one earlier than
    either takes part in its own next merge (on the right side: not later).
    """

    SLOTS = 1 << 20

    def __init__(self, pairs: Pairs, vocabulary: dict[str, int], letters: list[str]):
        byte = {c: b for b, c in enumerate(letters)}
        n = max(vocabulary.values()) + 1
        never = np.int64(1 << 40)
        self.left, self.right, self.made = (np.full(n, -1, np.int32) for _ in range(3))
        keys, ranks = np.zeros(len(pairs.rank), np.int64), np.zeros(len(pairs.rank), np.int64)
        for k, ((x, y), r) in enumerate(pairs.rank.items()):
            a, b, c = vocabulary[x], vocabulary[y], vocabulary[x + y]
            keys[k], ranks[k] = (a << 32) + b, r
            if self.made[c] < 0 or r < self.made[c]:
                self.left[c], self.right[c], self.made[c] = a, b, r
        order = np.argsort(keys)
        self.keys, self.ranks, self.never = np.append(keys[order], never << 20), np.append(ranks[order], never), never
        # a trie of the tokens' bytes; only nodes with children have a row
        child, self.open, self.closed = [{}], [-1], [-1]
        for token in sorted(pairs.tokens):
            closed = token.endswith(END) and len(token) > len(END)
            node = 0
            for c in token[: -len(END)] if closed else token:
                if byte[c] not in child[node]:
                    child[node][byte[c]] = len(child)
                    child.append({})
                    self.open.append(-1)
                    self.closed.append(-1)
                node = child[node][byte[c]]
            (self.closed if closed else self.open)[node] = vocabulary[token]
        inner = [k for k, c in enumerate(child) if c]
        self.row = np.full(len(child), len(inner), np.int32)
        self.row[inner] = np.arange(len(inner))
        self.step = np.full((len(inner) + 1, 256), -1, np.int32)
        for k in inner:
            for b, to in child[k].items():
                self.step[self.row[k], b] = to
        self.open, self.closed = np.array(self.open, np.int32), np.array(self.closed, np.int32)
        self.slot_key, self.slot_fit = np.full(self.SLOTS, -1, np.int64), np.zeros(self.SLOTS, bool)

    def fit(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = (left.astype(np.int64) << 32) + right
        slot = (T.mix(key.view(np.uint64)) & np.uint64(self.SLOTS - 1)).astype(np.int64)
        out = self.slot_fit[slot]
        new = np.flatnonzero(self.slot_key[slot] != key)
        if len(new):
            out[new] = self._fit(left[new], right[new])
            self.slot_key[slot[new]], self.slot_fit[slot[new]] = key[new], out[new]
        return out

    def _fit(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        ok, at = np.ones(len(a), bool), np.arange(len(a))
        a, b = a.astype(np.int64), b.astype(np.int64)
        until_a = np.full(len(a), self.never)  # when the symbol merges into its parent
        until_b = until_a.copy()
        while len(at):
            key = (a << 32) + b
            k = np.searchsorted(self.keys, key)
            rank = np.where(self.keys[k] == key, self.ranks[k], self.never)
            bad = (rank < until_a) & (rank <= until_b) & (rank < self.never)
            ok[at[bad]] = False
            made_a, made_b = self.made[a], self.made[b]
            on = ~bad & ((made_a >= 0) | (made_b >= 0))
            at, a, b, until_a, until_b, made_a, made_b = (x[on] for x in (at, a, b, until_a, until_b, made_a, made_b))
            undo = made_a >= made_b  # the later merge is undone first; equal merges run from the left
            until_a, until_b = np.where(undo, made_a, until_a), np.where(undo, until_b, made_b)
            a, b = np.where(undo, self.right[a], a), np.where(undo, b, self.left[b])
        return ok

    def counts(self, data: np.ndarray, first: np.ndarray, char_end: np.ndarray) -> np.ndarray:
        """For each byte that ends a character: the tokens of its piece, ended there. ``first``: offsets of the pieces, n+1."""
        n = len(data)
        begin = np.repeat(first[:-1], np.diff(first))
        end = np.repeat(first[1:], np.diff(first))
        start, node, ends, starts, nodes = np.arange(n), np.zeros(n, np.int32), [], [], []
        for size in range(n):
            node = self.step[self.row[node], data[start + size]]
            on = node >= 0
            start, node = start[on], node[on]
            if not len(start):
                break
            ends.append(start + size)
            starts.append(start)
            nodes.append(node)
            on = start + size + 1 < end[start]
            start, node = start[on], node[on]
        ends, starts, nodes = (np.concatenate(x) for x in (ends, starts, nodes))
        some = (self.open[nodes] >= 0) | (self.closed[nodes] >= 0) & char_end[ends]
        ends, starts, nodes = ends[some], starts[some], nodes[some]
        offset = ends - begin[ends]
        order = np.argsort(offset, kind="stable")
        cut = np.searchsorted(offset[order], np.arange(int(offset[order[-1]]) + 2))
        last, count, closed = np.full(n, -1, np.int32), np.zeros(n, np.int32), np.zeros(n, np.int32)
        for lo, hi in zip(cut[:-1].tolist(), cut[1:].tolist()):
            at = order[lo:hi]
            e, s, x = ends[at], starts[at], nodes[at]
            alone = s == begin[e]
            before = np.where(alone, 0, s - 1)
            reach = alone | (last[before] >= 0)
            for ids, shut in ((self.open[x], False), (self.closed[x], True)):
                on = reach & (ids >= 0) & (char_end[e] if shut else True)
                k = np.flatnonzero(on)
                inside = k[~alone[k]]
                good = np.ones(len(e), bool)
                good[inside] = self.fit(last[before[inside]], ids[inside])
                k = k[good[k]]
                total = 1 + np.where(alone[k], 0, count[before[k]])
                if shut:
                    closed[e[k]] = total
                else:
                    last[e[k]], count[e[k]] = ids[k], total
        return closed


class Counter:
    """Prefix tables of single words for one tokenizer file."""

    #: Words worked out at a time, and characters of the longest that go that way.
    GROUP, LONG = 20_000, 200

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.base = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        if model["type"] != "BPE" or model.get("end_of_word_suffix") != END:
            raise ValueError(f"{path}: not a byte-pair vocabulary with word ends")
        self.letters = byte_letters()
        self.pairs = Pairs(model["vocab"], model["merges"])
        self.grid = Grid(self.pairs, model["vocab"], self.letters)
        self.special = [x.content for x in self.base.get_added_tokens_decoder().values()]
        self.kinds: dict[str, str] = {}
        self.plain: dict[str, str] = {}
        self.joins: set[str] | None = None
        #: By code point: kind (0: not asked yet, 5: its normal form is not one character), normal form.
        self.kind_of, self.normal_of = np.zeros(0x110000, np.uint8), np.zeros(0x110000, np.uint32)
        self._clear()

    def _clear(self) -> None:
        self.index: dict[int, int] = {}
        self.start, self.size = (np.zeros(1 << 14, np.int64) for _ in range(2))
        self.flat = np.zeros(1 << 18, np.int32)
        self.used = 0

    def kind(self, char: str) -> str:
        """L, N, P or S (letter, digit, other, white space), as the tokenizer itself cuts."""
        if char not in self.kinds:
            pieces = lambda s: len(self.base.pre_tokenizer.pre_tokenize_str(s))
            self.kinds[char] = "S" if not pieces(char) else "L" if pieces(char + "a") == 1 else "P" if pieces(char + "!") == 1 else "N"
        return self.kinds[char]

    def normal(self, text: str) -> str:
        if len(text) > 1:
            return self.base.normalizer.normalize_str(text)
        if text not in self.plain:
            self.plain[text] = self.base.normalizer.normalize_str(text)
        return self.plain[text]

    def _joins(self, char: str) -> bool:
        """Whether the character may change what stands before it when texts are normalised."""
        if self.joins is None:
            parts = (unicodedata.decomposition(chr(c)).split() for c in range(0x110000))
            self.joins = {chr(int(p[1], 16)) for p in parts if len(p) == 2 and not p[0].startswith("<")}
            self.joins |= {chr(c) for c in [*range(0x1161, 0x1176), *range(0x11A8, 0x11C3)]}
        return unicodedata.combining(char) != 0 or char in self.joins

    def _ordinary(self, text: str) -> list[int]:
        """Counts of the prefixes of 0, 1, ... characters, where nothing is a special token."""
        run, out = Prefixes(self.pairs, self.kind, self.letters), [0]
        if unicodedata.is_normalized("NFC", text):
            for c in text:
                for x in self.normal(c):
                    run.feed(x)
                out.append(run.count())
            return out
        at = 0
        while at < len(text):
            end = at + 1
            while end < len(text) and self._joins(text[end]):
                end += 1
            state = run.mark()
            for k in range(at + 1, end + 1):
                run.back(state)
                for x in self.normal(text[at:k]):
                    run.feed(x)
                out.append(run.count())
            at = end
        return out

    def counts(self, text: str) -> list[int]:
        """The same for any text without white space of ASCII."""
        out, base, at = [0], 0, 0
        while True:
            found = min(((i, -len(s)) for s in self.special if (i := text.find(s, at)) >= 0), default=None)
            if found is None:
                return out + [base + x for x in self._ordinary(text[at:])[1:]]
            begin, end = found[0], found[0] - found[1]
            part = self._ordinary(text[at:end])
            out += [base + x for x in part[1:-1]]
            base += part[begin - at] + 1
            out.append(base)
            at = end

    def _usual(self, spans: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(steps, offsets, which spans have right ones): many spans at once; those with rare traits are left out."""
        sizes = np.array([len(s) for s in spans], np.int64)
        off = np.concatenate([[0], np.cumsum(sizes)])
        code = np.frombuffer("".join(spans).encode("utf-32-le"), np.uint32)
        asked = np.unique(code[self.kind_of[code] == 0])
        for c in asked.tolist():
            form = self.normal(chr(c))
            self.kind_of[c] = "LNPS".index(self.kind(form)) + 1 if len(form) == 1 else 5
            self.normal_of[c] = ord(form) if len(form) == 1 else c
        kind, form = self.kind_of[code], self.normal_of[code]
        odd = kind >= 4
        odd[:-1] |= (code[:-1] == 39) & (kind[1:] == 1)  # perhaps a contraction
        fine = sizes <= self.LONG
        fine[np.unique(np.searchsorted(off, np.flatnonzero(odd), "right") - 1)] = False
        for k in np.flatnonzero(fine & np.array([not s.isascii() for s in spans], bool)).tolist():
            fine[k] = unicodedata.is_normalized("NFC", spans[k])
        if any("<|" in s for s in spans) or any(not s.startswith("<|") for s in self.special):
            for k, s in enumerate(spans):
                if fine[k] and any(x in s for x in self.special):
                    fine[k] = False
        fresh = np.ones(len(code), bool)  # a piece begins
        fresh[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == 2)
        fresh[off[:-1]] = True
        use = np.repeat(fine, sizes)
        form, fresh, whole = form[use], fresh[use], np.flatnonzero(use)
        out = np.zeros(len(code), np.int32)
        if len(form):
            text = form.astype("<u4").tobytes().decode("utf-32-le")
            data = np.frombuffer(text.encode(), np.uint8)
            lead = np.flatnonzero((data & 0xC0) != 0x80)
            char_end = np.zeros(len(data), bool)
            final = np.append(lead[1:], len(data)) - 1
            char_end[final] = True
            begins = np.flatnonzero(fresh)
            first = np.append(lead[begins], len(data))
            counts = self.grid.counts(data, first, char_end)[final]
            piece = np.cumsum(fresh) - 1
            totals = counts[np.append(begins[1:], len(form)) - 1]
            base = np.concatenate([[0], np.cumsum(totals)])[piece]
            running = (base + counts).astype(np.int64)
            steps = np.diff(running, prepend=0)
            out[whole] = steps
        return out, off, fine

    def _learn(self, names: list[int], spans: list[str]) -> None:
        for lo in range(0, len(names), self.GROUP):
            part, known = spans[lo : lo + self.GROUP], names[lo : lo + self.GROUP]
            steps, off, fine = self._usual(part)
            for k in np.flatnonzero(~fine).tolist():
                steps[off[k] : off[k + 1]] = np.diff(self.counts(part[k]))
            n = len(self.index)
            while n + len(part) > len(self.start):
                self.start, self.size = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.size))
            while self.used + len(steps) > len(self.flat):
                self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
            self.flat[self.used : self.used + len(steps)] = steps
            self.start[n : n + len(part)] = self.used + off[:-1]
            self.size[n : n + len(part)] = np.diff(off)
            self.used += len(steps)
            self.index.update(zip(known, range(n, n + len(part))))

    def steps(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """One step for each character of all rows (what it adds to the count), and the offsets of the rows."""
        if len(self.index) > CACHE:
            self._clear()
        data, off = T.utf8(column)
        body = data.tobytes()
        w = T.words(column, runs=not any(x.encode() in body for x in self.special))
        names, first, which = np.unique(w.hash, return_index=True, return_inverse=True)
        at = np.fromiter(map(self.index.get, names.tolist(), itertools.repeat(-1)), np.int64, len(names))
        new = np.flatnonzero(at < 0)
        at[new] = np.arange(len(self.index), len(self.index) + len(new))
        self._learn(names[new].tolist(), [body[a:b].decode() for a, b in zip(w.start[first[new]].tolist(), w.end[first[new]].tolist())])
        lead = (data & 0xC0) != 0x80  # the first byte of each character
        place = np.concatenate([[0], np.cumsum(lead)])
        out = np.zeros(int(place[-1]), np.int32)
        if len(names):
            at = at[which]
            out[T.spread(place[w.start], self.size[at])] = self.flat[T.spread(self.start[at], self.size[at])]
        return out, place[off]


_loaded: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    if path not in _loaded:
        _loaded[path] = Counter(path)
    return _loaded[path]


def _packed(steps: np.ndarray) -> bytes:
    """The steps in as few bytes as hold them, behind a byte that says how many each takes."""
    least, most = (int(steps.min()), int(steps.max())) if len(steps) else (0, 0)
    width = 1 if -128 <= least and most <= 127 else 2 if -32768 <= least and most <= 32767 else 4
    return bytes([width]) + steps.astype(f"<i{width}").tobytes()


def unpacked(blob: bytes) -> np.ndarray:
    """Counts of the prefixes of 0, 1, 2, ... characters, from a row's ``steps``."""
    return np.concatenate([[0], np.cumsum(np.frombuffer(blob, f"<i{blob[0]}", offset=1), dtype=np.int64)])


def prefix_counts(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Rows (doc_id, n_bytes, n_chars, n_tokens, steps), one for each row of ``docs``.

    ``steps`` holds what each character adds to the token count of the prefix that ends with it (mostly 0 or
    1; less than 0 where a longer word takes fewer tokens), so any prefix's count is a running sum. Null and
    empty texts: 0 tokens, no step. Special strings in texts count as the tokenizer's default counts them.
    Texts of any length are worked through whole; a row's table takes one byte a character. Null or repeated
    doc_id and repeated rows: a row each. Other columns are ignored. Empty table: empty result.
    """
    path = path or vocabulary_path()
    Scratch(docs.sparkSession, "token-counts")  # batches that fit beside the heap

    def run(batches):
        t = counter(path)
        for b in T.slices(batches):
            text = b.column("text")
            steps, off = t.steps(text)
            _, size = T.utf8(text)
            sums = np.concatenate([[0], np.cumsum(steps, dtype=np.int64)])
            blobs = [_packed(steps[a:z]) for a, z in zip(off[:-1].tolist(), off[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(np.diff(size)), pa.array(np.diff(off)), pa.array(sums[off[1:]] - sums[off[:-1]]), pa.array(blobs, pa.binary())],
                ["doc_id", "n_bytes", "n_chars", "n_tokens", "steps"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(T.frugal(run), f"doc_id {kind}, n_bytes long, n_chars long, n_tokens long, steps binary")


def truncation(limit: int = LIMIT, steps: str = "steps") -> Column:
    """Characters of the longest prefix of at most ``limit`` tokens; null where ``steps`` is null."""
    if limit < 0:
        raise ValueError("limit must not be negative")

    @F.pandas_udf("long")
    def longest(blob: pd.Series) -> pd.Series:
        return blob.map(lambda x: None if x is None else int(np.flatnonzero(unpacked(x) <= limit)[-1])).astype("Int64")

    return longest(F.col(steps))


def counts_at(places: str, steps: str = "steps") -> Column:
    """Token counts of the prefixes that end at each of an array's character places.

    Places beyond the text count as its end, those below 0 as its start, null places give null.
    """

    @F.pandas_udf("array<long>")
    def look(blob: pd.Series, wanted: pd.Series) -> pd.Series:
        def one(x, at):
            if x is None or at is None:
                return None
            sums = unpacked(x)
            return [None if k is None or k != k else int(sums[min(max(int(k), 0), len(sums) - 1)]) for k in at]

        return pd.Series([one(x, at) for x, at in zip(blob, wanted)], dtype=object)

    return look(F.col(steps), F.col(places))


def chunks(docs: DataFrame, table: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Rows (doc_id, chunk, start, n_chars, n_tokens): texts cut at white space into pieces of at most ``limit`` tokens.

    Each piece takes as many words as fit; a word of more tokens than ``limit`` is a piece of its own, cut
    where its prefixes' counts say. doc_id must be unique and not null in both tables; a text without words
    has no piece. The counts come from ``table`` alone.
    """
    if limit < 1:
        raise ValueError("limit must be at least 1")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def cut(batches):
        for b in batches:
            rows = []
            for doc, text, blob in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), b.column("steps").to_pylist()):
                sums, k = unpacked(blob), 0
                data = np.frombuffer((text or "").encode("utf-32-le"), np.uint32)
                white = (data == 32) | ((data >= 9) & (data <= 13))
                ends = np.flatnonzero(~white & np.append(white[1:], True)) + 1  # one past each word
                starts = np.flatnonzero(~white & np.append(True, white[:-1]))
                word = 0
                while word < len(ends):
                    at = int(starts[word])
                    fits = int(np.searchsorted(sums[ends], sums[at] + limit, "right"))  # counts at word ends never fall
                    end = int(ends[max(fits, word + 1) - 1])
                    rows.append((doc, k, at, end - at, int(sums[end] - sums[at])))
                    word, k = max(fits, word + 1), k + 1
            yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], t) for j, t in enumerate([b.schema.field("doc_id").type, pa.int32(), pa.int64(), pa.int64(), pa.int64()])], ["doc_id", "chunk", "start", "n_chars", "n_tokens"])

    both = docs.select(*quoted(["doc_id", "text"])).join(table.select("doc_id", "steps"), "doc_id")
    return both.mapInArrow(T.frugal(cut), f"doc_id {kind}, chunk int, start long, n_chars long, n_tokens long")


def token_counts(docs: DataFrame, limit: int = LIMIT, path: str | None = None) -> DataFrame:
    """Rows (doc_id, n_bytes, n_tokens, over_limit, keep_chars) from the prefix tables; see ``prefix_counts``.

    keep_chars: characters of the longest prefix of at most ``limit`` tokens.
    """
    table = prefix_counts(docs, path)
    return table.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), truncation(limit).alias("keep_chars"))
