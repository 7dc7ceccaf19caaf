import random
import re

import numpy as np
import pyarrow as pa

from siltstone.llm import _text as T

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def thue_morse(n, a, b):
    return [(a, b)[bin(i).count("1") % 2] for i in range(n)]


def names(*texts, **kw):
    return T.words(pa.array(texts, pa.string()), **kw)


def test_words_of_every_length_have_names_of_their_own():
    r = random.Random(1)
    seen = {}
    for n in [*range(1, 40), 255, 256, 257, 300, 1024]:
        for _ in range(40):
            w = "".join(r.choice("abAé") for _ in range(n))
            h = int(names("x " + w + " y").hash[1])
            assert seen.setdefault(h, w) == w and int(names(w).hash[0]) == h
    lower = names("ABC abc aBé abé", lower=True).hash
    assert lower[0] == lower[1] and lower[2] == lower[3] != lower[0]


def test_texts_that_collide_under_any_polynomial_have_other_names():
    a, b = ("".join(thue_morse(1024, x, y)) for x, y in ("ab", "ba"))
    assert names(a).hash[0] != names(b).hash[0]
    for n in (64, 4096):
        x, y = (names(" ".join(thue_morse(n, *p))) for p in (("u", "v"), ("v", "u")))
        whole = [T.Ranges(w.hash).names(np.array([0]), np.array([n]))[0] for w in (x, y)]
        assert whole[0] != whole[1]


def test_ranges_match_by_words_alone():
    r = random.Random(2)
    words = [r.choice("abc") for _ in range(300)]
    w = names(" ".join(words))
    ranges = T.Ranges(w.hash)
    pairs = [(i, r.randrange(i, 301)) for i in (r.randrange(300) for _ in range(3000))]
    start, end = (np.array(x) for x in zip(*pairs))
    of = {}
    for (i, j), name in zip(pairs, ranges.names(start, end).tolist()):
        assert of.setdefault(tuple(words[i:j]), name) == name
    assert len(set(of.values())) == len(of)


def test_words_match_a_plain_version():
    r = random.Random(3)
    texts = ["".join(r.choice(["a", "B", "é", " ", "\t", "\x0b", " ", "-"]) for _ in range(r.randrange(60))) for _ in range(200)] + [None, "", " "]
    w = T.words(pa.array(texts, pa.string()))
    data, _ = T.utf8(pa.array(texts, pa.string()))
    raw = data.tobytes()
    for i, t in enumerate(texts):
        got = [raw[s:e] for s, e in zip(w.start[w.rows[i] : w.rows[i + 1]], w.end[w.rows[i] : w.rows[i + 1]])]
        assert got == WORD.findall((t or "").encode())
