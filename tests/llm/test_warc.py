import base64
import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from conftest_llm import SF
from siltstone.llm import warc


@settings(max_examples=50, deadline=None)
@given(st.binary(max_size=40_000))
def test_chunked_framing_round_trips(payload):
    assert warc.unchunked(warc.chunked(payload)) == payload


def test_broken_framing_is_refused():
    whole = warc.chunked(b"hello")
    assert warc.unchunked(whole[:-5]) is None and warc.unchunked(b"zz\r\nab\r\n0\r\n\r\n") is None


def expect(rows):
    top = {}
    for i, body in rows:
        b = (body or "").encode()
        top[b] = max(top.get(b, -1), i)
    out = set()
    for i, body in rows:
        b = (body or "").encode()
        d = base64.b32encode(hashlib.sha1(b).digest()).decode()
        out.add((i, len(b), d, *(("response", None) if i == top[b] else ("revisit", top[b]))))
    return out


def test_round_trip(spark):
    big = "<p>" + "é long text " * 30_000
    rows = [(1, None), (2, ""), (3, "a"), (4, "a"), (5, big), (6, big), (7, "x" * 32_600), (9, big + "!"), (10, "\r\n\r\n0\r\n\r\n")]
    pages = spark.createDataFrame([(i, None if i == 3 else f"http://x/ {i}", h, 1) for i, h in rows], "page_id long, url string, html string, digest int")
    got = warc.round_trip(pages).collect()
    assert all(r.valid for r in got) and len(got) == len(rows)
    assert {tuple(r)[:5] for r in got} == expect(rows)
    assert {r.page_id: r.n_segments for r in got}[9] > 5


def test_table_and_empty(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = warc.round_trip(pages).collect()
    assert {tuple(r)[:5] for r in got} == expect([(r.page_id, r.html) for r in pages.collect()])
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_missing_segment_is_not_valid(spark):
    rows = [("o", 1, None, "response", 1, None, "D", None, None, b"HTTP/1.1 200 OK\r\n\r\nab"), ("o", 3, 99, "continuation", None, None, "D", None, None, b"cd")]
    found = spark.createDataFrame(rows, warc.RECORD)
    (r,) = warc.reassemble(found, 2).collect()
    assert not r.valid and r.payload_bytes is None
