"""WARC archives: writing with segmentation and revisits, reading with reassembly.

Responses hold an HTTP message with a chunked body. A block over ``segment_bytes`` is cut: the first
piece stays in the response record, the rest follow as continuation records that name the first by
WARC-Segment-Origin-ID. Readers deal segments by that identifier, order them by number, verify the
total length, undo the chunked framing and verify the payload digest.

Archives go to a folder all executors share; each task writes files under names of its own and
reports what it finished, so that a task run twice leaves no doubled records. Only reported byte
ranges are read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm import _text as T
from siltstone.scratch import Scratch

CHUNK = 8192
_DATE = "2024-01-01T00:00:00Z"
MANIFEST = "path string, start long, size long, records long"
RECORD = "origin string, segment int, total long, record_type string, page_id long, refers_to long, digest string, payload_bytes long, valid boolean, block binary"


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes) -> bytes:
    """The payload in chunked transfer framing."""
    parts = []
    for i in range(0, len(payload), CHUNK):
        piece = payload[i : i + CHUNK]
        parts.append(b"%x\r\n%b\r\n" % (len(piece), piece))
    return b"".join(parts) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes | None:
    """The payload of a chunked body; None if the framing is broken."""
    parts, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            return None
        try:
            size = int(body[at:end].split(b";")[0], 16)
        except ValueError:
            return None
        at = end + 2
        if size == 0:
            return b"".join(parts)
        if body[at + size : at + size + 2] != b"\r\n":
            return None
        parts.append(body[at : at + size])
        at += size + 2


def http_payload(block: bytes) -> bytes | None:
    """The payload of an HTTP response block, decoded if it is chunked."""
    head, sep, body = block.partition(b"\r\n\r\n")
    if not sep:
        return None
    return unchunked(body) if re.search(rb"(?im)^transfer-encoding:\s*chunked\s*$", head) else body


def _record(kind: str, identifier: str, fields: dict, block: bytes) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{identifier}>", f"WARC-Date: {_DATE}"]
    lines += [f"{k}: {v}" for k, v in fields.items() if v is not None] + [f"Content-Length: {len(block)}", "", ""]
    pack = zlib.compressobj(1, zlib.DEFLATED, 31)
    return pack.compress("\r\n".join(lines).encode()) + pack.compress(block + b"\r\n\r\n") + pack.flush()


def records(page_id, url, payload: bytes, refers_to, name: str, segment_bytes: int):
    """The gzip members of one page: a revisit, or a response and its continuations."""
    uri = re.sub(r"[\x00-\x20]", lambda m: f"%{ord(m[0]):02X}", url) if url else None
    common = {"WARC-Target-URI": uri, "WARC-Payload-Digest": f"sha1:{sha1_base32(payload)}", "X-Page-Id": page_id, "Content-Type": "application/http;msgtype=response"}
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
    if refers_to is not None:
        yield _record("revisit", name, common | {"WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", "X-Refers-To-Page": refers_to}, head)
        return
    block = head + chunked(payload)
    if len(block) <= segment_bytes:
        yield _record("response", name, common, block)
        return
    pieces = [block[i : i + segment_bytes] for i in range(0, len(block), segment_bytes)]
    yield _record("response", name, common | {"WARC-Segment-Number": 1}, pieces[0])
    for k, piece in enumerate(pieces[1:], 2):
        last = {"WARC-Segment-Total-Length": len(block)} if k == len(pieces) else {}
        yield _record("continuation", f"{name}-{k}", {"WARC-Segment-Number": k, "WARC-Segment-Origin-ID": f"<{name}>"} | last, piece)


def plan_revisits(pages: DataFrame, at_least: int, scratch: Scratch) -> DataFrame:
    """pages with refers_to: of equal payloads the largest page_id is the response.

    Digests that occur once are left out before the join, whose size then decides how it runs.
    """
    body = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    keyed = pages.select("page_id", "url", "html").withColumn("d", F.sha1(body)).withColumn("n", F.octet_length(F.coalesce("html", F.lit(""))))
    twice = keyed.where(F.col("n") >= at_least).groupBy("d").agg(F.max("page_id").alias("top"), F.count("*").alias("c")).where("c > 1").select("d", "top")
    twice = scratch.save(twice, "twice")
    out = keyed.join(twice, "d", "left")
    return out.select("page_id", "url", "html", F.when((F.col("page_id") < F.col("top")) | F.col("page_id").isNull(), F.col("top")).alias("refers_to"))


def write(planned: DataFrame, folder: str, segment_bytes: int, range_bytes: int = 8 << 20) -> DataFrame:
    """Write archives under folder; returns the manifest of finished byte ranges."""

    def run(batches):
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        path, out, ranges, at, begun, count, made = None, None, [], 0, 0, 0, 0
        for b in T.slices(batches, column="html"):
            for page_id, url, body, refers in zip(*(b.column(c).to_pylist() for c in ("page_id", "url", "html", "refers_to"))):
                if out is None:
                    path = f"{base}/{uuid.uuid4().hex}.warc.gz"
                    out = store.open_output_stream(path, compression=None)
                made += 1
                for member in records(page_id, url, (body or "").encode(), refers, f"urn:x-page:{page_id}:{path[-40:-8]}{made}", segment_bytes):
                    out.write(member)
                    at += len(member)
                    count += 1
                    if at - begun >= range_bytes:
                        ranges.append((path, begun, at - begun, count))
                        begun, count = at, 0
        if out is not None:
            out.close()
            if count:
                ranges.append((path, begun, at - begun, count))
        if ranges:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*ranges)], ["path", "start", "size", "records"])

    return planned.mapInArrow(T.frugal(run), MANIFEST)


def parse(stream, size: int):
    """(headers, block) of each gzip member in the next ``size`` bytes of a stream."""
    left, held = size, b""
    while left or held:
        member, unpack = [], zlib.decompressobj(31)
        while not unpack.eof:
            if not held:
                if not left:
                    raise ValueError("an archive ends inside a record")
                held = stream.read(min(left, 1 << 20))
                left -= len(held)
            member.append(unpack.decompress(held))
            held = unpack.unused_data
        head, _, body = b"".join(member).partition(b"\r\n\r\n")
        fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
        yield fields, body[: int(fields["Content-Length"])]


def read(manifest: DataFrame, folder: str) -> DataFrame:
    """Records of the reported ranges. Whole ones are decoded at once; segments keep their block."""

    def run(batches):
        from pyarrow import fs

        store, _ = fs.FileSystem.from_uri(folder)
        for b in batches:
            for path, start, size in zip(*(b.column(c).to_pylist() for c in ("path", "start", "size"))):
                rows, held = [], 0
                with store.open_input_file(path) as f:
                    f.seek(start)
                    for h, block in parse(f, size):
                        number = h.get("WARC-Segment-Number")
                        origin = h.get("WARC-Segment-Origin-ID", h["WARC-Record-ID"]).strip("<>")
                        page, refers = h.get("X-Page-Id"), h.get("X-Refers-To-Page")
                        digest = h.get("WARC-Payload-Digest", "").removeprefix("sha1:") or None
                        n = valid = None
                        if number is None and h["WARC-Type"] == "response":
                            payload = http_payload(block)
                            n, valid = (None, False) if payload is None else (len(payload), sha1_base32(payload) == digest)
                        elif number is None:
                            valid = True
                        total = h.get("WARC-Segment-Total-Length")
                        rows.append((origin, int(number or 0), total and int(total), h["WARC-Type"], page and int(page), refers and int(refers), digest, n, valid, block if number else None))
                        held += len(block)
                        if held > 4 << 20 or len(rows) >= 2000:
                            yield _batch(rows)
                            rows, held = [], 0
                if rows:
                    yield _batch(rows)

    return manifest.mapInArrow(T.frugal(run), RECORD)


_TYPES = [pa.string(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.bool_(), pa.binary()]


def _batch(rows):
    return pa.RecordBatch.from_arrays([pa.array(list(x), t) for x, t in zip(zip(*rows), _TYPES)], [x.split()[0] for x in RECORD.split(", ")])


def reassemble(found: DataFrame, parts: int) -> DataFrame:
    """One row per page record; continuation records are joined to their origin, in order and whole.

    Rows are dealt by origin identifier, which one record alone has, and read in order as a stream.
    """

    def run(batches):
        group: list = []

        def close():
            head = group[0]
            numbers, total = [g[1] for g in group], group[-1][2]
            block = b"".join(g[9] for g in group)
            payload = http_payload(block) if head[3] == "response" and numbers == list(range(1, len(group) + 1)) and total == len(block) else None
            n = None if payload is None else len(payload)
            return (head[0], len(group), total, head[3], head[4], head[5], head[6], n, payload is not None and sha1_base32(payload) == head[6], None)

        for b in batches:
            rows = []
            for row in zip(*(c.to_pylist() for c in b.columns)):
                if row[1] == 0:
                    rows.append(row)
                    continue
                if group and group[0][0] != row[0]:
                    rows.append(close())
                    group = []
                group.append(row)
            if rows:
                yield _batch(rows)
        if group:
            yield _batch([close()])

    return found.repartition(parts, "origin").sortWithinPartitions("origin", "segment").mapInArrow(T.frugal(run), RECORD)


def round_trip(pages: DataFrame, at_least: int = 0, segment_bytes: int = 32 << 10) -> DataFrame:
    """Write pages as WARC records, read the archives back: one row per page.

    Columns page_id, payload_bytes, payload_digest, record_type, refers_to, n_segments, valid. Null
    html: the empty payload. Of equal payloads of at least ``at_least`` bytes the largest page_id is
    the response; rows that repeat this page_id are responses as well, and a null page_id revisits.
    Null url: no target. Other columns are ignored. Empty table: empty result.
    """
    spark = pages.sparkSession
    scratch = Scratch(spark, "warc")
    folder = f"{scratch.path}/archives"
    manifest = scratch.save(write(plan_revisits(pages, at_least, scratch), folder, segment_bytes), "manifest")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = scratch.save(reassemble(read(manifest.repartition(parts), folder), parts).drop("block", "origin"), "found")
    scratch.drop("archives")
    first = found.where("record_type = 'response'").groupBy(F.col("page_id").alias("r"), F.col("digest").alias("d")).agg(F.max("payload_bytes").alias("whole"))
    again = found.where("record_type = 'revisit'")
    again = again.join(first, (again.refers_to == first.r) & (again.digest == first.d), "left").withColumn("payload_bytes", F.col("whole")).withColumn("valid", F.col("whole").isNotNull())
    columns = ["page_id", "payload_bytes", F.col("digest").alias("payload_digest"), "record_type", "refers_to", F.greatest("segment", F.lit(1)).alias("n_segments"), "valid"]
    return found.where("record_type = 'response'").select(*columns).unionByName(again.select(*columns))
