"""Ordered, guarded outputs on the driver's file system and through Spark."""

from __future__ import annotations

import csv
import io
import json
import os
import re
import tempfile
import uuid
from collections.abc import Iterable
from hashlib import sha256
from pathlib import Path

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

CREATOR_KEY = "created_by"


def atomic_text(path: str | Path, content: str) -> None:
    """Write beside the target, then replace it."""
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    handle, spare = tempfile.mkstemp(dir=path.parent)
    try:
        with os.fdopen(handle, "w", encoding="utf-8", newline="\n") as f:
            f.write(content)
        os.replace(spare, path)
    except BaseException:
        os.unlink(spare)
        raise


def write_jsonl(rows: DataFrame, path: str | Path, order: list[str], column: str = "raw") -> int:
    """One JSON text per line, by ``order``, streamed through the driver a partition at a time."""
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    handle, spare = tempfile.mkstemp(dir=path.parent)
    n = 0
    with os.fdopen(handle, "w", encoding="utf-8", newline="\n") as f:
        for r in rows.orderBy(*order).select(column).toLocalIterator():
            f.write(r[0] + "\n")
            n += 1
    os.replace(spare, path)
    return n


def write_jsonl_parts(rows: DataFrame, path: str, order: list[str], column: str = "raw") -> None:
    """The same for large outputs: part files in global order, committed by Spark."""
    rows.repartitionByRange(*order).sortWithinPartitions(*order).select(F.col(column).alias("value")).write.mode("overwrite").text(path)


def _store(spark: SparkSession, path: str):
    """The file system of a path and the path; a local one without its checksum files."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return (store.getRawFileSystem() if store.getUri().getScheme() == "file" else store), target


class _Output:
    """A file that appears under its name when it is whole, with the SHA-256 of its bytes."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark.sparkContext._jvm
        self.store, self.target = _store(spark, path)
        self.store.mkdirs(self.target.getParent())
        self.spare = self.jvm.org.apache.hadoop.fs.Path(self.target.getParent(), f".{self.target.getName()}-{uuid.uuid4().hex}")
        self.digest = self.jvm.java.security.MessageDigest.getInstance("SHA-256")
        self.out = self.jvm.java.security.DigestOutputStream(self.store.create(self.spare, True), self.digest)

    def __enter__(self):
        return self.out

    def __exit__(self, kind, *_):
        self.out.close()
        if kind is not None:
            self.store.delete(self.spare, False)
            return
        self.store.delete(self.target, False)
        if not self.store.rename(self.spare, self.target):
            raise OSError(f"could not write {self.target.toString()}")

    def sha256(self) -> str:
        return bytes(self.digest.digest()).hex()


def write_ordered(rows: DataFrame, path: str, order: list[str], scratch, column: str = "raw") -> dict:
    """One JSON text per line, by ``order``, as one file; {path, sha256, rows}.

    Tasks write the parts, in global order; the parts are then appended by the driver's JVM, byte for byte.
    """
    spark, parts, seen = rows.sparkSession, f"{scratch.path}/parts-{uuid.uuid4().hex}", Observation()
    sorted_ = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    sorted_.select(F.col(column).alias("value")).observe(seen, F.count("*").alias("n")).write.text(parts)
    store, folder = _store(spark, parts)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    found = sorted((x.getPath() for x in store.listStatus(folder) if x.getPath().getName().startswith("part-")), key=lambda p: (len(p.getName()), p.getName()))
    file = _Output(spark, path)
    with file as out:
        for part in found:
            source = store.open(part)
            try:
                spark.sparkContext._jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, conf, False)
            finally:
                source.close()
    store.delete(folder, True)
    return {"path": path.rsplit("/", 1)[-1], "sha256": file.sha256(), "rows": seen.get["n"]}


def write_text(spark: SparkSession, path: str, pieces: Iterable[str]) -> dict:
    """A text file from pieces, a megabyte at a time; {path, sha256, rows}."""
    file, held, size = _Output(spark, path), [], 0
    with file as out:
        for piece in pieces:
            held.append(piece)
            size += len(piece)
            if size > 1 << 20:
                out.write("".join(held).encode())
                held, size = [], 0
        out.write("".join(held).encode())
    return {"path": path.rsplit("/", 1)[-1], "sha256": file.sha256(), "rows": 1}


def compact(value) -> str:
    return json.dumps(value, ensure_ascii=False, separators=(",", ":"))


def csv_text(rows: list[dict], columns: list[str]) -> str:
    out = io.StringIO()
    w = csv.DictWriter(out, columns, extrasaction="ignore", lineterminator="\n")
    w.writeheader()
    w.writerows(rows)
    return out.getvalue()


def safe_name(key: str, suffix: str = ".txt") -> str:
    """A file name for any key: safe characters, 80 at most, and ten of its hash."""
    stem = re.sub(r"[^A-Za-z0-9._-]+", "_", key).strip("._-") or "row"
    return f"{stem[:80]}-{sha256(key.encode()).hexdigest()[:10]}{suffix}"


def safe_name_column(key: str, suffix: str = ".txt") -> Column:
    """The same as an expression."""
    stem = F.regexp_replace(F.regexp_replace(key, r"[^A-Za-z0-9._-]+", "_"), r"^[._-]+|[._-]+$", "")
    stem = F.when(stem == "", "row").otherwise(F.substring(stem, 1, 80))
    return F.concat(stem, F.lit("-"), F.substring(F.sha2(key, 256), 1, 10), F.lit(suffix))


class OutputGuard:
    """Decides which planned files may be replaced.

    Only JSON files that carry this tool's creator tag may be; symlinks, roots, the home folder and
    overlaps with the inputs are refused.
    """

    def __init__(self, creator: str):
        self.creator = creator

    def problems(self, output_dir: str, planned: list[str], inputs: list[str] = (), force: bool = False) -> list[str]:
        out, found = Path(output_dir), []
        if out.is_symlink() or any(p.is_symlink() for p in out.parents if p.exists()):
            found.append("output directory lies behind a symlink")
        real = out.resolve()
        if real in (Path("/"), Path.home()):
            found.append("output directory is a root")
        for path in map(lambda x: Path(x).resolve(), inputs):
            if path == real or real in path.parents or path in real.parents:
                found.append(f"output directory overlaps input {path.name}")
        for name in planned:
            target = out / name
            if target.is_symlink():
                found.append(f"{name} is a symlink")
            elif target.exists():
                if not force:
                    found.append(f"{name} exists")
                elif not self.owns(target):
                    found.append(f"{name} was not created by {self.creator}")
        return found

    def owns(self, path: Path) -> bool:
        try:
            first = path.read_text(encoding="utf-8")
            value = json.loads(first if path.suffix == ".json" else first.split("\n", 1)[0])
        except (OSError, ValueError):
            return False
        return isinstance(value, dict) and value.get(CREATOR_KEY) == self.creator
