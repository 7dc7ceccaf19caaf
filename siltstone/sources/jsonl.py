"""JSONL and JSON scans that keep bad lines as data."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siltstone.functions.variant import strict_json
from siltstone.scratch import Scratch

ROWS = "file string, file_ord int, line long, raw string, v variant, problem string"
#: The table of ranges is sent to all workers up to this many; there is one for each split of a file.
BROADCAST_RANGES = 1_000_000
# The characters that Python strips as white space.
WHITE = r"\x09-\x0d\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_MISSING, _EMPTY, _MALFORMED, _MARK = "input file not found", "file is empty", "malformed JSON", b"\xef\xbb\xbf"


class _File(NamedTuple):
    file: str
    file_ord: int
    path: str | None
    bytes: int
    marked: bool


def _fs(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def _exists(spark: SparkSession, path: str) -> bool:
    store, target = _fs(spark, path)
    return store.exists(target)


def _listed(spark: SparkSession, paths: list[str]) -> list[_File]:
    """The named files with their size and whether they begin with a byte order mark; a folder stands for its .jsonl files by name."""
    out: list[_File] = []
    for path in paths:
        store, target = _fs(spark, path)
        if not store.exists(target):
            out.append(_File(path, len(out), None, 0, False))
            continue
        status = store.getFileStatus(target)
        found = [status]
        if status.isDirectory():
            found = sorted((x for x in store.listStatus(target) if x.isFile() and x.getPath().getName().endswith(".jsonl")), key=lambda x: x.getPath().getName())
        for one in found:
            handle = store.open(one.getPath())
            try:
                marked = one.getLen() >= 3 and bytes(handle.read() for _ in range(3)) == _MARK
            finally:
                handle.close()
            name = path if one is status else f"{path.rstrip('/')}/{one.getPath().getName()}"
            out.append(_File(name, len(out), one.getPath().toString(), one.getLen(), marked))
    return out


def _lines(spark: SparkSession, files: list[_File]) -> DataFrame:
    """(path, start, at, raw): the lines of each split of the files; ``at`` rises by one from line to line of a split."""
    paths = sorted({f.path for f in files if f.bytes})
    # a file's name as the reader reports it, without the number of slashes after the scheme
    path = F.regexp_replace(F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B"))), r"^(\w+):/+", "$1:/")
    return spark.read.text(paths).select(path.alias("path"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("at"), F.col("value").alias("raw"))


def scan(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """One row per non-blank line of the files, in ``ROWS``: 1-based line numbers, the parsed object in
    ``v``, and a ``problem`` where the line is malformed, no object or no UTF-8.

    Lines end at LF, CRLF or CR; U+2028 stays inside a line; the last line needs no end. A byte order mark
    makes its line malformed. A missing file and a file without a line that is not blank are one problem row
    each, with line null. Files keep the order of ``paths``; one named twice is read twice, a folder stands
    for its .jsonl files. JSON as the engine's VARIANT takes it: a repeated key, NaN and Infinity are malformed.

    Files are split like any text: a first pass counts the lines of each split, their running sums give the
    number of the split's first line, and a line's number follows from its place in the split. The table of
    splits is one row for each; lines are never shuffled while it can be broadcast.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    files = _listed(spark, paths)
    none = F.lit(None)
    table = spark.createDataFrame(files or [], "file string, file_ord int, path string, bytes long, marked boolean")
    table = table.withColumn("path", F.regexp_replace("path", r"^(\w+):/+", "$1:/"))
    odd = lambda frame, said: frame.select("file", "file_ord", none.cast("long").alias("line"), none.cast("string").alias("raw"), none.cast("variant").alias("v"), F.lit(said).alias("problem"))
    missing = odd(table.where("path IS NULL"), _MISSING)
    if not any(f.bytes for f in files):
        return missing.unionByName(odd(table.where("path IS NOT NULL"), _EMPTY))
    lines = _lines(spark, files)
    filled = ~F.col("raw").rlike(f"^[{WHITE}]*$")
    ranges = lines.groupBy("path", "start").agg(F.count("*").alias("n"), F.min("at").alias("first"), F.count_if(filled).alias("filled"))
    ranges = Scratch(spark, "jsonl").save(ranges, "ranges")
    counts = table.join(ranges.groupBy("path").agg(F.sum("filled").alias("filled")), "path", "left").where("path IS NOT NULL")
    empty = odd(counts.where("coalesce(filled, 0) = 0 AND NOT marked").select("file", "file_ord"), _EMPTY)
    bare = odd(counts.where("marked AND bytes = 3").select("file", "file_ord"), _MALFORMED).withColumn("line", F.lit(1).cast("long"))
    before = F.sum("n").over(Window.partitionBy("path").orderBy("start")) - F.col("n")
    places = ranges.withColumn("before", before).join(F.broadcast(table), "path").select("path", "start", "n", "first", "before", "file", "file_ord", "marked")
    split = int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    if sum(-(-f.bytes // split) for f in files) <= BROADCAST_RANGES:
        places = F.broadcast(places)
    offset = F.col("at") - F.col("first")
    line = F.when((offset >= 0) & (offset < F.col("n")), F.col("before") + offset + 1).otherwise(F.raise_error(F.lit("the files' splits differ from those counted")).cast("long"))
    d = lines.withColumn("filled", filled).where("filled OR start = 0").join(places, ["path", "start"]).withColumn("line", line)
    first = F.col("marked") & (F.col("line") == 1)
    v = strict_json(F.col("raw"))
    utf8 = F.is_valid_utf8("raw")
    bad = v.isNull() | first
    problem = F.when(~utf8, F.lit("line is not UTF-8")).when(bad, F.lit(_MALFORMED)).when(~F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False)), F.lit("row must be a JSON object"))
    d = d.where(F.col("filled") | first).select("file", "file_ord", "line", "raw", F.when(utf8 & ~bad, v).alias("v"), problem.alias("problem"))
    return d.unionByName(missing).unionByName(empty).unionByName(bare)


def rows(scanned: DataFrame) -> DataFrame:
    """The good rows of a scan."""
    return scanned.where("problem IS NULL")


def problems(scanned: DataFrame) -> DataFrame:
    """(file, line, problem) of the bad ones."""
    return scanned.where("problem IS NOT NULL").select("file", "file_ord", "line", "problem")


def payload_rows(scanned: DataFrame, column: str = "raw") -> DataFrame:
    """Rows of whole JSON documents: an array, {"answers": [...]}, {"rows": [...]} or one object.

    Adds row_index (from 0), ``v`` of each row and ``kind``: json_array, json_wrapper or json_single.
    """
    v = strict_json(F.col(column))
    list_of = lambda path: F.try_variant_get(v, path, "array<variant>")
    kind = F.when(list_of("$").isNotNull(), "json_array").when(list_of("$.answers").isNotNull() | list_of("$.rows").isNotNull(), "json_wrapper").when(F.schema_of_variant(v).startswith("OBJECT"), "json_single")
    items = F.coalesce(list_of("$"), list_of("$.answers"), list_of("$.rows"), F.when(F.schema_of_variant(v).startswith("OBJECT"), F.array(v)))
    return scanned.withColumn("kind", kind).select("*", F.posexplode(items).alias("row_index", "item"))


def documents(spark: SparkSession, path: str) -> DataFrame:
    """(file, raw) of whole files, recursively."""
    return spark.read.text(path, wholetext=True, recursiveFileLookup=True).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("raw"))
