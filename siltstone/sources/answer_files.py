"""Answer files in their own containers: found, read as rows, and written back the way they were.

A container is a JSON object with a list ``answers``, a JSON array, one answer, or JSON lines. A Spark data source
writes them: tasks put whole files into a staging folder, the commit moves them to their places, an abort
removes the folder, so a job that fails leaves nothing.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StringType

from siltstone import vocab as V
from siltstone.functions.json_text import compact
from siltstone.functions.variant import Node, strict_json
from siltstone.sources import jsonl

PATTERN = "*rtl_answer*v0_1*.json*"
# Parts of the names of files that hold no answers.
NOT_ANSWERS = ("manifest", "dataset_card", "validation", "report", "summary", "scores")
ROWS = "file string, kind string, row_index int, raw string, rest string"
PROBLEMS = "file string, problem string"


def found(spark: SparkSession, paths: list[str], pattern: str = PATTERN) -> list[str]:
    """Files named, and those below the folders named whose names fit, without files of other kinds by name; sorted, each once."""
    out: set[str] = set()
    for path in paths:
        store, target = jsonl._fs(spark, path)
        if store.exists(target) and store.getFileStatus(target).isDirectory():
            listed = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path).select("path")
            out |= {r.path for r in listed.collect()}  # names alone; contents are not read
        else:
            out.add(path)
    return sorted(p for p in out if not any(m in p.rsplit("/", 1)[-1].lower() for m in NOT_ANSWERS))


def read(spark: SparkSession, paths: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows, problems): each answer of the files in ``ROWS``, row_index from 1; ``rest`` is what a wrapper holds beside.

    A file is parsed whole where it is one JSON document, else by lines (splittable), named .jsonl or not. Chat rows are no
    answers: a file of them gives no row and no problem. Reported are files that are missing, hold no answer, or
    mix answers with others, lines that are malformed, and elements that are no object.
    """
    here = [p for p in paths if jsonl._exists(spark, p)]
    none = spark.createDataFrame([], ROWS), spark.createDataFrame([(p, "file not found") for p in sorted(set(paths) - set(here))], PROBLEMS)
    if not here:
        return none
    whole, lined = [p for p in here if not p.endswith(".jsonl")], [p for p in here if p.endswith(".jsonl")]
    rows, problems = none
    if whole:
        text = spark.read.text(whole, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("raw"), strict_json(F.col("value")).alias("v"))
        lined += [r.file for r in text.where("v IS NULL").select("file").collect()]
        v = Node("v")
        listed = v["answers"].is_list()
        kind = F.when(listed, "json_wrapper").when(v.is_list(), "json_array").when(v["schema_version"].isin(V.ANSWER_SCHEMA), "json_single")
        text = text.where("v IS NOT NULL").withColumn("kind", kind)
        items = F.when(F.col("kind") == "json_wrapper", v["answers"].items()).when(F.col("kind") == "json_array", v.items()).otherwise(F.array("v"))
        each = text.where("kind IS NOT NULL").select("file", "kind", "raw", F.posexplode(items).alias("k", "item"))
        objects = F.schema_of_variant("item").startswith("OBJECT")
        rest = _rest(F.when(F.col("kind") == "json_wrapper", F.col("raw")))
        rows = rows.union(each.where(objects).select("file", "kind", (F.col("k") + 1).alias("row_index"), _nth("raw", "kind", "k").alias("raw"), rest))
        problems = problems.union(each.where(~objects).select("file", F.format_string("answer %d must be a JSON object", F.col("k") + 1)))
        problems = problems.union(text.where(F.col("kind").isNull() & ~_chat(v)).select("file", F.lit("no standalone answers")))
    if lined:
        scanned = jsonl.scan(spark, sorted(lined))
        problems = problems.union(jsonl.problems(scanned).select("file", F.concat(F.coalesce(F.concat(F.lit("line "), "line", F.lit(": ")), F.lit("")), "problem")))
        v = Node("v")
        good = jsonl.rows(scanned).withColumn("answer", v["schema_version"].isin(V.ANSWER_SCHEMA)).withColumn("chat", _chat(v))
        broken = jsonl.problems(scanned).select("file").distinct()
        about = good.groupBy("file").agg(F.count("*").alias("n"), F.count_if("answer").alias("answers"), F.count_if("chat").alias("chats")).where("n <> answers AND n <> chats")
        problems = problems.union(about.join(broken, "file", "left_anti").select("file", F.when(F.col("answers") > 0, "answers mixed with other rows").otherwise("no standalone answers")))
        good = good.where("answer").join(broken, "file", "left_anti")
        rows = rows.union(good.select("file", F.lit("jsonl"), F.col("line").cast("int"), "raw", F.lit(None).cast("string")))
    return rows, problems


def _chat(v: Node):
    roles = F.transform(v["messages"].items(), lambda m: F.try_variant_get(m, "$.role", "string"))
    return F.coalesce(F.array_contains(roles, "assistant"), F.lit(False))


@F.pandas_udf(StringType())
def _nth(raw: pd.Series, kind: pd.Series, k: pd.Series) -> pd.Series:
    """An element of a container as it is written, keys in their order."""
    seen: dict[str, object] = {}

    def one(text, what, at):
        if text not in seen:
            seen.clear()
            seen[text] = json.loads(text)
        value = seen[text]
        return compact(value if what == "json_single" else (value["answers"] if what == "json_wrapper" else value)[at])

    return pd.Series([one(*x) for x in zip(raw, kind, k)], dtype=object)


@F.pandas_udf(StringType())
def _rest(raw: pd.Series) -> pd.Series:
    """A wrapper without its answers."""
    return raw.map(lambda t: compact({k: [] if k == "answers" else x for k, x in json.loads(t).items()}), na_action="ignore")


@dataclass
class Written(WriterCommitMessage):
    names: list[str]


class _Writer(DataSourceWriter):
    def __init__(self, target: str):
        self.target, self.stage = target.rstrip("/"), f"{target.rstrip('/')}/.staging-{uuid.uuid4().hex}"

    def _store(self, path: str):
        from pyarrow import fs

        if "://" not in path and not path.startswith("file:"):
            path = "file://" + path
        return fs.FileSystem.from_uri(path)

    def write(self, iterator: Iterator) -> Written:
        """Rows of a file come together and in order; each file is written whole."""
        import itertools

        names = []
        store, base = self._store(self.stage)
        for (name, kind), rows in itertools.groupby(iterator, key=lambda r: (r.file, r.kind)):
            path = f"{base}/{name}"
            store.create_dir(path.rsplit("/", 1)[0], recursive=True)
            with store.open_output_stream(path, compression=None) as out:
                if kind == "jsonl":
                    for r in rows:
                        out.write((r.raw + "\n").encode())
                else:
                    held = list(rows)
                    answers = [json.loads(r.raw) for r in held]
                    value = json.loads(held[0].rest) | {"answers": answers} if kind == "json_wrapper" else answers if kind == "json_array" else answers[0]
                    out.write((json.dumps(value, ensure_ascii=False, indent=2) + "\n").encode())
            names.append(name)
        return Written(names)

    def commit(self, messages: list) -> None:
        store, base = self._store(self.stage)
        _, final = self._store(self.target)
        for m in messages:
            for name in m.names if m else ():
                store.create_dir(f"{final}/{name}".rsplit("/", 1)[0], recursive=True)
                store.move(f"{base}/{name}", f"{final}/{name}")
        self._drop()

    def abort(self, messages: list) -> None:
        self._drop()

    def _drop(self) -> None:
        from pyarrow import fs

        store, base = self._store(self.stage)
        if store.get_file_info(base).type != fs.FileType.NotFound:
            store.delete_dir(base)


class AnswerFiles(DataSource):
    """``df.write.format("answer_files").save(folder)`` for rows in ``ROWS``, whose ``file`` is a path below the folder."""

    @classmethod
    def name(cls) -> str:
        return "answer_files"

    def schema(self) -> str:
        return ROWS

    def writer(self, schema, overwrite: bool) -> _Writer:
        return _Writer(self.options["path"])


def write(rows: DataFrame, target: str) -> None:
    """Write ``ROWS`` back as files below ``target``, each in its container; a file goes to one task."""
    spark = rows.sparkSession
    spark.dataSource.register(AnswerFiles)
    dealt = rows.select(*[c.split()[0] for c in ROWS.split(", ")]).repartition("file").sortWithinPartitions("file", "row_index")
    dealt.write.format("answer_files").mode("append").save(target)
