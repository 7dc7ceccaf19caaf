"""Public example sets as tables: manifests with side files, task exports and directory layouts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone import vocab as V
from siltstone.functions.variant import Node
from siltstone.scratch import Scratch
from siltstone.sources import jsonl

MAX_BYTES = 1 << 20
# Path fields of a manifest, and the names under which exports keep a field.
PATHS = ("rtl_code_path", "before_rtl_code_path", "after_rtl_code_path", "testbench_path", "lint_log_path", "synthesis_report_path", "toggle_report_path")
ALIASES = {
    "source_id": ("task_id", "problem_id", "id", "name"),
    "prompt": ("prompt", "instruction", "description", "spec"),
    "rtl": ("canonical_solution", "solution", "rtl", "verilog", "reference_solution"),
    "testbench": ("test", "testbench", "checker"),
}
REQUIRED = ("id", "source", "license", "design_family", "task_type", "user_goal")


def normal_path(path: Column) -> Column:
    """A relative path without ".", ".." and empty parts; null if it leaves its root."""
    start = F.struct(F.array().cast("array<string>").alias("kept"), F.lit(False).alias("out"))

    def step(state, part):
        up, size = part == "..", F.size(state["kept"])
        kept = F.when(part.isin("", "."), state["kept"]).when(up, F.slice(state["kept"], F.lit(1), F.greatest(size - 1, F.lit(0)))).otherwise(F.array_append(state["kept"], part))
        return F.struct(kept.alias("kept"), (state["out"] | (up & (size == 0))).alias("out"))

    return F.aggregate(F.split(path, "/"), start, step, lambda x: F.when(~x["out"], F.array_join(x["kept"], "/")))


def _unschemed(path: Column) -> Column:
    return F.regexp_replace(path, r"^[a-z0-9]+:/*", "/")


def side_files(spark: SparkSession, root: str, wanted: DataFrame, most: int = MAX_BYTES) -> DataFrame:
    """wanted (..., path) with ``text`` of the file at that path below ``root``, or ``refused`` with the reason.

    The folder is listed as a table and joined by relative path; contents are read by tasks, of files that are
    asked for and not too large. No path passes through the driver.
    """
    base = F.regexp_replace(_unschemed(F.lit(jsonl._fs(spark, root)[0].makeQualified(jsonl._fs(spark, root)[1]).toString())), "/+$", "")
    below = F.expr("substring(whole, length(base) + 2)")
    files = lambda: spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).withColumn("whole", _unschemed(F.col("path"))).withColumn("base", base)
    asked = wanted.withColumn("_norm", normal_path(F.col("path")))
    sizes = files().select(below.alias("_norm"), F.col("length").alias("_size"))
    names = asked.select("_norm").distinct()
    texts = files().where(F.col("length") <= most).select(below.alias("_norm"), "content").join(names, "_norm", "left_semi")
    told = asked.join(sizes, "_norm", "left").join(texts, "_norm", "left")
    text = F.col("content").cast("string")
    refused = (
        F.when(F.length(F.trim("path")) == 0, "artifact path must be a non-empty string or null")
        .when(F.col("path").startswith("/"), "absolute path").when(F.col("_norm").isNull(), "path leaves the root").when(F.col("_size").isNull(), "file not found")
        .when(F.col("_size") > most, "file too large").when(~F.is_valid_utf8(text), "not UTF-8")
    )
    return told.withColumn("refused", refused).withColumn("text", F.when(F.col("refused").isNull(), text)).drop("_norm", "_size", "content")


def manifest(spark: SparkSession, path: str, limit: int | None = None, source: str | None = None, license: str | None = None, most: int = MAX_BYTES) -> tuple[DataFrame, DataFrame]:
    """(examples, rejections) of a manifest, or of the manifest.jsonl of a folder, whose side files lie below its folder.

    A row is rejected for the first thing wrong with its fields, or for all that is wrong with its files. ``limit``
    counts accepted rows in line order; lines after the last of them are not looked at, so they are no rejections
    either. ``source`` and ``license`` stand in for those of the rows.
    """
    if not path.endswith((".json", ".jsonl")):
        path = f"{path.rstrip('/')}/manifest.jsonl"
    root = path.rsplit("/", 1)[0] if "/" in path else "."
    scanned = jsonl.scan(spark, path)
    v = Node("v")
    given = {"source": F.lit(source) if source else v["source"].text(), "license": F.lit(license) if license else v["license"].text()}
    blank = lambda c: ~F.coalesce(F.length(F.trim(c)) > 0, F.lit(False))
    missing = F.filter(F.array(*[F.when(v[f].absent(), F.lit(f)) for f in sorted((*REQUIRED, "artifacts", "provenance"))]), lambda x: x.isNotNull())
    tests = [
        (F.size(missing) > 0, F.concat(F.lit("missing "), F.array_join(missing, ", "))), (~F.coalesce(given["source"].isin(*V.SOURCES), F.lit(False)), F.lit("invalid source")),
        (~v["task_type"].isin(V.TASK_TYPES), F.lit("invalid task_type")), (~v["user_goal"].isin(V.USER_GOALS), F.lit("invalid user_goal")), (blank(v["id"].text()), F.lit("blank id")),
        (blank(given["license"]), F.lit("blank license")), (blank(v["design_family"].text()), F.lit("blank design_family")), (~v["artifacts"].is_object(), F.lit("artifacts must be an object")),
        (~v["provenance"].is_object(), F.lit("provenance must be an object")),
    ]
    wrong = F.lit(None).cast("string")
    for when, said in reversed(tests):
        wrong = F.when(when, said).otherwise(wrong)
    rows = jsonl.rows(scanned).withColumn("wrong", wrong)
    each = F.array(*[F.struct(F.lit(p.removesuffix("_path")).alias("name"), v["artifacts"][p].present().alias("set"), v["artifacts"][p].kind.alias("kind"), v["artifacts"][p].text().alias("path")) for p in PATHS])
    wanted = rows.where("wrong IS NULL").select("line", F.inline(each)).where("`set` AND kind <> 'VOID'").select("line", "name", F.coalesce("path", F.lit("")).alias("path"))
    read = side_files(spark, root, wanted, most)
    per_row = read.groupBy("line").agg(
        F.map_from_entries(F.filter(F.collect_list(F.when(F.col("refused").isNull(), F.struct("name", "text"))), lambda x: x.isNotNull())).alias("artifacts"),
        F.sort_array(F.filter(F.collect_list(F.when(F.col("refused").isNotNull(), F.concat_ws(": ", "name", "refused"))), lambda x: x.isNotNull())).alias("bad"),
    )
    none = F.array().cast("array<string>")
    rows = rows.join(per_row, "line", "left").withColumn("bad", F.coalesce("bad", none))
    bare = F.when(F.size(F.coalesce(F.map_keys("artifacts"), none)) == 0, F.array(F.lit("no artifacts"))).otherwise(none)
    rows = rows.withColumn("errors", F.when(F.col("wrong").isNotNull(), F.array("wrong")).otherwise(F.concat("bad", F.when(F.size("bad") == 0, bare).otherwise(none))))
    rows = Scratch(spark, "manifest").save(rows.select("line", *[(given[f] if f in given else v[f].text()).alias("source_id" if f == "id" else f) for f in REQUIRED], "artifacts", v["provenance"].value.alias("provenance"), "errors"), "rows")
    found = rows.where(F.size("errors") == 0).drop("errors")
    rejected = rows.where(F.size("errors") > 0).select("line", "source_id", "errors").union(jsonl.problems(scanned).select("line", F.lit(None).cast("string").alias("source_id"), F.array("problem").alias("errors")))
    if limit is not None:
        found = found.orderBy("line").limit(limit)
        if limit and (last := found.agg(F.count("*").alias("n"), F.max("line").alias("line")).first()).n == limit:
            rejected = rejected.where(F.col("line").isNull() | (F.col("line") < last.line))
    return found, rejected


def first_filled(v: Node, names: tuple[str, ...]) -> Column:
    """The first non-blank string among fields."""
    return F.coalesce(*[F.when(v[n].filled(), v[n].text()) for n in names])


def export(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(examples, rejections) of a JSONL export with varying field names; code must declare a module."""
    scanned = jsonl.scan(spark, path)
    rows = jsonl.rows(scanned).select("line", *[first_filled(Node("v"), names).alias(k) for k, names in ALIASES.items()])
    why = F.filter(
        F.array(F.when(F.col("source_id").isNull(), "missing id"), F.when(F.col("prompt").isNull(), "missing prompt"), F.when(F.col("rtl").isNull(), "missing rtl").when(~F.col("rtl").rlike(r"\bmodule\b"), "no module")),
        lambda x: x.isNotNull(),
    )
    rows = rows.withColumn("errors", why)
    bad = jsonl.problems(scanned).select("line", F.lit(None).cast("string").alias("source_id"), F.array("problem").alias("errors"))
    return rows.where(F.size("errors") == 0).drop("errors"), rows.where(F.size("errors") > 0).select("line", "source_id", "errors").union(bad)


def directory(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """(examples, rejections) of a folder of <stem>_prompt.txt, <stem>_ref.sv and, if any, <stem>_test.sv."""
    files = spark.read.text(root, wholetext=True, recursiveFileLookup=True)
    name = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)_(prompt\.txt|ref\.sv|test\.sv)$", 1)
    kind = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)_(prompt|ref|test)\.(?:txt|sv)$", 2)
    parts = files.select(name.alias("source_id"), kind.alias("kind"), "value").where("source_id <> ''")
    wide = parts.groupBy("source_id").pivot("kind", ["prompt", "ref", "test"]).agg(F.first("value"))
    wide = wide.select("source_id", "prompt", F.col("ref").alias("rtl"), F.col("test").alias("testbench"))
    why = F.filter(F.array(F.when(F.col("prompt").isNull(), "missing prompt"), F.when(F.col("rtl").isNull(), "missing rtl")), lambda x: x.isNotNull())
    wide = wide.withColumn("errors", why)
    return wide.where(F.size("errors") == 0).drop("errors"), wide.where(F.size("errors") > 0).select("source_id", "errors")


def _unknown(spark: SparkSession, said: str) -> tuple[DataFrame, DataFrame]:
    """No example, and one rejection of the whole input."""
    return spark.createDataFrame([], "line long, source_id string"), spark.createDataFrame([(None, None, [said])], "line long, source_id string, errors array<string>")


def problems(spark: SparkSession, path: str):
    """SRC-6: benchmark problems by the shape of ``path``: a folder with a manifest.jsonl, a JSON lines file, or a folder of prompt, reference and test files."""
    if path.endswith(".jsonl"):
        return manifest(spark, path) if path.rsplit("/", 1)[-1] == "manifest.jsonl" else export(spark, path)
    inside = f"{path.rstrip('/')}/manifest.jsonl"
    if jsonl._exists(spark, inside):
        return manifest(spark, inside)
    store, target = jsonl._fs(spark, path)
    if store.exists(target) and store.getFileStatus(target).isDirectory():
        return directory(spark, path)
    return _unknown(spark, "layout not recognized: expected a manifest.jsonl, JSON lines or a folder of prompts and references")


def manifest_only(spark: SparkSession, path: str):
    """SRC-9 and SRC-10: collections that are known by their manifest alone; any other layout is one rejection."""
    inside = path if path.endswith("manifest.jsonl") else f"{path.rstrip('/')}/manifest.jsonl"
    return manifest(spark, inside) if jsonl._exists(spark, inside) else _unknown(spark, "layout not recognized: expected a manifest.jsonl")


ADAPTERS = {"manifest": manifest, "export": export, "directory": directory, "verilog_eval": problems, "rtllm": manifest_only, "rtlfixer": manifest_only}


def adapter(name: str):
    if name not in ADAPTERS:
        raise ValueError(f"unknown adapter {name}; choices: {', '.join(sorted(ADAPTERS))}")
    return ADAPTERS[name]
