"""Inventory of a folder of data files, and a plan to tidy it: roles, schemas, hashes, duplicates, shared ids, moves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siltstone import vocab as V

# The roles of files.
ROLES = (
    "raw_source", "normalized_task", "teacher_answer_batch", "repaired_answer_batch", "assembled_answer_jsonl", "distill_dataset",
    "validation_report", "repair_report", "assembly_report", "eval_prompt", "eval_run", "unknown",
)
CHAT, BATCH = "train/chat row with messages", "rtl_answer_teacher_batch_v0.1"
REPORTS = ("validation_report", "repair_report", "assembly_report")


def _has(text: Column, *words: str) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | text.contains(w)
    return out


def role(path: Column, schema: Column | None = None, container: Column | None = None, batch: Column | None = None) -> Column:
    """EXT-27: the role of a file by its path below the root, the schema of its rows, its container and batch version; the first rule that fits decides."""
    p, none = F.lower(path), F.lit(None).cast("string")
    schema, container, batch = schema if schema is not None else none, container if container is not None else none, batch if batch is not None else none
    name, kind = F.substring_index(p, "/", -1), F.regexp_extract(p, r"\.[a-z0-9]+$", 0)
    report, lines = kind.isin(".json", ".md"), kind == ".jsonl"
    answers, tasks, chat = (F.coalesce(c, F.lit(False)) for c in (schema.isin(*V.ANSWER_SCHEMA), schema.isin(*V.TASK_SCHEMA), schema == CHAT))
    rules = [
        ("assembly_report", report & _has(name, "assembly") & _has(name, "report")),
        ("repair_report", report & _has(name, "repair") & _has(name, "report")),
        ("validation_report", report & _has(name, "validation", "readiness_report", "triage_report", "selection_report")),
        ("teacher_answer_batch", F.coalesce(batch == BATCH, F.lit(False))),
        ("repaired_answer_batch", answers & _has(p, "repaired_rtl_answer_batches", "/answers/repaired/", "/repaired/")),
        ("assembled_answer_jsonl", answers & lines & (_has(p, "/answers/assembled/", "/merged/") | _has(name, "assembled", "clean"))),
        ("teacher_answer_batch", answers & (_has(p, "teacher_answer_returns", "teacher_returns") | name.startswith("batch_"))),
        ("assembled_answer_jsonl", answers & lines),
        ("teacher_answer_batch", answers),
        ("unknown", tasks & _has(p, "normalization_batches") & F.coalesce(container == "rows_wrapper", F.lit(False))),
        ("normalized_task", tasks),
        ("distill_dataset", chat & _has(p, "/distill/")),
        ("eval_prompt", chat & _has(p, "/eval/") & _has(p, "prompt")),
        ("eval_run", chat & _has(p, "/eval/")),
        ("unknown", chat),
        ("eval_prompt", _has(p, "/eval/") & _has(p, "prompt")),
        ("eval_run", _has(p, "/eval/")),
        ("raw_source", p.startswith(".local_data/") | _has(p, "/.local_data/", "/raw/") | _has(name, "raw_index")),
    ]
    out = F.lit("unknown")
    for found, when in reversed(rules):
        out = F.when(when, found).otherwise(out)
    return out


def dataset_name(path: Column, ids: Column) -> Column:
    """EXT-28: the set a file belongs to, by its path and the ids in it; the first rule that fits decides."""
    p, some = F.lower(path), lambda test: F.coalesce(F.exists(ids, test), F.lit(False))
    inside = F.regexp_extract(p, "/distill/([^/]+)", 1)
    coder = _has(p, "rtlcoder") | some(lambda x: x.startswith("rtlcoder_"))
    made = _has(p, "synthetic") | some(lambda x: x.contains("_synthetic_"))
    out = F.when(inside != "", inside).when(_has(p, "rtlcoder_teacher", "synthetic_bug"), "rtlcoder_synthetic").when(_has(p, "verilog-eval", "verilog_eval", "verilog eval"), "verilog_eval")
    out = out.when(coder & made, "rtlcoder_synthetic").when(coder, "rtlcoder").when(some(lambda x: F.lower(x).startswith("prob")), "verilog_eval")
    return out.when(_has(p, "internal"), "internal").otherwise("unknown")


def inventory(spark: SparkSession, root: str) -> DataFrame:
    """AGG-12: one row per file: path below the root, size, sha256, container, schema, role, dataset, n_rows, ids, n_bad, and whether its content or an id is in another file."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    base = root.rstrip("/").split("://")[-1]
    below = F.regexp_replace(F.regexp_replace("path", "^[a-z]+:/*", "/"), "^.*?" + base.replace(".", r"\.") + "/", "")
    text, kind = F.decode("content", "UTF-8"), F.regexp_extract(F.lower("path"), r"\.[a-z0-9]+$", 0)
    lines = F.filter(F.split(text, r"\r\n|\r|\n"), lambda x: F.length(F.trim(x)) > 0)
    whole = F.try_parse_json(text)
    listed = lambda path: F.try_variant_get(whole, path, "array<variant>")
    is_object = lambda v: F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))
    container = F.when(kind == ".jsonl", "jsonl").when(kind != ".json", None).when(listed("$.answers").isNotNull(), "answers_wrapper").when(listed("$.rows").isNotNull(), "rows_wrapper").when(listed("$").isNotNull(), "json_array").when(is_object(whole), "json_single")
    rows = F.when(kind == ".jsonl", F.transform(lines, F.try_parse_json)).when(kind == ".json", F.coalesce(listed("$.answers"), listed("$.rows"), listed("$"), F.when(is_object(whole), F.array(whole))))
    d = files.select(below.alias("path"), F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"), container.alias("container"), F.coalesce(rows, F.array().cast("array<variant>")).alias("all"), F.try_variant_get(whole, "$.batch_schema_version", "string").alias("batch"))
    d = d.withColumn("rows", F.filter("all", is_object)).withColumn("n_bad", F.size("all") - F.size("rows"))
    get = lambda x, path: F.try_variant_get(x, path, "string")
    version = lambda x: F.when(get(x, "$.schema_version").isin(*V.ANSWER_SCHEMA, *V.TASK_SCHEMA), get(x, "$.schema_version")).when(F.try_variant_get(x, "$.messages", "array<variant>").isNotNull(), CHAT)
    kinds = F.array_distinct(F.transform("rows", version))
    d = d.withColumn("schema", F.when((F.size(kinds) == 1) & kinds[0].isNotNull(), kinds[0]).otherwise("unknown"))
    found = F.transform("rows", lambda x: F.coalesce(get(x, "$.source_id"), get(x, "$.messages[1].content.source_id"), get(x, "$.id")))
    d = d.withColumn("ids", F.array_distinct(F.filter(found, lambda x: F.coalesce(x != "", F.lit(False))))).withColumn("n_rows", F.size("rows"))
    d = d.withColumn("role", role(F.concat(F.lit("/"), "path"), F.col("schema"), F.col("container"), F.col("batch"))).withColumn("dataset", dataset_name(F.concat(F.lit("/"), "path"), F.col("ids")))
    return d.drop("all", "rows", "batch")


def duplicates(files: DataFrame) -> DataFrame:
    """(sha256, paths) of files with equal content."""
    return files.groupBy("sha256").agg(F.sort_array(F.collect_list("path")).alias("paths")).where("size(paths) > 1")


def shared_ids(files: DataFrame) -> DataFrame:
    """(id, n_files) of ids found in more than one file."""
    return files.select("path", F.explode("ids").alias("id")).groupBy("id").agg(F.countDistinct("path").alias("n_files")).where("n_files > 1")


def safe_to_archive(files: DataFrame) -> DataFrame:
    """HLP-19: files whose content is also in a file of an earlier path, unless they are sources or tasks."""
    first = files.groupBy("sha256").agg(F.min("path").alias("first"))
    return files.join(first, "sha256").where(F.col("path") != F.col("first")).where(~F.col("role").isin("raw_source", "normalized_task")).select("path", "first")


def cleanup_plan(files: DataFrame) -> DataFrame:
    """WSP-1 to WSP-3: (path, new_path, confidence, manual_review) of files that belong elsewhere. Nothing is moved.

    Two files for one place: the later, by path, gets part of its hash into its name.
    """
    name, p = F.substring_index("path", "/", -1), F.col("path")
    known = F.when(F.col("dataset") == "unknown", "unknown_dataset").otherwise(F.col("dataset"))
    folder = F.when(F.col("dataset").startswith("rtlcoder"), "rtlcoder").when(F.col("dataset").startswith("verilog_eval"), "verilog_eval").otherwise("internal")
    answers = F.col("schema").isin(*V.ANSWER_SCHEMA)
    local = p.startswith(".local_data/")
    raw = F.concat(F.lit("raw/"), folder, F.lit("/"), F.when(local, F.substring(p, len(".local_data/") + 1, 1 << 30)).otherwise(name))
    placed = F.struct
    place = lambda home, confidence, doubt=F.lit(False), target=None: placed(home.alias("home"), (target if target is not None else F.concat(home, F.lit("/"), name)).alias("new_path"), confidence.alias("confidence"), doubt.alias("manual_review"))
    under = lambda *parts: F.concat(*[x if isinstance(x, Column) else F.lit(x) for x in parts])
    high, medium, old = F.lit("high"), F.lit("medium"), p.startswith("distill/")
    move = (
        F.when(F.col("role") == "normalized_task", place(under("normalized/tasks"), high))
        .when(F.col("role") == "raw_source", place(under("raw/", folder), F.when(~local & name.contains("raw_index"), high).otherwise(medium), target=raw))
        .when(F.col("role") == "teacher_answer_batch", place(under("answers/teacher_returns/", known), F.when(answers, high).otherwise(medium), ~answers))
        .when(F.col("role") == "repaired_answer_batch", place(under("answers/repaired/", known), high))
        .when(F.col("role") == "assembled_answer_jsonl", place(under("answers/assembled"), high))
        .when(F.col("role") == "distill_dataset", place(under("distill/", known), F.when(old, high).otherwise(medium), ~old))
        .when(F.col("role").isin(*REPORTS), place(under("reports"), high))
    )
    stays = p.startswith("golden/") | name.isin(".gitkeep") | (p == "README.md")
    moves = files.withColumn("m", move).where(F.col("m").isNotNull() & ~stays & ~F.startswith(p, F.concat("m.home", F.lit("/")))).select("path", "sha256", "m.*")
    stem, kind = F.regexp_replace("new_path", r"\.[^./]*$", ""), F.regexp_extract("new_path", r"\.[^./]*$", 0)
    turn = F.row_number().over(Window.partitionBy("new_path").orderBy("path"))
    again = F.concat(stem, F.lit("__"), F.substring("sha256", 1, 8), F.when(F.col("turn") > 2, F.concat(F.lit("_"), (F.col("turn") - 2).cast("string"))).otherwise(""), kind)
    return moves.withColumn("turn", turn).select("path", F.when(F.col("turn") > 1, again).otherwise(F.col("new_path")).alias("new_path"), "confidence", "manual_review")
