"""Row constructors: draft rows, index rows, tasks, distilled rows, prompts and rule-based answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone import vocab as V
from siltstone.functions import rtl
from siltstone.functions.variant import Node


def row_id(source: Column, source_id: Column) -> Column:
    """<source>_<source_id> in lower case with safe characters, the source named once."""
    safe = lambda c: F.regexp_replace(F.lower(c), r"[^a-z0-9_]+", "_")
    s, i = safe(source), safe(source_id)
    return F.when(F.startswith(i, F.concat(s, F.lit("_"))), i).otherwise(F.concat_ws("_", s, i))


def verification_plan(task_type: Column, artifacts: Column) -> Column:
    """Steps by task type and artifacts at hand."""
    has = lambda k: F.length(F.trim(F.coalesce(artifacts[k], F.lit("")))) > 0
    steps = [
        F.lit("Lint and compile the design."),
        F.when(has("testbench"), "Run the testbench.").otherwise("Write a directed test for the reported issue."),
        F.when(task_type == "rtl_area_activity_review", "Synthesis area comparison, if available."),
        F.when(task_type == "rtl_area_activity_review", "Toggle activity comparison, if available."),
        F.when(task_type == "rtl_before_after_judgment", "Equivalence check of both versions."),
    ]
    return F.filter(F.array(*steps), lambda x: x.isNotNull())


def draft_rows(examples: DataFrame) -> DataFrame:
    """examples (source_id, source, license, design_family, task_type, user_goal, artifacts map) as conservative draft rows."""
    code = F.concat_ws("\n", *[F.col("artifacts")[k] for k in ("rtl_code", "before_rtl_code", "after_rtl_code")])
    task = F.struct(
        F.lit(V.TASK_SCHEMA[0]).alias("schema_version"), F.lit("digital_rtl").alias("domain"), "task_type", "user_goal", "artifacts",
        F.struct(*[c.alias(k) for k, c in rtl.summary(code).items()]).alias("extracted_rtl_summary"),
        F.array(*map(F.lit, V.REQUIRED_OUTPUT)).alias("required_output"),
    )
    levels = F.create_map(*[x for d in V.CLAIM_DOMAINS for x in (F.lit(d), F.lit("insufficient_evidence"))])
    answer = F.struct(F.lit(V.ANSWER_SCHEMA[0]).alias("schema_version"), "task_type", verification_plan(F.col("task_type"), F.col("artifacts")).alias("verification_plan"), levels.alias("claim_levels"))
    return examples.select(
        row_id(F.col("source"), F.col("source_id")).alias("id"), F.lit(V.DATASET_VERSION).alias("dataset_version"), F.lit("unsplit").alias("split"), "source", "license", "design_family",
        F.col("task_type").alias("task_family"), F.lit("draft").alias("review_status"), task.alias("task"), answer.alias("answer"),
    )


def index_rows(scanned: DataFrame) -> DataFrame:
    """Instruction and code of imported records with their modules, family and warnings."""
    v = Node("v")
    instruction = F.coalesce(*[F.when(v[n].filled(), v[n].text()) for n in ("Instruction", "instruction", "prompt", "input", "question", "description", "problem")])
    listed = v["Response"].as_("array<string>")
    code = F.coalesce(F.when(listed.isNotNull(), F.array_join(listed, "\n")), *[F.when(v[n].filled(), v[n].text()) for n in ("Response", "response", "output", "rtl", "code", "solution")])
    out = scanned.where("problem IS NULL").select("line", instruction.alias("instruction_text"), code.alias("rtl_code"))
    out = out.withColumn("source_id", F.format_string("rtlcoder_resyn27k_%06d", "line"))
    return out.withColumns({
        "detected_module_names": rtl.module_names(F.col("rtl_code")),
        "rough_design_family": rtl.design_family(F.col("instruction_text"), F.col("rtl_code"), F.array_join(rtl.module_names(F.col("rtl_code")), " ")),
        "import_warnings": rtl.import_warnings(F.col("instruction_text"), F.col("rtl_code")),
    })


def tasks(index: DataFrame, single_module_only: bool = True) -> tuple[DataFrame, DataFrame]:
    """(task rows, skipped with reason) of index rows; top_module only where there is exactly one module."""
    n = F.size("detected_module_names")
    why = F.when(F.length(F.trim(F.coalesce("rtl_code", F.lit("")))) == 0, "missing_rtl").when(n == 0, "no_module")
    if single_module_only:
        why = why.when(n > 1, "multiple_modules")
    judged = index.withColumn("reason", why)
    good = judged.where("reason IS NULL").select(F.concat("source_id", F.lit("_reference")).alias("source_id"), F.col("instruction_text").alias("prompt"), "rtl_code", F.col("rough_design_family").alias("design_family"), F.when(n == 1, F.col("detected_module_names")[0]).alias("top_module"), F.lit("reference_rtl").alias("source_rtl_role"), F.lit(False).alias("promotion_allowed"))
    return good, judged.where("reason IS NOT NULL").select("source_id", "reason")


def merge_tasks_answers(tasks_: DataFrame, answers: DataFrame, key: str = "source_id") -> dict[str, DataFrame]:
    """Answers joined to tasks; unmatched answers and unanswered tasks apart."""
    return {
        "rows": answers.join(tasks_, key),
        "unknown": answers.select(key).join(tasks_.select(key), key, "left_anti"),
        "unanswered": tasks_.select(key).join(answers.select(key), key, "left_anti"),
    }


def prompt_rows(rows: DataFrame) -> DataFrame:
    """(source_id, split, system_prompt, user_prompt, expected_answer): the answer leaves the prompt."""
    v = Node("v")
    m = v["messages"]
    return rows.select(F.coalesce(v["source_id"].text(), v["id"].text()).alias("source_id"), v["split"].text().alias("split"), m[0]["content"].text().alias("system_prompt"), m[1]["content"].json().alias("user_prompt"), m[2]["content"].value.alias("expected_answer"))


def signals(rows: DataFrame, fields: list[str], n: int = 4) -> Column:
    """The first n distinct names over array columns, in order."""
    return F.slice(F.array_distinct(F.filter(F.concat(*[F.coalesce(F.col(f), F.array().cast("array<string>")) for f in fields]), lambda x: F.length(F.trim(x)) > 0)), 1, n)


def teacher_batches(rows: DataFrame, key: str, size: int = 5, start: int = 0, limit: int | None = None) -> DataFrame:
    """(batch_index, batch_count, row_count, expected_ids, rows) of ``size`` rows each; a batch is short by construction."""
    from siltstone.operators.split import batches

    b = batches(rows, key, size, start, limit)
    packed = b.groupBy("batch_index").agg(F.array_sort(F.collect_list(F.struct(key, *[c for c in rows.columns if c != key]))).alias("rows"))
    count = packed.agg(F.count("*").alias("batch_count"))
    return packed.join(F.broadcast(count)).select("batch_index", "batch_count", F.size("rows").alias("row_count"), F.transform("rows", lambda x: x[key]).alias("expected_ids"), "rows")
