"""Distillation sets: task and answer pairs with provenance, dealt to splits of fixed sizes."""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone import vocab as V
from siltstone.functions import json_text
from siltstone.functions.variant import Node
from siltstone.operators import teacher
from siltstone.operators.keys import duplicate_keys
from siltstone.operators.split import global_rank, shuffled

# Names that mark a distilled row and its set.
STAGE, STATUS, APPROVAL, SOURCE = "teacher_distill_pilot", "teacher_distilled_unreviewed", "not_approved", "teacher_generated"
GENERATED, PUBLIC = "external_rtlcoder_gpt_generated_unverified", "public_verilog_eval"
SPLITS, CYCLE = ("train", "validation", "test"), ("train", "test", "validation")
NOTES = (
    "Teacher-distilled pilot row assembled from clean rtl_task_v0.1 and rtl_answer_v0.1 JSON. "
    "Not human-reviewed. Not golden. Not approved. Confirm license/provenance before any broader release or promotion."
)


def provenance(task: Node) -> Column:
    """PRJ-9: origin, name, address and commit (null where blank), and notes with the task's own after ours."""
    p = task["provenance"]
    filled = lambda n: F.when(n.filled(), n.text())
    note = F.concat_ws(" ", F.lit(NOTES), F.concat(F.lit("Original task provenance note: "), F.trim(filled(p["notes"]))))
    return F.struct(
        F.lit(STAGE).alias("origin"), F.coalesce(filled(p["public_dataset_name"]), F.when(task["source_dataset"].nonempty(), task["source_dataset"].text())).alias("public_dataset_name"),
        filled(p["public_dataset_url"]).alias("public_dataset_url"), filled(p["source_commit"]).alias("source_commit"), note.alias("notes"),
    )


def set_names(tasks: DataFrame, default: str = PUBLIC) -> DataFrame:
    """PRJ-10 and PRJ-11: one row, the source family and the name of a set of tasks (task: variant)."""
    t = Node("task")
    named = lambda n: F.collect_set(F.when(n.nonempty(), n.text()))
    d = tasks.agg(named(t["provenance"]["origin"]).alias("origins"), named(t["source_dataset"]).alias("sets"), F.coalesce(F.bool_or(t["synthetic_bug"].is_true()), F.lit(False)).alias("bugs"))
    family = F.when(F.array_contains("origins", GENERATED), GENERATED).when(F.size("origins") == 1, F.try_element_at("origins", F.lit(1))).when(F.size("sets") == 1, F.try_element_at("sets", F.lit(1))).when(F.array_contains("sets", PUBLIC), PUBLIC).otherwise(default)
    d = d.withColumn("source_family", family)
    coder = (F.col("source_family") == GENERATED) | F.exists("sets", lambda s: F.lower(s).startswith("rtlcoder"))
    slug = F.regexp_replace(F.regexp_replace(F.lower("source_family"), r"[^\p{L}\p{N}]", "_"), "^_+|_+$", "")
    name = F.when(coder, F.when(F.col("bugs"), "rtlcoder_synthetic_teacher_distill_v0_1").otherwise("rtlcoder_teacher_distill_v0_1")).when(F.col("source_family") == PUBLIC, "verilog_eval_teacher_distill_v0_1").otherwise(F.concat(F.when(slug == "", "teacher_distill").otherwise(slug), F.lit("_teacher_distill_v0_1")))
    return d.select("source_family", name.alias("dataset_name"))


def rows(tasks: DataFrame, answers: DataFrame, assigned: DataFrame, seed: int, system: str) -> DataFrame:
    """PRJ-8: tasks (source_id, task) and answers (source_id, answer) as distilled rows, with the splits of ``assigned`` (source_id, split)."""
    names = set_names(tasks)  # one row
    d = tasks.join(answers, "source_id").join(assigned, "source_id").join(F.broadcast(names))
    t = Node("task")
    checks = F.when(t["tool_checks"].is_object(), t["tool_checks"].value).otherwise(F.parse_json(F.lit("{" + ",".join(f'"{k}":null' for k in sorted(V.TOOLS)) + "}")))
    message = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    return d.select(
        F.concat(F.lit("teacher_distill_"), "source_id").alias("id"), "source_id", "dataset_name", F.lit(V.DATASET_VERSION).alias("dataset_version"), F.lit(STAGE).alias("dataset_stage"),
        F.lit(V.SCHEMA_PAIR).alias("schema_pair"), "split", F.lit(seed).alias("split_seed"), F.lit(SOURCE).alias("source"), "source_family", t["license"].text().alias("license"),
        t["design_family"].text().alias("design_family"), t["task_type"].text().alias("task_family"), F.lit("prepare_teacher_distill_dataset").alias("created_by"), F.lit(STATUS).alias("review_status"),
        F.lit(APPROVAL).alias("approval_status"), F.lit(False).alias("promotion_allowed"), provenance(t).alias("provenance"), checks.alias("tool_checks"),
        F.array(message("system", F.lit(system).cast("variant")), message("user", F.col("task")), message("assistant", F.col("answer"))).alias("messages"),
    )


def dealing(n: int, sizes: dict[str, int]) -> tuple[list[tuple[int, int, list[str]]], dict[str, int]]:
    """How ``n`` ranks are dealt round by round, and what room is left.

    Each piece (from, to, splits) covers a range of ranks; rank i goes to splits[i % 3]: the first split
    with room left, in the order of ``CYCLE`` from its i-th on.
    """
    left, at, pieces = dict(sizes), 0, []
    while at < n:
        if not any(left.values()):
            raise ValueError("the splits have no room for all rows with a candidate")
        turn = [next(s for k in range(3) if left[s := CYCLE[(r + k) % 3]] > 0) for r in range(3)]
        rounds = min(min(left[s] // turn.count(s) for s in set(turn)), (n - at) // 3) if at % 3 == 0 else 0
        steps = 3 * rounds or 1
        pieces.append((at, at + steps, turn))
        for i in range(at, at + min(steps, 3)):
            left[turn[i % 3]] -= rounds or 1
        at += steps
    return pieces, left


def assign(tasks: DataFrame, sizes: dict[str, int], seed: int) -> DataFrame:
    """SPL-4: (source_id, split) for tasks (source_id, task): rows with a candidate dealt in turn, the others filled in.

    The order is Python's seeded shuffle of the sorted ids, first of the rows with a candidate, then of the others. Ids are
    ranked in Spark; only the shuffled numbers of the ranks are made on the driver.
    """
    spark = tasks.sparkSession
    d = tasks.select("source_id", teacher.has_candidate(Node("task")).alias("candidate"))
    counts = {r.candidate: r["count"] for r in d.groupBy("candidate").count().collect()}
    n, m = counts.get(True, 0), counts.get(False, 0)
    if n + m != sum(sizes.values()):
        raise ValueError(f"{n + m} tasks for splits of {sum(sizes.values())}")
    pieces, left = dealing(n, sizes)
    draw, ranked = random.Random(seed), None
    for kind, many in ((True, n), (False, m)):
        part = global_rank(d.where(F.col("candidate") == kind), "source_id", "_row").join(shuffled(spark, many, draw, "_row", "rank"), "_row").drop("_row")
        ranked = part if ranked is None else ranked.unionByName(part)
    d = ranked
    dealt, filled, at = F.lit(None).cast("string"), F.lit(None).cast("string"), m
    for a, b, turn in reversed(pieces):
        dealt = F.when(F.col("rank") < b, F.element_at(F.array(*map(F.lit, turn)), (F.col("rank") % 3 + 1).cast("int"))).otherwise(dealt)
    for s in reversed(SPLITS):
        filled = F.when(F.col("rank") < at, s).otherwise(filled)
        at -= left[s]
    return d.select("source_id", F.when(F.col("candidate"), dealt).otherwise(filled).alias("split"))


def preflight(tasks: DataFrame, answers: DataFrame) -> DataFrame:
    """JOIN-8: (source_id, problem): missing and extra answers, and ids that occur twice on a side."""
    t, a = tasks.select("source_id"), answers.select("source_id")
    named = lambda d, why: d.select("source_id", F.lit(why).alias("problem"))
    out = named(t.distinct().join(a, "source_id", "left_anti"), "missing answer").union(named(a.distinct().join(t, "source_id", "left_anti"), "extra answer"))
    return out.union(named(duplicate_keys(t, "source_id"), "duplicate task")).union(named(duplicate_keys(a, "source_id"), "duplicate answer"))


def row_checks(distilled: DataFrame) -> DataFrame:
    """AGG-15 and DUP-10: one row of counts over rows (v: variant): what fails, of how many."""
    v = Node("v")
    m = v["messages"]
    task, answer = m[1]["content"], m[2]["content"]
    ordered = F.lit(True)
    for k, role in enumerate(V.ROLES):
        ordered = ordered & m[k]["role"].isin([role])
    d = distilled.withColumn("ordered", ordered & (F.size(m.items()) == 3)).withColumn("sid", v["source_id"].text())
    ok = F.col("ordered")
    d = d.withColumn("leak_u", json_text.answer_copy(F.when(ok, task.json()))).withColumn("leak_a", json_text.task_copy(F.when(ok, answer.json())))
    golden = v["source"].isin(["handwritten_golden"]) | F.coalesce(v["id"].text().startswith("golden_"), F.lit(False))
    unmarked = ~v["review_status"].isin([STATUS]) | ~v["approval_status"].isin([APPROVAL])
    return d.agg(
        F.count("*").alias("rows"), (F.count("sid") - F.countDistinct("sid")).alias("repeated_ids"), F.count_if(~ok).alias("role_order_failed"),
        F.count_if(ok & ~task["schema_version"].isin(V.TASK_SCHEMA)).alias("task_schema_failed"), F.count_if(ok & ~answer["schema_version"].isin(V.ANSWER_SCHEMA)).alias("answer_schema_failed"),
        F.count_if("leak_u").alias("answer_in_user"), F.count_if("leak_a").alias("task_in_assistant"), F.count_if(ok & unmarked).alias("unmarked"), F.count_if(ok & golden).alias("golden"),
        F.min("sid").alias("first_id"), F.max("sid").alias("last_id"),
    )
