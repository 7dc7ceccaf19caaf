"""Candidate rows with planted bugs from reference tasks, up to a number of rows, with the reasons of what was skipped.

Tasks are taken in file and line order. With a target, ranges of them are edited, each twice as long as those before,
until enough rows have come; later ranges are never read for edits. Where exactly the target is met is found
from sums of blocks, so no task holds the order of all rows.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions import rtl
from siltstone.functions.json_text import compact
from siltstone.functions.variant import Node
from siltstone.operators import mutate
from siltstone.operators.split import global_rank
from siltstone.scratch import Scratch
from siltstone.sources.jsonl import WHITE

BLOCK = 10_000
# The schema of tasks, the marks of synthetic rows and what they say about themselves.
SCHEMA, CREATOR = "rtl_task_v0.1", "synthesize_rtl_bug_variants"
NOTE = "Synthetic buggy candidate RTL was generated by deterministic text mutation ({}) from the reference RTL."
ASSUMPTION = "Synthetic candidate RTL was generated by text mutation only; no lint, simulation, synthesis, or formal verification was run."


@dataclass
class Synthesis:
    """emitted (rank, k, source_id, raw), skipped (rank, line, source_id, reasons), counts by bug type and reason, and how far the input was read."""

    emitted: DataFrame
    skipped: DataFrame
    processed: int
    emitted_rows: int
    shortfall: int
    ranges: int

    def bug_types(self) -> DataFrame:
        return self.emitted.groupBy("bug_type").count()

    def reasons(self) -> DataFrame:
        return self.skipped.select(F.explode("reasons").alias("reason")).groupBy("reason").count()


def skip_reasons() -> Column:
    """Why a task gets no candidate, in order; empty for those that may have one."""
    v = Node("v")
    artifacts, code = v["artifacts"], v["artifacts"]["rtl_code"]
    before, role = artifacts["before_rtl_code"], v["source_rtl_role"]
    void = lambda n: n.absent() | (n.kind == "VOID")
    blank = F.coalesce(~(artifacts.is_object() & code.is_text() & code.text().rlike(f"[^{WHITE}]")), F.lit(True))
    tests = [
        ("missing_source_id", ~F.coalesce(v["source_id"].text() != "", F.lit(False))),
        ("schema_version_mismatch", ~v["schema_version"].isin([SCHEMA])),
        ("missing_reference_rtl", blank),
        ("requires_single_reference_module", F.when(blank, True).otherwise(F.size(rtl.module_names(F.coalesce(code.text(), F.lit("")))) != 1)),
        ("candidate_rtl_already_present", artifacts.is_object() & ~void(before) & ~(before.is_text() & F.coalesce(before.text() == "", F.lit(False)))),
        ("candidate_rtl_already_present", v["design_context"]["prompt_embedded_candidate_rtl"].is_true()),
        ("source_rtl_role_must_be_reference_rtl", ~void(role) & ~role.isin(["reference_rtl"])),
    ]
    return F.filter(F.array(*[F.when(F.coalesce(when, F.lit(False)), name) for name, when in tests]), lambda x: x.isNotNull())


def judged(ranked: DataFrame, per_row: int, seed: int) -> DataFrame:
    """(rank, line, raw, source_id, reasons, picked): what is skipped, and the chosen edits of the others."""
    v = Node("v")
    d = ranked.withColumn("v", F.parse_json("raw")).withColumn("reasons", skip_reasons())
    d = d.select("rank", "line", "raw", F.when(F.coalesce(v["source_id"].text() != "", F.lit(False)), v["source_id"].text()).otherwise(F.format_string("line_%d", "line")).alias("source_id"), "reasons", v["artifacts"]["rtl_code"].text().alias("code"))
    picked = F.when(F.size("reasons") == 0, mutate.chosen(mutate.edits(F.col("code")), F.col("source_id"), per_row, seed)).otherwise(F.array().cast(f"array<{mutate.EDIT}>"))
    d = d.withColumn("picked", picked)
    return d.withColumn("reasons", F.when((F.size("reasons") == 0) & (F.size("picked") == 0), F.array(F.lit("no_safe_mutation_pattern"))).otherwise(F.col("reasons"))).drop("code")


def _cut(counts: DataFrame, need: int) -> tuple[int, int]:
    """(rank of the row with which ``need`` is met, how many of that row to take) of (rank, n), by sums of blocks and one block."""
    have = 0
    for r in counts.groupBy(F.floor(F.col("rank") / BLOCK).alias("block")).agg(F.sum("n").alias("n")).orderBy("block").collect():
        if have + r.n >= need:
            for one in counts.where((F.col("rank") >= r.block * BLOCK) & (F.col("rank") < (r.block + 1) * BLOCK) & (F.col("n") > 0)).orderBy("rank").collect():
                if have + one.n >= need:
                    return one["rank"], need - have
                have += one.n
        have += r.n
    raise ValueError("not enough")


def _built(rows: DataFrame, seed: int) -> DataFrame:
    """The task of each edit as a candidate row: raw JSON, keys in their order."""

    def run(batches):
        for b in batches:
            out = []
            for raw, source, bug, mutated, signals, confidence, summary in zip(b.raw, b.source_id, b.bug_type, b.mutated, b.signals, b.confidence, b.summary):
                row = json.loads(raw)
                listed = lambda x: list(x) if isinstance(x, list) else [x] if isinstance(x, str) else []
                row |= {
                    "created_by": CREATOR, "generated_by": CREATOR, "source_variant_of": source, "source_id": f"{source}_synthetic_{bug}", "synthetic_bug": True, "bug_type": bug, "mutation_summary": summary,
                    "mutated_signal_names": list(signals), "mutation_confidence": confidence, "seed": seed, "review_status": "synthetic_draft", "approval_status": "not_approved", "promotion_allowed": False,
                    "source_rtl_role": "reference_rtl",
                }
                row["artifacts"] |= {"before_rtl_code": mutated, "after_rtl_code": None}
                checks = row.get("tool_checks")
                row["tool_checks"] = dict.fromkeys(checks) if isinstance(checks, dict) else {}
                if isinstance(row.get("design_context"), dict):
                    row["design_context"] |= {"source_rtl_role": "reference_rtl", "prompt_embedded_candidate_rtl": True}
                row["notes"] = [*listed(row.get("notes")), NOTE.format(bug)]
                row["assumptions"] = [*listed(row.get("assumptions")), ASSUMPTION]
                out.append(compact(row))
            yield pd.DataFrame({"rank": b["rank"], "k": b.k, "source_id": b.source_id, "bug_type": b.bug_type, "raw": out})

    return rows.mapInPandas(run, "rank long, k int, source_id string, bug_type string, raw string")


def synthesize(scanned: DataFrame, per_row: int = 1, target: int | None = None, max_rows: int | None = None, seed: int = 42) -> Synthesis:
    """Candidates of the tasks of a scan, at most ``per_row`` for each, ``target`` in all and from the first ``max_rows`` tasks.

    A task after the one that meets the target is neither edited nor skipped. Equal whatever the partitions.
    """
    if per_row < 1 or target is not None and target < 1 or max_rows is not None and max_rows < 1:
        raise ValueError("per_row, target and max_rows must be at least 1")
    spark = scanned.sparkSession
    scratch = Scratch(spark, "synthesize")
    rows = scanned.where("problem IS NULL").select(F.struct("file_ord", "line").alias("place"), "line", "raw")
    ranked = global_rank(rows, "place", "rank").drop("place")
    total = rows.count() if max_rows is None else min(rows.count(), max_rows)
    size = total if target is None else max(BLOCK // 10, 2 * target // per_row)
    parts, lo, have, cut, last = [], 0, 0, total, per_row
    while lo < total and (target is None or have < target):
        hi = min(lo + size, total)
        part = scratch.save(judged(ranked.where((F.col("rank") >= lo) & (F.col("rank") < hi)), per_row, seed), f"range-{len(parts)}")
        parts.append(part)
        n = part.agg(F.sum(F.size("picked"))).first()[0] or 0
        if target is not None and have + n >= target:
            cut, last = _cut(part.select("rank", F.size("picked").alias("n")), target - have)
            have = target
        else:
            have += n
        lo, size = hi, 2 * size
    done = None
    for part in parts:
        done = part if done is None else done.union(part)
    if done is None:
        done = judged(ranked.limit(0), per_row, seed)
    edits = done.where(F.col("rank") <= cut).select("rank", "raw", "source_id", F.posexplode("picked").alias("k", "m")).select("rank", "raw", "source_id", "k", "m.*").where((F.col("rank") < cut) | (F.col("k") < last))
    processed = min(cut + 1, total)
    skipped = done.where((F.col("rank") < processed) & (F.size("reasons") > 0)).select("rank", "line", "source_id", "reasons")
    return Synthesis(_built(edits, seed), skipped, processed, have, max((target or 0) - have, 0), len(parts))
