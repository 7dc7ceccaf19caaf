"""Normalised tasks against the raw batch they came from: what must be kept, derived or absent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone import vocab as V
from siltstone.functions import json_text, prompts, rtl
from siltstone.functions.variant import Node
from siltstone.operators.keys import tag_best
from siltstone.operators.rules import Rule, found

# Fields kept word for word, fields that only answers have, and wording that batches share.
KEPT = ("source_dataset", "license", "design_family", "task_type", "user_goal", "provenance")
RAW_TEXT = ("source_id", "source_dataset", "license", "design_family", "task_type", "user_goal", "raw_prompt", "raw_reference_rtl")
ANSWER_ONLY = ("issue_summary", "time_reasoning", "space_reasoning", "safe_optimization", "functional_risk", "verification_plan", "claim_levels", "patch", "messages")
CANDIDATE_NOTES = (
    "The prompt includes a buggy TopModule candidate implementation.",
    "artifacts.rtl_code is the fixed/reference RTL used by the benchmark testbench.",
)
CONTEXT_NOTES = (
    "The prompt includes context RTL used to derive the requested TopModule implementation.",
    "artifacts.rtl_code is the fixed/reference RTL used by the benchmark testbench.",
)
RAW_NOTE = (
    "Normalize this row into rtl_task_v0.1 only. Preserve prompt/spec, RTL, and testbench text exactly. Keep missing tool evidence null "
    "and do not add any rtl_answer_v0.1 content."
)


def _same(a: Node, b: Node) -> Column:
    """Equal JSON values; an absent key equals null."""
    value = lambda n: F.when(n.kind != "VOID", F.to_json(n.value))
    return value(a).eqNullSafe(value(b))


def raw_rows(examples: DataFrame) -> DataFrame:
    """PRJ-7: raw batch rows of examples (source_id, source, license, design_family, task_type, user_goal, prompt, artifacts map, provenance)."""
    art = lambda k: F.try_element_at("artifacts", F.lit(k))
    own = F.col("prompt") if "prompt" in examples.columns else F.lit(None).cast("string")
    kept = [F.col("provenance")] if "provenance" in examples.columns else []
    return examples.select(
        "source_id", F.col("source").alias("source_dataset"), "license", *kept, "design_family", "task_type", "user_goal", prompts.raw_prompt(own, art("lint_log")).alias("raw_prompt"),
        art("rtl_code").alias("raw_reference_rtl"), F.lit("reference_rtl").alias("source_rtl_role"), art("testbench").alias("raw_testbench"), F.lit(RAW_NOTE).alias("notes"),
    )


def raw_rules(raw: Node) -> list[Rule]:
    """HLP-3: what a raw row needs."""
    r = [Rule("empty", f, "error", ~(raw[f].is_text() & raw[f].nonempty())) for f in RAW_TEXT]
    return [*r, Rule("no_object", "provenance", "error", ~raw["provenance"].is_object()), Rule("testbench", "raw_testbench", "error", raw["raw_testbench"].nonempty() & ~raw["raw_testbench"].is_text())]


def check_rules(raw: Node, row: Node) -> list[Rule]:
    """NRM-2, NRM-3 and NRM-5 to NRM-7 for a normalised row beside its raw one."""
    r: list[Rule] = []
    context, summary, artifacts, checks = row["design_context"], row["extracted_rtl_summary"], row["artifacts"], row["tool_checks"]
    prompt, code = raw["raw_prompt"].text(), raw["raw_reference_rtl"].text()
    candidate, inside = prompts.embedded_candidate(prompt), prompts.embedded_context(prompt)
    text = lambda n: n.text()
    off = lambda n: ~n.nonempty() | n.is_false()

    def add(rule, field, when, severity="error", guard=None):
        r.append(Rule(rule, field, severity, F.coalesce(when, F.lit(False)), None, guard))

    add("schema", "schema_version", ~row["schema_version"].isin(["rtl_task_v0.1"]))
    for f in KEPT:
        add("changed", f, ~_same(row[f], raw[f]))
    add("role", "source_rtl_role", row["source_rtl_role"].nonempty() & ~row["source_rtl_role"].isin(["reference_rtl"]))
    keys = F.map_keys(checks.fields())
    add("changed", "tool_checks", ~_same(checks, raw["tool_checks"]))
    for t in V.TOOLS:
        add("missing_check", t, ~F.array_contains(keys, t), guard=checks.is_object())
    add("odd_check", "tool_checks", F.size(F.array_except(keys, F.array(*map(F.lit, V.TOOLS)))) > 0)
    add("invented_check", "tool_checks", F.exists(F.map_values(checks.fields()), lambda x: F.to_json(x) != "null"))
    on = context.is_object()
    add("no_object", "design_context", ~on)
    for f, want in (("target_domain", "digital_rtl_public_benchmark"), ("timing_policy", "timing_is_constraint_not_reward"), ("source_rtl_role", "reference_rtl")):
        add("context", f, ~context[f].isin([want]), guard=on)
    add("context", "priority", ~context["priority"].is_list() | ~context["priority"].nonempty(), guard=on)
    target, module = prompts.target_module(prompt), F.try_element_at(rtl.module_names(code), F.lit(1))
    for f, want in (("target_module_name", target), ("rtl_module_name", module)):
        add("context", f, context[f].absent() | want.isNotNull() & ~text(context[f]).eqNullSafe(want), guard=on)
    ports = context["interface_ports_from_prompt"]
    add("context", "interface_ports_from_prompt", ports.absent() | ~ports.is_list() | (ports.strings() != prompts.interface_ports(prompt)), guard=on)
    odd = prompts.direction_mismatches(prompt, code)
    warned = F.transform(context["interface_warnings"].items(), lambda x: F.struct(F.try_variant_get(x, "$.port", "string"), F.try_variant_get(x, "$.prompt_direction", "string"), F.try_variant_get(x, "$.rtl_direction", "string")))
    add("context", "interface_warnings", F.when(F.size(odd) > 0, F.to_json(warned) != F.to_json(odd.cast("array<struct<col1:string,col2:string,col3:string>>"))).otherwise(context["interface_warnings"].nonempty()), guard=on)
    for f, real in (("prompt_embedded_candidate_rtl", candidate), ("prompt_embedded_context_rtl", inside)):
        add("context", f, F.when(real.isNotNull(), ~context[f].is_true()).otherwise(~off(context[f])), guard=on)
    add("no_object", "extracted_rtl_summary", ~summary.is_object())
    for f in V.SUMMARY_FIELDS:
        add("missing", f"extracted_rtl_summary.{f}", summary[f].absent(), guard=summary.is_object())
        if f != "top_module":
            add("no_list", f"extracted_rtl_summary.{f}", summary[f].present() & ~summary[f].is_list(), guard=summary.is_object())
    about = rtl.summary(code)
    add("summary", "top_module", about["top_module"].isNotNull() & ~summary["top_module"].nonempty(), guard=summary.is_object())
    add("summary", "reset_signals", F.size(F.array_except(about["reset_signals"], summary["reset_signals"].strings())) > 0, guard=summary.is_object())
    notes = row["notes"].strings()
    listed = lambda texts: F.array(*map(F.lit, texts))
    wrong = F.when(candidate.isNotNull(), notes != listed(CANDIDATE_NOTES)).when(inside.isNotNull(), notes != listed(CONTEXT_NOTES)).otherwise(F.array_contains(notes, CANDIDATE_NOTES[0]))
    add("notes", "notes", wrong)
    said = F.lower(F.array_join(row["assumptions"].strings(), "\n"))
    has = candidate.isNotNull()
    add("assumptions", "no_list", has & ~row["assumptions"].is_list())
    spoken = has & row["assumptions"].is_list()
    add("assumptions", "denies_candidate", spoken & said.contains("no candidate dut source"))
    add("assumptions", "no_candidate", spoken & ~said.contains("buggy topmodule candidate implementation"))
    add("assumptions", "no_reference", spoken & ~said.contains("artifacts.rtl_code is the fixed/reference rtl"))
    for f in ANSWER_ONLY:
        add("answer_field", f, row[f].present())
    add("answer_content", "", json_text.holds_answer_schema(F.to_json(row.value)))
    add("empty", "prompt", ~row["prompt"].filled())
    add("changed", "prompt", row["prompt"].filled() & (row["prompt"].text() != prompt))
    add("domain", "domain", ~row["domain"].isin(["digital_rtl"]))
    given = artifacts.is_object()
    add("no_object", "artifacts", ~given)
    add("changed", "artifacts.rtl_code", ~text(artifacts["rtl_code"]).eqNullSafe(code), guard=given)
    before = artifacts["before_rtl_code"]
    add("changed", "artifacts.before_rtl_code", has & ~text(before).eqNullSafe(candidate), guard=given)
    add("unexpected", "artifacts.before_rtl_code", ~has & before.nonempty(), "warning", given)
    add("unexpected", "artifacts.after_rtl_code", artifacts["after_rtl_code"].nonempty(), "warning", given)
    bench = raw["raw_testbench"].text()
    add("changed", "artifacts.testbench", F.when(bench.isNull(), artifacts["testbench"].nonempty()).otherwise(~text(artifacts["testbench"]).eqNullSafe(bench)), guard=given)
    for f in ("lint_log", "synthesis_report", "toggle_report"):
        add("invented", f"artifacts.{f}", artifacts[f].nonempty(), guard=given)
    add("required_output", "required_output", F.size(F.array_except(listed(V.REQUIRED_OUTPUT), row["required_output"].strings())) > 0)
    return r


def validate(raw: DataFrame, rows: DataFrame) -> DataFrame:
    """JOIN-6: (row_index, source_id, rule, field, severity) of normalised rows (row_index, item) against raw rows (row_index, item).

    The first row of an id counts on either side.
    """
    sid = Node("item")["source_id"].text()
    filled = lambda c: F.coalesce(c != "", F.lit(False))
    none = F.lit(None).cast("int")

    def named(d, rule, severity="error"):
        index = F.col("row_index") if "row_index" in d.columns else none
        return d.select(index.alias("row_index"), "source_id", F.lit(rule).alias("rule"), F.lit("source_id").alias("field"), F.lit(severity).alias("severity"))

    sides = []
    out = None
    for name, d in (("raw", raw), ("row", rows)):
        d = d.select("row_index", F.col("item").alias(name), sid.alias("source_id"))
        tagged = tag_best(d.where(filled(F.col("source_id"))), "source_id", ["row_index"])
        part = named(d.where(~filled(F.col("source_id"))), f"{name}_without_id").union(named(tagged.where("NOT kept"), f"{name}_duplicate"))
        out = part if out is None else out.union(part)
        sides.append(tagged.where("kept").drop("kept", "size"))
    a, b = sides
    out = out.union(named(b.join(a.select("source_id"), "source_id", "left_anti"), "unknown_id")).union(named(a.join(b.select("source_id"), "source_id", "left_anti").drop("row_index"), "missing_row"))
    pairs = b.join(a.drop("row_index"), "source_id")
    wrong = pairs.select("row_index", "source_id", F.explode(found(check_rules(Node("raw"), Node("row")))).alias("p"))
    return out.union(wrong.select("row_index", "source_id", "p.rule", "p.field", "p.severity"))
