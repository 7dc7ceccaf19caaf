"""A rule-based answer to each dataset row: careful, without any claim."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone import vocab as V
from siltstone.functions.variant import Node

SIGNAL_FIELDS = ("registered_signals", "clock_signals", "reset_signals", "suspected_counters", "suspected_fsm_signals", "activity_hotspots")
EVIDENCE = ("before_rtl_code", "rtl_code", "after_rtl_code", "testbench", "lint_log", "synthesis_report", "toggle_report")
PLAN = (
    "Lint or compile the code or the reports at hand.", "Simulate before any claim of correct behavior.", "Run synthesis before any claim about area.",
    "Compare toggle activity (VCD) before any claim about activity; evidence is unavailable here.", "Claim nothing about power without a power report.",
)
UNCHECKED = "No tool check was run: all entries of tool_checks are null or absent."
CHECKED = "Nothing is claimed about tool outcomes beyond the artifacts at hand."
READ_ONLY = "Based on the text of the prompt and the artifacts alone."


def _listed(*texts: str) -> Column:
    return F.array(*map(F.lit, texts))


def signals(task: Node, n: int = 4) -> Column:
    """PRJ-14: the first distinct signals of the summary, else names of filled artifacts, else a constant."""
    named = F.array_distinct(F.concat(*[task["extracted_rtl_summary"][f].strings() for f in SIGNAL_FIELDS]))
    filled = F.map_keys(F.map_filter(task["artifacts"].fields(), lambda k, v: ~F.to_json(v).isin("null", '""', "[]", "{}")))
    return F.when(F.size(named) > 0, F.slice(named, 1, n)).when(F.size(filled) > 0, F.slice(F.array_sort(filled), 1, n)).otherwise(_listed("supplied_artifact"))


def evidence_used(task: Node) -> Column:
    """PRJ-15: what of the task an answer can rest on, in order."""
    each = [F.when(task["artifacts"][f].filled(), F.lit(f"artifacts.{f}")) for f in EVIDENCE]
    each += [F.when(task["mutation_summary"].filled(), "mutation_summary"), F.when(task["mutated_signal_names"].is_list() & task["mutated_signal_names"].nonempty(), "mutated_signal_names"), F.when(task["prompt"].filled(), "prompt"), F.lit("tool_checks")]
    return F.filter(F.array(*each), lambda x: x.isNotNull())


def limitations(task: Node) -> Column:
    """HLP-41."""
    checks = task["tool_checks"]
    run = checks.is_object() & F.exists(F.map_values(checks.fields()), lambda x: F.to_json(x) != "null")
    return F.array(F.when(run, CHECKED).otherwise(UNCHECKED), F.lit(READ_ONLY))


def source_id(row: Node, task: Node) -> Column:
    """HLP-42: the task's id, else the row's."""
    first = [F.when(n.nonempty(), n.text()) for n in (task["source_id"], row["source_id"], row["id"])]
    return F.coalesce(*first, F.lit("unknown_source_id"))


def answers(rows: DataFrame) -> DataFrame:
    """PRJ-13 and PIP-9: (id, answer struct) of dataset rows (v)."""
    row = Node("v")
    task = row["messages"][1]["content"]
    module = F.coalesce(task["extracted_rtl_summary"]["top_module"].text(), F.lit("unknown"))
    area = task["task_type"].isin(["rtl_area_activity_review"])
    plan = F.when(area, F.array_append(_listed(*PLAN), F.lit("Compare synthesis area and toggle activity before any change is taken."))).otherwise(_listed(*PLAN))
    s = lambda **kw: F.struct(*[(F.lit(v) if isinstance(v, str) else v).alias(k) for k, v in kw.items()])
    none = F.array().cast("array<string>")
    evidence = s(signal_names=signals(task), code_location=s(module=module, block="unknown", line_range=F.lit(None).cast("string")), reason="The text was read, not run; nothing about behavior is established.")
    answer = s(
        schema_version=V.ANSWER_SCHEMA[0], source_id=source_id(row, task), task_type=task["task_type"].text(), issue_summary=F.array(s(issue="The code or report is set out for review; no fault is claimed.", severity="low", evidence=evidence)),
        time_reasoning=s(clock_cycle_behavior="Cycle behavior has to be kept; it was not simulated here.", latency_or_state_risk="Any change needs a check of latency and state.", reset_behavior_risk="Any change needs a check of reset behavior."),
        space_reasoning=s(hardware_resources_involved=_listed("registers", "logic"), area_risk="Synthesis evidence is unavailable.", activity_risk="Toggle evidence is unavailable."),
        safe_optimization=s(recommendation="Change nothing before the checks have run.", patch_style="explanation_only", expected_effect="None is claimed."), functional_risk=_listed("Unverified changes may alter behavior."),
        verification_plan=plan, claim_levels=s(**dict.fromkeys(V.CLAIM_DOMAINS, "insufficient_evidence")), evidence_used=evidence_used(task), limitations=limitations(task), patch=s(provided=F.lit(False), files=none),
    )
    return rows.select(row["id"].text().alias("id"), answer.alias("answer"))
