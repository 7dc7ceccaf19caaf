"""Rubric scores of candidate answers to dataset rows, as sums of weighted points."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone import vocab as V
from siltstone.functions import rtl
from siltstone.functions.once import let
from siltstone.functions.variant import Node, replaced
from siltstone.operators import dataset_rules
from siltstone.scratch import Scratch

#: Weight of each part.
WEIGHTS = {"schema": 0.20, "grounding": 0.25, "reasoning": 0.20, "claim_safety": 0.20, "verification": 0.10, "alignment": 0.05}
FIELDS = (*V.ANSWER_FIELDS, "source_id", "evidence_used", "limitations")
CAP, PENALTY = 0.25, 0.05
#: Claims whose report among the row's problems counts as a failure once more, and rules that count too.
COUNTED = ("C-1", "C-3", "C-4", "C-5", "A-12", "A-13")
SIGNAL_FIELDS = ("clock_signals", "reset_signals", "registered_signals", "suspected_fsm_signals", "suspected_counters", "activity_hotspots")


def points(tests: list[Column], weight: float) -> Column:
    total = F.lit(0)
    for t in tests:
        total = total + F.when(t, 1).otherwise(0)
    return total * weight / len(tests)


def reference_signals(row: Node) -> Column:
    """SCO-9: signals of the reference answer's issues and of the task's summary."""
    named = F.flatten(F.transform(row["messages"][2]["content"]["issue_summary"].items(), lambda x: F.coalesce(F.try_variant_get(x, "$.evidence.signal_names", "array<string>"), F.array().cast("array<string>"))))
    summary = row["messages"][1]["content"]["extracted_rtl_summary"]
    return F.array_distinct(F.concat(named, *[summary[k].strings() for k in SIGNAL_FIELDS]))


def top_modules(row: Node) -> Column:
    """SCO-10: the summary's top module and all modules in the artifacts, in lower case."""
    task = row["messages"][1]["content"]
    texts = F.transform(F.map_values(task["artifacts"].fields()), lambda x: F.when(F.schema_of_variant(x) == "STRING", F.try_variant_get(x, "$", "string")))
    named = F.array_append(rtl.module_mentions(F.array_join(texts, "\n")), task["extracted_rtl_summary"]["top_module"].text())
    return F.array_distinct(F.transform(F.filter(named, lambda x: x.isNotNull()), F.lower))


def specific(text: Column) -> Column:
    """At least 20 characters, none of them a phrase that says nothing."""
    t = F.lower(F.coalesce(text, F.lit("")))
    said = F.lit(False)
    for phrase in V.GENERIC_TEXT:
        said = said | t.contains(phrase)
    return (F.length(F.trim(t)) >= 20) & ~said


def schema_tests(a: Node, family: Column) -> list[Column]:
    """SCO-2."""
    whole, levels = F.lit(True), a["claim_levels"].is_object()
    for f in FIELDS:
        whole = whole & a[f].present()
    for d in V.CLAIM_DOMAINS:
        levels = levels & a["claim_levels"][d].isin(V.CLAIM_LEVELS)
    return [whole, whole, a["schema_version"].isin(V.ANSWER_SCHEMA), a["task_type"].text().eqNullSafe(family), levels, a["patch"].is_object()]


def grounding_tests(a: Node, signals: Column, modules: Column, artifacts: Column) -> list[Column]:
    """SCO-3: the first issue only."""
    issue = a["issue_summary"][0]
    place, on = issue["evidence"]["code_location"]["module"].text(), issue.is_object()
    named = F.exists(issue["evidence"]["signal_names"].strings(), lambda s: F.length(F.trim(s)) > 0)
    known = place.isNotNull() & let(modules, lambda m: (F.size(m) == 0) | F.array_contains(m, F.lower(place)))
    mentioned = let(F.lower(a.json()), lambda text: F.exists(F.concat(signals, artifacts), lambda s: text.contains(F.lower(s))))
    tests = [issue["issue"].filled(), issue["severity"].isin(V.SEVERITIES), named, known, specific(issue["evidence"]["reason"].text()), mentioned]
    return [on & F.coalesce(t, F.lit(False)) for t in tests]


def reasoning_tests(a: Node) -> list[Column]:
    """SCO-4."""
    time, space = a["time_reasoning"], a["space_reasoning"]
    risk = lambda name: F.lower(space[name].json())
    return [
        specific(time["clock_cycle_behavior"].text()),
        time["latency_or_state_risk"].nonempty() & time["reset_behavior_risk"].nonempty(),
        space["hardware_resources_involved"].is_list() & space["hardware_resources_involved"].nonempty(),
        risk("area_risk").rlike("evidence|synthesis|tool|report|unavailable"),
        risk("activity_risk").rlike("evidence|vcd|toggle|activity|tool|report|unavailable"),
    ]


def verification_tests(a: Node) -> list[Column]:
    """SCO-6: steps of the plan, asked only where the answer speaks of their matter."""
    text, plan = F.lower(a.json()), F.lower(F.array_join(F.transform(a["verification_plan"].items(), lambda x: F.coalesce(F.try_variant_get(x, "$", "string"), F.to_json(x))), " "))
    has = lambda *words: plan.rlike("|".join(words))
    return [
        has("lint", "compile"),
        has("simulation", "simulate"),
        has("synthesis") | ~text.contains("area"),
        has("vcd", "toggle") | ~text.contains("activity"),
        has("power report") | ~text.contains("power"),
    ]


def alignment(a: Node, family: Column) -> Column:
    """SCO-7: half the weight where the words of the task are missing, nothing for another task."""
    text, full = F.lower(a.json()), F.lit(WEIGHTS["alignment"])
    words = F.when(family == "unsafe_optimization_rejection", text.rlike("reject|unsafe|risk")).when(family == "rtl_before_after_judgment", text.rlike("before|after|compare")).when(family == "rtl_tool_report_explanation", text.rlike("report|log|excerpt")).otherwise(True)
    return F.when(~a["task_type"].text().eqNullSafe(family), 0.0).when(words, full).otherwise(full / 2)


def score_answers(rows: DataFrame) -> DataFrame:
    """rows (v: dataset row, answer: variant, and others) with six subscores, failures, errors and ``score``.

    The answer takes the place of the row's own in all rules (SCO-8). errors: problems of that row,
    warnings included, and points missed of the schema; with any, the score is at most ``CAP``.
    failures: claims without support, and the rules of ``COUNTED``. An answer that is no object scores 0.
    """
    a, given = Node("answer"), Node("_given")
    family = given["task_family"].text()
    message = replaced(given["messages"][2], {"content": a.json()})
    swapped = replaced(given, {"messages": F.concat(F.lit("["), given["messages"][0].json(), F.lit(","), given["messages"][1].json(), F.lit(","), message, F.lit("]"))})
    scratch = Scratch(rows.sparkSession, "scores")
    d = rows.withColumns({"_given": F.col("v"), "problem": F.lit(None).cast("string")})
    # written between the steps: the plans stay small, and a row is read apart once
    d = scratch.save(dataset_rules.prepared(d.withColumn("v", F.when(a.is_object(), F.parse_json(swapped)))), "rows")
    artifacts = F.map_keys(F.map_filter(given["messages"][1]["content"]["artifacts"].fields(), lambda k, v: ~F.to_json(v).isin("null", '""', "[]", "{}", "0", "false")))
    tests = schema_tests(a, family)
    parts = {
        "schema": points(tests, WEIGHTS["schema"]),
        "grounding": points(grounding_tests(a, reference_signals(given), top_modules(given), artifacts), WEIGHTS["grounding"]),
        "reasoning": points(reasoning_tests(a), WEIGHTS["reasoning"]),
        "verification": points(verification_tests(a), WEIGHTS["verification"]),
        "alignment": alignment(a, family),
    }
    own = {"_found": F.transform(dataset_rules.row_findings(), lambda x: x["rule"]), "_said": dataset_rules.said(), "_missed": sum((F.when(t, 0).otherwise(1) for t in tests[1:]), F.lit(0)), "_object": a.is_object()}
    d = scratch.save(d.withColumns(own | {k: F.when(a.is_object(), F.coalesce(c, F.lit(0.0))).otherwise(0.0) for k, c in parts.items()}), "judged")
    counted = F.size(F.filter(F.concat("_found", "_said"), lambda x: x.isin(*COUNTED)))
    failures = F.when(F.col("_object"), F.size("_said") + counted).otherwise(0)
    errors = F.when(F.col("_object"), F.size("_found") + F.size("_said") + F.col("_missed")).otherwise(1)
    safe = F.when(F.col("_object"), F.greatest(F.lit(0.0), F.lit(WEIGHTS["claim_safety"]) - PENALTY * failures)).otherwise(0.0)
    total = F.round(sum((F.col(k) for k in parts), safe), 6)
    d = d.withColumns({"failures": failures, "errors": errors, "claim_safety": safe, "score": F.when(errors > 0, F.least(total, F.lit(CAP))).otherwise(total)})
    return d.select(*(F.col("_given").alias("v") if c == "v" else c for c in rows.columns), "failures", "errors", *(F.round(k, 6).alias(k) for k in WEIGHTS), "score")


def summary(scored: DataFrame, by: str | None = None) -> DataFrame:
    """mean, median, min and max of the scores; 0.0 where there are none."""
    z = lambda c: F.coalesce(F.round(c, 6), F.lit(0.0))
    g = scored.groupBy(by) if by else scored
    return g.agg(F.count("*").alias("n"), z(F.avg("score")).alias("mean"), z(F.median("score")).alias("median"), z(F.min("score")).alias("min"), z(F.max("score")).alias("max"))
