"""Scores of model predictions against prompts, by category; null where a category does not apply."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone import vocab as V
from siltstone.functions import claims, json_text
from siltstone.functions.variant import Node
from siltstone.operators import teacher
from siltstone.operators.keys import tag_best
from siltstone.operators.rules import found
from siltstone.scratch import Scratch

# The categories, in order.
CATEGORIES = (
    "json_valid", "schema_valid", "source_id_match", "required_fields_valid", "claim_safety_valid",
    "reference_only_behavior_valid", "candidate_bug_behavior_valid", "exact_expected_match_optional", "overall_valid",
)
UNSAFE = ("unsupported_claim", "level", "level_without_evidence", "verified_without_evidence")
PROMPT_FIELDS = ("source_id", "system_prompt", "user_prompt", "user_content", "expected_answer", "metadata", "scoring_row")


def load_prompts(scanned: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(prompts, problems) of scanned prompt rows: source_id, family, task, expected, checks."""
    v = Node("v")
    missing = F.filter(F.array(*[F.when(v[f].absent(), F.lit(f"missing {f}")) for f in PROMPT_FIELDS]), lambda x: x.isNotNull())
    bad = F.when(F.col("problem").isNotNull(), F.col("problem")).when(F.size(missing) > 0, F.array_join(missing, ", ")).when(~v["source_id"].filled(), "source_id must be a non-empty string")
    d = scanned.withColumn("bad", bad).withColumn("source_id", v["source_id"].text())
    good = d.where("bad IS NULL").select("file_ord", "line", "source_id", v["metadata"]["task_family"].text().alias("family"), v["user_content"].value.alias("task"), v["expected_answer"].value.alias("expected"), v["scoring_row"]["tool_checks"].value.alias("checks"))
    return good, d.where("bad IS NOT NULL").select("line", "bad")


def load_predictions(scanned: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(predictions, problems): source_id, model, output; a source_id counts once, a missing model is a warning."""
    v = Node("v")
    bad = F.when(F.col("problem").isNotNull(), F.col("problem")).when(~v["source_id"].filled(), "source_id must be a non-empty string").when(v["output"].absent(), "missing output")
    d = scanned.withColumn("source_id", v["source_id"].text()).withColumn("bad", bad)
    tagged = tag_best(d.where("bad IS NULL"), "source_id", ["file_ord", "line"])
    problems = d.where("bad IS NOT NULL").select("line", "bad", F.lit("error").alias("severity"))
    problems = problems.union(tagged.where("NOT kept").select("line", F.concat(F.lit("duplicate source_id "), "source_id"), F.lit("error")))
    kept = tagged.where("kept").select("line", "source_id", v["model"].text().alias("model"), v["output"].value.alias("output"))
    return kept.drop("line"), problems.union(kept.where("model IS NULL").select("line", F.lit("missing model"), F.lit("warning")))


def required_valid(answer: Node) -> Column:
    """SCO-13: twelve fields, four of them of their types."""
    out = answer["issue_summary"].is_list() & answer["verification_plan"].is_list() & answer["claim_levels"].is_object() & answer["limitations"].is_list()
    for f in V.TEACHER_FIELDS:
        out = out & answer[f].present()
    return out


def discusses_candidate(answer: Node) -> Column:
    """SCO-12: the answer names the candidate, or places an issue in it."""
    named = F.lower(answer.json()).rlike("candidate|topmodule|before_rtl_code|prompt-embedded")
    return named | F.exists(answer["issue_summary"].items(), lambda x: F.coalesce(F.try_variant_get(x, "$.evidence.code_location.module", "string") == "TopModule", F.lit(False)))


def score(prompts: DataFrame, predictions: DataFrame) -> DataFrame:
    """SCO-11 for every prompt (source_id, family, task, expected, checks) and its prediction (source_id, model, output), if any.

    Adds parse_status, the nine categories and ``errors``, the names of what is wrong.
    """
    p = predictions.select("source_id", "model", "output", F.lit(True).alias("_given"))
    d = prompts.join(p, "source_id", "left")
    out, text = Node("output"), F.when(Node("output").is_text(), Node("output").as_("string"))
    d = d.withColumn("_parsed", F.when(text.isNotNull(), json_text.parsed_output(text)))
    d = d.withColumn("parse_status", F.when(F.col("_given").isNull(), "missing_prediction").when(out.is_object(), "parsed_object").when(text.isNotNull(), F.col("_parsed.status")).otherwise("missing_prediction"))
    d = d.withColumn("answer", F.when(out.is_object(), out.value).otherwise(F.try_parse_json("_parsed.answer")))
    a, t, checks = Node("answer"), Node("task"), Node("checks")
    d = Scratch(prompts.sparkSession, "predictions").save(d.drop("_parsed"), "parsed")
    d = d.withColumn("_rules", F.when(F.col("answer").isNotNull(), F.transform(found(teacher.answer_rules(a, t, F.col("answer").isNotNull())), lambda x: x["rule"])))
    passed = {k: checks[k]["status"].isin(["pass"]) for k in V.TOOLS}
    d = d.withColumn("_said", claims.unsupported(F.lower(a.json()), passed, t["artifacts"]["power_report"].nonempty(), a["functional_risk"].nonempty(), F.lower(a["time_reasoning"].json())))
    has = F.col("answer").isNotNull()
    rule = lambda *names: F.coalesce(F.arrays_overlap("_rules", F.array(*map(F.lit, names))), F.lit(False))
    reference, candidate = teacher.reference_only(t), teacher.has_candidate(t)
    only = lambda c: F.coalesce(has & c, F.lit(False))
    d = d.withColumns(
        {
            "json_valid": has,
            "schema_valid": only(a["schema_version"].isin(["rtl_answer_v0.1"]) & a["task_type"].text().eqNullSafe(F.col("family"))),
            "source_id_match": only(a["source_id"].text() == F.col("source_id")),
            "required_fields_valid": only(required_valid(a)),
            "claim_safety_valid": only((F.size("_said") == 0) & ~rule(*UNSAFE) & a["claim_levels"].is_object()),
            "reference_only_behavior_valid": F.when(reference, has & ~rule("reference_bug")),
            "candidate_bug_behavior_valid": F.when(candidate, only(discusses_candidate(a))),
            "exact_expected_match_optional": only(F.to_json("answer") == F.to_json("expected")),
        }
    )
    good = F.lit(True)
    for c in CATEGORIES[:5]:
        good = good & F.col(c)
    for c in CATEGORIES[5:7]:
        good = good & F.coalesce(F.col(c), F.lit(True))
    d = d.withColumn("overall_valid", good & ~rule("task_copy"))
    named = [F.when(F.col("_given").isNull(), "missing prediction").when(~has, "no answer")]
    named += [F.when(has & (F.col(c) == F.lit(False)), F.lit(c)) for c in CATEGORIES[1:7]]
    errors = F.array_distinct(F.concat(F.filter(F.array(*named), lambda x: x.isNotNull()), F.coalesce("_rules", F.array().cast("array<string>")), F.when(has, F.col("_said")).otherwise(F.array().cast("array<string>"))))
    return d.withColumn("errors", errors).select("source_id", "model", "parse_status", *CATEGORIES, "errors")


def category_counts(scored: DataFrame) -> DataFrame:
    """AGG-5: (category, n_pass, n_fail, total, rate); null counts in none."""
    each = F.array(*[F.struct(F.lit(c).alias("category"), F.col(c).alias("ok")) for c in CATEGORIES])
    total, passed = F.count("ok"), F.count_if(F.col("ok"))
    rows = scored.select(F.inline(each))
    return rows.groupBy("category").agg(passed.alias("n_pass"), F.count_if(~F.col("ok")).alias("n_fail"), total.alias("total"), F.when(total > 0, F.round(passed / total, 6)).alias("rate"))


def failures_by_source(scored: DataFrame) -> DataFrame:
    """AGG-6: the ids with errors, and these."""
    return scored.where(F.size("errors") > 0).select("source_id", "errors")


def extra(prompts: DataFrame, predictions: DataFrame) -> DataFrame:
    """Predictions for no prompt."""
    return predictions.select("source_id").join(prompts.select("source_id"), "source_id", "left_anti")
