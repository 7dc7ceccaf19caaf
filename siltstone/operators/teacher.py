"""Answers of a teacher model, paired with their tasks: rules, batch validation, merging."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone import vocab as V
from siltstone.functions import claims, json_text
from siltstone.functions.variant import Node
from siltstone.operators.keys import duplicate_keys, tag_best
from siltstone.operators.rules import Rule, found

#: Domains that need a tool, whatever the answer says.
MEASURED = ("area", "activity", "power")


def _any(columns) -> Column:
    out = F.lit(False)
    for c in columns:
        out = out | c
    return out


def has_candidate(task: Node) -> Column:
    """ANS-1: the prompt embeds a candidate, or there is code from before a change."""
    return task["design_context"]["prompt_embedded_candidate_rtl"].is_true() | task["artifacts"]["before_rtl_code"].filled()


def reference_only(task: Node) -> Column:
    """ANS-2: the code has the role of a reference and there is no candidate."""
    context = task["design_context"]["source_rtl_role"]
    role = F.when(context.present(), context.text()).otherwise(task["source_rtl_role"].text())
    return F.coalesce(role == "reference_rtl", F.lit(False)) & ~has_candidate(task)


def claims_candidate_bug(answer: Node) -> Column:
    """ANS-3: an issue or its reason speaks of a defect of the candidate, and none denies one."""
    get = lambda x, path: F.coalesce(F.try_variant_get(x, path, "string"), F.lit(""))
    text = F.lower(F.array_join(F.transform(answer["issue_summary"].items(), lambda x: F.concat_ws("\n", get(x, "$.issue"), get(x, "$.evidence.reason"))), "\n"))
    denies = text.rlike(r"\b(no|not|cannot|can't|insufficient)\b.{0,80}\b(candidate|dut)\b.{0,80}\bbug")
    return ~denies & text.rlike(r"\b(candidate|dut)\b.{0,80}\b(bug|incorrect|wrong|fails|mismatch|broken|defect)\b")


def answer_rules(answer: Node, task: Node, on: Column | None = None, text: Column | None = None) -> list[Rule]:
    """ANS-0: the rules of an answer beside its task. ``on``: rows where they are asked, which spares Python the others.

    ``text``: a column with the answer's JSON, where there is one; without it several rules write the answer out.
    """
    from siltstone.operators.dataset_rules import tool_evidence

    evidence = {t: tool_evidence(task, t) for t in V.TOOLS}
    asked = F.lit(True) if on is None else on
    text = answer.json() if text is None else text
    levels, r = answer["claim_levels"], []

    def add(rule, field, when, guard=None):
        r.append(Rule(rule, field, "error", when, f"{rule}: {field}", guard))

    for f in sorted(V.TEACHER_FIELDS):
        add("missing", f, answer[f].absent())
    add("schema", "schema_version", ~answer["schema_version"].isin(V.ANSWER_SCHEMA))
    add("other_task", "task_type", ~answer["task_type"].text().eqNullSafe(task["task_type"].text()))
    add("task_copy", "", json_text.task_copy(F.when(asked, text)))
    add("no_list", "issue_summary", ~answer["issue_summary"].is_list())
    for f in ("time_reasoning", "space_reasoning", "safe_optimization"):
        add("no_object", f, answer[f].present() & ~answer[f].is_object())
    for f in ("functional_risk", "verification_plan", "evidence_used", "limitations"):
        add("no_list", f, answer[f].present() & ~answer[f].is_list())
    add("no_object", "claim_levels", ~levels.is_object())
    for d in sorted(V.CLAIM_DOMAINS):
        backed = _any(evidence[t] for t in V.EVIDENCE_TOOLS[d])
        add("level", f"claim_levels.{d}", ~levels[d].isin(V.CLAIM_LEVELS), levels.is_object())
        if d in MEASURED:
            add("level_without_evidence", f"claim_levels.{d}", ~backed & ~levels[d].isin(["insufficient_evidence"]), levels.is_object())
        add("verified_without_evidence", f"claim_levels.{d}", ~backed & levels[d].isin(["verified"]), levels.is_object())
    said = claims.tool_claims(text, evidence)
    r.append(Rule("unsupported_claim", "answer", "error", F.size(said) > 0, F.concat(F.lit("unsupported_claim: "), F.array_join(said, ", "))))
    add("reference_bug", "issue_summary", reference_only(task) & claims_candidate_bug(answer))
    add("denies_candidate", "", has_candidate(task) & F.lower(text).contains("no candidate dut source is provided"))
    return r


def validate_batch(tasks: DataFrame, answers: DataFrame, expected: list[str] | None = None) -> DataFrame:
    """Issues (row_index, source_id, rule, field) of answers (row_index, item) to tasks (line, v).

    The first task and the first answer of a source_id count; later ones are duplicates. ``expected``:
    the ids that a batch file announces.
    """
    t, a = Node("v")["source_id"].text(), Node("item")["source_id"].text()
    filled = lambda c: F.coalesce(c != "", F.lit(False))
    tasks = tasks.select("line", F.col("v").alias("task"), t.alias("source_id"))
    none = F.lit(None)
    issue = lambda d, rule, field="source_id": d.select("row_index", "source_id", F.lit(rule).alias("rule"), F.lit(field).alias("field"))
    of_tasks = tasks.withColumn("row_index", none.cast("int"))
    out = issue(of_tasks.where(~filled(F.col("source_id"))), "task_without_id")
    keyed = tasks.where(filled(F.col("source_id")))
    out = out.union(issue(duplicate_keys(keyed, "source_id").withColumn("row_index", none.cast("int")), "task_duplicate"))
    first = tag_best(keyed, "source_id", ["line"]).where("kept").select("source_id", "task")
    answers = answers.select("row_index", F.col("item").alias("answer"), a.alias("source_id"))
    out = out.union(issue(answers.where(~filled(F.col("source_id"))), "answer_without_id"))
    tagged = tag_best(answers.where(filled(F.col("source_id"))), "source_id", ["row_index"])
    out = out.union(issue(tagged.where("NOT kept"), "answer_duplicate"))
    kept = tagged.where("kept").drop("kept", "size")
    out = out.union(issue(kept.join(first.select("source_id"), "source_id", "left_anti"), "unknown_id"))
    paired = kept.join(first, "source_id").withColumn("text", Node("answer").json())
    problems = paired.select("row_index", "source_id", F.explode(found(answer_rules(Node("answer"), Node("task"), text=F.col("text")))).alias("p"))
    out = out.union(problems.select("row_index", "source_id", "p.rule", "p.field"))
    if expected is not None:
        want = tasks.sparkSession.createDataFrame([(x,) for x in expected], "source_id string").distinct()
        gone = want.join(kept, "source_id", "left_anti").withColumn("row_index", none.cast("int"))
        out = out.union(issue(gone, "expected_missing")).union(issue(kept.join(want, "source_id", "left_anti"), "not_expected"))
    return out


def merge(tasks: DataFrame, answers: DataFrame, system: str) -> tuple[DataFrame, DataFrame]:
    """(rows, issues): JOIN-5, one row of three messages per answer, in the answers' order; none while there are issues."""
    issues = validate_batch(tasks, answers)
    t = tasks.select(Node("v")["source_id"].text().alias("source_id"), F.to_json("v").alias("task"))
    a = answers.select("row_index", Node("item")["source_id"].text().alias("source_id"), F.to_json("item").alias("answer"))
    role = lambda name, text: F.concat(F.lit(f'{{"role":"{name}","content":'), text, F.lit("}"))
    raw = F.concat(F.lit('{"id":'), F.to_json(F.col("source_id").cast("variant")), F.lit(',"messages":['), F.concat_ws(",", role("system", F.to_json(F.lit(system).cast("variant"))), role("user", F.col("task")), role("assistant", F.col("answer"))), F.lit("]}"))
    clean = issues.agg((F.count("*") == 0).alias("clean"))  # one row
    return a.join(t, "source_id").select("row_index", "source_id", raw.alias("raw")).join(F.broadcast(clean), F.col("clean")).drop("clean"), issues
