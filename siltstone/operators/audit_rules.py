"""Audit and repair of standalone answers against their tasks.

What a task says (tool evidence, identifiers, whether its design is a synthetic candidate) is read from VARIANT
columns; the audit is expressions. A repair rewrites a tree of unknown depth, so it is a small function over one
answer, fed with those facts; it reports each change with old and new value, and a second repair changes nothing.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone import vocab as V
from siltstone.functions import json_text
from siltstone.functions.variant import Node
from siltstone.operators.dataset_rules import report_evidence

# Names, levels, patterns and texts of the audit.
CANONICAL, ALIAS = "rtl_answer.v0.1", "rtl_answer_v0.1"
REQUIRED = (
    "source_id", "task_type", "issue_summary", "time_reasoning", "space_reasoning", "safe_optimization", "functional_risk", "verification_plan", "claim_levels", "evidence_used", "limitations",
)
SEVERITIES = ("low", "medium", "high", "critical")
CONSERVATIVE = ("suggestion_only", "text_inspection", "insufficient_evidence")
STRONG = ("verified", "passed", "correct", "simulation_passed", "lint_clean", "tool_supported")
OTHER_DOMAINS = ("activity", "area", "power")
LISTS = ("evidence_used", "functional_risk", "limitations", "verification_plan")
PREFERRED = ("artifacts.before_rtl_code", "artifacts.rtl_code", "mutation_summary", "mutated_signal_names", "prompt", "tool_checks")
NOT_RUN = "tool_checks are null or absent, so parse, lint, simulation, equivalence, synthesis, power, and toggle checks were not run."
IDENTIFIER = r"[A-Za-z_][A-Za-z0-9_$]*"
SIGNAL = rf"{IDENTIFIER}(?:\[[^\]]+\])?"
KEYWORDS = (
    "always", "and", "assign", "begin", "case", "default", "else", "end", "endcase", "endmodule", "for", "generate", "if", "inout", "input", "logic", "module", "negedge", "or", "output",
    "parameter", "posedge", "reg", "wire",
)
PHRASES = (
    ("simulation", r"\bpassed\s+simulation\b|\bsimulation\s+passed\b|\bverified\s+by\s+simulation\b", "simulation"),
    ("lint", r"\bpassed\s+lint\b|\blint\s+passed\b|\blint\s+clean\b|\bno\s+lint\s+errors\b", "lint"),
    ("synthesis", r"\bsynthesized\s+successfully\b|\bsynthesis\s+passed\b|\bsynthesis\s+shows\b", "synthesis"),
    ("area", r"\barea\s+(?:improved|reduced|decreased)\b", "synthesis"),
    ("power", r"\bpower\s+(?:improved|reduced|decreased)\b", "power"),
    ("timing", r"\btiming\s+(?:met|passed|improved)\b|\bmet\s+timing\b", "synthesis"),
    ("formal", r"\bequivalent\s+by\s+formal\b|\bequivalence\s+passed\b|\bformal\s+(?:passed|proved)\b", "equivalence"),
)
BY_TEXT = r"\bverified\s+by\s+text\s+inspection\b"
CANDIDATE_BUG = r"\b(candidate|dut)\b.{0,80}\b(bug|incorrect|wrong|broken|defect)\b"
HINTS = {
    "wrong_reset_polarity": ("reset", "polarity", "active"),
    "wrong_mux_select_polarity": ("mux", "select", "polarity", "ternary"),
    "incomplete_comb_assignment": ("incomplete", "comb", "assignment", "latch", "else"),
    "off_by_one_counter_limit": ("off-by-one", "counter", "limit", "comparison", "<", "<=", ">", ">="),
    "shift_direction_flip": ("shift", "<<", ">>", "direction"),
    "blocking_nonblocking_swap_in_clocked_block": ("blocking", "nonblocking", "<=", "clocked"),
    "width_truncation_output": ("width", "truncat", "bit 0", "vector"),
    "wrong_fsm_reset_state": ("fsm", "state", "reset"),
}
ISSUE = "struct<severity:string,code:string,field:string>"
CHANGES = "array<struct<field:string,old:string,new:string,reason:string>>"


# what tasks and answers say


def domain_evidence(task: Node, domain: str) -> Column:
    out = F.lit(False)
    for tool in V.EVIDENCE_TOOLS[domain]:
        out = out | report_evidence(task, tool)
    return F.coalesce(out, F.lit(False))


def no_checks(task: Node) -> Column:
    """No task, no checks, or checks that are all null."""
    values = F.map_values(task["tool_checks"].fields())
    return ~task["tool_checks"].is_object() | ~F.exists(values, lambda x: F.schema_of_variant(x) != "VOID")


def _spoken(items: Column) -> Column:
    """The elements of a list as texts."""
    return F.transform(items, lambda x: F.coalesce(F.try_variant_get(x, "$", "string"), F.to_json(x)))


def says_not_run(answer: Node) -> Column:
    text = F.lower(F.array_join(_spoken(answer["limitations"].items()), "\n"))
    return text.contains("tool_checks") & (text.contains("not run") | text.contains("null") | text.contains("absent"))


def synthetic_task(task: Node) -> Column:
    return task["synthetic_bug"].is_true() | task["artifacts"]["before_rtl_code"].filled() | task["design_context"]["prompt_embedded_candidate_rtl"].is_true()


def is_synthetic(answer: Node, task: Node) -> Column:
    """Whether an answer is about a candidate with a planted bug: by its id, its task, or (without a task) its evidence."""
    used = F.exists(_spoken(answer["evidence_used"].items()), lambda x: x.isin("artifacts.before_rtl_code", "mutation_summary"))
    return F.coalesce(answer["source_id"].text().contains("_synthetic_"), F.lit(False)) | F.when(task.is_object(), synthetic_task(task)).otherwise(used)


def identifiers(task: Node) -> Column:
    """Names in a task's designs, its mutated signals and its modules, without keywords."""
    code = F.concat_ws("\n", *[task["artifacts"][k].text() for k in ("rtl_code", "before_rtl_code", "after_rtl_code")])
    named = F.filter(F.array(*[task["design_context"][k].text() for k in ("target_module_name", "rtl_module_name")]), lambda x: x.isNotNull())
    every = F.concat(F.regexp_extract_all(code, F.lit(rf"\b({IDENTIFIER})\b"), F.lit(1)), task["mutated_signal_names"].strings(), named)
    return F.array_distinct(F.filter(every, lambda x: ~F.lower(x).isin(*KEYWORDS)))


def is_label(name: Column) -> Column:
    """A label instead of a signal's name: all known labels hold a space, a hyphen or a slash."""
    return ~F.trim(name).rlike(rf"^{SIGNAL}\z")


def issue_words(answer: Node) -> Column:
    part = lambda x, path: F.coalesce(F.try_variant_get(x, path, "string"), F.lit(""))
    each = F.transform(answer["issue_summary"].items(), lambda x: F.concat(part(x, "$.issue"), F.lit("\n"), part(x, "$.evidence.reason")))
    return F.lower(F.array_join(each, "\n"))


# audit


def findings(answer: Node, task: Node) -> Column:
    """All issues of an answer: an array of (severity, code, field)."""
    issue = lambda severity, code, field: F.struct(F.lit(severity).alias("severity"), (code if isinstance(code, Column) else F.lit(code)).alias("code"), (field if isinstance(field, Column) else F.lit(field)).alias("field"))
    out: list[Column] = []
    many: list[Column] = []
    add = lambda when, severity, code, field: out.append(F.when(F.coalesce(when, F.lit(False)), issue(severity, code, field)))
    a, text, words = answer, answer.json(), issue_words(answer)
    synthetic, items = is_synthetic(answer, task), answer["issue_summary"].items()
    add(a["schema_version"].isin([ALIAS]), "error", "schema_alias", "schema_version")
    add(~a["schema_version"].isin([CANONICAL, ALIAS]), "error", "schema_version", "schema_version")
    add(_any(a[f].absent() for f in REQUIRED), "error", "missing_required_fields", "")
    add(~F.coalesce(a["source_id"].text() != "", F.lit(False)), "error", "missing_source_id", "source_id")
    add(json_text.task_copy(F.to_json(a.value)), "manual_review", "answer_contains_task_copy", "answer")
    add(~a["issue_summary"].is_list(), "error", "issue_summary_type", "issue_summary")
    add(a["issue_summary"].is_list() & synthetic & (F.size(items) == 0), "error", "empty_candidate_issue_summary", "issue_summary")
    known = identifiers(task)

    def of_issue(x: Column, k: Column) -> Column:
        at = lambda path: F.concat(F.lit("issue_summary["), k.cast("string"), F.lit("]" + path))
        is_object = F.try_variant_get(x, "$", "map<string,variant>").isNotNull()
        names = F.coalesce(F.try_variant_get(x, "$.evidence.signal_names", "array<variant>"), F.array().cast("array<variant>"))

        def of_name(n: Column) -> Column:
            name = F.when(F.schema_of_variant(n) == "STRING", F.try_variant_get(n, "$", "string"))
            return F.when(name.isNull() | is_label(name), issue("error", "generic_signal_name", at(".evidence.signal_names"))).when(
                (F.size(known) > 0) & ~F.array_contains(known, F.substring_index(name, "[", 1)), issue("manual_review", "unknown_signal_name", at(".evidence.signal_names"))
            )

        lines = F.try_variant_get(x, "$.evidence.code_location.line_range", "variant")
        blank = lines.isNull() | (F.schema_of_variant(lines) == "VOID") | (F.to_json(lines) == '""')
        severity = F.when(F.schema_of_variant(F.try_variant_get(x, "$.severity", "variant")) == "STRING", F.try_variant_get(x, "$.severity", "string"))
        whole = F.concat(F.array(F.when(~F.coalesce(severity.isin(*SEVERITIES), F.lit(False)), issue("error", "invalid_severity", at(".severity")))), F.transform(names, of_name), F.array(F.when(blank, issue("manual_review", "missing_line_range", at(".evidence.code_location.line_range")))))
        return F.when(~F.coalesce(is_object, F.lit(False)), F.array(issue("error", "issue_summary_item_type", at("")))).otherwise(whole)

    many.append(F.flatten(F.transform(items, of_issue)))
    levels = a["claim_levels"]
    sure = domain_evidence(task, "correctness")
    add(~levels.is_object(), "error", "claim_levels_type", "claim_levels")
    add(levels.is_object() & ~sure & ~levels["correctness"].isin(CONSERVATIVE), "error", "strong_correctness_claim", "claim_levels.correctness")
    add(levels.is_object() & ~sure & levels["correctness"].isin(STRONG), "error", "unsupported_correctness_claim_level", "claim_levels.correctness")
    for d in OTHER_DOMAINS:
        add(levels.is_object() & ~domain_evidence(task, d) & ~levels[d].isin(["insufficient_evidence"]), "error", f"unsupported_{d}_claim_level", f"claim_levels.{d}")
    for code, pattern, tool in PHRASES:
        add(text.rlike("(?i)" + pattern) & ~F.coalesce(report_evidence(task, tool), F.lit(False)), "error", f"unsupported_{code}_wording", "answer")
    add(text.rlike("(?i)" + BY_TEXT), "error", "verified_by_text_inspection_wording", "answer")
    used, listed = _spoken(a["evidence_used"].items()), a["evidence_used"].is_list()
    add(~listed, "error", "evidence_used_type", "evidence_used")
    add(listed & says_not_run(a) & ~F.array_contains(used, "tool_checks"), "error", "missing_tool_checks_evidence", "evidence_used")
    add(listed & synthetic & (F.size(F.array_except(F.array(*map(F.lit, PREFERRED)), used)) > 0), "warning", "synthetic_evidence_incomplete", "evidence_used")
    add(no_checks(task) & ~says_not_run(a), "error", "missing_tool_checks_limitation", "limitations")
    bug = F.regexp_extract(a["source_id"].text(), r"^(?s:.*?)_synthetic_(?s:(.*))$", 1)
    for name, hints in HINTS.items():
        add((bug == name) & ~_any(words.contains(h) for h in hints), "manual_review", "suspicious_mutation_label_mismatch", "issue_summary")
    add(~synthetic & words.rlike(CANDIDATE_BUG), "manual_review", "bug_claim_without_candidate", "issue_summary")
    return F.filter(F.concat(F.array(*out), *[F.coalesce(m, F.array().cast(f"array<{ISSUE}>")) for m in many]), lambda x: x.isNotNull())


def _any(conditions) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | c
    return out


def with_tasks(answers: DataFrame, tasks: DataFrame | None) -> DataFrame:
    """answers (..., item) with ``source_id`` and ``task``: the first task of that id by file and line."""
    rows = answers.withColumn("source_id", Node("item")["source_id"].text())
    if tasks is None:
        return rows.withColumn("task", F.lit(None).cast("variant"))
    named = tasks.select(Node("v")["source_id"].text().alias("_id"), F.shiftleft(F.col("file_ord").cast("long"), 40).alias("_f") + F.col("line"), F.col("v").alias("task")).toDF("_id", "_place", "task").where("_id <> ''")
    first = named.groupBy("_id").agg(F.min("_place").alias("_place"))
    named = named.join(first, ["_id", "_place"])
    return rows.join(named, rows.source_id == named["_id"], "left").drop("_id", "_place")


def audit(answers: DataFrame, tasks: DataFrame | None = None) -> DataFrame:
    """(file, row_index, source_id, severity, code, field) of answers (file, row_index, item).

    An id that an earlier answer has (by file and index), and with ``tasks`` an answer without a task and a task
    without an answer, are errors too.
    """
    rows = with_tasks(answers, tasks)
    out = rows.select("file", "row_index", "source_id", F.inline(findings(Node("item"), Node("task"))))
    named = rows.where("source_id <> ''").select("file", "row_index", "source_id", F.col("task").isNotNull().alias("tasked"))
    again = named.groupBy("source_id").agg(F.min(F.struct("file", "row_index")).alias("first"), F.count("*").alias("n")).where("n > 1")
    told = lambda frame, code: frame.select("file", "row_index", "source_id", F.lit("error"), F.lit(code), F.lit("source_id"))
    out = out.union(told(named.join(again, "source_id").where(F.struct("file", "row_index") != F.col("first")), "duplicate_source_id"))
    if tasks is not None:
        out = out.union(told(named.where("NOT tasked"), "answer_missing_matching_task"))
        asked = tasks.select("file", F.lit(None).cast("int").alias("row_index"), Node("v")["source_id"].text().alias("source_id")).where("source_id <> ''").dropDuplicates(["source_id"])
        out = out.union(told(asked.join(named.select("source_id").distinct(), "source_id", "left_anti"), "task_missing_matching_answer"))
    return out


# repair


def distinct(values: list) -> list:
    """Each value once; objects and lists by their content, others by their text."""
    return list({json.dumps(v, sort_keys=True, ensure_ascii=False) if isinstance(v, (dict, list)) else str(v): v for v in reversed(values)}.values())[::-1]


class Repair:
    """The repair of one answer; ``changes`` lists (field, old, new, reason) in order."""

    def __init__(self, answer: dict, facts: dict):
        self.answer, self.facts, self.changes = answer, facts, []

    def put(self, holder: dict, key: str, new, reason: str, field: str | None = None) -> None:
        old = holder.get(key)
        if old != new:
            self.changes.append((field or key, old, new, reason))
        holder[key] = new

    def run(self) -> dict:
        for step in (self.schema, self.wording, self.lists, self.evidence, self.limitations, self.levels, self.signals):
            step()
        return self.answer

    def schema(self) -> None:
        if self.answer.get("schema_version") == ALIAS:
            self.put(self.answer, "schema_version", CANONICAL, "schema alias")

    def wording(self) -> None:
        def walk(value, path):
            if isinstance(value, str):
                new = re.sub(BY_TEXT, "reviewed by text inspection", value, flags=re.IGNORECASE)
                if new != value:
                    self.changes.append((path, value, new, "wording that claims verification by reading"))
                return new
            if isinstance(value, list):
                return [walk(x, path + "[]") for x in value]
            return {k: walk(x, f"{path}.{k}") for k, x in value.items()} if isinstance(value, dict) else value

        self.answer = walk(self.answer, "answer")

    def lists(self) -> None:
        for name in LISTS:
            if isinstance(self.answer.get(name), list):
                self.put(self.answer, name, distinct(self.answer[name]), f"repeated {name}")

    def not_run(self) -> bool:
        given = self.answer.get("limitations")
        text = "\n".join(map(str, given)).lower() if isinstance(given, list) else ""
        return "tool_checks" in text and any(x in text for x in ("not run", "null", "absent"))

    def synthetic(self) -> bool:
        name = self.answer.get("source_id")
        if isinstance(name, str) and "_synthetic_" in name:
            return True
        if self.facts["tasked"]:
            return self.facts["synthetic"]
        used = self.answer.get("evidence_used")
        return isinstance(used, list) and any(str(x) in ("artifacts.before_rtl_code", "mutation_summary") for x in used)

    def evidence(self) -> None:
        if not isinstance(self.answer.get("evidence_used"), list):
            return
        used = [str(x) for x in self.answer["evidence_used"]]
        lead = [x for x in PREFERRED if x not in used] if self.synthetic() else []
        tail = ["tool_checks"] if self.not_run() and "tool_checks" not in lead + used else []
        self.put(self.answer, "evidence_used", distinct(lead + used + tail), "evidence of synthetic and unchecked answers")

    def limitations(self) -> None:
        given = self.answer.get("limitations")
        if self.facts["unchecked"] and not (isinstance(given, list) and self.not_run()):
            self.put(self.answer, "limitations", distinct([*given, NOT_RUN]) if isinstance(given, list) else [NOT_RUN], "no tool check was run")

    def levels(self) -> None:
        given = self.answer.get("claim_levels")
        if isinstance(given, dict):
            new = dict(given)
            if not self.facts["correctness"] and new.get("correctness") not in CONSERVATIVE:
                new["correctness"] = "suggestion_only"
            new |= {d: "insufficient_evidence" for d in OTHER_DOMAINS if not self.facts[d]}
            self.put(self.answer, "claim_levels", new, "claim levels above the evidence")

    def signals(self) -> None:
        """Labels leave the signal names and are kept as hardware."""
        space = self.answer.get("space_reasoning")
        if not isinstance(space, dict):
            space = self.answer["space_reasoning"] = {}
        key = "hardware_resources_involved"
        kept = space.get(key) if isinstance(space.get(key), list) else []
        moved: list[str] = []
        issues = self.answer.get("issue_summary")
        for k, issue in enumerate(issues if isinstance(issues, list) else []):
            holder = issue.get("evidence") if isinstance(issue, dict) else None
            names = holder.get("signal_names") if isinstance(holder, dict) else None
            labels = [n for n in names if isinstance(n, str) and not re.fullmatch(SIGNAL, n.strip())] if isinstance(names, list) else []
            if labels:
                self.put(holder, "signal_names", distinct([n for n in names if not (isinstance(n, str) and n in labels)]), "labels among the signal names", f"issue_summary[{k}].evidence.signal_names")
                moved += labels
        if moved or key in space and isinstance(space[key], list):
            self.put(space, key, distinct(kept + moved), "labels kept as hardware" if moved else f"repeated {key}", f"space_reasoning.{key}")


def repair(answers: DataFrame, tasks: DataFrame | None = None) -> DataFrame:
    """answers (file, kind, row_index, raw, rest) with ``raw`` repaired, the raw text ``before`` and the ``changes`` in order.

    Old and new values are JSON texts (old null where a key was absent). Rows stay as they are if nothing is wrong.
    """
    rows = with_tasks(answers.withColumn("item", F.parse_json("raw")), tasks)
    t = Node("task")
    facts = {"tasked": t.is_object(), "synthetic": synthetic_task(t), "unchecked": no_checks(t)} | {d: domain_evidence(t, d) for d in V.CLAIM_DOMAINS}
    names = ["file", "kind", "row_index", "raw", "rest"]
    given = rows.select(*names, *[F.coalesce(c, F.lit(False)).alias(k) for k, c in facts.items()])

    asked = list(facts)

    def run(batches: Iterator[pa.RecordBatch]):
        kind = pa.list_(pa.struct([(k, pa.string()) for k in ("field", "old", "new", "reason")]))
        for b in batches:
            told = {k: b.column(k).to_pylist() for k in asked}
            new, changes = [], []
            for k, raw in enumerate(b.column("raw").to_pylist()):
                work = Repair(json.loads(raw), {f: v[k] for f, v in told.items()})
                value = work.run()
                new.append(json_text.compact(value) if work.changes else raw)
                changes.append([{"field": f, "old": None if o is None else json_text.compact(o), "new": json_text.compact(n), "reason": r} for f, o, n, r in work.changes])
            yield pa.RecordBatch.from_arrays([*[b.column(n) for n in ("file", "kind", "row_index")], pa.array(new, pa.string()), b.column("rest"), b.column("raw"), pa.array(changes, kind)], [*names, "before", "changes"])

    return given.mapInArrow(run, f"file string, kind string, row_index int, raw string, rest string, before string, changes {CHANGES}")


def change_rows(repaired: DataFrame) -> DataFrame:
    """The log: (file, row_index, source_id, place, field, old, new, reason), one row for each change."""
    each = repaired.select("file", "row_index", F.get_json_object("raw", "$.source_id").alias("source_id"), F.posexplode("changes").alias("place", "c"))
    return each.select("file", "row_index", "source_id", "place", "c.*")
