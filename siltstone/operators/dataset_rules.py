"""The rule catalogue of dataset rows held as VARIANT: row, task and answer rules in one scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone import vocab as V
from siltstone.functions import claims, json_text, rtl
from siltstone.functions.variant import Node
from siltstone.operators.rules import Rule, violations

ROW = Node("v")
TASK, ANSWER = ROW["messages"][1]["content"], ROW["messages"][2]["content"]


def row_rules() -> list[Rule]:
    """V-01 ... V-15."""
    r: list[Rule] = []
    is_row = F.col("problem").isNull()

    def add(rule, field, when, severity="error", message=None, guard=is_row):
        r.append(Rule(rule, field, severity, when, message, guard))

    add("V-01", "", F.col("problem").isNotNull(), message=F.col("problem"), guard=None)
    for name in sorted(V.ROW_FIELDS):
        add("V-02", name, ROW[name].absent(), message=f"missing field {name}")
    add("V-04", "id", ROW["id"].present() & ~ROW["id"].filled())
    add("V-05", "dataset_version", ~ROW["dataset_version"].isin([V.DATASET_VERSION]))
    for name, words in (("split", V.SPLITS), ("source", V.SOURCES), ("task_family", V.TASK_TYPES), ("review_status", V.REVIEW_STATUSES)):
        add("V-06", name, ROW[name].present() & ~ROW[name].isin(words))
    pilot = ROW["review_status"].isin(["teacher_distilled_unreviewed"]) & ROW["dataset_stage"].isin(["teacher_distill_pilot"]) & ROW["approval_status"].isin(["not_approved"])
    add("V-07", "review_status", ROW["split"].isin(V.TRAINING_SPLITS) & ~ROW["review_status"].isin(["validated", "reviewed"]) & ~pilot)
    add("V-08", "split", ROW["split"].isin(["unsplit"]) & ROW["review_status"].isin(["rejected"]), severity="warning")
    for name in ("license", "design_family", "created_by"):
        add("V-09", name, ROW[name].present() & ~ROW[name].filled())
    p = ROW["provenance"]
    add("V-10", "provenance", p.present() & ~p.is_object())
    for name in V.PROVENANCE_FIELDS:
        add("V-10", f"provenance.{name}", p.is_object() & p[name].absent())
    add("V-10", "provenance.notes", p.is_object() & p["notes"].present() & ~p["notes"].is_text())
    t = ROW["tool_checks"]
    add("V-11", "tool_checks", t.present() & ~t.is_object())
    for name in V.TOOLS:
        one = t[name]
        add("V-11", f"tool_checks.{name}", t.is_object() & (one.absent() | ~(one.is_object() | (one.kind == "VOID"))))
        add("V-11", f"tool_checks.{name}.status", one.is_object() & ~one["status"].isin(V.TOOL_STATUSES))
    add("V-12", "messages", ~three())
    for k, role in enumerate(V.ROLES):
        m = ROW["messages"][k]
        add("V-13", f"messages[{k}]", ~m.is_object(), guard=is_row & three())
        add("V-13", f"messages[{k}].role", m.is_object() & ~m["role"].isin([role]), guard=is_row & three())
        add("V-13", f"messages[{k}].content", m.is_object() & m["content"].absent(), guard=is_row & three())
    add("V-14", "messages[0].content", ~ROW["messages"][0]["content"].filled(), guard=is_row & shaped())
    add("V-15", "messages[1].content", ~TASK.is_object(), guard=is_row & shaped())
    add("V-15", "messages[2].content", ~ANSWER.is_object(), guard=is_row & shaped())
    return r


def prepared(rows: DataFrame) -> DataFrame:
    """rows (v, problem) with the guards of the rules as columns, each evaluated once a row.

    _three: there are three messages. _shaped: all are objects with content, so the rules after V-13 apply.
    _whole: task and answer are objects, so their rules apply. _distill: the row is a distilled one.
    """
    m = ROW["messages"]
    shaped_ = F.size(m.items()) == 3
    for k in range(3):
        shaped_ = shaped_ & m[k].is_object() & m[k]["content"].present()
    distilled = ROW["review_status"].isin(["teacher_distilled_unreviewed"]) | ROW["dataset_stage"].isin(["teacher_distill_pilot"])
    whole_ = F.col("problem").isNull() & shaped_ & TASK.is_object() & ANSWER.is_object()
    guards = {"_three": F.size(m.items()) == 3, "_shaped": shaped_, "_whole": whole_, "_distill": distilled}
    return rows.withColumns({k: F.coalesce(c, F.lit(False)) for k, c in guards.items()})


def three() -> Column:
    return F.col("_three")


def shaped() -> Column:
    return F.col("_shaped")


def whole() -> Column:
    return F.col("_whole")


def is_distill() -> Column:
    return F.col("_distill")


def task_rules() -> list[Rule]:
    """T-01 ... T-12."""
    r: list[Rule] = []

    def add(rule, field, when, guard=None):
        r.append(Rule(rule, f"messages[1].content.{field}", "error", when, None, whole() if guard is None else whole() & guard))

    add("T-01", "schema_version", ~TASK["schema_version"].isin(V.TASK_SCHEMA))
    add("T-02", "domain", ~TASK["domain"].isin(["digital_rtl"]))
    kind = TASK["task_type"]
    add("T-03", "task_type", ~kind.isin(V.TASK_TYPES) | ~kind.text().eqNullSafe(ROW["task_family"].text()))
    add("T-04", "user_goal", ~TASK["user_goal"].isin(V.USER_GOALS))
    a = TASK["artifacts"]
    add("T-05", "artifacts", ~a.is_object())
    for name in V.ARTIFACTS:
        add("T-05", f"artifacts.{name}", a[name].absent(), a.is_object())
    some = F.lit(False)
    for name in V.ARTIFACTS:
        some = some | a[name].nonempty()
    add("T-05", "artifacts", ~some, a.is_object())
    c = TASK["constraints"]
    add("T-06", "constraints", ~c.is_object())
    for name in V.CONSTRAINTS:
        add("T-06", f"constraints.{name}", c[name].absent(), c.is_object())
    add("T-07", "constraints.do_not_claim_power_without_power_report", ~c["do_not_claim_power_without_power_report"].is_true(), c.is_object())
    add("T-08", "constraints.preserve_cycle_level_behavior", ~c["preserve_cycle_level_behavior"].is_true() & ~kind.isin(["unsafe_optimization_rejection"]), c.is_object())
    out = F.coalesce(TASK["required_output"].as_("array<string>"), F.array().cast("array<string>"))
    add("T-09", "required_output", ~TASK["required_output"].is_list() | (F.size(F.array_except(F.array(*map(F.lit, V.REQUIRED_OUTPUT)), out)) > 0))
    for name, fields, rule in (("design_context", V.CONTEXT_FIELDS, "T-10"), ("extracted_rtl_summary", V.SUMMARY_FIELDS, "T-11")):
        add(rule, name, ~TASK[name].is_object())
        for f in fields:
            add(rule, f"{name}.{f}", TASK[name][f].absent(), TASK[name].is_object())
    add("T-12", "assumptions", ~TASK["assumptions"].is_list())
    return r


def passed(tool: str) -> Column:
    """EVD-1: the tool's check has status pass."""
    return ROW["tool_checks"][tool]["status"].isin(["pass"])


def evidence(tool: str) -> Column:
    """EVD-2: a pass with a summary or the tool's report; fail or unknown only explain a report at hand."""
    check = ROW["tool_checks"][tool]
    report = TASK["artifacts"][V.TOOL_ARTIFACTS[tool]].filled() if tool in V.TOOL_ARTIFACTS else F.lit(False)
    good = check["status"].isin(["pass"]) & (check["summary"].filled() | report)
    return good | (check["status"].isin(["fail", "unknown"]) & report & TASK["task_type"].isin(["rtl_tool_report_explanation"]))


def _either(columns) -> Column:
    out = F.lit(False)
    for c in columns:
        out = out | c
    return out


def answer_rules() -> list[Rule]:
    """A-01 ... A-15, but for distilled rows."""
    r: list[Rule] = []

    def add(rule, field, when, severity="error", guard=None):
        on = whole() & ~is_distill()
        r.append(Rule(rule, f"messages[2].content.{field}".rstrip("."), severity, when, None, on if guard is None else on & guard))

    for name in V.ANSWER_FIELDS:
        add("A-01", name, ANSWER[name].absent())
    add("A-02", "schema_version", ~ANSWER["schema_version"].isin(V.ANSWER_SCHEMA))
    add("A-03", "task_type", ~ANSWER["task_type"].text().eqNullSafe(TASK["task_type"].text()))
    issues = ANSWER["issue_summary"]
    items = issues.items()
    add("A-04", "issue_summary", ~issues.is_list() | (F.size(items) == 0))

    def some(test) -> Column:
        return F.exists(items, test)

    get = lambda x, path, kind="variant": F.try_variant_get(x, f"$.{path}", kind)
    is_kind = lambda x, start: F.coalesce(F.schema_of_variant(x).startswith(start), F.lit(False))
    graded = lambda x: is_kind(x, "OBJECT") & F.coalesce(get(x, "severity", "string").isin(*V.SEVERITIES), F.lit(False))

    def lacks(path, field):
        return lambda x: graded(x) & is_kind(get(x, path), "OBJECT") & get(x, f"{path}.{field}").isNull()

    add("A-05", "issue_summary", some(lambda x: ~graded(x)))
    add("A-06", "issue_summary.issue", some(lambda x: graded(x) & (F.length(F.trim(F.coalesce(get(x, "issue", "string"), F.lit("")))) == 0)))
    add("A-06", "issue_summary.evidence", some(lambda x: graded(x) & ~is_kind(get(x, "evidence"), "OBJECT")))
    for f in ("signal_names", "code_location", "reason"):
        add("A-06", f"issue_summary.evidence.{f}", some(lacks("evidence", f)))
    for f in ("module", "block"):
        add("A-06", f"issue_summary.evidence.code_location.{f}", some(lacks("evidence.code_location", f)))
    add("A-07", "issue_summary.evidence.code_location.line_range", some(lacks("evidence.code_location", "line_range")), "warning")
    safe, risk, plan = ANSWER["safe_optimization"], ANSWER["functional_risk"], ANSWER["verification_plan"]
    add("A-08", "safe_optimization", ~safe.is_object())
    add("A-08", "functional_risk", ~risk.is_list() | ((F.size(risk.items()) == 0) & ~safe["patch_style"].isin(["explanation_only"])), guard=safe.is_object())
    words = F.lower(plan.json())
    add("A-09", "verification_plan", ~plan.is_list() | ~(words.contains("lint") | words.contains("compile")))
    area = words.contains("synthesis") & (words.contains("area") | words.contains("unavailable"))
    activity = (words.contains("vcd") | words.contains("toggle") | words.contains("activity")) & (words.contains("comparison") | words.contains("unavailable"))
    add("A-10", "verification_plan", ~area | ~activity, guard=plan.is_list() & TASK["task_type"].isin(["rtl_area_activity_review"]))
    levels = ANSWER["claim_levels"]
    add("A-11", "claim_levels", ~levels.is_object())
    for d in V.CLAIM_DOMAINS:
        level = levels[d]
        add("A-11", f"claim_levels.{d}", ~level.isin(V.CLAIM_LEVELS), guard=levels.is_object())
        add("A-12", f"claim_levels.{d}", level.isin(["verified"]) & ~_either(map(passed, V.EVIDENCE_TOOLS[d])), guard=levels.is_object())
        add("A-13", f"claim_levels.{d}", level.isin(["tool_supported"]) & ~_either(map(evidence, V.EVIDENCE_TOOLS[d])), guard=levels.is_object())
    add("A-14", "claim_level", ANSWER["claim_level"].present(), "warning")
    add("A-14", "claim_level", ANSWER["claim_level"].present() & levels.absent())
    for f in ("time_reasoning", "space_reasoning", "patch"):
        add("A-15", f, ~ANSWER[f].is_object())
    code = {k: TASK["artifacts"][k] for k in ("rtl_code", "before_rtl_code", "after_rtl_code")}
    golden = ROW["source"].isin(["handwritten_golden"]) & ROW["review_status"].isin(["reviewed"])
    add("G-01", "", ~F.coalesce(ROW["id"].text(), F.lit("")).rlike(r"^golden_[a-z0-9_]+_(?:bug|activity|report|reject|compare)_\d{3}\z"), guard=golden)
    compared, explained = (TASK["task_type"].isin([k]) for k in ("rtl_before_after_judgment", "rtl_tool_report_explanation"))
    real = {k: rtl.is_substantive(n.text()) for k, n in code.items()}
    need = F.when(compared, real["before_rtl_code"] & real["after_rtl_code"]).when(explained, ~code["rtl_code"].nonempty() | real["rtl_code"]).otherwise(real["rtl_code"])
    add("G-02", "artifacts", ~need, guard=golden)
    given = F.when(compared, F.concat_ws("\n", code["before_rtl_code"].text(), code["after_rtl_code"].text())).otherwise(code["rtl_code"].text())
    known = F.transform(rtl.module_mentions(given), F.lower)
    backed = golden & F.coalesce(F.length(given) > 0, F.lit(False))
    words = lambda x, path: F.when(F.schema_of_variant(get(x, path)) == "STRING", get(x, path, "string"))
    listed = lambda x: F.size(F.coalesce(get(x, "evidence.signal_names", "array<variant>"), F.array().cast("array<variant>"))) > 0
    add("G-03", "issue_summary.evidence.signal_names", some(lambda x: ~listed(x)), guard=backed)
    add("G-03", "issue_summary.evidence.code_location.module", some(lambda x: ~F.coalesce(F.array_contains(known, F.lower(words(x, "evidence.code_location.module"))), F.lit(False))), guard=backed)
    add("G-03", "issue_summary.evidence.code_location.block", some(lambda x: ~F.coalesce(words(x, "evidence.code_location.block").isin(*V.BLOCKS), F.lit(False))), guard=backed)
    return r


def distill_rules() -> list[Rule]:
    """D-01 ... D-14 of distilled rows."""
    from siltstone.operators import teacher

    on = whole() & is_distill()
    family, origins = ROW["source_family"], F.array(TASK["source_dataset"].text(), TASK["provenance"]["origin"].text())
    origins = F.filter(origins, lambda x: F.coalesce(x != "", F.lit(False)))
    tests = [
        ("D-01", "dataset_stage", ~ROW["dataset_stage"].isin(["teacher_distill_pilot"])),
        ("D-02", "approval_status", ~ROW["approval_status"].isin(["not_approved"])),
        ("D-03", "source", ~ROW["source"].isin(["teacher_generated"])),
        ("D-04", "source_family", ~(family.is_text() & family.nonempty())),
        ("D-05", "source_family", (F.size(origins) > 0) & F.coalesce(family.text() != "", F.lit(False)) & ~F.array_contains(origins, family.text())),
        ("D-06", "schema_pair", ~ROW["schema_pair"].isin([V.SCHEMA_PAIR])),
        ("D-07", "promotion_allowed", ~ROW["promotion_allowed"].is_false()),
        ("D-08", "dataset_name", ~(ROW["dataset_name"].is_text() & ROW["dataset_name"].nonempty())),
        ("D-09", "split_seed", ~ROW["split_seed"].is_integer()),
        ("D-10", "id", F.coalesce(ROW["id"].text().startswith("golden_"), F.lit(False))),
        ("D-11", "source", ROW["source"].isin(["handwritten_golden"])),
        ("D-12", "source_id", ~(TASK["source_id"].is_text() & TASK["source_id"].nonempty()) | ~TASK["source_id"].text().eqNullSafe(ANSWER["source_id"].text()) | (ROW["source_id"].nonempty() & ~ROW["source_id"].text().eqNullSafe(TASK["source_id"].text()))),
        ("D-13", "messages[1].content", json_text.answer_copy(F.when(on, TASK.json()))),
    ]
    rules = [Rule(k, f, "error", w, None, on) for k, f, w in tests]
    answered = teacher.answer_rules(ANSWER, TASK, on)
    return rules + [Rule("D-14", f"messages[2].content.{r.field}", "error", r.when, r.message if r.message is not None else r.rule, on if r.guard is None else on & r.guard) for r in answered]


def row_findings() -> Column:
    """All problems within one row, but for claims."""
    from siltstone.operators.rules import found

    return found([*row_rules(), *task_rules(), *answer_rules(), *distill_rules()])


def said() -> Column:
    """C-1 ... C-8 of a row."""
    text = F.lower(ANSWER.json())
    return claims.unsupported(
        text, {t: passed(t) for t in V.TOOLS}, TASK["artifacts"]["power_report"].nonempty(), ANSWER["functional_risk"].nonempty(), F.lower(ANSWER["time_reasoning"].json())
    )


def judge(scanned: DataFrame) -> DataFrame:
    """A scan with ``row_id``, ``findings`` (the problems of each row taken by itself) and ``trains``
    (the split and family of a row that takes part in training splits), in one projection."""
    keyed = prepared(scanned).withColumn("row_id", F.when(F.col("problem").isNull(), ROW["id"].text()))
    claim = lambda rule: F.struct(rule.alias("rule"), F.lit("messages[2].content").alias("field"), F.lit("error").alias("severity"), F.concat(F.lit("unsupported claim "), rule).alias("message"), F.lit(1000).alias("ord"))
    claims_ = F.coalesce(F.when(whole(), F.transform(said(), claim)), F.array().cast("array<struct<rule:string,field:string,severity:string,message:string,ord:int>>"))
    trains = F.when(~is_distill() & ROW["split"].isin(V.TRAINING_SPLITS), F.struct(ROW["split"].text().alias("split"), ROW["design_family"].text().alias("family")))
    return keyed.withColumn("findings", F.concat(row_findings(), claims_)).withColumn("trains", trains)


def violations_of(judged: DataFrame) -> DataFrame:
    """All violations of judged rows, with duplicate ids (V-03) and families in several training splits (V-22) of each file."""
    found = judged.select("file", "line", "row_id", F.explode("findings").alias("x")).select("file", "line", "row_id", "x.*")
    good = judged.where("problem IS NULL AND row_id IS NOT NULL").select("file", "line", "row_id", "trains")
    first = good.groupBy(F.col("file").alias("f"), F.col("row_id").alias("k")).agg(F.min("line").alias("first"), F.count("*").alias("n")).where("n > 1")
    again = good.join(first, (good.row_id == first.k) & (good.file == first.f)).where("line <> first")
    message = F.concat(F.lit("duplicate row id; first seen on line "), F.col("first"))
    found = found.union(again.select("file", "line", "row_id", F.lit("V-03"), F.lit("id"), F.lit("error"), message, F.lit(1001)))
    family = good.where("trains IS NOT NULL").groupBy("file", F.col("trains.family").alias("family")).agg(F.collect_set("trains.split").alias("s")).where("size(s) > 1")
    none = F.lit(None).cast("long")
    return found.union(family.select("file", none, "family", F.lit("V-22"), F.lit("design_family"), F.lit("error"), F.concat(F.lit("family in splits "), F.array_join(F.sort_array("s"), ", ")), F.lit(1002)))


def validate(scanned: DataFrame) -> DataFrame:
    """All violations of a scan: (file, line, row_id, rule, field, severity, message, ord), each file by itself.

    One scan evaluates the row rules; only duplicate ids and families in several training splits need an
    aggregation.
    """
    return violations_of(judge(scanned))


def verdict(found: DataFrame, strict: bool = False) -> bool:
    """No errors, and no warnings if strict."""
    return found.where("true" if strict else "severity = 'error'").limit(1).count() == 0


def by_task_type(scanned: DataFrame, found: DataFrame) -> DataFrame:
    """V-21: (task_type, n) of the rows whose messages are whole."""
    return prepared(scanned).where(whole()).groupBy(TASK["task_type"].text().alias("task_type")).agg(F.count("*").alias("n"))


def tool_evidence(task, tool: str) -> Column:
    """EVD-4: any status but none and not_run; a check that is no object counts if it is not empty."""
    check = task["tool_checks"][tool]
    return F.when(check.is_object(), check["status"].nonempty() & ~check["status"].isin(["not_run"])).otherwise(check.nonempty() & ~check.is_false())


def report_evidence(task, tool: str) -> Column:
    """EVD-5: as EVD-4, or a filled report of the tool, a power report included."""
    reports = V.TOOL_ARTIFACTS | {"power": "power_report"}
    report = task["artifacts"][reports[tool]].filled() if tool in reports else F.lit(False)
    return tool_evidence(task, tool) | report
