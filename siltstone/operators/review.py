"""Gates of the review flow: promotion of public rows, readiness against the selection, triage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone import vocab as V
from siltstone.functions.json_text import with_value
from siltstone.functions.variant import Node
from siltstone.operators import dataset_rules, keys
from siltstone.operators.dataset_rules import ANSWER, ROW, TASK, evidence, passed
from siltstone.operators.rules import Rule, violations
from siltstone.scratch import Scratch

PUBLIC = ("public_verilog_eval", "public_rtllm", "public_rtllm_2", "public_rtlfixer", "public_openllm_rtl", "llm_converted_public")
SEVERITY_RANK = {"critical": 0, "important": 1, "minor": 2}


# Wording of imported drafts, phrases that say nothing of a clock, licenses that say nothing.
STUBS = ("Imported public dataset draft row requires review", "Treat this as a draft review seed only", "No optimization effect is claimed", "Imported public artifacts may be incomplete")
IDLE_CLOCK = ("Cycle-level behavior was not verified during import", "must be reviewed against the task intent")
UNCERTAIN = ("unknown", "uncertain", "todo")
EXPLAINS = "rtl_tool_report_explanation"
#: Reasons of a rejection by what its errors begin with, the first that fits.
REASONS = (("stub", "stub answer"), ("license", "license gate"), ("provenance", "provenance gate"), ("source", "public source gate"), ("duplicate", "duplicate id"))


def is_stub():
    """PRO-3: wording of an import, or, outside explanations of reports, an answer that claims nothing or only explains."""
    first, levels = ANSWER["issue_summary"][0], ANSWER["claim_levels"].fields()
    imported = first["severity"].isin(["low"]) & F.coalesce(F.lower(first["issue"].text()).contains("imported public"), F.lit(False))
    claims_nothing = (F.size(levels) > 0) & ~F.exists(F.map_values(levels), lambda x: ~F.coalesce((F.schema_of_variant(x) == "STRING") & (F.try_variant_get(x, "$", "string") == "insufficient_evidence"), F.lit(False)))
    idle = claims_nothing | ANSWER["safe_optimization"]["patch_style"].isin(["explanation_only"])
    return ANSWER.json().rlike("|".join(STUBS)) | imported | (idle & ~ANSWER["task_type"].isin([EXPLAINS]))


def _said(tests) -> Column:
    """The names of the tests that hold, in order."""
    return F.filter(F.array(*[F.when(F.coalesce(when, F.lit(False)), F.lit(name)) for name, when in tests]), lambda x: x.isNotNull())


def quality_errors() -> Column:
    """PRO-2: what a task and its answer lack for promotion, in order."""
    text = lambda x, path: F.when(F.schema_of_variant(F.try_variant_get(x, path, "variant")) == "STRING", F.trim(F.try_variant_get(x, path, "string")))
    items, code = ANSWER["issue_summary"].items(), _any_code() | TASK["artifacts"]["after_rtl_code"].filled()

    def of_issue(x, k):
        at = F.concat(F.lit("issue_summary["), k.cast("string"), F.lit("]."))
        names = F.coalesce(F.try_variant_get(x, "$.evidence.signal_names", "array<variant>"), F.array().cast("array<variant>"))
        named = F.exists(names, lambda n: F.coalesce(F.length(text(n, "$")) > 0, F.lit(False)))
        return F.array(F.when(~F.coalesce(F.length(text(x, "$.evidence.reason")) > 0, F.lit(False)), F.concat(at, F.lit("reason"))), F.when(code & ~named, F.concat(at, F.lit("signal_names"))))

    time, space = ANSWER["time_reasoning"]["clock_cycle_behavior"], ANSWER["space_reasoning"]
    plan = F.lower(F.array_join(F.transform(ANSWER["verification_plan"].items(), lambda x: F.coalesce(F.try_variant_get(x, "$", "string"), F.to_json(x))), " "))
    risk = lambda name, pattern: ~F.coalesce(space[name].text().rlike("(?i)" + pattern), F.lit(False))
    balance = TASK["task_type"].isin(["rtl_area_activity_review"])
    rest = _said([
        ("clock_cycle_behavior", ~time.filled() | time.text().rlike("|".join(IDLE_CLOCK))), ("area_risk", risk("area_risk", "evidence|synthesis|tool|report|unavailable")),
        ("activity_risk", risk("activity_risk", "evidence|vcd|toggle|activity|tool|report|unavailable")), ("verification_plan", ~plan.rlike("lint|compile")),
        ("verification_plan.synthesis", balance & ~plan.contains("synthesis")), ("verification_plan.toggle", balance & ~plan.rlike("vcd|toggle")),
    ])
    issues = F.when(F.size(items) == 0, F.array(F.lit("issue_summary"))).otherwise(F.filter(F.flatten(F.transform(items, of_issue)), lambda x: x.isNotNull()))
    return F.when(TASK.is_object() & ANSWER.is_object(), F.concat(issues, rest)).otherwise(F.array(F.lit("messages")))


def promotion_errors(allow_stub: bool = False) -> Column:
    """PRO-1: what bars a row of a public source from promotion, in order."""
    p, license_ = ROW["provenance"], F.lower(F.trim(F.coalesce(ROW["license"].text(), F.lit(""))))
    gate_ = _said([
        ("source", ~ROW["source"].isin(PUBLIC)), ("license", ~ROW["license"].filled()), ("license uncertain", license_.isin(*UNCERTAIN)), ("provenance", ~p.is_object()),
        ("provenance.public_dataset_name", p.is_object() & ~p["public_dataset_name"].filled()), ("provenance.notes", p.is_object() & ~p["notes"].filled()), ("rejected", ROW["review_status"].isin(["rejected"])),
        ("answer", ~ANSWER.is_object()), ("stub", ANSWER.is_object() & is_stub() & F.lit(not allow_stub)),
    ])
    return F.concat(gate_, F.when(ANSWER.is_object(), quality_errors()).otherwise(F.array().cast("array<string>")))


def _starts(start: str):
    return lambda x: x.startswith(start)


def promote(rows: DataFrame, allow_stub: bool = False, target: str = "validated") -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) rows: accepted with ``review_status`` set to ``target`` in raw and v, rejected with ``problems`` and ``reason``.

    A row needs an id, must pass the promotion rules, and, with its new status, all rules of the catalogue, warnings
    included. Only accepted rows occupy an id: the first of them wins.
    """
    if target not in ("validated", "reviewed"):
        raise ValueError(f"rows are promoted to validated or reviewed, not {target}")
    columns = list(dict.fromkeys([*rows.columns, "id"]))
    d = rows.withColumn("id", ROW["id"].text()).withColumn("own", F.concat(_said([("id", ~F.coalesce(F.col("id") != "", F.lit(False)))]), promotion_errors(allow_stub)))
    d = d.withColumn("given", F.col("v")).withColumn("text", with_value("raw", F.lit("review_status"), F.lit(target))).withColumn("v", F.parse_json("text")).withColumn("problem", F.lit(None).cast("string"))
    judged = dataset_rules.judge(d).withColumn("problems", F.when(F.size("own") > 0, F.col("own")).otherwise(F.transform("findings", lambda x: F.concat_ws(" ", x["rule"], F.when(x["field"] != "", x["field"])))))
    judged = Scratch(rows.sparkSession, "promote").save(judged.select(*[c for c in columns if c != "v"], "v", "given", "text", "problems"), "judged")
    tagged = keys.tag_best(judged.where("size(problems) = 0"), "id", ["file_ord", "line"])
    again = tagged.where("NOT kept").withColumn("problems", F.array(F.lit("duplicate"))).select(judged.columns)
    reason = F.lit("promotion gate failed")
    for start, said in reversed(REASONS):
        reason = F.when(F.size(F.filter("problems", _starts(start))) > 0, said).otherwise(reason)
    accepted = tagged.where("kept").withColumn("raw", F.col("text")).select(*columns)
    return accepted, judged.where("size(problems) > 0").unionByName(again).withColumn("v", F.col("given")).withColumn("reason", reason).select(*columns, "problems", "reason")


def readiness(selected: DataFrame, reviewed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(status of every id, claim risks of the reviewed rows)."""
    ids = keys.reconcile(selected.select(ROW["id"].text().alias("id")), reviewed.select(ROW["id"].text().alias("id")), "id")
    rules = [Rule("verified", "claim_levels", "error", _some(lambda d: ANSWER["claim_levels"][d].isin(["verified"]) & ~_either(passed, d)))]
    rules.append(Rule("above", "claim_levels", "error", _some(lambda d: ANSWER["claim_levels"][d].isin(["tool_supported"]) & ~_either(evidence, d))))
    rules.append(Rule("plan", "verification_plan", "error", ~F.lower(ANSWER["verification_plan"].json()).rlike("lint|compile")))
    return ids, violations(reviewed.withColumn("id", ROW["id"].text()), rules, ["id"])


def _some(test):
    out = F.lit(False)
    for d in V.CLAIM_DOMAINS:
        out = out | test(d)
    return out


def _either(check, domain):
    out = F.lit(False)
    for tool in V.EVIDENCE_TOOLS[domain]:
        out = out | check(tool)
    return out


# Strong wording by the evidence that it needs, and wording that softens it.
STRONG = (
    ("unverified_correctness_wording", r"\b(?:verified|passes|passed\s+simulation|equivalent|proven)\b", ("simulation", "equivalence")),
    ("unsupported_synthesis_wording", r"\b(?:synthesis\s+result|timing\s+met|area\s+reduced)\b", ("synthesis",)),
    ("unsupported_activity_wording", r"\b(?:activity\s+reduced|toggle\s+(?:reduced|improved))\b", ("toggle",)),
    ("unsupported_power_wording", r"\bpower\s+(?:reduced|improved)\b", ("power",)),
)
SOFT = r"\b(?:may|might|could|should|suggest(?:s|ed)?|potential(?:ly)?|not verified|unverified|without|unavailable)\b"


def reset_rules() -> list[Rule]:
    """TRI-3: what the prompt, the code and the testbench say of the reset against what the answer says."""
    art = TASK["artifacts"]
    blank = lambda c: F.coalesce(F.trim(c), F.lit(""))
    prompt = blank(F.when(TASK["prompt"].filled(), TASK["prompt"].text()).otherwise(art["lint_log"].text()))
    code = blank(F.coalesce(*[F.when(art[k].nonempty(), art[k].text()) for k in ("rtl_code", "before_rtl_code", "after_rtl_code")]))
    bench = blank(art["testbench"].text())
    context, said = F.lower(F.concat_ws("\n", prompt, code, bench)), F.lower(ANSWER.json())
    late, timed = context.rlike(r"\basynchronous\b") | context.contains("posedge areset"), code.rlike(r"(?i)always\s*@\s*\(\s*posedge\s+clk\s*\)") & ~F.lower(code).contains("posedge areset")
    sync = context.rlike(r"\bsynchronous\b") | timed
    says_sync, says_async = said.rlike(r"(?<!a)\bsynchronous(?:\s+\w+){0,2}\s+reset\b"), said.rlike(r"\basynchronous(?:\s+\w+){0,2}\s+reset\b")
    alias = bench.rlike(r"(?i)(?:assign\s+)?areset\s*=\s*reset|(?:assign\s+)?reset\s*=\s*areset")
    mode = lambda k: F.lower(bench).contains(f"reset_test({k}")
    return [
        Rule("reset_async_sync_contradiction", "answer", "important", late & says_sync),
        Rule("reset_sync_async_contradiction", "answer", "important", sync & says_async),
        Rule("testbench_reset_mode_contradiction", "answer", "important", (mode(1) & says_sync) | (mode(0) & says_async)),
        Rule("reset_signal_name_uncertain", "answer", "minor", context.contains("areset") & ~said.contains("areset") & said.contains("reset") & ~alias),
    ]


def strong_wording(rows: DataFrame) -> DataFrame:
    """TRI-2: (id, code) of strong wording in a string of the answer that has no softening, without a passed check."""
    from siltstone.functions.json_text import leaves

    checks = {t: passed(t) for t in V.TOOLS}
    d = rows.select(ROW["id"].text().alias("id"), F.struct(*[c.alias(t) for t, c in checks.items()]).alias("ok"), F.explode(leaves(F.when(ANSWER.present(), ANSWER.json()))).alias("s"))
    d = d.withColumn("s", F.lower("s")).where(~F.col("s").rlike(SOFT))
    found = []
    for code, pattern, tools in STRONG:
        backed = F.lit(False)
        for t in tools:
            backed = backed | F.col(f"ok.{t}")
        found.append(F.when(F.col("s").rlike(pattern) & ~backed, F.lit(code)))
    return d.select("id", F.explode(F.filter(F.array(*found), lambda x: x.isNotNull())).alias("code")).distinct()


def triage(reviewed: DataFrame) -> DataFrame:
    """Issues of reviewed rows, worst first: id, severity, code, field; each code once a row."""
    text = F.lower(ANSWER.json())
    patch, safe = ANSWER["patch"], ANSWER["safe_optimization"]
    resources = ANSWER["space_reasoning"]["hardware_resources_involved"].strings()
    rules = [
        Rule("shape", "messages", "critical", ~ROW["messages"].is_list() | (F.size(ROW["messages"].items()) < 3)),
        Rule("roles", "messages", "critical", ~(ROW["messages"][0]["role"].isin(["system"]) & ROW["messages"][1]["role"].isin(["user"]) & ROW["messages"][2]["role"].isin(["assistant"]))),
        Rule("swap", "messages", "critical", TASK["schema_version"].isin(V.ANSWER_SCHEMA) | ANSWER["schema_version"].isin(V.TASK_SCHEMA)),
        Rule("copy", "messages", "critical", TASK.json() == ANSWER.json(), None, TASK.present()),
        Rule("placeholder", "answer", "important", text.rlike(r"\btodo\b|\btbd\b|lorem ipsum|placeholder")),
        Rule("strong_claim", "answer", "important", text.rlike(r"guarantee|proven|certainly|definitely") & ~text.rlike(r"may|might|could|not verified|unverified")),
        Rule("no_code", "artifacts", "important", ~_any_code()),
        Rule("no_testbench", "artifacts", "minor", ~TASK["artifacts"]["testbench"].filled()),
        Rule("patch_state", "patch", "minor", (patch["provided"].is_true() & ~patch["diff"].filled()) | (patch["provided"].is_false() & patch["diff"].filled())),
        Rule("patch_style", "safe_optimization", "minor", patch["provided"].is_true() & safe["patch_style"].isin(["explanation_only"])),
        Rule("repeated_resources", "space_reasoning", "minor", F.size(resources) > F.size(F.array_distinct(resources))),
        *reset_rules(),
    ]
    found = violations(reviewed.withColumn("id", ROW["id"].text()), rules, ["id"]).select("id", "severity", F.col("rule").alias("code"), "field")
    found = found.union(strong_wording(reviewed).select("id", F.lit("important"), "code", F.lit("answer"))).dropDuplicates(["id", "code", "field"])
    rank = F.when(F.col("severity") == "critical", 0).when(F.col("severity") == "important", 1).otherwise(2)
    return found.orderBy("id", rank, "code")


def _any_code():
    return TASK["artifacts"]["rtl_code"].filled() | TASK["artifacts"]["before_rtl_code"].filled()
