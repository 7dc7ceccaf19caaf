import copy
import json

import pytest
from pyspark.sql import functions as F

from siltstone import vocab as V
from siltstone.operators import dataset_rules, mutate, scoring
from siltstone.sources import jsonl

CODE = "module top(input clk, input rst_n, output reg [3:0] q);\n always @(posedge clk) if (!rst_n) q <= 0; else q <= q + 1;\nendmodule"


def row(k=1, **over):
    task = {
        "schema_version": "rtl_task_v0.1", "domain": "digital_rtl", "task_type": "rtl_bug_review", "user_goal": "find_correctness_bug",
        "design_context": dict.fromkeys(V.CONTEXT_FIELDS, "x"), "artifacts": dict.fromkeys(V.ARTIFACTS) | {"rtl_code": CODE},
        "extracted_rtl_summary": dict.fromkeys(V.SUMMARY_FIELDS, []), "constraints": dict.fromkeys(V.CONSTRAINTS, True), "assumptions": [], "required_output": list(V.REQUIRED_OUTPUT),
    }
    answer = {
        "schema_version": "rtl_answer_v0.1", "task_type": "rtl_bug_review",
        "issue_summary": [{"issue": "counter wraps", "severity": "low", "evidence": {"signal_names": ["q"], "code_location": {"module": "top", "block": "always", "line_range": "2"}, "reason": "q is four bits wide and wraps"}}],
        "time_reasoning": {"reset_behavior_risk": "none"}, "space_reasoning": {}, "safe_optimization": {"recommendation": "none", "patch_style": "explanation_only", "expected_effect": "none"},
        "functional_risk": ["wrap"], "verification_plan": ["lint", "simulate"], "claim_levels": dict.fromkeys(V.CLAIM_DOMAINS, "insufficient_evidence"), "patch": {},
    }
    out = {
        "id": f"row_{k}", "dataset_version": "dataset_v0.1", "split": "unsplit", "source": "public_rtllm", "license": "MIT", "design_family": f"fam{k % 5}", "task_family": "rtl_bug_review",
        "created_by": "t", "review_status": "reviewed", "provenance": dict.fromkeys(V.PROVENANCE_FIELDS, "p"), "tool_checks": dict.fromkeys(V.TOOLS),
        "messages": [{"role": "system", "content": "s"}, {"role": "user", "content": task}, {"role": "assistant", "content": answer}],
    }
    return out | over


def found(spark, tmp_path, rows):
    path = tmp_path / "in.jsonl"
    path.write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in rows))
    return dataset_rules.validate(jsonl.scan(spark, str(path)))


def edit(path, value=..., k=1):
    r = copy.deepcopy(row(k))
    at = r
    for p in path[:-1]:
        at = at[p]
    if value is ...:
        del at[path[-1]]
    else:
        at[path[-1]] = value
    return r


TASK, ANSWER = ("messages", 1, "content"), ("messages", 2, "content")
CASES = [
    ("V-02", edit(("license",))), ("V-04", edit(("id",), " ")), ("V-05", edit(("dataset_version",), None)), ("V-06", edit(("split",), [])), ("V-07", row(split="train", review_status="draft")),
    ("V-08", row(review_status="rejected")), ("V-09", edit(("created_by",), None)), ("V-10", edit(("provenance",), "x")), ("V-10", edit(("provenance", "notes"))), ("V-11", edit(("tool_checks", "lint"), {"status": "odd"})),
    ("V-11", edit(("tool_checks", "lint"))), ("V-12", edit(("messages",), [])), ("V-13", edit(("messages", 1, "role"), "x")), ("V-14", edit(("messages", 0, "content"), "")), ("V-15", edit(TASK, "t")),
    ("T-01", edit((*TASK, "schema_version"), "v9")), ("T-03", edit((*TASK, "task_type"), None)), ("T-05", edit((*TASK, "artifacts", "rtl_code"), "")), ("T-07", edit((*TASK, "constraints", "do_not_claim_power_without_power_report"), 1)),
    ("T-09", edit((*TASK, "required_output"), [])), ("T-12", edit((*TASK, "assumptions"), {})), ("A-01", edit((*ANSWER, "patch"))), ("A-04", edit((*ANSWER, "issue_summary"), [])), ("A-05", edit((*ANSWER, "issue_summary", 0, "severity"), "huge")),
    ("A-06", edit((*ANSWER, "issue_summary", 0, "evidence", "reason"))), ("A-07", edit((*ANSWER, "issue_summary", 0, "evidence", "code_location", "line_range"))), ("A-09", edit((*ANSWER, "verification_plan"), ["look"])),
    ("A-11", edit((*ANSWER, "claim_levels", "area"), "sure")), ("A-12", edit((*ANSWER, "claim_levels", "area"), "verified")), ("A-13", edit((*ANSWER, "claim_levels", "area"), "tool_supported")), ("C-1", edit((*ANSWER, "functional_risk"), ["reduces power"])),
]


def test_each_rule_reports_its_fault_and_a_good_row_none(spark, tmp_path):
    rows = [row(0)] + [c | ({"id": f"case_{k}"} if c.get("id") == "row_1" else {}) for k, (_, c) in enumerate(CASES, 1)]
    got = {}
    for r in found(spark, tmp_path, rows).collect():
        got.setdefault(r.line, set()).add(r.rule)
    assert 1 not in got
    for k, (rule, _) in enumerate(CASES, 2):
        assert rule in got.get(k, ()), (rule, got.get(k))


def test_table_rules(spark, tmp_path):
    rows = [row(1, split="train"), row(2, id="row_1"), row(6, split="test"), "{bad", "[]"]
    got = [(r.rule, r.line, r.row_id) for r in found(spark, tmp_path, rows).collect()]
    assert ("V-03", 2, "row_1") in got and ("V-22", None, "fam1") in got
    assert sorted(r[1] for r in got if r[0] == "V-01") == [4, 5]


def test_scores(spark):
    good = row()["messages"][2]["content"] | {"source_id": "s", "evidence_used": [], "limitations": []}
    claims_ = copy.deepcopy(good)
    claims_["functional_risk"] = ["it reduces power"]
    bare = {k: v for k, v in good.items() if k != "limitations"}
    cases = {"good": good, "claims": claims_, "bare": bare, "other": good | {"task_type": "rtl_area_activity_review"}, "empty": {}, "list": []}
    d = spark.createDataFrame([(k, json.dumps(row()), json.dumps(a)) for k, a in cases.items()], "id string, r string, j string").select("id", F.parse_json("r").alias("v"), F.parse_json("j").alias("answer"))
    got = {r.id: r for r in scoring.score_answers(d).collect()}
    # worked by hand: all of schema and grounding, nothing of reasoning, two of five steps, the whole of the rest
    assert (got["good"].schema, got["good"].grounding, got["good"].reasoning, got["good"].verification, got["good"].alignment) == (0.2, 0.25, 0.0, 0.04, 0.05)
    assert got["good"].errors == 0 and got["good"].score == 0.74
    # one claim, reported by the claims and by the rules: two failures of 0.05
    assert got["claims"].failures == 2 and got["claims"].claim_safety == 0.1 and got["claims"].score == 0.25
    assert got["bare"].schema == round(0.2 * 4 / 6, 6) and got["bare"].score == 0.25
    assert got["other"].alignment == 0.0 and got["other"].score == 0.25 and got["list"].score == 0.0
    s = scoring.summary(spark.createDataFrame([], "score double")).first()
    assert (s.n, s["mean"], s["max"]) == (0, 0.0, 0.0)


def test_mutations(spark):
    code = CODE + "\nassign y = sel ? a : b; // my_cnt < 5\nassign z = a << 2;"
    d = spark.createDataFrame([(1, code), (2, "nothing"), (3, None)], "id int, code string")
    rows = mutate.mutate(d, "id", "code", 9).collect()
    got = {r.bug_type: r.mutated for r in rows}
    assert "if (rst_n)" in got["wrong_reset_polarity"] and "!sel ? a : b" in got["wrong_mux_select_polarity"]
    assert "my_cnt <= 5" in got["off_by_one_counter_limit"] and "a >> 2" in got["shift_direction_flip"] and "q = 0" in got["blocking_nonblocking_swap_in_clocked_block"]
    assert all(x != code for x in got.values()) and {r.bug_type: r.signals for r in rows}["shift_direction_flip"] == ["z"]
    one = mutate.mutate(d, "id", "code").collect()
    assert len(one) == 1 and one == mutate.mutate(d, "id", "code").collect()
    assert mutate.mutate(d, "id", "code", 9, limit=2).count() == 2


def test_distilled_rows(spark, tmp_path):
    task = row()["messages"][1]["content"] | {"source_id": "s", "source_dataset": "d"}
    answer = {k: v for k, v in row()["messages"][2]["content"].items() if k != "patch"} | {"source_id": "s", "evidence_used": [], "limitations": []}
    pilot = row(review_status="teacher_distilled_unreviewed", source="teacher_generated", dataset_stage="teacher_distill_pilot", approval_status="not_approved", schema_pair=V.SCHEMA_PAIR, promotion_allowed=False, dataset_name="n", split_seed=7, source_id="s", source_family="d")
    pilot["messages"][1]["content"], pilot["messages"][2]["content"] = task, answer
    changed = {
        "D-01": {"dataset_stage": "x"}, "D-02": {"approval_status": "approved"}, "D-03": {"source": "public_rtllm"}, "D-04": {"source_family": ""}, "D-05": {"source_family": "e"}, "D-06": {"schema_pair": "x"},
        "D-07": {"promotion_allowed": None}, "D-08": {"dataset_name": ""}, "D-09": {"split_seed": "7"}, "D-10": {"id": "golden_x"}, "D-12": {"source_id": "t"},
    }
    rows = [pilot, *(copy.deepcopy(pilot) | c for c in changed.values())]
    for k, r in enumerate(rows):
        r["id"] = r["id"] if r["id"] == "golden_x" else f"r{k}"
    leak, claim = copy.deepcopy(pilot) | {"id": "leak"}, copy.deepcopy(pilot) | {"id": "claim"}
    leak["messages"][1]["content"]["design_context"] = {"x": [{"schema_version": "rtl_answer_v0.1"}]}
    claim["messages"][2]["content"]["limitations"] = ["passed simulation"]
    got = {}
    for r in found(spark, tmp_path, [*rows, leak, claim]).where("rule LIKE 'D-%'").collect():
        got.setdefault(r.row_id, set()).add(r.rule)
    assert "r0" not in got and got["leak"] == {"D-13"} and got["claim"] == {"D-14"}
    for k, rule in enumerate(changed, 1):
        assert rule in got["golden_x" if rule == "D-10" else f"r{k}"], rule


@pytest.mark.parametrize("n", [0, 1, 7])
def test_batches_and_ranks(spark, n):
    from siltstone.operators.split import batches, global_rank

    words = spark.createDataFrame([(f"w{k:03d}",) for k in range(n)], "k string")
    assert sorted((r.r, r.k) for r in global_rank(words, "k", "r").collect()) == [(k, f"w{k:03d}") for k in range(n)]
    d = spark.createDataFrame([(k * 3,) for k in range(n)], "k long")
    assert sorted(r.r for r in global_rank(d, "k", "r").collect()) == list(range(n))
    assert sorted(r.batch_index for r in batches(d, "k", 3, 1).collect()) == [i // 3 for i in range(max(0, n - 1))]
