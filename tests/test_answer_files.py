import copy
import json

import pytest
from pyspark.sql import functions as F

from siltstone.operators import audit_rules as A
from siltstone.sources import answer_files, jsonl
from test_dataset import CODE


def answer(source_id="s1", **over):
    base = {
        "schema_version": "rtl_answer.v0.1", "source_id": source_id, "task_type": "rtl_bug_review",
        "issue_summary": [{"issue": "counter wraps", "severity": "low", "evidence": {"signal_names": ["q"], "code_location": {"line_range": "2"}, "reason": "q is narrow"}}],
        "time_reasoning": {}, "space_reasoning": {"hardware_resources_involved": ["counter"]}, "safe_optimization": {}, "functional_risk": ["wrap"], "verification_plan": ["lint"],
        "claim_levels": {"correctness": "suggestion_only"} | dict.fromkeys(("area", "activity", "power"), "insufficient_evidence"),
        "evidence_used": ["artifacts.rtl_code", "tool_checks"], "limitations": [A.NOT_RUN],
    }
    return copy.deepcopy(base) | over


def task(source_id="s1", **over):
    return {"source_id": source_id, "artifacts": {"rtl_code": CODE}, "tool_checks": {"lint": None}} | over


def table(spark, answers):
    rows = [(f"{k:03}.json", "json_array", 1, json.dumps(a), None) for k, a in enumerate(answers)]
    return spark.createDataFrame(rows, answer_files.ROWS)


def tasks_table(spark, tmp_path, tasks):
    path = tmp_path / "tasks.jsonl"
    path.write_text("\n".join(map(json.dumps, tasks)))
    return jsonl.rows(jsonl.scan(spark, str(path)))


def issue(**over):
    return answer()["issue_summary"][0] | over


def names(*signals):
    return {"issue_summary": [issue(evidence={"signal_names": list(signals), "code_location": {"line_range": "2"}})]}


CASES = [
    (answer(), set()),
    (answer(schema_version="rtl_answer_v0.1"), {"schema_alias"}),
    (answer(schema_version="v9"), {"schema_version"}),
    ({k: v for k, v in answer().items() if k != "limitations"}, {"missing_required_fields", "missing_tool_checks_limitation"}),
    (answer(source_id=""), {"missing_source_id"}),
    (answer(time_reasoning={"copy": {"prompt": 1, "artifacts": 2, "constraints": 3}}), {"answer_contains_task_copy"}),
    (answer(issue_summary={}), {"issue_summary_type"}),
    (answer("a_synthetic_odd", issue_summary=[], evidence_used=list(A.PREFERRED)), {"empty_candidate_issue_summary", "answer_missing_matching_task"}),
    (answer(issue_summary=["x", issue(severity="huge")]), {"issue_summary_item_type", "invalid_severity"}),
    (answer(**names("mux/output assignment", "q[3:0]", 5)), {"generic_signal_name"}),
    (answer(**names("elsewhere", "module")), {"unknown_signal_name"}),
    (answer(issue_summary=[issue(evidence={"signal_names": ["q"], "code_location": {"line_range": ""}}), issue(evidence={})]), {"missing_line_range"}),
    (answer(claim_levels=None), {"claim_levels_type"}),
    (answer(claim_levels={"correctness": "verified", "area": "tool_supported"}), {"strong_correctness_claim", "unsupported_correctness_claim_level", "unsupported_area_claim_level", "unsupported_activity_claim_level", "unsupported_power_claim_level"}),
    (answer(functional_risk=["it passed  simulation, lint clean, met timing"]), {"unsupported_simulation_wording", "unsupported_lint_wording", "unsupported_timing_wording"}),
    (answer(functional_risk=["Verified by text inspection"]), {"verified_by_text_inspection_wording"}),
    (answer(evidence_used="x"), {"evidence_used_type"}),
    (answer(evidence_used=["prompt"]), {"missing_tool_checks_evidence"}),
    (answer("b_synthetic_wrong_reset_polarity", evidence_used=["tool_checks"]), {"synthetic_evidence_incomplete", "suspicious_mutation_label_mismatch", "answer_missing_matching_task"}),
    (answer(limitations=["none"]), {"missing_tool_checks_limitation"}),
    (answer(issue_summary=[issue(issue="the candidate has a bug")]), {"bug_claim_without_candidate"}),
]


def test_every_audit_rule(spark, tmp_path):
    rows = [(i, a if a["source_id"] != "s1" else a | {"source_id": f"s{i}"}) for i, (a, _) in enumerate(CASES)]
    asked = tasks_table(spark, tmp_path, [task(f"s{i}") for i, _ in rows] + [task("s0", artifacts={}), task("lonely")])
    found = A.audit(table(spark, [a for _, a in rows]).select("file", "row_index", F.parse_json("raw").alias("item")), asked).collect()
    got = {}
    for r in found:
        got.setdefault(r.file, set()).add(r.code)
    missing = got.pop(next(f for f in got if f.endswith("tasks.jsonl")))
    assert missing == {"task_missing_matching_answer"}
    assert {r.source_id for r in found if r.code == "task_missing_matching_answer"} >= {"lonely"}
    assert got == {f"{i:03}.json": want for i, (_, want) in enumerate(CASES) if want}


def test_evidence_and_duplicates(spark, tmp_path):
    proven = task("p", tool_checks={"simulation": {"status": "pass"}, "synthesis": {"status": "pass"}, "power": True, "toggle": {"status": "not_run"}}, synthetic_bug=True)
    strong = answer("p", claim_levels={"correctness": "verified", "area": "tool_supported", "activity": "tool_supported", "power": "verified"}, functional_risk=["passed simulation"], evidence_used=list(A.PREFERRED))
    found = A.audit(table(spark, [strong, answer("p", evidence_used=list(A.PREFERRED)), answer("q")]).select("file", "row_index", F.parse_json("raw").alias("item")), tasks_table(spark, tmp_path, [proven])).collect()
    got = {(r.file, r.code) for r in found}
    assert got == {("000.json", "unsupported_activity_claim_level"), ("001.json", "duplicate_source_id"), ("002.json", "answer_missing_matching_task")}
    bare = A.audit(table(spark, [answer("q"), answer("q")]).select("file", "row_index", F.parse_json("raw").alias("item"))).collect()
    assert [(r.file, r.code) for r in bare] == [("001.json", "duplicate_source_id")]


def test_repairs_in_order_with_their_log(spark, tmp_path):
    broken = answer(
        "r_synthetic_wrong_reset_polarity", schema_version="rtl_answer_v0.1", functional_risk=["wrap", "wrap", {"a": 1}, {"a": 1}, "Verified  by text inspection of reset"], evidence_used=["prompt", "prompt", 3],
        limitations=["small", "small"], claim_levels={"correctness": "verified", "area": "verified", "note": "x"}, space_reasoning=None,
        issue_summary=[issue(), issue(evidence={"signal_names": ["reset branch", "q", "q", "a b"]}), "odd"],
    )
    done = A.repair(table(spark, [broken, answer(), {"x": 1}]), tasks_table(spark, tmp_path, [task("r_synthetic_wrong_reset_polarity")])).orderBy("file").collect()
    first = json.loads(done[0].raw)
    assert [(c.field, c.reason) for c in done[0].changes] == [
        ("schema_version", "schema alias"), ("answer.functional_risk[]", "wording that claims verification by reading"), ("evidence_used", "repeated evidence_used"), ("functional_risk", "repeated functional_risk"),
        ("limitations", "repeated limitations"), ("evidence_used", "evidence of synthetic and unchecked answers"), ("limitations", "no tool check was run"), ("claim_levels", "claim levels above the evidence"),
        ("issue_summary[1].evidence.signal_names", "labels among the signal names"), ("space_reasoning.hardware_resources_involved", "labels kept as hardware"),
    ]
    assert first["functional_risk"] == ["wrap", {"a": 1}, "reviewed by text inspection of reset"] and first["limitations"] == ["small", A.NOT_RUN]
    assert first["evidence_used"] == ["artifacts.before_rtl_code", "artifacts.rtl_code", "mutation_summary", "mutated_signal_names", "tool_checks", "prompt", "3"]
    assert first["claim_levels"] == {"correctness": "suggestion_only", "area": "insufficient_evidence", "note": "x", "activity": "insufficient_evidence", "power": "insufficient_evidence"}
    assert first["issue_summary"][1]["evidence"]["signal_names"] == ["q"] and first["space_reasoning"] == {"hardware_resources_involved": ["reset branch", "a b"]}
    assert done[0].changes[0].old == '"rtl_answer_v0.1"' and done[0].changes[0].new == '"rtl_answer.v0.1"'
    assert done[1].raw == done[1].before and not done[1].changes
    assert json.loads(done[2].raw)["limitations"] == [A.NOT_RUN] and done[2].changes[0].old is not None or done[2].changes[0].field == "limitations"
    again = A.repair(spark.createDataFrame([(r.file, r.kind, r.row_index, r.raw, r.rest) for r in done], answer_files.ROWS)).collect()
    second = {r.file: [c.field for c in r.changes] for r in again}
    assert second["000.json"] == ["evidence_used"] or not second["000.json"]  # the limitation it got asks for nothing more
    log = A.change_rows(A.repair(table(spark, [broken]))).collect()
    assert {r.source_id for r in log} == {broken["source_id"]} and [r.place for r in log] == list(range(len(log)))


def test_a_second_repair_changes_nothing(spark, tmp_path):
    asked = tasks_table(spark, tmp_path, [task(f"s{i}") for i in range(len(CASES))])
    rows = table(spark, [a | {"source_id": a["source_id"] if a["source_id"] != "s1" else f"s{i}"} for i, (a, _) in enumerate(CASES)])
    once = A.repair(rows, asked).select("file", "kind", "row_index", "raw", "rest").collect()
    twice = A.repair(spark.createDataFrame(once, answer_files.ROWS), asked).collect()
    assert {r.file: [c.asDict() for c in r.changes] for r in twice if r.changes and r.file != "018.json"} == {}
    assert all(r.raw == r.before for r in twice if r.file != "018.json")


FILES = {
    "in/a_rtl_answer_v0_1.json": json.dumps({"by": "x", "answers": [answer("a1"), answer("a2")], "n": 2}), "in/deep/b_rtl_answer_v0_1.json": json.dumps([answer("b1"), 7]),
    "in/c_rtl_answer_v0_1.json": json.dumps(answer("c1")), "in/d_rtl_answer_v0_1.jsonl": "\n".join(json.dumps(answer(f"d{k}")) for k in range(3)) + "\n",
    "in/e_rtl_answer_v0_1.json": "\n".join(json.dumps(answer(f"e{k}")) for k in range(2)), "in/f_rtl_answer_v0_1_report.json": "{}", "in/g_rtl_answer_v0_1.json": '{"messages": [{"role": "assistant"}]}',
    "in/h_rtl_answer_v0_1.json": '{"other": 1}', "in/i_rtl_answer_v0_1.jsonl": json.dumps(answer("i")) + '\n{"x": 1}\n', "in/k_rtl_answer_v0_1.json": "{oops", "in/unrelated.json": "{}",
}


@pytest.fixture()
def folder(tmp_path):
    for name, data in FILES.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(data)
    return tmp_path


def short(path):
    return path.rsplit("/", 1)[-1][0]


def test_containers_round_trip(spark, folder):
    paths = answer_files.found(spark, [str(folder / "in"), str(folder / "none.json")])
    assert sorted(map(short, paths)) == list("abcdeghikn")
    rows, problems = answer_files.read(spark, paths)
    got = {}
    for r in rows.orderBy("file", "row_index").collect():
        got.setdefault((short(r.file), r.kind), []).append((r.row_index, json.loads(r.raw)["source_id"]))
    assert got == {
        ("a", "json_wrapper"): [(1, "a1"), (2, "a2")], ("b", "json_array"): [(1, "b1")], ("c", "json_single"): [(1, "c1")], ("d", "jsonl"): [(1, "d0"), (2, "d1"), (3, "d2")],
        ("e", "jsonl"): [(1, "e0"), (2, "e1")], ("i", "jsonl"): [(1, "i")],
    }
    assert {(short(r.file), r.problem.split(":")[-1].strip()) for r in problems.collect()} == {
        ("b", "answer 2 must be a JSON object"), ("h", "no standalone answers"), ("i", "answers mixed with other rows"), ("k", "malformed JSON"), ("n", "file not found"),
    }
    named = rows.withColumn("file", F.regexp_extract("file", "/in/(.*)$", 1))
    out = folder / "out"
    answer_files.write(named, str(out))
    assert json.loads((out / "a_rtl_answer_v0_1.json").read_text()) == json.loads(FILES["in/a_rtl_answer_v0_1.json"])
    assert json.loads((out / "deep/b_rtl_answer_v0_1.json").read_text()) == [answer("b1")] and json.loads((out / "c_rtl_answer_v0_1.json").read_text()) == answer("c1")
    assert [json.loads(x)["source_id"] for x in (out / "d_rtl_answer_v0_1.jsonl").read_text().splitlines()] == ["d0", "d1", "d2"]
    assert list(json.loads((out / "c_rtl_answer_v0_1.json").read_text())) == list(answer()) and not [p for p in out.iterdir() if p.name.startswith(".")]


def test_an_aborted_write_leaves_nothing(spark, tmp_path):
    rows = table(spark, [answer(f"s{k}") for k in range(6)])
    bad = rows.withColumn("raw", F.when(F.col("file") == "004.json", F.lit("{oops")).otherwise(F.col("raw")))
    with pytest.raises(Exception, match="(?i)job aborted|json|failed"):
        answer_files.write(bad, str(tmp_path / "out"))
    assert not (tmp_path / "out").exists() or not list((tmp_path / "out").iterdir())
    answer_files.write(rows, str(tmp_path / "out"))
    assert len(list((tmp_path / "out").iterdir())) == 6
