import json

import pytest
from pyspark.sql import functions as F

from siltstone.operators import review, workspace
from siltstone.plans import evaluate
from siltstone.sources import adapters, jsonl
from test_dataset import edit, row


def scan(spark, tmp_path, rows, name="in.jsonl"):
    path = tmp_path / name
    path.write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in rows))
    return jsonl.scan(spark, str(path))


def test_manifest(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub/a b+%.v").write_text("module a; endmodule")
    (tmp_path / "bad.v").write_bytes(b"\xff\xfe")
    (tmp_path / "big.v").write_text("x" * 200)
    base = {"id": "x", "source": "public_rtllm", "license": "MIT", "design_family": "f", "task_type": "rtl_bug_review", "user_goal": "find_correctness_bug", "provenance": {"origin": "o"}}
    good = {"rtl_code_path": "sub/./x/../a b+%.v", "testbench_path": None}
    rows = [
        base | {"id": "1", "artifacts": good}, base | {"id": "2", "artifacts": {"rtl_code_path": "../x.v", "testbench_path": "none.v"}}, base | {"id": "3", "license": " ", "artifacts": good},
        base | {"id": "4", "artifacts": {"rtl_code_path": "/etc/passwd"}}, "{oops", base | {"id": "5", "artifacts": good | {"lint_log_path": "bad.v"}}, base | {"id": "6", "artifacts": {}},
        base | {"id": "7", "artifacts": {"rtl_code_path": "big.v", "testbench_path": "sub"}}, base | {"id": "8", "source": "x", "artifacts": good}, base | {"id": "9", "artifacts": {"rtl_code_path": 5}},
        {"id": "10", "artifacts": good}, base | {"id": "11", "artifacts": good}, base | {"id": "12", "artifacts": {}},
    ]
    (tmp_path / "manifest.jsonl").write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in rows))
    found, rejected = adapters.manifest(spark, str(tmp_path), most=100)
    assert sorted((r.source_id, r.artifacts) for r in found.collect()) == [("1", {"rtl_code": "module a; endmodule"}), ("11", {"rtl_code": "module a; endmodule"})]
    got = {r.source_id: r.errors for r in rejected.collect()}
    assert got == {
        "2": ["rtl_code: path leaves the root", "testbench: file not found"], "3": ["blank license"], "4": ["rtl_code: absolute path"], None: ["malformed JSON"], "5": ["lint_log: not UTF-8"], "6": ["no artifacts"],
        "7": ["rtl_code: file too large", "testbench: file not found"], "8": ["invalid source"], "9": ["rtl_code: artifact path must be a non-empty string or null"],
        "10": ["missing design_family, license, provenance, source, task_type, user_goal"], "12": ["no artifacts"],
    }
    found, rejected = adapters.adapter("rtllm")(spark, str(tmp_path))
    assert found.count() == 2
    few, before = adapters.manifest(spark, str(tmp_path / "manifest.jsonl"), limit=1, license="BSD")
    assert [(r.source_id, r.license) for r in few.collect()] == [("1", "BSD")] and before.count() == 0
    none, why = adapters.adapter("rtlfixer")(spark, str(tmp_path / "sub"))
    assert none.count() == 0 and why.first().errors[0].startswith("layout not recognized")


def test_export_and_directory(spark, tmp_path):
    path = tmp_path / "e.jsonl"
    path.write_text("\n".join(map(json.dumps, [{"task_id": "a", "prompt": "p", "solution": "module m; endmodule"}, {"problem_id": "b", "spec": " ", "rtl": "x"}])))
    found, rejected = adapters.export(spark, str(path))
    assert [r.source_id for r in found.collect()] == ["a"] and rejected.first().errors == ["missing prompt", "no module"]
    d = tmp_path / "d"
    d.mkdir()
    for n in ("P1_prompt.txt", "P1_ref.sv", "P1_test.sv", "P2_prompt.txt", "other.txt"):
        (d / n).write_text(n)
    found, rejected = adapters.directory(spark, str(d))
    assert found.first().testbench == "P1_test.sv" and [tuple(r) for r in rejected.collect()] == [("P2", ["missing rtl"])]
    with pytest.raises(ValueError):
        adapters.adapter("none")


def promotable(k=1, **over):
    """A row of a public source that may be promoted."""
    r = edit(("messages", 2, "content", "claim_levels", "area"), "suggestion_only", k=k) | over
    answer = r["messages"][2]["content"]
    answer["safe_optimization"]["patch_style"] = "minimal"
    answer["time_reasoning"] |= {"clock_cycle_behavior": "adds one each cycle"}
    answer["space_reasoning"] |= {"area_risk": "no synthesis evidence", "activity_risk": "toggle data unavailable"}
    answer["verification_plan"] = ["Lint", "simulate"]
    return r


def changed(path, value, k=1):
    r = promotable(k)
    at = r["messages"][2]["content"]
    for p in path[:-1]:
        at = at[p]
    at[path[-1]] = value
    return r


def test_promotion(spark, tmp_path):
    cases = [
        (promotable(1, license="TODO"), ["license uncertain"], "license gate"), (promotable(1), None, None), (promotable(1), ["duplicate"], "duplicate id"), (row(2), None, "stub answer"),
        (promotable(3, source="handwritten_golden"), ["source"], "public source gate"), (promotable(4, provenance={"public_dataset_name": " "}), ["provenance.public_dataset_name", "provenance.notes"], "provenance gate"),
        (promotable(5, review_status="rejected"), ["rejected"], "promotion gate failed"), (promotable(6, id=""), ["id"], "promotion gate failed"), (changed(("safe_optimization", "patch_style"), "explanation_only", 7), ["stub"], "stub answer"),
        (changed(("functional_risk",), ["No optimization effect is claimed"], 8), ["stub"], "stub answer"), (changed(("issue_summary",), [], 9), ["issue_summary"], "promotion gate failed"),
        (changed(("issue_summary", 0, "evidence"), {"signal_names": [" "], "reason": ""}, 10), ["issue_summary[0].reason", "issue_summary[0].signal_names"], "promotion gate failed"),
        (changed(("time_reasoning", "clock_cycle_behavior"), "It must be reviewed against the task intent.", 11), ["clock_cycle_behavior"], "promotion gate failed"),
        (changed(("space_reasoning",), {"area_risk": "none", "activity_risk": None}, 12), ["area_risk", "activity_risk"], "promotion gate failed"), (changed(("verification_plan",), ["look"], 13), ["verification_plan"], "promotion gate failed"),
        (promotable(14) | {"messages": []}, ["answer"], "promotion gate failed"), (promotable(15, created_by=""), ["V-09 created_by"], "promotion gate failed"),
    ]
    good, bad = review.promote(jsonl.rows(scan(spark, tmp_path, [r for r, _, _ in cases])))
    kept = good.collect()
    assert [(r.line, json.loads(r.raw)["review_status"]) for r in kept] == [(2, "validated")]
    got = {r.line: (r.problems, r.reason) for r in bad.collect()}
    assert sorted(got) == [k for k, (_, _, why) in enumerate(cases, 1) if why]
    for k, (_, problems, why) in enumerate(cases, 1):
        if why:
            assert got[k][1] == why and (problems is None or got[k][0] == problems), (k, got[k])
    with pytest.raises(ValueError):
        review.promote(jsonl.rows(scan(spark, tmp_path, [row(1)])), target="draft")


def test_readiness_and_triage(spark, tmp_path):
    a = scan(spark, tmp_path, [row(1), row(2)], "a.jsonl")
    b = scan(spark, tmp_path, [edit(("messages", 2, "content", "claim_levels", "area"), "verified", k=2), row(3)], "b.jsonl")
    ids, risks = review.readiness(a, b)
    assert {r.id: r.status for r in ids.collect()} == {"row_1": "missing", "row_2": "matched", "row_3": "extra"}
    assert [(r.id, r.rule) for r in risks.collect()] == [("row_2", "verified")]
    t = review.triage(scan(spark, tmp_path, [edit(("messages", 2, "content", "functional_risk"), ["TODO, guaranteed"])], "c.jsonl")).collect()
    assert [(r.severity, r.code) for r in t] == [("important", "placeholder"), ("important", "strong_claim"), ("minor", "no_testbench")]


def test_evaluate_and_compare(spark, tmp_path):
    s = scan(spark, tmp_path, [{"id": "a", "answer": {}}, {"id": "a", "answer": {}}, {"id": "", "answer": {}}, {"id": "b", "answer": []}, {"id": "z", "answer": {}}])
    good, bad = evaluate.load_candidates(s)
    assert sorted(r.id for r in good.collect()) == ["a", "z"] and sorted(r.line for r in bad.collect()) == [2, 3, 4]
    data = spark.createDataFrame([("a", json.dumps(row(1))), ("c", json.dumps(row(2)))], "id string, r string").select("id", F.parse_json("r").alias("v"))
    out = evaluate.evaluate(data, good)
    assert [r.id for r in out["missing"].collect()] == ["c"] and [r.id for r in out["extra"].collect()] == ["z"] and out["metrics"].first().n == 1
    runs = spark.createDataFrame([("x", "1", 0.5, 0), ("y", "1", 0.9, 1), ("x", "2", 0.1, 0)], "run string, id string, score double, failures int")
    c = evaluate.compare_runs(runs)
    assert [tuple(r) for r in c["missing"].collect()] == [("y", "2")] and [(r.id, round(r.spread, 6)) for r in c["spread"].collect()] == [("1", 0.4)]
    assert {tuple(r) for r in c["pairs"].collect()} == {("x", "x", 2), ("x", "y", 1), ("y", "x", 1), ("y", "y", 1)}
    assert [r.run for r in evaluate.leaderboard(runs).collect()] == ["y", "x"]


def test_inventory(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw/a.jsonl").write_text('{"id": "1"}\n\n{"id": "2"}')
    (tmp_path / "answers.jsonl").write_text('{"source_id": "1", "schema_version": "rtl_answer_v0.1"}')
    (tmp_path / "copy.jsonl").write_text('{"source_id": "1", "schema_version": "rtl_answer_v0.1"}')
    (tmp_path / "t.json").write_text('{"rows": [{"source_id": "rtlcoder_1", "schema_version": "rtl_task_v0.1"}, 3]}')
    f = workspace.inventory(spark, str(tmp_path)).cache()
    got = {r.path: (r.role, r.container, r.n_rows, r.n_bad, r.dataset) for r in f.collect()}
    assert got["raw/a.jsonl"] == ("raw_source", "jsonl", 2, 0, "unknown") and got["answers.jsonl"][0] == "assembled_answer_jsonl"
    assert got["t.json"] == ("normalized_task", "rows_wrapper", 1, 1, "rtlcoder")
    assert workspace.duplicates(f).count() == 1 and [tuple(r) for r in workspace.shared_ids(f).collect()] == [("1", 3)]
    assert [tuple(r) for r in workspace.safe_to_archive(f).collect()] == [("copy.jsonl", "answers.jsonl")]
    moves = {r.path: r.new_path for r in workspace.cleanup_plan(f).collect()}
    assert moves == {"answers.jsonl": "answers/assembled/answers.jsonl", "copy.jsonl": "answers/assembled/copy.jsonl", "t.json": "normalized/tasks/t.json", "raw/a.jsonl": "raw/internal/a.jsonl"}


def test_run_files(spark, tmp_path):
    (tmp_path / "good.json").write_text(json.dumps(dict.fromkeys(evaluate.METRICS, 1)))
    (tmp_path / "part.json").write_text(json.dumps(dict.fromkeys(evaluate.METRICS[2:], 1)))
    (tmp_path / "list.json").write_text("[1]")
    (tmp_path / "bad.json").write_text("{} x")
    found, wrong = evaluate.load_objects(spark, [str(tmp_path / f"{n}.json") for n in ("good", "part", "list", "bad", "none")], evaluate.METRICS)
    assert sorted(r.file.rsplit("/", 1)[-1] for r in found.collect()) == ["good.json", "part.json"]
    got = sorted((r.file.rsplit("/", 1)[-1], r.problem) for r in wrong.collect())
    assert got == [("bad.json", "malformed JSON"), ("list.json", "not a JSON object"), ("none.json", "file not found"), ("part.json", "missing matched_rows"), ("part.json", "missing mean_score")]
    rows, bad = evaluate.load_results(scan(spark, tmp_path, [{"id": "a", "score": 1, "errors": [1, 2]}, {"id": "", "score": 1}, {"id": "b", "score": "x"}, {"id": "c", "score": 0.5, "safety_failures": ["s"]}, "{"]))
    assert sorted((r.id, r.score, r.errors, r.failures) for r in rows.collect()) == [("a", 1.0, 2, 0), ("c", 0.5, 0, 1)]
    assert sorted((r.line, r.problem) for r in bad.collect()) == [(2, "id must be a non-empty string"), (3, "score must be numeric"), (5, "malformed JSON")]
