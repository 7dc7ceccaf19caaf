import json

import pytest

from siltstone import cli
from siltstone.plans import config
from test_dataset import row


def write(path, rows):
    path.write_text("\n".join(map(json.dumps, rows)))
    return str(path)


def run(spark, capsys, *argv):
    code = cli.main(list(argv), spark)
    return code, json.loads(capsys.readouterr().out.strip().splitlines()[-1])["rows"]


def test_commands_over_dataset_rows(spark, tmp_path, capsys):
    data = write(tmp_path / "d.jsonl", [row(1), row(2)])
    answer = row(1)["messages"][2]["content"] | {"source_id": "s", "evidence_used": [], "limitations": []}
    given = write(tmp_path / "c.jsonl", [{"id": "row_1", "answer": answer}])
    other = write(tmp_path / "o.jsonl", [{"id": "row_1", "answer": answer | {"limitations": ["x"]}}])
    code, n = run(spark, capsys, "inspect", "--input", data, "--output", str(tmp_path / "out"))
    assert code == 0 and n["counts"] == 6 and n["claim_levels"] == 4 and n["duplicate_ids"] == 0 and (tmp_path / "out/counts").is_dir()
    code, n = run(spark, capsys, "evaluate", "--dataset", data, "--candidates", given, "--strict")
    assert code == 1 and n["results"] == 1 and n["missing"] == 1 and n["extra"] == 0
    code, n = run(spark, capsys, "differences", "--dataset", data, "--a", given, "--b", other)
    assert code == 0 and n["differences"] == 1 and n["missing_in_a"] == 1
    code, n = run(spark, capsys, "review-packet", "--input", data)
    assert code == 0 and n["packets"] == 2
    code, n = run(spark, capsys, "prompts", "--dataset", data)
    assert n["prompts"] == 2
    code, n = run(spark, capsys, "baseline", "--dataset", data)
    assert n["candidates"] == 2


def test_commands_over_tasks_and_answers(spark, tmp_path, capsys):
    task = row()["messages"][1]["content"]
    tasks = write(tmp_path / "t.jsonl", [task | {"source_id": "a"}, task | {"source_id": "b"}])
    answer = row(1)["messages"][2]["content"] | {"evidence_used": [], "limitations": []}
    good, bad = [answer | {"source_id": k} for k in "ab"], [answer | {"source_id": "a", "limitations": ["lint passed"]}, answer | {"source_id": "z"}]
    (tmp_path / "g.json").write_text(json.dumps({"answers": good}))
    (tmp_path / "b.json").write_text(json.dumps(bad))
    assert run(spark, capsys, "teacher-validate", "--tasks", tasks, "--answers", str(tmp_path / "g.json")) == (0, {"issues": 0})
    code, n = run(spark, capsys, "teacher-validate", "--tasks", tasks, "--answers", str(tmp_path / "b.json"))
    assert code == 1 and n["issues"] == 2
    assert run(spark, capsys, "teacher-merge", "--tasks", tasks, "--answers", str(tmp_path / "g.json")) == (0, {"rows": 2, "issues": 0})
    assert run(spark, capsys, "teacher-merge", "--tasks", tasks, "--answers", str(tmp_path / "b.json"))[1] == {"rows": 0, "issues": 2}
    code, n = run(spark, capsys, "distill", "--tasks", tasks, "--answers", str(tmp_path / "g.json"), "--sizes", "1,1,0")
    assert code == 0 and n["rows"] == 2 and n["checks"] == 1
    code, n = run(spark, capsys, "teacher-export", "--input", tasks, "--size", "1")
    assert n["batches"] == 2
    code, n = run(spark, capsys, "assemble", "--input", str(tmp_path / "g.json"), str(tmp_path / "b.json"), "--tasks", tasks)
    assert code == 0 and n == {"rows": 2, "others": 1, "missing": 0, "extra": 1}
    code, n = run(spark, capsys, "mutate", "--input", tasks, "--per-row", "9")
    assert n["variants"] >= 2


def test_normalised_rows(spark, tmp_path):
    from pyspark.sql import functions as F

    from siltstone.operators import normalize

    code = "module TopModule (input a, output reg q, input reset);\nendmodule"
    prompt = "Write a module named TopModule.\n - input a\n - output q\n - input reset\n"
    kept = {"source_dataset": "s", "license": "MIT", "design_family": "f", "task_type": "rtl_bug_review", "user_goal": "g", "provenance": {"o": 1}, "tool_checks": dict.fromkeys(("parse", "lint", "simulation", "equivalence", "synthesis", "toggle", "power"))}
    raw = kept | {"source_id": "p", "raw_prompt": prompt, "raw_reference_rtl": code}
    summary = {k: [] for k in ("clock_signals", "registered_signals", "combinational_blocks", "suspected_fsm_signals", "suspected_counters", "unused_enable_signals", "activity_hotspots")} | {"top_module": "TopModule", "reset_signals": ["reset"]}
    context = {"target_domain": "digital_rtl_public_benchmark", "priority": ["x"], "timing_policy": "timing_is_constraint_not_reward", "source_rtl_role": "reference_rtl", "target_module_name": "TopModule", "rtl_module_name": "TopModule", "interface_ports_from_prompt": ["input a", "output q", "input reset"]}
    from siltstone import vocab as V

    good = kept | {"source_id": "p", "schema_version": "rtl_task_v0.1", "domain": "digital_rtl", "prompt": prompt, "artifacts": {"rtl_code": code}, "design_context": context, "extracted_rtl_summary": summary, "required_output": list(V.REQUIRED_OUTPUT)}
    bad = good | {"license": "x", "artifacts": {"rtl_code": code + " ", "lint_log": "x"}, "patch": {}, "extracted_rtl_summary": summary | {"reset_signals": []}}
    frame = lambda rows: spark.createDataFrame([(k, json.dumps(r)) for k, r in enumerate(rows)], "row_index int, j string").select("row_index", F.parse_json("j").alias("item"))
    assert normalize.validate(frame([raw]), frame([good])).collect() == []
    got = {(r.rule, r.field) for r in normalize.validate(frame([raw]), frame([bad, good, raw | {"source_id": "q"}])).collect()}
    assert {("changed", "license"), ("changed", "artifacts.rtl_code"), ("invented", "artifacts.lint_log"), ("answer_field", "patch"), ("summary", "reset_signals"), ("row_duplicate", "source_id"), ("unknown_id", "source_id")} == got


def test_config():
    assert config.is_safe_name("a b-1.x") and not any(map(config.is_safe_name, ("", "CON", "x.", "a/b", "x" * 81, None)))
    suite = {"defaults": {"temperature": 0.5, "y": 1}, "models": [{"name": "a", "model": "m"}, {"name": "A", "model": "m", "x": 1}, {"name": "b", "model": " ", "retries": "2"}, 3, {"name": "a", "model": "n"}, {"name": "c", "model": "m", "retries": True, "top_p": None}]}
    models, problems = config.effective_models(suite)
    assert [m["name"] for m in models] == ["a", "A", "c"] and models[0]["temperature"] == 0.5 and models[0]["max_tokens"] == 8192 and models[0]["retries"] == 1
    assert problems == ["defaults.y is unknown", "models[1].x is unknown", "models[2] names no model", "models[3] is no object", "models[4] repeats a name", "models[5].retries has the wrong type"]
    assert config.effective_models({"models": {}})[1] == ["models must be an array"]
    base = {"mean_score": 0.9}
    tuned = {"candidate_rows": 100, "matched_rows": 100, "missing_candidates": 0, "extra_candidates": 0, "safety_failures": 0, "mean_score": 1.0}
    rows = [{"mentions_mutation_type": {"t": True}, "mentions_mutated_signal_names": {"t": True}}] * 100
    diff = {"name_a": "b", "name_b": "t", "duplicate_analysis": {"b": {"near_duplicate_pairs": [1]}, "t": {}}, "row_differences": rows}
    got = config.acceptance(tuned, base, diff, {"parse_error_rows": 0, "api_error_rows": 0})
    assert got["accepted"] and got["deltas"] == {"mean_score": 0.1, "near_duplicate_pairs": -1}
    assert not config.acceptance(tuned | {"mean_score": None}, base, diff, {"parse_error_rows": 0, "api_error_rows": 0})["accepted"]
