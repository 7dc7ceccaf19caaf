import json

from pyspark.sql import functions as F

from siltstone.operators import audit, construct
from siltstone.sources import jsonl
from test_dataset import CODE, row


def test_constructors(spark, tmp_path):
    ex = spark.createDataFrame([("P 1", "public_rtllm", "MIT", "fam", "rtl_bug_review", "find_correctness_bug", {"rtl_code": CODE})], "source_id string, source string, license string, design_family string, task_type string, user_goal string, artifacts map<string,string>")
    r = construct.draft_rows(ex).first()
    assert r.id == "public_rtllm_p_1" and r.task.extracted_rtl_summary.top_module == "top" and r.task.extracted_rtl_summary.reset_signals == ["rst_n"]
    assert set(r.answer.claim_levels.values()) == {"insufficient_evidence"} and len(r.answer.verification_plan) == 2
    path = tmp_path / "r.json"
    path.write_text("\n".join(map(json.dumps, [{"Instruction": "make a fifo", "Response": [CODE]}, {"Instruction": " ", "Response": [CODE, "module two; endmodule"]}, {"prompt": "x", "Response": ""}])))
    index = construct.index_rows(jsonl.scan(spark, str(path))).cache()
    got = {x.line: x for x in index.collect()}
    assert got[1].source_id == "rtlcoder_resyn27k_000001" and got[1].rough_design_family == "fifo" and got[2].detected_module_names == ["top", "two"] and "empty_instruction" in got[2].import_warnings
    good, skipped = construct.tasks(index)
    assert [x.source_id for x in good.collect()] == ["rtlcoder_resyn27k_000001_reference"] and {x.reason for x in skipped.collect()} == {"multiple_modules", "missing_rtl"}
    m = construct.merge_tasks_answers(spark.createDataFrame([("a", 1), ("b", 2)], "source_id string, t int"), spark.createDataFrame([("a", 1), ("c", 2)], "source_id string, x int"))
    assert m["rows"].count() == 1 and m["unknown"].first()[0] == "c" and m["unanswered"].first()[0] == "b"
    b = construct.teacher_batches(spark.range(12).select(F.format_string("s%02d", "id").alias("k"), "id").withColumn("n", F.col("id")), "id", 5, 1)
    assert sorted((x.batch_index, x.batch_count, x.row_count) for x in b.collect()) == [(0, 3, 5), (1, 3, 5), (2, 3, 1)]
    p = tmp_path / "p.jsonl"
    p.write_text(json.dumps(row(1)))
    q = construct.prompt_rows(jsonl.rows(jsonl.scan(spark, str(p)))).first()
    assert q.source_id == "row_1" and '"task_type":"rtl_bug_review"' in q.user_prompt and "counter wraps" not in q.user_prompt


def test_assemble(spark):
    good = row()["messages"][2]["content"] | {"source_id": "s", "evidence_used": [], "limitations": []}
    rows = [("x/a.json", json.dumps([good, good | {"source_id": "t"}])), ("repaired/b.json", json.dumps([good | {"schema_version": "rtl_answer.v0.1"}])), ("c.json", json.dumps([good, {}]))]
    answers = jsonl.payload_rows(spark.createDataFrame(rows, "file string, raw string")).cache()
    chosen, others = audit.assemble(answers)
    assert {(r.source_id, r.file) for r in chosen.collect()} == {("s", "repaired/b.json"), ("t", "x/a.json")}
    assert sorted(r.relation for r in others.collect()) == ["conflicting", "conflicting"]
