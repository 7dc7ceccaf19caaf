import copy
import json

import pytest

from siltstone.operators import synthesize as S
from siltstone.sources import jsonl

COUNTER = "module {0} (input clk, input rst_n, output reg [3:0] q_cnt);\n always @(posedge clk) if (!rst_n) q_cnt <= 0; else if (q_cnt < 9) q_cnt <= q_cnt + 1;\nendmodule"


def task(k, **over):
    base = {"schema_version": "rtl_task_v0.1", "source_id": f"t{k}", "artifacts": {"rtl_code": COUNTER.format(f"m{k}"), "lint_log": None}, "tool_checks": {"lint": {"status": "pass"}}, "design_context": {"x": 1}, "notes": "given", "assumptions": ["one"]}
    return copy.deepcopy(base) | over


BAD = [
    (task(1, source_id=""), ["missing_source_id"]), (task(2, schema_version="rtl_task.v0.1"), ["schema_version_mismatch"]), (task(3, artifacts={"rtl_code": " \n"}), ["missing_reference_rtl", "requires_single_reference_module"]),
    (task(4, artifacts=[]), ["missing_reference_rtl", "requires_single_reference_module"]), (task(5, artifacts={"rtl_code": "module a; endmodule\nmodule b; endmodule"}), ["requires_single_reference_module"]),
    (task(6, artifacts={"rtl_code": COUNTER.format("m"), "before_rtl_code": "x"}, design_context={"prompt_embedded_candidate_rtl": True}), ["candidate_rtl_already_present", "candidate_rtl_already_present"]),
    (task(7, source_rtl_role="other"), ["source_rtl_role_must_be_reference_rtl"]), (task(8, artifacts={"rtl_code": "module only; endmodule"}), ["no_safe_mutation_pattern"]),
]


def scanned(spark, tmp_path, rows):
    path = tmp_path / "tasks.jsonl"
    path.write_text("\n".join(map(json.dumps, rows)))
    return jsonl.scan(spark, str(path))


def test_reasons_and_rows(spark, tmp_path):
    rows = [task(0)] + [t for t, _ in BAD] + [task(9, tool_checks=None, design_context=None, notes=None, source_rtl_role="reference_rtl")]
    got = S.synthesize(scanned(spark, tmp_path, rows), per_row=99)
    skipped = {r.line: (r.source_id, r.reasons) for r in got.skipped.collect()}
    assert skipped == {k + 2: (t["source_id"] or f"line_{k + 2}", why) for k, (t, why) in enumerate(BAD)}
    made = [json.loads(r.raw) for r in got.emitted.orderBy("rank", "k").collect()]
    assert got.processed == 10 and got.emitted_rows == len(made) and got.shortfall == 0 and {r["source_variant_of"] for r in made} == {"t0", "t9"}
    first = {r["bug_type"]: r for r in made if r["source_variant_of"] == "t0"}
    limit = first["off_by_one_counter_limit"]
    assert limit["artifacts"]["before_rtl_code"] == COUNTER.format("m0").replace("q_cnt <= 0", "q_cnt < 0") and limit["artifacts"]["rtl_code"] == COUNTER.format("m0")
    assert limit["mutation_summary"] == "Changed counter limit comparison for q_cnt from '<=' to '<'." and limit["mutated_signal_names"] == ["q_cnt"]
    reset = first["wrong_reset_polarity"]
    assert reset["mutation_summary"] == "Changed reset polarity check from 'if (!rst_n)' to 'if (rst_n)'." and "if (rst_n)" in reset["artifacts"]["before_rtl_code"]
    assert limit["source_id"] == "t0_synthetic_off_by_one_counter_limit" and limit["tool_checks"] == {"lint": None} and limit["design_context"] == {"x": 1, "source_rtl_role": "reference_rtl", "prompt_embedded_candidate_rtl": True}
    assert limit["notes"] == ["given", S.NOTE.format("off_by_one_counter_limit")] and limit["assumptions"] == ["one", S.ASSUMPTION] and limit["promotion_allowed"] is False
    last = next(r for r in made if r["source_variant_of"] == "t9")
    assert last["tool_checks"] == {} and last["notes"] == [S.NOTE.format(last["bug_type"])] and last["design_context"] is None
    assert {r.reason: r["count"] for r in got.reasons().collect()}["requires_single_reference_module"] == 3


def plain(rows, per_row, target, max_rows, all_edits):
    """The loop over the rows, one by one."""
    emitted, processed = [], 0
    for k, t in enumerate(rows[:max_rows]):
        if target is not None and len(emitted) >= target:
            break
        processed += 1
        for bug in all_edits.get(k, [])[:per_row]:
            if target is None or len(emitted) < target:
                emitted.append((k, bug))
    return emitted, processed


@pytest.mark.parametrize("parts", [1, 7])
def test_stops_where_the_target_is_met(spark, tmp_path, monkeypatch, parts):
    monkeypatch.setattr(S, "BLOCK", 10)
    rows = [task(k) if k % 3 else BAD[k % len(BAD)][0] for k in range(60)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        found = scanned(spark, tmp_path, rows)
        every = {}
        for r in S.synthesize(found, per_row=3).emitted.orderBy("rank", "k").collect():
            every.setdefault(r["rank"], []).append(r.bug_type)
        for per_row, target, max_rows in ((3, 1, None), (2, 11, None), (3, 500, None), (1, 9, 12)):
            got = S.synthesize(found, per_row, target, max_rows)
            want, processed = plain(rows, per_row, target, max_rows, every)
            assert [(r["rank"], r.bug_type) for r in got.emitted.orderBy("rank", "k").collect()] == want
            assert (got.processed, got.emitted_rows, got.shortfall) == (processed, len(want), max(target - len(want), 0))
            assert all(r["rank"] < processed for r in got.skipped.collect())
        assert S.synthesize(found, 3, 1).ranges <= 2 < len(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    with pytest.raises(ValueError):
        S.synthesize(found, target=0)
