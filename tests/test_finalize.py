import json

import pytest

from siltstone.plans import finalize as Z
from test_plans import promotable
from test_release import few_rules, lines, put, unique  # noqa: F401


def names(folder):
    return sorted(p.name for p in folder.iterdir())


def test_stages_resume_at_the_first_that_failed(spark, tmp_path):
    ran, broken = [], {"b"}

    def stage(name):
        def work(folder, done):
            ran.append(name)
            with open(f"{folder}/out.txt", "w") as f:
                f.write(name)
            if name in broken:
                raise Z.Stopped("not yet")
            return {"seen": sorted(done)}

        return name, work

    stages, out = [stage(n) for n in "abc"], tmp_path / "out"
    first = Z.run_stages(spark, str(out), stages, "v1")
    assert not first.ok and first.errors == ["b: not yet"] and ran == ["a", "b"] and names(out) == ["a", "summary.json"]
    broken.clear()
    second = Z.run_stages(spark, str(out), stages, "v1")
    assert second.ok and second.reused == ["a"] and ran == ["a", "b", "b", "c"] and second.done["c"] == {"seen": ["a", "b"]}
    assert (out / "c" / "out.txt").read_text() == "c" and json.loads((out / "summary.json").read_text())["ok"]
    assert Z.run_stages(spark, str(out), stages, "v1").reused == ["a", "b", "c"] and len(ran) == 4
    assert Z.run_stages(spark, str(out), stages, "v2").reused == [] and len(ran) == 7
    broken.add("a")  # of other inputs nothing may stay
    assert not Z.run_stages(spark, str(out), stages, "v3").ok and names(out) == ["summary.json"]
    broken.clear()

    def dies(folder, done):
        raise OSError("disk")

    with pytest.raises(OSError, match="disk"):
        Z.run_stages(spark, str(out), [stages[0], ("b", dies)], "v4")
    assert names(out) == ["a", "summary.json"]


def test_finalize(spark, tmp_path, few_rules):  # noqa: F811
    def ready(k, **over):
        r = promotable(k, **over)
        r["messages"][1]["content"]["artifacts"]["testbench"] = f"// bench {k}"
        return r

    golden = put(tmp_path / "golden.jsonl", [ready(k, design_family=f"g{k}") for k in range(10, 14)])
    drafts = [ready(k, review_status="draft", design_family=f"f{k}") for k in range(3)]
    selected, out = put(tmp_path / "selected.jsonl", drafts), tmp_path / "out"
    reviewed = put(tmp_path / "reviewed.jsonl", [unique(0), *drafts[1:]])  # the first is still a stub
    first = Z.finalize_batch(spark, selected, reviewed, golden, str(out), allow_source_overlap=True)
    assert not first.ok and "readiness" in first.errors[0] and names(out) == ["summary.json"]
    put(tmp_path / "reviewed.jsonl", drafts)
    done = Z.finalize_batch(spark, selected, reviewed, golden, str(out), allow_source_overlap=True)
    assert done.ok, done.errors
    assert names(out) == ["candidates", "evaluation", "promotion", "readiness", "release", "summary.json"]
    assert {r["review_status"] for r in lines(out / "promotion", "promoted")} == {"validated"}
    test = lines(out / "release", "test")
    assert done.done["evaluation"]["rows_evaluated"] == len(test) and done.done["release"]["accepted_rows"] == 7
    assert [r["id"] for r in lines(out / "candidates", "candidates")] == sorted(r["id"] for r in test)
    again = Z.finalize_batch(spark, selected, reviewed, golden, str(out), allow_source_overlap=True)
    assert again.reused == ["readiness", "promotion", "release", "candidates", "evaluation"]
    wrong = Z.finalize_batch(spark, selected, str(tmp_path / "none.jsonl"), golden, str(out))
    assert not wrong.ok and "not found" in wrong.errors[0]
