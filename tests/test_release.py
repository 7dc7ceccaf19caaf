import json
import random

import pytest
from pyspark.sql import functions as F

from siltstone.operators import duplicates, keys, split
from siltstone.plans import release
from siltstone.plans.release import SPLITS, build_release, split_dataset
from test_dataset import edit, row


@pytest.fixture()
def few_rules(monkeypatch):
    """The row rules alone: the whole catalogue takes long to compile, and one test runs it."""
    from siltstone.operators import dataset_rules

    for name in ("task_rules", "distill_rules"):
        monkeypatch.setattr(dataset_rules, name, list)
    kept = [r for r in dataset_rules.answer_rules() if r.rule == "A-13"]
    monkeypatch.setattr(dataset_rules, "answer_rules", lambda: kept)
    monkeypatch.setattr(dataset_rules, "said", lambda: F.array().cast("array<string>"))


def put(path, rows):
    path.write_text("\n".join(r if isinstance(r, str) else json.dumps(r, ensure_ascii=False) for r in rows), encoding="utf-8")
    return str(path)


def lines(folder, name):
    return [json.loads(x) for x in (folder / f"{name}.jsonl").read_text().splitlines()]


def unique(k, **over):
    """A row whose artifacts no other row has."""
    r = row(k, **over)
    r["messages"][1]["content"]["artifacts"]["testbench"] = f"// bench {k}"
    return r


def expected_split(rows, ratios, seed):
    """Families in order of first appearance, shuffled, by size, where most is missing."""
    groups = {}
    for r in rows:
        groups.setdefault(r["design_family"], []).append(r)
    order = list(groups)
    random.Random(seed).shuffle(order)
    order.sort(key=lambda f: -len(groups[f]))
    out = [[], [], []]
    for f in order:
        k = max(range(3), key=lambda i: (len(rows) * ratios[i] - len(out[i]), ratios[i], -i))
        out[k] += [r["id"] for r in groups[f]]
    return out


def test_layout_order_and_repeatability(spark, tmp_path, few_rules):
    rows = [unique(k, design_family=f"fam{(k * 7) % 6}") for k in range(20)]
    rows[3]["note"] = "größer ≥"
    a, b = put(tmp_path / "a.jsonl", rows[:12]), put(tmp_path / "b.jsonl", rows[12:])
    got = [build_release(spark, [a, b], str(tmp_path / f"o{k}"), seed=5, allow_source_overlap=True) for k in (1, 2)]
    assert got[0].ok and got[0] == got[1] and got[0].accepted_rows == 20 and got[0].rejected_rows == 0
    assert all("source overlap allowed for public_rtllm" in w for w in got[0].warnings) and got[0].warnings
    out = tmp_path / "o1"
    for s in SPLITS:
        assert (out / f"{s}.jsonl").read_bytes() == (tmp_path / "o2" / f"{s}.jsonl").read_bytes()
    assert [[r["id"] for r in lines(out, s)] for s in SPLITS] == expected_split(rows, (0.7, 0.15, 0.15), 5)
    assert {r["split"] for r in lines(out, "train")} == {"train"}
    assert [r["id"] for r in lines(out, "all_accepted.unsplit")] == [r["id"] for r in rows]
    raw = (out / "all_accepted.unsplit.jsonl").read_text().splitlines()[3]
    assert raw == json.dumps(rows[3], ensure_ascii=False, separators=(",", ":"))
    manifest = json.loads((out / "manifest.json").read_text())
    from hashlib import sha256

    for f in manifest["files"].values():
        assert sha256((out / f["path"]).read_bytes()).hexdigest() == f["sha256"]
    assert {k: v["rows"] for k, v in manifest["files"].items() if k in SPLITS} == {s: len(lines(out, s)) for s in SPLITS}
    assert not [p.name for p in out.iterdir() if p.name.startswith(".")]
    stats = json.loads((out / "stats.json").read_text())
    assert stats["rows_by_source"] == {"public_rtllm": 20} and stats["claim_levels"]["area"] == {"insufficient_evidence": 20}
    assert sum(stats["rows_by_design_family"].values()) == 20 and stats["rows_by_split"]["train"] == len(lines(out, "train"))
    shared = stats["duplicate_leakage_checks"]["source_overlaps"]["public_rtllm"]
    assert shared == {"rows": sorted(r["id"] for r in rows), "splits": ["test", "train", "val"]}
    assert (out / "stats.json").read_text() == json.dumps(stats, indent=2, sort_keys=True) + "\n"
    assert "| train |" in (out / "dataset_card.md").read_text()
    assert not build_release(spark, [a], str(out)).ok  # files are there already
    assert build_release(spark, [a, b], str(out), seed=5, allow_source_overlap=True, force=True).ok


def test_rows_are_rejected_one_by_one(spark, tmp_path, few_rules):
    bad = edit(("messages", 2, "content", "claim_levels", "area"), "tool_supported", k=6)
    rows = [unique(0, license="TODO"), unique(0), unique(1), unique(1), unique(2, review_status="draft"), unique(3, provenance=dict.fromkeys(row()["provenance"], "Confidential")), bad, "{oops", unique(4), unique(5)]
    rows[9]["messages"][2]["content"]["functional_risk"] = ["No optimization effect is claimed"]
    got = build_release(spark, [put(tmp_path / "in.jsonl", rows)], str(tmp_path / "o"), allow_source_overlap=True)
    assert not got.ok and (got.accepted_rows, got.rejected_rows) == (2, 8) and got.input_rows == 9
    gone = lines(tmp_path / "o", "rejected_rows")
    assert [(r["id"], r["reason"]) for r in gone] == [
        (None, "input load failed"), ("row_0", "license gate"), ("row_0", "duplicate row id"), ("row_1", "duplicate row id"), ("row_2", "review status gate"), ("row_3", "private source gate"),
        ("row_6", "validation failed"), ("row_5", "stub answer"),
    ]
    # the first row with an id holds it even where it is rejected itself
    assert sorted(r["id"] for r in lines(tmp_path / "o", "all_accepted.unsplit")) == ["row_1", "row_4"]
    assert gone[1]["row"] == rows[0] and any("license must not be" in e for e in gone[1]["errors"])
    stats = json.loads((tmp_path / "o" / "stats.json").read_text())
    checks = stats["duplicate_leakage_checks"]
    assert checks["duplicate_row_ids"] == 2 and checks["duplicate_row_fingerprints"] == 1 and stats["rejected_reasons"]["duplicate row id"] == 2
    assert any("malformed JSON" in e for e in got.errors) and any("duplicate row id; first seen on line 1" in e for e in got.errors)


def test_duplicates_across_files_do_not_fail_the_inputs(spark, tmp_path, few_rules):
    a, b = put(tmp_path / "a.jsonl", [unique(1)]), put(tmp_path / "b.jsonl", [unique(1)])
    got = build_release(spark, [a, b], str(tmp_path / "o"))
    assert got.ok and got.accepted_rows == 1 and lines(tmp_path / "o", "rejected_rows")[0]["reason"] == "duplicate row id"


def test_the_whole_catalogue(spark, tmp_path):
    claims = edit(("messages", 2, "content", "claim_levels", "correctness"), "verified", k=3)
    got = build_release(spark, [put(tmp_path / "in.jsonl", [unique(1), claims])], str(tmp_path / "o"))
    assert not got.ok and got.accepted_rows == 1 and any("(A-12)" in e and "row_id=row_3" in e for e in got.errors)
    assert [r["reason"] for r in lines(tmp_path / "o", "rejected_rows")] == ["validation failed"]


def test_overlaps_are_errors_unless_allowed(spark, tmp_path, few_rules):
    twins = [row(1), row(1, id="row_1_copy")]
    same = put(tmp_path / "same.jsonl", twins)
    got = build_release(spark, [same], str(tmp_path / "same"), allow_source_overlap=True)
    assert got.ok and any("duplicate artifact fingerprint in one split" in w for w in got.warnings)
    found = json.loads((tmp_path / "same" / "stats.json").read_text())["duplicate_leakage_checks"]["artifact_fingerprint_overlaps"]
    assert [v for v in found.values()] == [{"rows": ["row_1", "row_1_copy"], "splits": [next(iter(found.values()))["splits"][0]]}]
    cross = put(tmp_path / "cross.jsonl", [row(1), row(2)])
    got = build_release(spark, [cross], str(tmp_path / "c1"), (0.5, 0.5, 0), allow_source_overlap=True)
    assert not got.ok and any("duplicate artifact fingerprint crosses splits" in e for e in got.errors)
    got = build_release(spark, [cross], str(tmp_path / "c2"), (0.5, 0.5, 0), allow_source_overlap=True, allow_family_overlap=True)
    assert got.ok and any("artifact fingerprint overlap allowed" in w for w in got.warnings)
    got = build_release(spark, [cross], str(tmp_path / "c3"), (0.5, 0.5, 0))
    assert any("source appears in multiple splits: public_rtllm" in e for e in got.errors)


def test_rows_are_shuffled_one_by_one_where_families_may_part(spark, tmp_path, few_rules):
    rows = [unique(k, design_family="one") for k in range(11)]
    got = build_release(spark, [put(tmp_path / "in.jsonl", rows)], str(tmp_path / "o"), (0.6, 0.2, 0.2), 9, allow_family_overlap=True, allow_source_overlap=True)
    order = list(range(11))
    random.Random(9).shuffle(order)
    ids = [f"row_{k}" for k in order]
    assert got.ok and [[r["id"] for r in lines(tmp_path / "o", s)] for s in SPLITS] == [ids[:7], ids[7:9], ids[9:]]
    assert any("family overlap allowed for one" in w for w in got.warnings)


def test_arguments(spark, tmp_path, few_rules):
    path = put(tmp_path / "in.jsonl", [unique(1)])
    assert not build_release(spark, [path], str(tmp_path / "x"), (0.5, 0.6, -0.1)).ok and not (tmp_path / "x").exists()
    assert build_release(spark, [path], str(tmp_path / "y"), min_rows=0).errors == ["min_rows must be at least 1"]
    got = build_release(spark, [path, str(tmp_path / "none.jsonl")], str(tmp_path / "z"), min_rows=2)
    assert not got.ok and any("below min_rows 2" in e for e in got.errors) and any("not found" in e for e in got.errors)


def test_split_dataset(spark, tmp_path, few_rules):
    rows = [unique(k) for k in range(10)]
    got = split_dataset(spark, put(tmp_path / "in.jsonl", rows), str(tmp_path / "o"), seed=3)
    assert got.ok and [[r["id"] for r in lines(tmp_path / "o", s)] for s in SPLITS] == expected_split(rows, (0.7, 0.15, 0.15), 3)
    assert json.loads((tmp_path / "o" / "split_summary.json").read_text())["train_rows"] == got.train_rows
    draft = put(tmp_path / "draft.jsonl", [*rows, unique(20, review_status="draft")])
    assert "row_20" in split_dataset(spark, draft, str(tmp_path / "d")).errors[0] and not (tmp_path / "d").exists()
    bad = put(tmp_path / "bad.jsonl", [unique(1, license=None)])
    assert any("license" in e for e in split_dataset(spark, bad, str(tmp_path / "b")).errors)


def test_split_families_meets_ratios():
    got = release.split_families({f"f{k}": 10 for k in range(10)}, (0.8, 0.1, 0.1), 3)
    assert sorted([s for s, _ in got.values()].count(s) for s in SPLITS) == [1, 1, 8]
    assert not release.ratios_valid((0.5, 0.6, -0.1))


def test_overlaps_and_members(spark):
    d = spark.createDataFrame([("a", "x", "p", "train"), ("b", "x", None, "val"), ("c", "y", "p", "train"), ("d", None, "q", "test")], "id string, family string, artifacts string, split string")
    kinds = {"family": "family", "artifact": "artifacts"}
    found = duplicates.overlaps(d, kinds, "split")
    assert {tuple(r) for r in found.select("kind", "key", "n", F.array_join("splits", ",")).collect()} == {("family", "x", 2, "train,val"), ("artifact", "p", 2, "train")}
    assert {tuple(r) for r in duplicates.members(d, found, kinds, "id").collect()} == {("family", "x", "a"), ("family", "x", "b"), ("artifact", "p", "a"), ("artifact", "p", "c")}


def test_first_seen(spark):
    d = spark.createDataFrame([(0, 1, "a", "f"), (0, 2, "a", "g"), (1, 1, "b", "f"), (1, 2, None, "h")], "file_ord int, line long, id string, fp string")
    got = keys.first_seen(d, {"id": "id", "fp": "fp"}, keys.place_number("file_ord", "line"), ["line"])
    assert {(r.file_ord, r.line, r.id_line, r.fp_line) for r in got.collect()} == {(0, 1, 1, 1), (0, 2, 1, None), (1, 1, None, 1), (1, 2, None, None)}


@pytest.mark.parametrize("n", [0, 1, 7])
def test_shuffled_places(n):
    order = list(range(n))
    random.Random(4).shuffle(order)
    assert [order.index(k) for k in range(n)] == list(split.shuffled_places(n, random.Random(4)))
