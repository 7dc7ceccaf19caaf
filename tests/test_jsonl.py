import json
import random

import pytest

from siltstone.sources import jsonl

SPLIT = "spark.sql.files.maxPartitionBytes"


@pytest.fixture()
def small_splits(spark):
    before = {k: spark.conf.get(k) for k in (SPLIT, "spark.sql.files.openCostInBytes")}
    spark.conf.set(SPLIT, "700b")
    spark.conf.set("spark.sql.files.openCostInBytes", "0b")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def plain(path):
    """(line, problem) of the lines that are not blank, as a plain reader numbers them."""
    out = []
    with open(path, encoding="utf-8") as f:
        for k, raw in enumerate(f, 1):
            if raw.strip():
                try:
                    problem = None if isinstance(json.loads(raw), dict) else "row must be a JSON object"
                except ValueError:
                    problem = "malformed JSON"
                out.append((k, problem))
    return out


def written(path, seed, ends, last=True):
    r, parts = random.Random(seed), []
    for k in range(400):
        kind = r.random()
        line = "" if kind < 0.1 else " \t　" if kind < 0.15 else "[1]" if kind < 0.2 else "{oops" if kind < 0.25 else json.dumps({"k": k, "t": "wörd   " * r.randrange(9)}, ensure_ascii=False)
        parts.append(line + r.choice(ends))
    parts.append('{"k": "last"}' if last else "")
    path.write_bytes("".join(parts).encode())
    return str(path)


@pytest.mark.parametrize("ends", [["\n"], ["\r\n"], ["\r"], ["\n", "\r\n", "\r"]])
def test_line_numbers_over_many_splits(spark, tmp_path, small_splits, ends):
    paths = [written(tmp_path / f"a b+c%{k}.jsonl", k, ends, k % 2 == 0) for k in range(3)]
    found = jsonl.scan(spark, [paths[2], paths[0], paths[1]])
    assert found.rdd.getNumPartitions() > 6
    got = sorted((r.file_ord, r.file, r.line, r.problem) for r in found.select("file_ord", "file", "line", "problem").collect())
    want = [(i, p, line, problem) for i, p in enumerate([paths[2], paths[0], paths[1]]) for line, problem in plain(p)]
    assert got == want
    texts = {(r.file, r.line): r.raw for r in found.collect()}
    with open(paths[0], encoding="utf-8") as f:
        for k, raw in enumerate(f, 1):
            if raw.strip():
                assert texts[paths[0], k] == raw.rstrip("\r\n")


def test_one_large_file_is_read_by_many_tasks(spark, tmp_path):
    path = tmp_path / "big.jsonl"
    with open(path, "w") as f:
        for k in range(200_000):
            f.write(f'{{"k": {k}, "t": "{"x" * (k % 50)}"}}\n')
    before = spark.conf.get(SPLIT)
    spark.conf.set(SPLIT, "1m")
    try:
        found = jsonl.scan(spark, str(path))
        assert found.rdd.getNumPartitions() >= 8
        assert found.where("line <> variant_get(v, '$.k', 'long') + 1").count() == 0 and found.count() == 200_000
        plan = found._jdf.queryExecution().toString()
        assert "wholetext=true" not in plan and "SortMergeJoin" not in plan
    finally:
        spark.conf.set(SPLIT, before)


def test_odd_files(spark, tmp_path):
    files = {
        "mark.jsonl": b'\xef\xbb\xbf{"a": 1}\n{"a": 2}', "zero.jsonl": b"", "blank.jsonl": b"\n \n\r\n", "latin.jsonl": b'{"a": 1}\n{"a": "\xff"}\n{"a": 3}\n',
        "only.jsonl": b'{"a": 1}', "end.jsonl": b'\n{"a": 1}\n\n', "bare.jsonl": b"\xef\xbb\xbf",
    }
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
    paths = [str(tmp_path / n) for n in files] + [str(tmp_path / "none.jsonl"), str(tmp_path / "only.jsonl")]
    got = {}
    for r in jsonl.scan(spark, paths).orderBy("file_ord", "line").collect():
        got.setdefault((r.file_ord, r.file.rsplit("/", 1)[-1]), []).append((r.line, r.problem))
    assert got == {
        (0, "mark.jsonl"): [(1, "malformed JSON"), (2, None)], (1, "zero.jsonl"): [(None, "file is empty")], (2, "blank.jsonl"): [(None, "file is empty")],
        (3, "latin.jsonl"): [(1, None), (2, "line is not UTF-8"), (3, None)], (4, "only.jsonl"): [(1, None)], (5, "end.jsonl"): [(2, None)], (6, "bare.jsonl"): [(1, "malformed JSON")],
        (7, "none.jsonl"): [(None, "input file not found")], (8, "only.jsonl"): [(1, None)],
    }
    (tmp_path / "first.jsonl").write_bytes(b'\xef\xbb\xbf\n{"a": 2}\n')
    assert sorted((r.line, r.problem) for r in jsonl.scan(spark, str(tmp_path / "first.jsonl")).collect()) == [(1, "malformed JSON"), (2, None)]
    (tmp_path / "first.jsonl").unlink()
    assert jsonl.scan(spark, []).count() == 0 and jsonl.scan(spark, str(tmp_path / "zero.jsonl")).count() == 1
    folder = jsonl.scan(spark, str(tmp_path))
    assert folder.select("file").distinct().count() == len(files)


def test_a_line_is_one_json_value(spark):
    from siltstone.functions.variant import strict_json

    texts = ['{"a":1}', ' {"a":1} ', '{"a":1} x', '{"a":1}}', '{"a":1}]', '{"a":1}\n{"b":2}', '{"a":1},', '{"a":1},{"b":2}', '1,"x":2', "[1]", "[1] ]", "", " ", "null", '"a"', '{"a":1}]}', '{"a":1}}]', '],[1', "{", '{"a":[1,2,{"b":null}]}']

    def plain(t):
        try:
            json.loads(t)
            return True
        except ValueError:
            return False

    from pyspark.sql import functions as F

    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", strict_json(F.col("t")).isNotNull().alias("ok")).collect()
    assert {r.t: r.ok for r in got} == {t: plain(t) for t in texts}
