import json

from pyspark.sql import functions as F

from siltstone.functions import claims, json_text, rtl
from siltstone.functions.variant import Node
from siltstone.sources import jsonl, sinks


def test_three_states(spark):
    rows = [('{"a": 1}',), ('{"a": null}',), ('{"a": ""}',), ('{"a": []}',), ('{"a": {}}',), ('{"a": 0}',), ('{"a": false}',), ('{"a": " x "}',), ("{}",)]
    v = spark.createDataFrame(rows, "raw string").select("raw", F.parse_json("raw").alias("v"))
    a = Node("v")["a"]
    got = {r.raw: tuple(r)[1:] for r in v.select("raw", a.present(), a.nonempty(), a.filled(), a.is_false(), a.is_list(), a.is_object(), a.is_integer()).collect()}
    assert got['{"a": null}'] == (True, False, False, False, False, False, False)
    assert got["{}"] == (False, False, False, False, False, False, False)
    assert got['{"a": ""}'][:3] == (True, False, False) and got['{"a": 0}'][1] and got['{"a": false}'][1] and got['{"a": false}'][3]
    assert got['{"a": []}'][1] is False and got['{"a": []}'][4] and got['{"a": {}}'][1] is False and got['{"a": {}}'][5] and got['{"a": 1}'][6]
    assert got['{"a": " x "}'][2]


def test_scan_keeps_bad_lines(spark, tmp_path):
    path = tmp_path / "a.jsonl"
    path.write_bytes('{"id": 1}\r\n\n   \n[1]\n{bad\n{"t": "x y"}'.encode())
    (tmp_path / "e.jsonl").write_text("")
    s = jsonl.scan(spark, [str(path), str(tmp_path / "none.jsonl"), str(tmp_path / "e.jsonl")])
    got = sorted((r.file_ord, r.line or 0, r.problem or "") for r in s.collect())
    assert got == [(0, 1, ""), (0, 4, "row must be a JSON object"), (0, 5, "malformed JSON"), (0, 6, ""), (1, 0, "input file not found"), (2, 0, "file is empty")]
    assert jsonl.rows(s).count() == 2 and jsonl.problems(s).count() == 4


def test_payload_shapes(spark):
    rows = [("a", '[{"x":1},{"x":2}]'), ("b", '{"answers":[{"x":3}]}'), ("c", '{"x":4}'), ("d", '{"rows":[]}')]
    got = jsonl.payload_rows(spark.createDataFrame(rows, "file string, raw string")).select("file", "kind", "row_index", F.to_json("item").alias("j")).collect()
    assert sorted(tuple(r) for r in got) == [("a", "json_array", 0, '{"x":1}'), ("a", "json_array", 1, '{"x":2}'), ("b", "json_wrapper", 0, '{"x":3}'), ("c", "json_single", 0, '{"x":4}')]


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([(2, '{"b":1}'), (1, '{"é":2}')], "k int, raw string")
    assert sinks.write_jsonl(rows, tmp_path / "o/x.jsonl", ["k"]) == 2
    assert (tmp_path / "o/x.jsonl").read_text() == '{"é":2}\n{"b":1}\n'
    key = "a b/c" * 40
    name = spark.createDataFrame([(key,)], "k string").select(sinks.safe_name_column("k")).first()[0]
    assert name == sinks.safe_name(key) and len(name) == 95 and sinks.safe_name("..//--") .startswith("row-")
    guard = sinks.OutputGuard("tool")
    (tmp_path / "o/m.json").write_text(json.dumps({"created_by": "tool"}))
    assert guard.problems(str(tmp_path / "o"), ["m.json"]) == ["m.json exists"]
    assert guard.problems(str(tmp_path / "o"), ["m.json"], force=True) == []
    assert guard.problems(str(tmp_path / "o"), ["x.jsonl"], force=True) == ["x.jsonl was not created by tool"]
    assert guard.problems(str(tmp_path / "o"), [], inputs=[str(tmp_path / "o/x.jsonl")]) != []
    assert sinks.csv_text([{"a": 1, "b": 2}], ["a"]) == "a\n1\n"


def test_negation_window(spark):
    cases = {
        "this is verified correct": True, "it was not verified correct": False, "without a run, the design cannot be called verified correct": False,
        "it does not work. correctness is verified": True, "not verified correct. later: " + "x" * 200 + " proven correct": True, "nothing": False, "": False,
    }
    d = spark.createDataFrame([(t,) for t in [*cases, None]], "t string")
    got = {r.t: r.c for r in d.select("t", claims.unnegated_claim(F.col("t")).alias("c")).collect()}
    assert got == cases | {None: False}


def test_claims(spark):
    texts = ["reduces power", "may reduce power", "area improved", "patch is safe", "removing the reset", "verified correct", "not verified correct", "fine"]
    no, timing = F.lit(False), F.lit("")
    passed = {t: no for t in ("power", "synthesis", "toggle", "simulation", "equivalence")}
    d = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r.t: r.c for r in d.select("t", claims.unsupported(F.col("t"), passed, no, no, timing).alias("c")).collect()}
    assert got == {"reduces power": ["C-1"], "may reduce power": [], "area improved": ["C-3"], "patch is safe": ["C-6"], "removing the reset": ["C-7"], "verified correct": ["C-5"], "not verified correct": [], "fine": []}


def test_rtl(spark):
    code = "// module ghost(a);\nmodule top(input [3:0] a, b, output reg y);\n  assign y = a;\nendmodule\nmodule top(); endmodule\n  module two; endmodule"
    d = spark.createDataFrame([(code,), ("module m; endmodule",), (None,)], "c string")
    c = F.col("c")
    r = d.select(rtl.module_mentions(c), rtl.module_names(c), rtl.is_substantive(c), rtl.port_names(c), rtl.import_warnings(F.lit("x"), c), rtl.design_family(F.lit("A FIFO counter")), rtl.preview(F.lit("a  b " * 60))).collect()
    assert r[0][0] == ["ghost", "top", "top", "two"] and r[0][1] == ["top", "two"] and r[0][2] and r[0][3] == ["a", "b", "y"]
    assert not r[1][2] and "very_short_rtl" in r[1][4] and r[2][4] == ["empty_rtl", "no_detected_module", "very_short_rtl"] and r[0][5] == "counter" and len(r[0][6]) == 123


def test_json_text(spark):
    assert json_text.canonical({"b": [1, 2.0], "a": "é"}) == '{"a":"é","b":[1,2.0]}'
    assert json_text.first_object('noise {bad} then {"a": {"b": 1}} tail') == {"a": {"b": 1}}
    assert json_text.first_object("[1]") is None and json_text.first_object("") is None
    assert json_text.string_leaves({"a": ["x", {"b": "y"}], "c": 1}) == ["x", "y"]
    assert json_text.holds_copy({"q": [{"a": 1, "b": 2, "c": 3}]}, frozenset("abcd"), frozenset())
    d = spark.createDataFrame([('{"b":1,"a":2}',), ("x {",), (None,)], "r string")
    assert [x[0] for x in d.select(json_text.lenient_object("r")).collect()] == ['{"a":2,"b":1}', None, None]
