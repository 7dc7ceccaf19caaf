"""Values that were worked out once a use are worked out once a row."""

import re

from pyspark.sql import functions as F

from siltstone.functions import claims, rtl
from siltstone.functions.once import opened


def _plan(frame) -> str:
    frame.sparkSession.conf.set("spark.sql.debug.maxToStringFields", "100000")
    return frame._jdf.queryExecution().optimizedPlan().toString()


def test_families_by_first_letters(spark):
    """the text is lower-cased once for all classes, and places are told by a letter before a word's edge."""
    texts = ["a dual-port RAM", "grammar aluminium", "éram", "counting", "discounts", "next_state", "flip-flop", "memory controller", "", "edge detector"]
    d = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.f for r in d.select(rtl.design_family(F.col("t")).alias("f")).collect()]
    assert got == ["memory", "general_rtl", "general_rtl", "counter", "general_rtl", "fsm", "register", "memory", "general_rtl", "edge_detector"]
    assert _plan(d.select(rtl.design_family(F.col("t")).alias("f"))).count("lower(") == 1
    for _, p in rtl.FAMILIES:
        assert all(re.match(r"\\b[a-z]", x) for x in p.split("|") if "(" not in x and ")" not in x)
        assert opened(p).endswith(f"(?:{p})")


def test_claims_of_a_text_made_once(spark):
    """a text that has to be made is made once for all tools; before, once for each, and more."""
    d = spark.createDataFrame([("It PASSED  simulation; not verified",), ("verified, lint clean",), ("unverified",), ("",), (None,)], "t string")
    none = {t: F.lit(False) for t in ("parse", "lint", "simulation", "equivalence", "synthesis", "toggle", "power")}
    said = claims.tool_claims(F.regexp_replace("t", "zz", "y"), none)
    got = [r.s for r in d.select(said.alias("s")).collect()]
    assert got == [["simulation"], ["lint", "verified"], [], [], []]
    assert _plan(d.select(said.alias("s"))).count("regexp_replace(") == 1
    for p in claims.TOOL_CLAIMS.values():
        assert opened(p).count(r"\b") == p.count(r"\b")


def test_mutations_read_a_text_once(spark):
    """no filter on the shapes' names that reads the whole texts again; each edit is worked out once."""
    from siltstone.operators import mutate
    from siltstone.plans.operator_queries import mutations

    assert _plan(mutations(spark, "/root/testdata/sf0.001")).count("regexp_extract_all(lower(") == 1
    d = spark.createDataFrame([("if (rst) q_state <= 2'b00; assign y = a << 2;",)], "t string")
    plan = _plan(d.select(mutate.edits(F.col("t")).alias("e")))
    assert len(plan) < 200_000
    assert {x.bug_type for x in d.select(F.explode(mutate.edits(F.col("t"))).alias("e")).select("e.*").collect()} == {"shift_direction_flip", "wrong_fsm_reset_state"}


def test_rows_are_read_once(spark):
    """members of an object are read once, not once a key; objects are told without a copy of all below."""
    from siltstone.functions.variant import Node, replaced

    d = spark.createDataFrame([('{"b":1,"a":"x","m":{"k":null}}',), ("{}",), ("[]",)], "t string").select(F.parse_json("t").alias("v"))
    new = replaced(Node("v"), {"m": F.lit("[1]"), "n": F.lit(None).cast("string")})
    assert [r.x for r in d.select(new.alias("x")).collect()] == ['{"a":"x","b":1,"m":[1]}', '{"m":[1]}', '{"m":[1]}']
    assert _plan(d.select(new.alias("x"))).count("map_filter(") == 1
    assert "map" not in _plan(d.select(Node("v").is_object().alias("x"))).lower()
    said = claims.unsupported(F.regexp_replace("t", "zz", "y"), {t: F.lit(False) for t in ("power", "synthesis", "toggle", "simulation", "equivalence")}, F.lit(False), F.lit(False), F.lit(""))
    texts = spark.createDataFrame([("power is reduced",), ("may reduce power",), ("this patch is safe, verified correct",), ("not verified correct",), ("removing the reset; smaller area",)], "t string")
    assert [r.s for r in texts.select(said.alias("s")).collect()] == [["C-1"], [], ["C-5", "C-6"], [], ["C-3", "C-7"]]
    assert _plan(texts.select(said.alias("s"))).count(", zz, y") == 1


def test_orphans_dealt_by_rows(spark, monkeypatch):
    """the tasks that aggregate keys follow the number of rows, so the keys of one do not grow."""
    from siltstone.plans import driver_queries

    monkeypatch.setattr(driver_queries, "KEYS", 500)
    d = driver_queries.orphan_references(spark, "/root/testdata/sf0.001")
    rows = sum(spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet").count() for t in ("lineitem", "orders"))
    assert "RepartitionByExpression [key" in _plan(d) and f", {1 + rows // 500}" in _plan(d)
    assert d.count() == d.distinct().count()


def test_answers_written_out_once(spark):
    """an answer is parsed once and written out once for all rules; Python reads only texts that may hold a copy; claims are sought where their words are."""
    from siltstone.functions import json_text
    from siltstone.plans.operator_queries import teacher_answer_problems

    plan = _plan(teacher_answer_problems(spark, "/root/testdata/sf0.001"))
    assert len(re.findall(r"evaluate\(try_variant_get\(answer#\d+, \$, ", plan)) == 1 and plan.count("parseJson(concat(") == 1 and '"required_output"' in plan
    copies = ['{"a":[{"prompt":1,"artifacts":2,"constraints":3}]}', r'{"a":{"\u0070rompt":1,"artifacts":2,"constraints":3}}', '{"x":{"schema_version":"rtl_task_v0.1"}}', r'{"schema_version":"rtl_\u0074ask.v0.1"}']
    others = ['{"prompt":1,"a":{"artifacts":2,"constraints":3}}', '{"a":["prompt","artifacts","constraints"]}', '{"x":"rtl_task_v0.1"}', "{}", "", None]
    d = spark.createDataFrame([(t,) for t in copies + others], "t string").coalesce(1)
    assert [r.c for r in d.select(json_text.task_copy(F.col("t")).alias("c")).collect()] == [True] * len(copies) + [False] * len(others)
    read = _plan(d.select(json_text.answer_copy(F.col("t")).alias("c")))
    assert all(f'"{k}"' in read for k in json_text.ANSWER_KEYS)
    said = {
        "simulation": "passed simulation|simulation passed|simulated successfully|verified by simulation", "lint": "passed lint|lint passed|lint clean|no lint errors", "synthesis": "synthesized|synthesis passed|synthesis shows",
        "power": "power improved|power reduced|power decreased|lower power", "toggle": "toggle improved|toggles reduced|activity decreased|switching improved", "equivalence": "equivalence passed|formal passed|formal proved", "timing": "timing passed|timing met|timing improved|met timing", "verified": "verified",
    }
    rows = [(k, f"İ {x.upper()}.") for k, texts in said.items() for x in texts.split("|")]
    none = dict.fromkeys(("parse", "lint", "simulation", "equivalence", "synthesis", "toggle", "power"), F.lit(False))
    got = spark.createDataFrame(rows, "k string, t string").select("k", claims.tool_claims(F.col("t"), none).alias("s")).collect()
    assert all(r.k in r.s for r in got) and _plan(d.select(claims.tool_claims(F.col("t"), none).alias("s"))).count("Contains(") == sum(map(len, claims.CLAIM_WORDS.values()))
