"""Queries of the operators on dataset rows, tasks and answers, which are made of the texts of the tables.

Each document gives one row. Its words become the names in designs, prompts, paths and answers, or stand-ins for the
words that an operator looks for, and the SQL works the expected result out of the same text in its own way.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions import claims
from siltstone.functions.variant import Node

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return put


def _docs(spark, sf_dir) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _pick(values: list[str], by: str = "doc_id") -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (F.col(by) % len(values) + 1).cast("int"))


def _pick_sql(values: list, by: str = "doc_id") -> str:
    def one(v):
        return "true" if v is True else "false" if v is False else "null" if v is None else str(v) if isinstance(v, (int, float)) else "'" + v.replace("'", "''") + "'"

    return f"[{', '.join(map(one, values))}][({by} % {len(values)} + 1)::INT]"


PLACES = 6


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit("[a-z]+"), F.lit(0))


def _named(spark, sf_dir) -> DataFrame:
    """Each document with six names n0 ... n5, of words spread over its whole text."""
    d = _docs(spark, sf_dir).withColumn("w", _words(F.col("text"))).withColumn("n", F.size("w"))
    at = lambda k: F.coalesce(F.try_element_at("w", (1 + F.floor(F.col("n") * k / PLACES)).cast("int")), F.lit("none"))
    return d.select("*", *[F.concat(F.lit(f"{chr(97 + k)}_"), at(k)).alias(f"n{k}") for k in range(PLACES)])


NAMED = f"""
with w as (select *, regexp_extract_all(lower(coalesce(text, '')), '[a-z]+') w from documents),
n as (select *, len(w)::INT n, {", ".join(f"'{chr(97 + k)}_' || coalesce(w[1 + len(w) * {k} // {PLACES}], 'none') n{k}" for k in range(PLACES))} from w)
"""


# claims

def _stand_in(text: Column, words: dict[str, str]) -> Column:
    """A text with some of its words exchanged, and a letter of ASCII for each other character, whose word ends engines see differently."""
    text = F.regexp_replace(text, r"[^\x00-\x7F]", "x")
    for old, new in words.items():
        letters = "".join(sorted({w[0] for w in old.split("|")}))  # looked at before a word's edge
        text = F.regexp_replace(text, rf"(?i)(?=[{letters}])\b(?:{old})\b", new)
    return text


def _stand_in_sql(words: dict[str, str]) -> str:
    sql = r"regexp_replace(coalesce(text, ''), '[^\x00-\x7F]', 'x', 'g')"
    for old, new in words.items():
        sql = f"regexp_replace({sql}, '(?i)\\b(?:{old})\\b', '{new}', 'g')"
    return sql


def _unexcused_sql(t: str, claim: str, negation: str, back: int) -> str:
    """Whether a claim of a fixed wording stands in ``t`` without a negation in the characters before it: each claim by its own prefix."""
    neg = negation.replace("'", "''")
    piece = f"string_split_regex({t}, '(?i)\\b{claim}\\b')"
    many = back // len(claim) + 2
    before = f"right(array_to_string(p[greatest(1, i - {many}):i], '{claim}'), {back})"
    return f"""(select coalesce(bool_or(not regexp_matches({before} || '{claim}', '(?i){neg}[\\w\\s,;:()/-]{{0,{back}}}\\b{claim}')), false)
      from (select p, unnest(range(1, len(p))) i from (select {piece} p)))"""


_CLAIMED = {"the|de|der|la": "not", "of|en|und|que": "verified correct", "and|est|die": "."}
_TOOLED = {"and|et|und": "passed simulation", "in|pas": "lint clean", "is|des|der": "is verified", "to|de|la": "not", "on|que|die": "met timing", "for|les": "lower power", "a|du|das": "formal passed"}


@query(f"with t as (select doc_id, {_stand_in_sql(_CLAIMED)} t from documents) select doc_id, {_unexcused_sql('t', 'verified correct', claims.NEGATION, claims.LOOK_BACK)} as claimed from t")
def unnegated_claims(spark, sf_dir):
    """Whether a text claims without denial, where its own frequent words stand for claims, negations and stops."""
    return _docs(spark, sf_dir).select("doc_id", claims.unnegated_claim(_stand_in(F.coalesce("text", F.lit("")), _CLAIMED)).alias("claimed"))


_TOOL_SQL = ", ".join(f"case when regexp_matches(t, '(?i){p}') then '{k}' end" for k, p in claims.TOOL_CLAIMS.items())


@query(f"""
with t as (select doc_id, {_stand_in_sql(_TOOLED)} t from documents),
s as (select doc_id, list_filter([{_TOOL_SQL}, case when {_unexcused_sql('t', 'verified', claims.VERIFIED_NEGATION, claims.VERIFIED_BACK)} then 'verified' end], lambda x: x is not null) k from t)
select doc_id, array_to_string(list_sort(k), ',') as tools from s
""")
def unsupported_tool_claims(spark, sf_dir):
    """The tools whose outcome a text claims, where its own frequent words stand for the claims."""
    from siltstone import vocab as V

    said = claims.tool_claims(_stand_in(F.coalesce("text", F.lit("")), _TOOLED), dict.fromkeys(V.TOOLS, F.lit(False)))
    return _docs(spark, sf_dir).select("doc_id", F.array_join(F.array_sort(said), ",").alias("tools"))


@query("""
select doc_id, list_aggregate(list_sort(list_filter([
  case when length(trim(source)) = 0 then 'empty_instruction' end, case when not regexp_matches(text, '\\S') then 'empty_rtl' end, 'no_detected_module',
  case when regexp_matches(text, '\\S') and not contains(text, 'endmodule') then 'missing_endmodule' end, case when length(text) < 80 then 'very_short_rtl' end,
  case when length(text) > 6000 then 'very_long_rtl' end, case when contains(text, '```') then 'suspicious_markdown_fences' end], lambda x: x is not null)), 'string_agg', ',') as codes from documents where text is not null
""")
def import_warning_codes(spark, sf_dir):
    from siltstone.functions.rtl import import_warnings

    return _docs(spark, sf_dir).where("text IS NOT NULL").select("doc_id", F.array_join(F.array_sort(import_warnings(F.col("source"), F.col("text"))), ",").alias("codes"))


_CODE = [("module a(input clk, input rst_n, output reg [3:0] q);\n always @(posedge clk) if (!rst_n) q <= 0; else q <= q + 1;\nendmodule",)]

_SEQUENTIAL = "module {0} (input {1}_clk, input {2}_rst_n, output reg [3:0] {3}_q);\n always @(posedge {1}_clk) if (!{2}_rst_n) {3}_q <= 0; else {3}_q <= {3}_q + 1;\nendmodule\nmodule {4}; endmodule"
_PLAIN = "  module {4} (input areset, input [1:0] {5}_d,\n output {0}_y);\n assign {0}_y = {5}_d[0];\nendmodule"


def _filled(template: str) -> Column:
    """A template with the document's names in it."""
    parts = re.split(r"\{(\d)\}", template)
    return F.concat(*[F.col(f"n{x}") if k % 2 else F.lit(x) for k, x in enumerate(parts) if x])


def _filled_sql(template: str) -> str:
    parts = re.split(r"\{(\d)\}", template)
    return " || ".join(f"n{x}" if k % 2 else "'" + x.replace("'", "''") + "'" for k, x in enumerate(parts) if x)


@query(f"""{NAMED}, k as (select *, case when n % 3 = 0 then 2 when n % 3 = 1 then 1 else 0 end kind from n)
select doc_id, case kind when 2 then n0 when 1 then n4 end as top_module, case kind when 2 then n2 || '_rst_n' when 1 then 'areset' else '' end as resets, case kind when 2 then n1 || '_clk' else '' end as clocks,
  case kind when 2 then n3 || '_q' when 1 then n0 || '_y' else '' end as outputs from k
""")
def rtl_summaries(spark, sf_dir):
    """Designs named after words of the text, with and without a clock; a third are the text itself, which is no design."""
    from siltstone.functions import rtl

    code = F.when(F.col("n") % 3 == 0, _filled(_SEQUENTIAL)).when(F.col("n") % 3 == 1, _filled(_PLAIN)).otherwise(F.coalesce("text", F.lit("")))
    d = _named(spark, sf_dir).select("doc_id", code.alias("code"))
    about, ports = rtl.summary(F.col("code")), rtl.port_directions(F.col("code"))
    outputs = F.map_keys(F.map_filter(ports, lambda k, v: v == "output"))
    return d.select("doc_id", about["top_module"].alias("top_module"), F.array_join(about["reset_signals"], ",").alias("resets"), F.array_join(about["clock_signals"], ",").alias("clocks"), F.array_join(outputs, ",").alias("outputs"))


_EDITS = [
    ("wrong_reset_polarity", "module {0} (input {1}_clk, input {2}_rst_n, output reg {3}_q);\n always @(posedge {1}_clk) if (!{2}_rst_n) {3}_q <= {4};\nendmodule", "if (!{2}_rst_n)", "if ({2}_rst_n)"),
    ("shift_direction_flip", "assign {0} = {1} << 2; assign {2} = {3} >> 1;", "{1} << 2", "{1} >> 2"),
    ("wrong_mux_select_polarity", "assign {0} = {1}_sel ? {2} : {3};", "{1}_sel ?", "!{1}_sel ?"),
    ("off_by_one_counter_limit", "if ({0}_count < 9) {1} = 1;", "{0}_count < 9", "{0}_count <= 9"),
    ("incomplete_comb_assignment", "always @* if ({0}) {1} = {2}; else {1} = {3};", "else {1} = {3};", "else begin\n     /* incomplete_comb_assignment removed assignment to {1} */\n end"),
    ("blocking_nonblocking_swap_in_clocked_block", "always @(posedge {0}) {1} <= {2}; always @(posedge {0}) {3} <= {1};", "{1} <= {2};", "{1} = {2};"),
    ("width_truncation_output", "output [3:0] {0}_q; assign {0}_q = {1};", "= {1};", "= {1}[0];"),
    ("wrong_fsm_reset_state", "if ({0}_rst) {1}_state <= 2'b00;", "2'b00", "2'b01"),
]


def _edits_sql() -> str:
    """The designs by the number of words, and each with its first fitting place exchanged as text."""
    code = " ".join(f"when {k} then {_filled_sql(e[1])}" for k, e in enumerate(_EDITS))
    old, new = (" ".join(f"when {k} then {_filled_sql(e[i])}" for k, e in enumerate(_EDITS)) for i in (2, 3))
    types = " ".join(f"when {k} then '{e[0]}'" for k, e in enumerate(_EDITS))
    return f"""{NAMED}, c as (select doc_id, case n % 8 {types} end bug_type, case n % 8 {code} end code, case n % 8 {old} end old, case n % 8 {new} end new from n)
select doc_id, bug_type, left(code, instr(code, old)::BIGINT - 1) || new || substr(code, instr(code, old)::BIGINT + length(old)) as mutated from c"""


@query(_edits_sql())
def mutations(spark, sf_dir):
    """Designs named after words of the text, one shape for each edit; of all edits that fit, the one the shape is made for."""
    from siltstone.operators.mutate import mutate

    kind, code, want = F.col("n") % len(_EDITS), F.lit(None).cast("string"), F.lit(None).cast("string")
    for k, e in enumerate(_EDITS):
        code, want = F.when(kind == k, _filled(e[1])).otherwise(code), F.when(kind == k, e[0]).otherwise(want)
    d = _named(spark, sf_dir).select(F.struct("doc_id", want.alias("want")).alias("key"), code.alias("code"))
    return mutate(d, "key", "code", 99).where("bug_type <=> key.want").select("key.doc_id", "bug_type", "mutated")


_PROMPTS = [
    ("Write a module named {0}.\n - input {1}\n - output {2} ({3} bits)\n", "'{0}'", "'input {1}|output {2} ({3} bits)'", False, False),
    ("Fix this.\nmodule TopModule (\n  input {0},\n  output {1}\n);\nendmodule\nUnfortunately, this module has a bug.", "'TopModule'", "'input {0}|output {1}'", True, False),
    ("Use\nmodule {2} (\n  input {3}\n);\nendmodule\n", "'{2}'", "'input {3}'", False, True),
    ("A top-level module with the following interface: {4}", "'TopModule'", "''", False, False),
]


def _prompts_sql() -> str:
    column = lambda i: " ".join(f"when {k} then {_filled_sql(p[i][1:-1]) if p[i] != chr(39) * 2 else p[i]}" for k, p in enumerate(_PROMPTS))
    flag = lambda i: " or ".join(f"n % 5 = {k}" for k, p in enumerate(_PROMPTS) if p[i])
    return f"{NAMED} select doc_id, case n % 5 {column(1)} end as target, case n % 5 {column(2)} else '' end as ports, ({flag(3)}) as candidate, ({flag(4)}) as context from n"


@query(_prompts_sql())
def prompt_interfaces(spark, sf_dir):
    """Prompts about modules and ports named after words of the text; a fifth are the text itself."""
    from siltstone.functions import prompts

    prompt = F.coalesce("text", F.lit(""))
    for k, p in enumerate(_PROMPTS):
        prompt = F.when(F.col("n") % 5 == k, _filled(p[0])).otherwise(prompt)
    d = _named(spark, sf_dir).select("doc_id", prompt.alias("p"))
    ports = F.array_join(F.transform(prompts.interface_ports(F.col("p")), lambda x: F.regexp_replace(x, r"\s+", " ")), "|")
    return d.select("doc_id", prompts.target_module(F.col("p")).alias("target"), ports.alias("ports"), prompts.embedded_candidate(F.col("p")).isNotNull().alias("candidate"), prompts.embedded_context(F.col("p")).isNotNull().alias("context"))


# files

# folders and names that a path is made of, by words of the page's address and text
_FOLDERS = ["repaired", "assembled", "x", "merged", "Teacher_Answer_Returns", "distill", "eval", "raw", "clean", "answers"]
_FILE_NAMES = ["batch_001.json", "assembly_report.md", "y.json", "answers.jsonl", "prompts.jsonl", "triage_report.json", "t.txt"]
_SCHEMAS = ["rtl_answer_v0.1", "rtl_task_v0.1", "train/chat row with messages", "unknown"]
_PATH_SQL = f"""
with u as (select page_id, url, length(html) h, len(regexp_extract_all(html, '<p>')) p from pages),
p as (select page_id, h, p, regexp_replace(url, '^[a-z]+://', '') || '/' || {json.dumps(_FOLDERS).replace('"', "'")}[1 + h % {len(_FOLDERS)}] || '/' || {json.dumps(_FOLDERS).replace('"', "'")}[1 + p % {len(_FOLDERS)}] || '/' || {json.dumps(_FILE_NAMES).replace('"', "'")}[1 + (h + p) % {len(_FILE_NAMES)}] as path,
  {json.dumps(_SCHEMAS).replace('"', "'")}[1 + h % {len(_SCHEMAS)}] as schema from u)
"""


def _paths(spark, sf_dir) -> DataFrame:
    """Paths of the pages' addresses with folders, file names and row schemas that their lengths and paragraphs pick."""
    h, p = F.length("html"), F.regexp_count("html", F.lit("<p>"))
    of = lambda values, k: F.element_at(F.array(*map(F.lit, values)), (1 + k % len(values)).cast("int"))
    path = F.concat_ws("/", F.regexp_replace("url", "^[a-z]+://", ""), of(_FOLDERS, h), of(_FOLDERS, p), of(_FILE_NAMES, h + p))
    return spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", path.alias("path"), of(_SCHEMAS, h).alias("schema"))


@query(_PATH_SQL + """
, t as (select page_id, lower(path) l from p)
select page_id, case when contains(l, 'repaired') then 'repaired' when regexp_matches(l, 'assembled|combined|clean|merged') then 'combined' when regexp_matches(l, 'batch_|teacher_answer_returns|teacher_answer_batches|answer') then 'batch' else 'other' end as tier,
  case when contains(l, 'repaired') then 0 when regexp_matches(l, 'assembled|combined|clean|merged') then 1 when regexp_matches(l, 'batch_|answer') then 2 else 3 end::INT as place from t
""")
def answer_file_tiers(spark, sf_dir):
    from siltstone.operators.audit import priority, tier

    return _paths(spark, sf_dir).select("page_id", tier(F.col("path")).alias("tier"), priority(F.col("path")).alias("place"))


@query(_PATH_SQL + """
, t as (select page_id, lower(path) l, regexp_extract(lower(path), '[^/]*$') f, schema from p)
select page_id, case
  when regexp_matches(f, '\\.(json|md)$') and contains(f, 'assembly') and contains(f, 'report') then 'assembly_report'
  when regexp_matches(f, '(validation|readiness_report|triage_report|selection_report).*\\.(json|md)$') then 'validation_report'
  when schema = 'rtl_answer_v0.1' then case when contains(l, '/repaired/') then 'repaired_answer_batch' when f like '%.jsonl' and (contains(l, '/merged/') or regexp_matches(f, 'assembled|clean')) then 'assembled_answer_jsonl'
    when contains(l, 'teacher_answer_returns') or starts_with(f, 'batch_') then 'teacher_answer_batch' when f like '%.jsonl' then 'assembled_answer_jsonl' else 'teacher_answer_batch' end
  when schema = 'rtl_task_v0.1' then 'normalized_task'
  when schema like '%messages' and contains(l, '/distill/') then 'distill_dataset'
  when contains(l, '/eval/') then case when contains(l, 'prompt') then 'eval_prompt' else 'eval_run' end
  when schema like '%messages' then 'unknown' when contains(l, '/raw/') then 'raw_source' else 'unknown' end as role from t
""")
def file_roles(spark, sf_dir):
    from siltstone.operators.workspace import role

    return _paths(spark, sf_dir).select("page_id", role(F.col("path"), F.col("schema")).alias("role"))


@query("""
select doc_id, regexp_replace(substr(coalesce(nullif(regexp_replace(regexp_replace(k, '[^A-Za-z0-9._-]+', '_', 'g'), '^[._-]+|[._-]+$', '', 'g'), ''), 'row'), 1, 80), '$', '-' || substr(sha256(k), 1, 10) || '.txt') as name
from (select doc_id, source || '/' || left(text, 100) as k from documents where text is not null)
""")
def safe_file_names(spark, sf_dir):
    from siltstone.sources.sinks import safe_name_column

    d = _docs(spark, sf_dir).where("text IS NOT NULL").withColumn("k", F.concat("source", F.lit("/"), F.substring("text", 1, 100)))
    return d.select("doc_id", safe_name_column("k").alias("name"))


# keys

@query("""
with s as (select printf('doc-%07d', doc_id) as k, row_number() over (order by printf('doc-%07d', doc_id)) - 1 as r from documents)
select k as id, r as place, (r // 7)::BIGINT as batch from s
""")
def text_key_batches(spark, sf_dir):
    from siltstone.operators.split import global_rank

    d = _docs(spark, sf_dir).select(F.format_string("doc-%07d", "doc_id").alias("id"))
    return global_rank(d, "id", "place").select("id", "place", F.floor(F.col("place") / 7).alias("batch"))


@query("""
with r as (select source, doc_id, n_chars, row_number() over (partition by source order by n_chars desc, doc_id) n from documents)
select source, doc_id, n_chars as chars from r where n = 1
""")
def first_with_maps(spark, sf_dir):
    """The longest document of each source, with a map beside it."""
    from siltstone.operators.keys import first_wins

    d = _docs(spark, sf_dir).select("source", "doc_id", F.create_map(F.lit("chars"), F.col("n_chars").cast("long")).alias("m"), (-F.col("n_chars")).alias("o"))
    return first_wins(d, "source", ["o", "doc_id"]).select("source", "doc_id", F.col("m")["chars"].alias("chars"))


@query("""
select 'source' as kind, source as key, count(*) as n, string_agg(distinct lang, ',' order by lang) as splits from documents where source is not null group by source having count(*) > 1
union all select 'text', sha256(text), count(*), string_agg(distinct lang, ',' order by lang) from documents where text is not null group by text having count(*) > 1
""")
def shared_keys(spark, sf_dir):
    """Sources and texts that several documents have, with the languages they are spread over."""
    from siltstone.operators.duplicates import overlaps

    d = _docs(spark, sf_dir).withColumn("fp", F.sha2("text", 256))
    return overlaps(d, {"source": "source", "text": "fp"}, "lang").select("kind", "key", "n", F.array_join("splits", ",").alias("splits"))


@query("""
select doc_id, case when text is not null and count(*) over (partition by text) > 1 then min(doc_id) over (partition by text) else -1 end as text_first,
  case when count(*) over (partition by source) > 1 then min(doc_id) over (partition by source) else -1 end as source_first from documents
""")
def first_seen_keys(spark, sf_dir):
    """For texts and sources that repeat, the first document that has them; -1 for others."""
    from siltstone.operators.keys import first_seen

    d = _docs(spark, sf_dir).select("doc_id", "source", F.sha2("text", 256).alias("fp"))
    return first_seen(d, {"text": "fp", "source": "source"}, F.col("doc_id"), []).select("doc_id", *[F.coalesce(f"{k}_first", F.lit(-1)).alias(f"{k}_first") for k in ("text", "source")])


@query("""
with o as (select doc_id, text, source, row_number() over (order by source, doc_id) r, 2 * row_number() over (order by source, doc_id) - 1 as line from documents)
select doc_id, line, length(text)::BIGINT as chars from o
""")
def jsonl_round_trip(spark, sf_dir):
    """Documents written as one JSON lines file in the order of their sources, a blank line after each, and read back with line numbers."""
    from siltstone.scratch import Scratch
    from siltstone.sources import jsonl, sinks

    scratch = Scratch(spark, "round-trip")
    raw = F.concat(F.to_json(F.struct("doc_id", "text")), F.lit("\n"))
    path = f"{scratch.path}/documents.jsonl"
    sinks.write_ordered(_docs(spark, sf_dir).select("source", "doc_id", raw.alias("raw")), path, ["source", "doc_id"], scratch)
    v = Node("v")
    return jsonl.rows(jsonl.scan(spark, path)).select(v["doc_id"].as_("long").alias("doc_id"), "line", F.length(v["text"].text()).cast("long").alias("chars"))


@query(NAMED + """
, k as (select doc_id, row_number() over (order by doc_id) - 1 r, coalesce(lang = 'en', false) fits, n0 from n),
e as (select *, sum(fits::INT) over (order by r) upto, (select count(*) // 20 + 1 from documents) target from k)
select doc_id, r as place, fits as emitted, case when fits then 'm_' || n0 else 'schema_version_mismatch' end as what from e where upto - fits::INT < target
""")
def planted_until_target(spark, sf_dir):
    """Candidates with planted bugs, from tasks named after words of the documents, until a twentieth of their number is met; and what was skipped on the way."""
    from siltstone.operators.synthesize import synthesize

    d = _named(spark, sf_dir)
    code = "module m_{0} (input {1}_clk, input {2}_rst_n, output reg [3:0] {3}_q);\n always @(posedge {1}_clk) if (!{2}_rst_n) {3}_q <= 0; else {3}_q <= {3}_q + 1;\nendmodule"
    parts = ['{"schema_version":"', '","source_id":"', '","artifacts":{"rtl_code":' + json.dumps(code) + "}}"]
    raw = F.concat(F.lit(parts[0]), F.when(F.col("lang") == "en", "rtl_task_v0.1").otherwise("other"), F.lit(parts[1]), F.col("doc_id").cast("string"), _filled(parts[2]))
    scanned = d.select(F.lit(None).cast("string").alias("problem"), F.lit(0).alias("file_ord"), F.col("doc_id").alias("line"), raw.alias("raw"))
    made = synthesize(scanned, 1, spark.read.parquet(f"{sf_dir}/documents.parquet").count() // 20 + 1)
    name = F.regexp_extract(F.get_json_object("raw", "$.artifacts.before_rtl_code"), r"module (\w+)", 1)
    emitted = made.emitted.select(F.get_json_object("raw", "$.source_variant_of").cast("long").alias("doc_id"), F.col("rank").alias("place"), F.lit(True).alias("emitted"), name.alias("what"))
    return emitted.union(made.skipped.select(F.col("line"), "rank", F.lit(False), F.array_join("reasons", ",")))


# answers

_TASK = {"schema_version": "rtl_task_v0.1", "task_type": "rtl_bug_review", "artifacts": {"rtl_code": _CODE[0][0]}, "extracted_rtl_summary": {"top_module": "a", "registered_signals": ["q"]}}
_PLANS = [["lint"], ["compile", "simulate"], ["lint", "simulation", "synthesis area", "toggle vcd", "power report"], []]
_SEVERITIES = ["low", "huge", "high"]


def _row_text() -> str:
    """A dataset row that keeps every rule, around a design named after words of the document."""
    from siltstone import vocab as V

    task = {
        "schema_version": "rtl_task_v0.1", "domain": "digital_rtl", "task_type": "rtl_bug_review", "user_goal": "find_correctness_bug", "design_context": dict.fromkeys(V.CONTEXT_FIELDS, "x"),
        "artifacts": dict.fromkeys(V.ARTIFACTS) | {"rtl_code": _SEQUENTIAL}, "extracted_rtl_summary": dict.fromkeys(V.SUMMARY_FIELDS, []) | {"top_module": "{0}", "registered_signals": ["{3}_q"]},
        "constraints": dict.fromkeys(V.CONSTRAINTS, True), "assumptions": [], "required_output": list(V.REQUIRED_OUTPUT),
    }
    return json.dumps({
        "id": "row_{0}", "dataset_version": "dataset_v0.1", "split": "unsplit", "source": "public_rtllm", "license": "MIT", "design_family": "{1}", "task_family": "rtl_bug_review", "created_by": "t",
        "review_status": "reviewed", "provenance": dict.fromkeys(V.PROVENANCE_FIELDS, "p"), "tool_checks": dict.fromkeys(V.TOOLS),
        "messages": [{"role": "system", "content": "s"}, {"role": "user", "content": task}, {"role": "assistant", "content": {"issue_summary": []}}],
    })


def _rows(spark, sf_dir, risk: Column | str = "x") -> DataFrame:
    """A dataset row ``v`` and a candidate ``answer`` for each document: the text's digits, words and length decide how good it is.

    ``risk``: the answer's functional risk, plain letters, which may ask for ``digits``.
    """
    from siltstone import vocab as V

    en, said = F.col("lang") == "en", F.array_join(F.slice("w", 1, 1 + F.col("n") % 6), " ")
    levels = dict.fromkeys(V.CLAIM_DOMAINS, "insufficient_evidence")
    pick = lambda values, k: F.element_at(F.array(*map(F.lit, values)), (1 + k % len(values)).cast("int"))
    parts = [
        F.lit('{"schema_version":"rtl_answer_v0.1","task_type":"rtl_bug_review","source_id":"s","evidence_used":[],"limitations":[],"patch":{},"functional_risk":["'), F.lit(risk) if isinstance(risk, str) else risk, F.lit('"],"safe_optimization":{"recommendation":"none","patch_style":"explanation_only","expected_effect":"none"},"claim_levels":' + json.dumps(levels) + ',"issue_summary":[{"issue":"'),
        F.when(F.col("digits"), "counter wraps").otherwise(""), F.lit('","severity":"'), pick(_SEVERITIES, F.length(F.coalesce("text", F.lit("")))), F.lit('","evidence":{"signal_names":["'), F.concat("n3", F.lit("_q")),
        F.lit('"],"code_location":{"module":"'), F.upper("n0"), F.lit('","block":"always","line_range":"2"},"reason":"'), said, F.lit('"}}],"time_reasoning":{"clock_cycle_behavior":"'), said,
        F.lit('","latency_or_state_risk":"none","reset_behavior_risk":"none"},"space_reasoning":{"hardware_resources_involved":["register"],"area_risk":"'), F.when(en, "synthesis evidence").otherwise("small"),
        F.lit('","activity_risk":"unknown"},"verification_plan":'), pick([json.dumps(p) for p in _PLANS], F.col("n")), F.lit("}"),
    ]
    d = _named(spark, sf_dir).withColumn("digits", F.coalesce("text", F.lit("")).rlike("[0-9]"))
    return d.select("doc_id", "lang", "n", "digits", F.parse_json(_filled(_row_text())).alias("v"), F.parse_json(F.concat(*parts)).alias("answer"))


@query(NAMED + """
, d as (select doc_id, regexp_matches(coalesce(text, ''), '[0-9]')::INT o, (length(array_to_string(w[1:1 + n % 6], ' ')) >= 20)::INT l, coalesce(lang = 'en', false)::INT e, length(coalesce(text, '')) % 3 m, n % 4 k from n),
p as (select *, 0.2 as schema_, round(0.25 * (o + case when m <> 1 then 1 else 0 end + 3 + l) / 6, 6) as grounding, round(0.2 * (l + 2 + e) / 5, 6) as reasoning, round(0.1 * case k when 0 then 1 when 1 then 2 when 2 then 5 else 0 end / 5, 6) as verification from d)
select doc_id, schema_, grounding, reasoning, verification, 0.05 as alignment, 0.2 as claim_safety,
  case when o = 0 or m = 1 or k = 3 then least(0.25, round(schema_ + 0.25 * (o + case when m <> 1 then 1 else 0 end + 3 + l) / 6 + reasoning + verification + 0.25, 6)) else round(schema_ + 0.25 * (o + 1 + 3 + l) / 6 + reasoning + verification + 0.25, 6) end as score from p
""")
def evaluator_scores(spark, sf_dir):
    """Scores of answers to whole rows; those that break a rule are capped."""
    from siltstone.operators.scoring import score_answers

    return score_answers(_rows(spark, sf_dir).select("doc_id", "v", "answer")).select("doc_id", F.col("schema").alias("schema_"), "grounding", "reasoning", "verification", "alignment", "claim_safety", "score")


@query(NAMED + """
, d as (select doc_id, n % 5 k from n)
select doc_id, case k when 0 then 'parsed_object' when 1 then 'parsed_json' when 2 then 'extracted_json' when 3 then 'parse_failed' else 'missing_prediction' end as parse_status,
  k < 3 as json_valid, k < 3 as schema_valid, k < 3 as required_fields_valid, k < 3 as claim_safety_valid, case when k < 3 then true else false end as reference_only_behavior_valid,
  null::BOOLEAN as candidate_bug_behavior_valid, k < 3 as exact_expected_match_optional, false as overall_valid from d
""")
def prediction_categories(spark, sf_dir):
    """Predictions as an object, as JSON text, within other text, as a list, and none; ids never match, so none is valid overall."""
    from siltstone.operators import predictions

    d, k = _rows(spark, sf_dir), F.col("n") % 5
    d = d.withColumn("source_id", F.col("doc_id").cast("string"))
    task = F.parse_json(F.lit(json.dumps(_TASK | {"source_rtl_role": "reference_rtl"})))
    prompts = d.select("source_id", F.lit("rtl_bug_review").alias("family"), task.alias("task"), F.col("answer").alias("expected"), F.parse_json(F.lit("{}")).alias("checks"))
    text = F.to_json("answer")
    output = F.when(k == 0, F.col("answer")).when(k == 1, text.cast("variant")).when(k == 2, F.concat(F.lit("so: "), text).cast("variant")).otherwise(F.concat(F.lit("["), text, F.lit("]")).cast("variant"))
    given = d.where(k < 4).select("source_id", F.lit("m").alias("model"), output.alias("output"))
    kept = ["parse_status", *(c for c in predictions.CATEGORIES if c != "source_id_match")]
    return predictions.score(prompts, given).select(F.col("source_id").cast("long").alias("doc_id"), *kept)


@query(NAMED + """
, d as (select doc_id, regexp_matches(coalesce(text, ''), '[0-9]') o, regexp_matches(n3, 'th|en') s from n)
select doc_id, (o::INT + s::INT)::INT as difference_score, o as issue_text_changed, s as signal_names_changed, false as patch_provided_changed, not o and not s as exact_same from d
""")
def answer_differences(spark, sf_dir):
    """Each answer against itself without the text of its issue, and with its signal's name without some letters."""
    from siltstone.operators.differences import row_differences

    d = _rows(spark, sf_dir).withColumn("id", F.col("doc_id").cast("string"))
    signal = F.concat(F.lit('"signal_names":["'), F.regexp_replace(F.get_json_object(F.to_json("answer"), "$.issue_summary[0].evidence.signal_names[0]"), "th|en", "x"), F.lit('"]'))
    bare = F.regexp_replace(F.regexp_replace(F.to_json("answer"), F.lit("counter wraps"), F.lit("")), F.lit(r'"signal_names":\[[^\]]*\]'), signal)
    bare = d.select("id", F.parse_json(bare).alias("answer"))
    found = row_differences(d.select("id", "v"), d.select("id", "answer"), bare)
    return found.select(F.col("id").cast("long").alias("doc_id"), "difference_score", "issue_text_changed", "signal_names_changed", "patch_provided_changed", "exact_same")


@query("select lang as split, count(*) as n, round(avg(length(text)), 2) as mean, max(length(text))::INT as longest from documents where text is not null group by rollup (lang)")
def message_lengths(spark, sf_dir):
    from siltstone.operators.finetune import lengths

    message = F.struct(F.lit("user").alias("role"), F.col("text").alias("content"))
    d = _docs(spark, sf_dir).where("text IS NOT NULL").select(F.col("lang").alias("split"), F.lit(None).cast("string").alias("problem"), F.parse_json(F.to_json(F.struct(F.array(message).alias("messages")))).alias("v"))
    return lengths(d)


@query("""
select doc_id, rule from (select doc_id, unnest(list_filter([case when k = 1 then 'approved' end, case when k = 2 then 'three_messages' end, case when k = 3 then 'role' end], lambda x: x is not null)) as rule from (select doc_id, len(regexp_extract_all(lower(coalesce(text, '')), '[a-z]+')) % 4 k from documents))
""")
def finetune_problems(spark, sf_dir):
    """Chat rows around the texts; the number of a text's words decides what is wrong with its row."""
    from siltstone.operators.finetune import check

    k = F.size(_words(F.col("text"))) % 4
    message = lambda role, content: '{"role":"' + role + '","content":' + content + "}"
    three = [message("system", '"s"'), message("user", '{"schema_version":"rtl_task_v0.1","prompt":@}'), message("assistant", '{"schema_version":"rtl_answer_v0.1"}')]
    whole = ",".join(three)
    raw = F.when(k == 1, '{"approval_status":"approved","messages":[' + whole + "]}").when(k == 2, '{"messages":[' + three[0] + "]}").when(k == 3, '{"messages":[' + whole.replace('"user"', '"tool"') + "]}").otherwise('{"messages":[' + whole + "]}")
    raw = F.replace(raw, F.lit("@"), F.to_json(F.coalesce("text", F.lit("")).cast("variant")))
    d = _docs(spark, sf_dir).select(F.lit("train").alias("split"), F.col("doc_id").cast("int").alias("line"), F.lit(None).cast("string").alias("problem"), raw.alias("raw"), F.parse_json(raw).alias("v"))
    return check(d).select(F.col("line").cast("long").alias("doc_id"), "rule")


@query()
def distill_splits(spark, sf_dir):
    """Documents dealt to three splits of fixed sizes; those in English have a candidate."""
    from siltstone.operators.distill import assign

    d = _docs(spark, sf_dir)
    task = F.when(F.col("lang") == "en", '{"artifacts":{"before_rtl_code":"x"}}').otherwise("{}")
    n = d.count()
    sizes = {"train": n - 2 * (n // 10), "validation": n // 10, "test": n // 10}
    d = d.select(F.format_string("d%07d", "doc_id").alias("source_id"), F.parse_json(task).alias("task"))
    return assign(d, sizes, 7)


@query("select doc_id, rule from (select doc_id, unnest(list_filter([case when len(regexp_extract_all(lower(coalesce(text, '')), '[a-z]+')) % 2 = 0 then 'other_task' end, case when regexp_matches(text, '[0-9]') then 'unsupported_claim' end], lambda x: x is not null)) as rule from documents)")
def teacher_answer_problems(spark, sf_dir):
    """Answers with another task's type, or with a claim that no tool backs."""
    from siltstone.operators import teacher
    from siltstone.operators.rules import violations

    d = _rows(spark, sf_dir, F.when(F.col("digits"), "lint clean").otherwise("x"))
    task = F.parse_json(F.when(F.col("n") % 2 == 0, '{"task_type":"rtl_area_activity_review"}').otherwise('{"task_type":"rtl_bug_review"}'))
    d = d.select("doc_id", "answer", task.alias("task")).withColumn("text", Node("answer").json())
    return violations(d, teacher.answer_rules(Node("answer"), Node("task"), text=F.col("text")), ["doc_id"]).select("doc_id", "rule")
