"""Queries over the driver's tables, each with its DuckDB counterpart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
#: Rows of keys that one task aggregates.
KEYS = 1_000_000


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(sql: str | None = None):
    """Register a function (spark, sf_dir) under its own name, with its DuckDB SQL."""

    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return put


@query("""
with firsts as (select *, row_number() over (partition by sha256(text) order by doc_id) n from documents where text is not null and length(trim(text)) > 0),
s as (select lang, source, case when b < 80 then 'train' when b < 90 then 'val' else 'test' end split
      from (select *, ('0x' || substr(sha256('7:' || source), 1, 8))::UBIGINT % 100 b from firsts where n = 1))
select split, lang, count(*) as n_rows, count(distinct source) as n_sources from s group by split, lang
""")
def release_split_composition(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltstone.operators import keys, split

    docs = _t(spark, sf_dir, "documents").where("text IS NOT NULL AND length(trim(text)) > 0")
    firsts = keys.first_wins(docs.select(F.sha2("text", 256).alias("fp"), "doc_id", "lang", "source"), "fp", ["doc_id"])
    return split.hash_split(firsts, "source", 7).groupBy("split", "lang").agg(F.count("*").alias("n_rows"), F.countDistinct("source").alias("n_sources"))


@query("select sha256(text) as fp, count(*) as n, min(doc_id) as first_id from documents where text is not null group by 1 having count(*) > 1")
def exact_duplicate_groups(spark, sf_dir):
    from siltstone.operators.duplicates import duplicate_groups

    return duplicate_groups(_t(spark, sf_dir, "documents"), "text", "doc_id").withColumnRenamed("first", "first_id")


@query("""
with s as (select sha256(text) fp, ('0x' || substr(sha256('7:' || doc_id), 1, 8))::UBIGINT % 100 b from documents where text is not null),
p as (select distinct fp, case when b < 80 then 'train' when b < 90 then 'val' else 'test' end split from s)
select fp, string_agg(split, ',' order by split) as splits from p group by fp having count(*) > 1
""")
def cross_split_fingerprints(spark, sf_dir):
    from siltstone.operators import duplicates, split

    dealt = split.hash_split(_t(spark, sf_dir, "documents"), "doc_id", 7)
    return duplicates.leaks(dealt, "text", "split").select("fp", F.array_join("splits", ",").alias("splits"))


@query("select lang, count(distinct source) as n_sources, min(source) as first_source from documents group by lang having count(distinct source) > 1")
def group_crosses_partitions(spark, sf_dir):
    d = _t(spark, sf_dir, "documents")
    return d.groupBy("lang").agg(F.countDistinct("source").alias("n_sources"), F.min("source").alias("first_source")).where("n_sources > 1")


@query("select lang, source, grouping_id(lang, source) as gid, count(*) as n, sum(n_chars) as chars from documents group by grouping sets ((lang), (source), ())")
def composition_grouping_sets(spark, sf_dir):
    _t(spark, sf_dir, "documents").createOrReplaceTempView("silt_documents")
    return spark.sql("SELECT lang, source, grouping_id(lang, source) AS gid, count(*) AS n, sum(n_chars) AS chars FROM silt_documents GROUP BY lang, source GROUPING SETS ((lang), (source), ())")


_RULES_SQL = """
with v as (
  select doc_id, 'D-01' as rule, 'text' as field, 'error' as severity from documents where text is null or length(trim(text)) = 0
  union all select doc_id, 'D-02', 'n_chars', 'error' from documents where n_chars <> length(text)
  union all select doc_id, 'D-03', 'lang', 'error' from documents where lang is null or lang not in ('en', 'de', 'fr', 'es')
  union all select doc_id, 'D-04', 'text', 'warning' from documents where length(text) < 40
  union all select doc_id, 'D-05', 'text', 'warning' from documents where text like '%###%'
  union all select doc_id, 'D-06', 'source', 'error' from documents where not regexp_matches(source, '^src[0-9]+$'))
"""


def _document_violations(spark, sf_dir) -> DataFrame:
    from siltstone.operators.rules import Rule, violations

    text, source = F.col("text"), F.col("source")
    rules = [
        Rule("D-01", "text", "error", text.isNull() | (F.length(F.trim(text)) == 0)),
        Rule("D-02", "n_chars", "error", F.col("n_chars") != F.length(text)),
        Rule("D-03", "lang", "error", F.col("lang").isNull() | ~F.col("lang").isin("en", "de", "fr", "es")),
        Rule("D-04", "text", "warning", F.length(text) < 40),
        Rule("D-05", "text", "warning", text.contains("###")),
        Rule("D-06", "source", "error", ~source.rlike("^src[0-9]+$")),
    ]
    return violations(_t(spark, sf_dir, "documents"), rules, ["doc_id"])


@query(_RULES_SQL + "select doc_id, rule, field, severity from v")
def rule_violations(spark, sf_dir):
    return _document_violations(spark, sf_dir).select("doc_id", "rule", "field", "severity")


@query(_RULES_SQL + "select rule, severity, count(*) as n from v group by rule, severity")
def violation_counts(spark, sf_dir):
    return _document_violations(spark, sf_dir).groupBy("rule", "severity").agg(F.count("*").alias("n"))


@query("select o_orderkey, o_orderstatus from orders where o_orderstatus not in ('O', 'F')")
def enum_violations(spark, sf_dir):
    return _t(spark, sf_dir, "orders").where(~F.col("o_orderstatus").isin("O", "F")).select("o_orderkey", "o_orderstatus")


@query("select l_orderkey, count(*) as n, min(l_linenumber) as first_line from lineitem group by l_orderkey having count(*) > 1")
def duplicate_ids(spark, sf_dir):
    from siltstone.operators.keys import duplicate_keys, first_wins

    lines = _t(spark, sf_dir, "lineitem")
    first = first_wins(lines.select("l_orderkey", "l_linenumber"), "l_orderkey", ["l_linenumber"]).withColumnRenamed("l_linenumber", "first_line")
    return duplicate_keys(lines, "l_orderkey").join(first, "l_orderkey").select("l_orderkey", "n", "first_line")


@query("select conv_id, string_agg(role, '>' order by turn) as roles from conversations group by conv_id")
def role_sequence(spark, sf_dir):
    turns = F.array_sort(F.collect_list(F.struct("turn", "role")))
    return _t(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_join(F.transform(turns, lambda x: x["role"]), ">").alias("roles"))


@query("""
select conv_id, count(*) as n_turns, arg_min(role, turn) as first_role, sum(length(text)) as n_chars from conversations group by conv_id having count(*) <> 3
""")
def message_shape(spark, sf_dir):
    c = _t(spark, sf_dir, "conversations")
    return c.groupBy("conv_id").agg(F.count("*").alias("n_turns"), F.min_by("role", "turn").alias("first_role"), F.sum(F.length("text")).alias("n_chars")).where("n_turns <> 3")


@query("select role, count(*) as n, avg(length(text)) as mean_chars, max(length(text)) as max_chars from conversations group by role")
def char_length_stats(spark, sf_dir):
    n = F.length("text")
    return _t(spark, sf_dir, "conversations").groupBy("role").agg(F.count("*").alias("n"), F.avg(n).alias("mean_chars"), F.max(n).cast("long").alias("max_chars"))


def _scored(spark, sf_dir) -> DataFrame:
    d, y = _t(spark, sf_dir, "documents"), _t(spark, sf_dir, "labels")
    return d.select("doc_id", "source", "lang", "n_chars").join(y, "doc_id")


@query("""
select source, count(*) as n, round(avg(quality), 6) as mean, median(quality)::DOUBLE as median, min(quality)::DOUBLE as min, max(quality)::DOUBLE as max
from documents join labels using (doc_id) group by source
""")
def score_metrics_by_group(spark, sf_dir):
    from siltstone.operators.scoring import summary

    return summary(_scored(spark, sf_dir).withColumn("score", F.col("quality").cast("double")), "source")


@query("select doc_id from documents where doc_id not in (select doc_id from labels)")
def missing_candidates(spark, sf_dir):
    from siltstone.operators.keys import pending

    return pending(_t(spark, sf_dir, "documents").select("doc_id"), _t(spark, sf_dir, "labels"), "doc_id")


@query("""
with d as (select doc_id from documents where lang <> 'fr'), l as (select doc_id from labels)
select coalesce(d.doc_id, l.doc_id) as id, case when l.doc_id is null then 'missing' when d.doc_id is null then 'extra' else 'matched' end as status
from d full outer join l on d.doc_id = l.doc_id
""")
def reconcile_status(spark, sf_dir):
    from siltstone.operators.keys import reconcile

    return reconcile(_t(spark, sf_dir, "documents").where("lang <> 'fr'"), _t(spark, sf_dir, "labels"), "doc_id").withColumnRenamed("doc_id", "id")


@query("""
select source, sum(case when quality = 1 then 1 else 0 end)::BIGINT as n_pass, sum(case when quality = 0 then 1 else 0 end)::BIGINT as n_fail, count(quality) as total,
  case when count(quality) > 0 then sum(case when quality = 1 then 1 else 0 end) / count(quality)::DOUBLE end as rate
from documents left join labels using (doc_id) group by source
""")
def category_rates(spark, sf_dir):
    from siltstone.operators.metrics import tri_state_rates

    d = _t(spark, sf_dir, "documents").select("doc_id", "source").join(_t(spark, sf_dir, "labels"), "doc_id", "left")
    return tri_state_rates(d.withColumn("ok", F.col("quality") == 1), "source", "ok")


@query("""
with a as (select user_id, event_type, max(value) > 50 p from events where event_id % 2 = 0 group by 1, 2), b as (select user_id, event_type, max(value) > 50 p from events where event_id % 2 = 1 group by 1, 2)
select case when b.p then 'improvement' else 'regression' end as kind, count(*) as n from a join b using (user_id, event_type) where a.p <> b.p group by 1
""")
def improvements_regressions(spark, sf_dir):
    from siltstone.operators.metrics import changes

    e = _t(spark, sf_dir, "events")
    run = lambda k: e.where(f"event_id % 2 = {k}").groupBy("user_id", "event_type").agg((F.max("value") > 50).alias("passed"))
    return changes(run(0), run(1), ["user_id", "event_type"], "passed").groupBy("kind").agg(F.count("*").alias("n"))


@query("""
with u as (select distinct event_type, user_id from events)
select a.event_type as left_type, b.event_type as right_type, count(*) as shared from u a join u b using (user_id) group by 1, 2
""")
def pairwise_overlap(spark, sf_dir):
    from siltstone.plans.evaluate import compare_runs

    return compare_runs(_runs(spark, sf_dir))["pairs"].toDF("left_type", "right_type", "shared")


def _runs(spark, sf_dir) -> DataFrame:
    """Event types as runs, users as ids, and their mean value as score."""
    e = _t(spark, sf_dir, "events")
    return e.groupBy(F.col("event_type").alias("run"), F.col("user_id").alias("id")).agg(F.avg("value").alias("score"))


@query("""
with r as (select distinct o_orderpriority run, o_custkey id from orders), a as (select distinct id from r), k as (select distinct run from r)
select k.run, a.id from k cross join a where not exists (select 1 from r where r.run = k.run and r.id = a.id)
""")
def missing_by_run(spark, sf_dir):
    """Order priorities as runs, customers as ids."""
    from siltstone.plans.evaluate import compare_runs

    orders = _t(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("run"), F.col("o_custkey").alias("id")).agg(F.avg("o_totalprice").cast("double").alias("score"))
    return compare_runs(orders)["missing"]


@query("""
with m as (select user_id, event_type, avg(value) v from events group by 1, 2)
select user_id, max(v) - min(v) as spread, count(*) as n_runs from m group by user_id having count(*) > 1 order by spread desc, user_id limit 20
""")
def score_spread(spark, sf_dir):
    from siltstone.plans.evaluate import compare_runs

    return compare_runs(_runs(spark, sf_dir))["spread"].toDF("user_id", "spread", "n_runs")


@query("select doc_id as id, quality - toxic as score from documents join labels using (doc_id) order by score, doc_id limit 10")
def weakest_rows(spark, sf_dir):
    from siltstone.plans.evaluate import weakest

    return weakest(_scored(spark, sf_dir).select(F.col("doc_id").alias("id"), (F.col("quality") - F.col("toxic")).alias("score")))


@query("""
select source as run, avg(quality) as mean, sum(toxic)::BIGINT as failures from documents join labels using (doc_id) group by source
""")
def leaderboard(spark, sf_dir):
    from siltstone.plans import evaluate

    return evaluate.leaderboard(_scored(spark, sf_dir).select(F.col("source").alias("run"), F.col("quality").alias("score"), F.col("toxic").alias("failures")))


@query("""
with m as (select avg(quality) as mean_quality, avg(toxic) as mean_toxic from labels)
select 'mean_quality' as gate, mean_quality as value, mean_quality >= 0.8 as passed from m union all select 'mean_toxic', mean_toxic, mean_toxic <= 0.05 from m
""")
def acceptance_gates(spark, sf_dir):
    from siltstone.operators.metrics import gates

    m = _t(spark, sf_dir, "labels").agg(F.avg("quality").alias("mean_quality"), F.avg("toxic").alias("mean_toxic"))
    return gates(m, {"mean_quality": (">=", 0.8), "mean_toxic": ("<=", 0.05)})


@query("""
select doc_id, (case when lang = 'en' then 2 else 0 end + case when n_chars > 2000 then 3 else 0 end + case when text like '%?%' then 1 else 0 end + case when source in ('src1', 'src2') then 4 else 0 end)::INT as score
from documents order by score desc, doc_id limit 20
""")
def selection_score_topk(spark, sf_dir):
    add = lambda c, k: F.when(c, k).otherwise(0)
    score = add(F.col("lang") == "en", 2) + add(F.col("n_chars") > 2000, 3) + add(F.col("text").contains("?"), 1) + add(F.col("source").isin("src1", "src2"), 4)
    return _t(spark, sf_dir, "documents").select("doc_id", score.alias("score")).orderBy(F.desc("score"), "doc_id").limit(20)


@query("""
select source, doc_id from (select source, doc_id, row_number() over (partition by source order by sha256('11:' || source || ':' || doc_id), doc_id) n from documents) where n <= 3
""")
def hash_ranked_sample(spark, sf_dir):
    from siltstone.operators.split import hash_sample

    return hash_sample(_t(spark, sf_dir, "documents").select("source", "doc_id"), "source", "doc_id", 3, 11)


@query("""
with s as (select doc_id, row_number() over (order by doc_id) - 1 as r from documents order by doc_id limit 300 offset 20)
select (r - 20) // 25 as batch_index, count(*) as n_rows, min(doc_id) as first_id, max(doc_id) as last_id from s group by 1
""")
def batch_windows(spark, sf_dir):
    from siltstone.operators.split import batches

    b = batches(_t(spark, sf_dir, "documents").select("doc_id"), "doc_id", size=25, start=20, limit=300)
    return b.groupBy("batch_index").agg(F.count("*").alias("n_rows"), F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))


_TIER = "case lang when 'en' then 0 when 'de' then 1 else 2 end"


@query(f"""
with r as (select sha256(text) fp, doc_id, {_TIER} as tier, row_number() over (partition by sha256(text) order by {_TIER}, doc_id) n, count(*) over (partition by sha256(text)) c from documents)
select fp, doc_id, tier, n = 1 as kept from r where c > 1
""")
def priority_dedup(spark, sf_dir):
    from siltstone.operators.keys import tag_best

    d = _t(spark, sf_dir, "documents").select(F.sha2("text", 256).alias("fp"), "doc_id", F.expr(_TIER).alias("tier"))
    return tag_best(d, "fp", ["tier", "doc_id"]).where("size > 1").select("fp", "doc_id", "tier", "kept")


@query("select doc_id from documents where lang = 'de' and doc_id not in (select doc_id from labels)")
def resume_pending(spark, sf_dir):
    from siltstone.operators.keys import pending

    return pending(_t(spark, sf_dir, "documents").where("lang = 'de'").select("doc_id"), _t(spark, sf_dir, "labels"), "doc_id")


@query("""
select doc_id, regexp_matches(lower(text), 'licen[cs]e') as licence, regexp_matches(lower(text), 'permission') as permission,
  regexp_matches(lower(text), 'licen[cs]e[^.\n]{0,50}permission|permission[^.\n]{0,50}licen[cs]e') as both_near from documents
""")
def claim_phrase_flags(spark, sf_dir):
    t = F.lower("text")
    near = "licen[cs]e[^.\n]{0,50}permission|permission[^.\n]{0,50}licen[cs]e"
    return _t(spark, sf_dir, "documents").select("doc_id", t.rlike("licen[cs]e").alias("licence"), t.rlike("permission").alias("permission"), t.rlike(near).alias("both_near"))


@query("select doc_id, sha256(regexp_replace(text, '(the|that) (of|and|or|in)', 'it', 'g')) as fp from documents")
def hedge_rewrite(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", F.sha2(F.regexp_replace("text", "(the|that) (of|and|or|in)", "it"), 256).alias("fp"))


@query("select doc_id, len(regexp_extract_all(text, '[A-Z][a-z]+'))::INT as n_tokens from documents")
def token_counts(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", F.size(F.regexp_extract_all("text", F.lit("[A-Z][a-z]+"), 0)).alias("n_tokens"))


def _family_sql() -> str:
    """DuckDB's word boundary knows ASCII letters only, so that of other letters is spelled out."""
    import re

    from siltstone.functions.rtl import FAMILIES

    edge = r"[^\p{L}\p{N}_]"
    spelled = lambda p: re.sub(r"\\b(.+?)\\b", lambda m: f"(?:^|{edge}){m[1]}(?:{edge}|$)", p)
    return "case " + " ".join(f"when regexp_matches(lower(text), '{spelled(p)}') then '{k}'" for k, p in FAMILIES) + " else 'general_rtl' end"


@query(f"select {_family_sql()} as family, count(*) as n from documents group by 1")
def family_classifier(spark, sf_dir):
    from siltstone.functions.rtl import design_family

    return _t(spark, sf_dir, "documents").groupBy(design_family(F.coalesce("text", F.lit(""))).alias("family")).agg(F.count("*").alias("n"))


@query("""
with p as (select doc_id, regexp_replace(regexp_replace(text, '[ \t\n\x0b\f\r]+', ' ', 'g'), '^ | $', '', 'g') t from documents)
select doc_id, sha256(substr(t, 1, 120) || case when length(t) > 120 then '...' else '' end) as preview from p
""")
def whitespace_preview(spark, sf_dir):
    from siltstone.functions.rtl import preview

    return _t(spark, sf_dir, "documents").select("doc_id", F.sha2(preview(F.col("text")), 256).alias("preview"))


@query("select event_id, json_extract_string(props, '$.k') as k from events")
def json_field(spark, sf_dir):
    from siltstone.functions.variant import Node

    e = _t(spark, sf_dir, "events").withColumn("v", F.try_parse_json("props"))
    return e.select("event_id", Node("v")["k"].as_("string").alias("k"))


@query("select doc_id, item_id from documents join benchmark on instr(documents.text, benchmark.text) > 0")
def contained_passages(spark, sf_dir):
    from siltstone.operators.duplicates import contained

    return contained(_t(spark, sf_dir, "documents"), _t(spark, sf_dir, "benchmark"), "doc_id", "item_id")


@query("""
select 'line_without_order' as kind, l_orderkey as key from lineitem where l_orderkey not in (select o_orderkey from orders)
union select 'order_without_line', o_orderkey from orders where o_orderkey not in (select l_orderkey from lineitem)
""")
def orphan_references(spark, sf_dir):
    """Keys of one table that the other lacks: one aggregation over the keys of both, dealt before it so that a task has about ``KEYS`` rows, however many there are."""
    lines, orders = _t(spark, sf_dir, "lineitem"), _t(spark, sf_dir, "orders")
    keys = lines.select(F.col("l_orderkey").alias("key"), F.lit(True).alias("line")).union(orders.select("o_orderkey", F.lit(False))).where("key IS NOT NULL")
    n = 1 + (lines.count() + orders.count()) // KEYS  # from the files' footers
    both = keys.repartition(n, "key").groupBy("key").agg(F.min("line").alias("all"), F.max("line").alias("some")).where("all = some")
    return both.select(F.when(F.col("some"), "line_without_order").otherwise("order_without_line").alias("kind"), "key")


@query("""
with n as (select source, count(*) n from documents group by source),
p as (select source, n, split, r, floor(n * r / 100)::BIGINT f, (n * r) % 100 rem, o from n cross join (values ('train', 70, 0), ('val', 15, 1), ('test', 15, 2)) t(split, r, o)),
q as (select *, n - sum(f) over (partition by source) short, row_number() over (partition by source order by rem desc, o) k from p)
select source, split, (f + case when k <= short then 1 else 0 end)::BIGINT as n_rows from q
""")
def ratio_split_sizes(spark, sf_dir):
    from siltstone.operators.split import largest_remainder

    n = _t(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("n"))
    return largest_remainder(n, "n", [("train", 70), ("val", 15), ("test", 15)]).select("source", "split", "n_rows")


@query()
def near_duplicate_pairs(spark, sf_dir):
    """Pairs of benchmark items whose texts match to 0.95."""
    from siltstone.operators.near import near_pairs

    return near_pairs(_t(spark, sf_dir, "benchmark"), "item_id", "text", 0.95)


@query("select doc_id, sha256(regexp_replace(text, '\\bthe\\b', 'this')) as fp from documents where regexp_matches(text, '\\bthe\\b')")
def first_match_mutation(spark, sf_dir):
    """The first 'the' of each document changed, by hash of the result; documents without one are left out."""
    from siltstone.operators.mutate import first_edit

    changed = first_edit(F.col("text"), r"\bthe\b", F.lit("this"))
    return _t(spark, sf_dir, "documents").where(changed.isNotNull()).select("doc_id", F.sha2(changed, 256).alias("fp"))


@query("select event_id, sha256(json(props)) as fp from events")
def canonical_json_hash(spark, sf_dir):
    from siltstone.functions.json_text import canonical_sha256

    return _t(spark, sf_dir, "events").select("event_id", canonical_sha256("props").alias("fp"))


@query("""
select event_id, case event_id % 3 when 0 then 'parsed_json' when 1 then 'extracted_json' else 'parse_failed' end as status, case when event_id % 3 < 2 then json(props)::VARCHAR end as answer from events
""")
def lenient_json(spark, sf_dir):
    """Model outputs made of the events' properties: alone, within other text, and as a list."""
    from siltstone.functions.json_text import parsed_output

    kind = F.col("event_id") % 3
    text = F.when(kind == 0, F.col("props")).when(kind == 1, F.concat(F.lit("Here {is} it:\n"), "props", F.lit("\ndone"))).otherwise(F.concat(F.lit("["), "props", F.lit("]")))
    return _t(spark, sf_dir, "events").select("event_id", parsed_output(text).alias("p")).select("event_id", "p.status", "p.answer")


from siltstone.plans import operator_queries  # noqa: E402

QUERIES |= operator_queries.QUERIES
SQL |= operator_queries.SQL
