"""Fine-tuning sets: checks of the three split files, and their export in the canonical schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone import vocab as V
from siltstone.functions.json_text import dumped_length
from siltstone.functions.variant import Node, replaced
from siltstone.operators.rules import Rule, violations
from siltstone.sources import jsonl

FILES = ("train.jsonl", "validation.jsonl", "test.jsonl")
MISSING = "<missing>"


def load_splits(spark: SparkSession, folder: str) -> DataFrame:
    """SRC-27: a scan of the three files, with ``split``; a file that is not there is a problem row."""
    found = jsonl.scan(spark, [f"{folder.rstrip('/')}/{f}" for f in FILES])
    return found.withColumn("split", F.element_at(F.array(*[F.lit(f.split(".")[0]) for f in FILES]), F.col("file_ord") + 1))


def rules(golden: bool = False) -> list[Rule]:
    """FTC-1: each row has three messages in the roles' order, whose contents have their types and schemas."""
    v, good, r = Node("v"), F.col("problem").isNull(), []
    m = v["messages"]
    whole = good & m.is_list() & (F.size(m.items()) == 3)

    def add(rule, field, when, guard=good):
        r.append(Rule(rule, field, "error", when, None, guard))

    add("file", "", F.col("problem").isNotNull(), None)
    if not golden:
        add("approved", "approval_status", v["approval_status"].isin(["approved"]))
    add("messages", "messages", ~m.is_list())
    add("three_messages", "messages[3_exact]", m.is_list() & (F.size(m.items()) != 3))
    for k, role in enumerate(V.ROLES):
        add("message", f"messages[{k}]", ~m[k].is_object(), whole)
        add("role", f"messages[{k}].role", m[k].is_object() & ~m[k]["role"].isin([role]), whole)
        add("content", f"messages[{k}].content", m[k].is_object() & m[k]["content"].absent(), whole)
    shaped = whole & m[0].is_object() & m[1].is_object() & m[2].is_object()
    add("type", "messages[0].content", m[0]["content"].present() & ~m[0]["content"].is_text(), shaped)
    for k, known in ((1, V.TASK_SCHEMA), (2, V.ANSWER_SCHEMA)):
        c = m[k]["content"]
        add("type", f"messages[{k}].content", c.present() & ~c.is_object(), shaped)
        add("schema", f"messages[{k}].content.schema_version", c.is_object() & ~c["schema_version"].isin(known), shaped)
    return r


def check(loaded: DataFrame, golden: bool = False) -> DataFrame:
    """(split, line, id, rule, field) of everything wrong."""
    named = loaded.withColumn("id", F.coalesce(Node("v")["id"].text(), F.concat(F.lit("line_"), F.col("line").cast("string"))))
    return violations(named, rules(golden), ["split", "line", "id"]).select("split", "line", "id", "rule", "field")


def missing_fields(problems: DataFrame) -> DataFrame:
    """Counts of the fields that are missing or wrong."""
    return problems.where("field <> ''").groupBy("field").agg(F.count("*").alias("n"))


def distributions(loaded: DataFrame) -> DataFrame:
    """(field, value, n) of source, review and approval status, in one pass."""
    v = Node("v")
    each = F.array(*[F.struct(F.lit(f).alias("field"), F.when(v[f].absent(), MISSING).otherwise(F.coalesce(v[f].text(), v[f].json())).alias("value")) for f in ("source", "review_status", "approval_status")])
    return loaded.where("problem IS NULL").select(F.inline(each)).groupBy("field", "value").agg(F.count("*").alias("n"))


def aliases(loaded: DataFrame) -> DataFrame:
    """(role, version, n) of schema versions that are no canonical ones."""
    m = Node("v")["messages"]
    each = F.array(*[F.struct(F.lit(role).alias("role"), m[k]["content"]["schema_version"].text().alias("version")) for k, role in ((1, "user"), (2, "assistant"))])
    odd = F.col("version").isin(V.TASK_SCHEMA[1], V.ANSWER_SCHEMA[1])
    return loaded.where("problem IS NULL").select(F.inline(each)).where(odd).groupBy("role", "version").agg(F.count("*").alias("n"))


def lengths(loaded: DataFrame) -> DataFrame:
    """AGG-14: (split, n, mean, longest) characters of a row's messages, and a row for all of them (split null)."""
    m = Node("v")["messages"]
    rows = loaded.where("problem IS NULL").where(m.is_list())
    # the contents of a row go to Python as one column each; an absent one counts nothing
    n = sum((F.coalesce(dumped_length(F.when(m[k]["content"].present(), F.to_json(m[k]["content"].value))), F.lit(0)) for k in range(3)), F.lit(0))
    return rows.select("split", n.alias("chars")).rollup("split").agg(F.count("*").alias("n"), F.round(F.avg("chars"), 2).alias("mean"), F.max("chars").alias("longest"))


def canonical_rows(loaded: DataFrame, golden: bool = False) -> tuple[DataFrame, DataFrame]:
    """PRJ-18: (rows, problems). rows: split, line, changed and raw, the row's JSON with canonical schema versions."""
    v = Node("v")
    problems = check(loaded, golden)
    bad = problems.select("split", "line").distinct()
    good = loaded.where("problem IS NULL").join(bad, ["split", "line"], "left_anti")
    m, other = v["messages"], F.lit(False)
    parts = [m[0].json()]
    for k, name in ((1, V.TASK_SCHEMA[0]), (2, V.ANSWER_SCHEMA[0])):
        content = m[k]["content"]
        other = other | ~content["schema_version"].isin([name])
        parts.append(replaced(m[k], {"content": replaced(content, {"schema_version": F.lit(f'"{name}"')})}))
    raw = replaced(v, {"messages": F.concat(F.lit("["), F.concat_ws(",", *parts), F.lit("]"))})
    return good.select("split", "line", other.alias("changed"), F.when(other, raw).otherwise(F.col("raw")).alias("raw")), problems


def chat_messages(rows: DataFrame) -> DataFrame:
    """PRJ-19: (role, content) of each message, structured contents as canonical JSON."""
    content = lambda x: F.coalesce(F.when(F.schema_of_variant(F.try_variant_get(x, "$.content", "variant")) == "STRING", F.try_variant_get(x, "$.content", "string")), F.to_json(F.try_variant_get(x, "$.content", "variant")))
    each = F.transform(Node("v")["messages"].items(), lambda x: F.struct(F.try_variant_get(x, "$.role", "string").alias("role"), content(x).alias("content")))
    return rows.withColumn("chat", each)
