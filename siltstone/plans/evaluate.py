"""Evaluation of candidate answers, and comparison of evaluation runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions.variant import Node, strict_json
from siltstone.operators import keys, scoring
from siltstone.sources import jsonl

# What a run's metrics and a score summary must hold.
METRICS = ("matched_rows", "mean_score", "median_score", "min_score", "max_score", "safety_failures", "error_counts", "score_by_task_type")
SUMMARY = ("category_counts", "row_results", "failures_by_source_id")


def load_candidates(scanned: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(candidates, problems): id, answer, metadata of the first row of each id with an object answer."""
    v = Node("v")
    bad = F.when(F.col("problem").isNotNull(), F.col("problem")).when(~v["id"].filled(), "id must be a non-empty string").when(~v["answer"].is_object(), "answer must be an object")
    rows = scanned.withColumn("id", v["id"].text()).withColumn("bad", bad)
    good = keys.tag_best(rows.where("bad IS NULL"), "id", ["file_ord", "line"])
    problems = rows.where("bad IS NOT NULL").select("line", "bad").union(good.where("NOT kept").select("line", F.concat(F.lit("duplicate id "), "id")))
    return good.where("kept").select("id", v["answer"].value.alias("answer"), v["metadata"].value.alias("metadata")), problems


def evaluate(dataset: DataFrame, candidates: DataFrame) -> dict[str, DataFrame]:
    """Dataset rows (id, v) against candidates (id, answer).

    results: scored matches; missing and extra ids; metrics over the results.
    """
    matched = dataset.join(candidates.select("id", "answer"), "id")
    results = scoring.score_answers(matched)
    return {
        "results": results,
        "missing": keys.pending(dataset.select("id"), candidates, "id"),
        "extra": keys.pending(candidates.select("id"), dataset, "id"),
        "metrics": scoring.summary(results),
    }


def load_objects(spark: SparkSession, paths: list[str], fields: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """(objects, problems) of JSON files that hold one object each: (file, v) and (file, problem).

    A file is missing, malformed or no object, or lacks fields; one that only lacks fields is among the objects too.
    ``fields``: ``METRICS`` for the metrics of a run, ``SUMMARY`` for a score summary.
    """
    here = [p for p in paths if jsonl._exists(spark, p)]
    problems = spark.createDataFrame([(p, "file not found") for p in paths if p not in here], "file string, problem string")
    if not here:
        return spark.createDataFrame([], "file string, v variant"), problems
    read = spark.read.text(here, wholetext=True).select(F.col("_metadata.file_path").alias("file"), strict_json(F.col("value")).alias("v"))
    v = Node("v")
    lacking = F.filter(F.array(*[F.when(v[f].absent(), F.lit(f"missing {f}")) for f in fields]), lambda x: x.isNotNull())
    wrong = F.when(F.col("v").isNull(), F.array(F.lit("malformed JSON"))).when(~v.is_object(), F.array(F.lit("not a JSON object"))).otherwise(lacking)
    return read.where(F.coalesce(v.is_object(), F.lit(False))), problems.union(read.select("file", F.explode(wrong)))


def load_results(scanned: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(results, problems) of a run's row results: (file, id, score, errors, failures) and (file, line, problem)."""
    v = Node("v")
    number = v["score"].kind.rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$")
    bad = F.when(F.col("problem").isNotNull(), F.col("problem")).when(~F.coalesce(v["id"].text() != "", F.lit(False)), "id must be a non-empty string").when(~F.coalesce(number, F.lit(False)), "score must be numeric")
    rows = scanned.withColumn("bad", bad)
    good = rows.where("bad IS NULL").select("file", v["id"].text().alias("id"), v["score"].as_("double").alias("score"), F.size(v["errors"].items()).alias("errors"), F.size(v["safety_failures"].items()).alias("failures"))
    return good, rows.where("bad IS NOT NULL").select("file", "line", F.col("bad").alias("problem"))


def weakest(results: DataFrame, n: int = 10) -> DataFrame:
    return results.orderBy("score", "id").limit(n)


def compare_runs(results: DataFrame) -> dict[str, DataFrame]:
    """results (run, id, score) of several runs: ids missing by run, shared ids by pair, spread by id."""
    present = results.select("run", "id").distinct()
    runs = present.agg(F.sort_array(F.collect_set("run")).alias("runs"))  # a short list of names
    held = present.groupBy("id").agg(F.sort_array(F.collect_set("run")).alias("held"))
    missing = held.join(F.broadcast(runs)).select(F.explode(F.array_except("runs", "held")).alias("run"), "id")
    pairs = held.select(F.explode("held").alias("left_run"), "held").select("left_run", F.explode("held").alias("right_run")).groupBy("left_run", "right_run").agg(F.count("*").alias("shared"))
    spread = results.groupBy("id").agg((F.max("score") - F.min("score")).alias("spread"), F.countDistinct("run").alias("n_runs")).where("n_runs > 1")
    return {"missing": missing, "pairs": pairs, "spread": spread.orderBy(F.desc("spread"), "id").limit(20)}


def leaderboard(results: DataFrame) -> DataFrame:
    """run, mean, failures; best mean first, then fewest failures, then name."""
    return results.groupBy("run").agg(F.coalesce(F.avg("score"), F.lit(0.0)).alias("mean"), F.sum("failures").alias("failures")).orderBy(F.desc("mean"), "failures", "run")
