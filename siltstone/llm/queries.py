"""Driver queries of the operators in this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from siltstone.llm.sql import SQL  # noqa: F401


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltstone.llm.minhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"op1_minhash": op1_minhash}


def op2_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltstone.llm.html import extract

    return extract(table(spark, sf_dir, "pages"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltstone.llm.warc import round_trip

    return round_trip(table(spark, sf_dir, "pages")).drop("n_segments")


def op6_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltstone.llm.rules import apply

    return apply(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES |= {"op2_html": op2_html, "op3_warc": op3_warc, "op6_rules": op6_rules}


def op4_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltstone.llm.substring import remove_repeats

    return remove_repeats(table(spark, sf_dir, "documents"))


QUERIES |= {"op4_substring": op4_substring}


def op10_ngram(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltstone.llm.ngram import score

    return score(table(spark, sf_dir, "documents"))


QUERIES |= {"op10_ngram": op10_ngram}


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from siltstone.llm.decontaminate import overlaps

    return overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).withColumn("contaminated", F.lit(True))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltstone.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"))


QUERIES |= {"op7_decontaminate": op7_decontaminate, "op9_packing": op9_packing}


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltstone.llm.quality import score

    return score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltstone.llm.toxicity import score

    return score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES |= {"op5_quality": op5_quality, "op8_toxicity": op8_toxicity}


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltstone.llm.whitening import whiten

    return whiten(table(spark, sf_dir, "embeddings"))


def op12_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltstone.llm.periodic import find_runs

    return find_runs(table(spark, sf_dir, "documents"), rewrite=True).drop("runs")


def op13_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltstone.llm.token_counts import token_counts

    return token_counts(table(spark, sf_dir, "documents"))


QUERIES |= {"op11_whitening": op11_whitening, "op12_periodic": op12_periodic, "op13_tokens": op13_tokens}
