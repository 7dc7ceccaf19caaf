"""Keyed work with bounded attempts over batches and streams: every call is counted, results come once, failures are rows.

A batch first writes what it is about to try (its intents), then calls, then writes its results whole. A batch that
runs again after a crash finds its results and calls nothing, or finds none and tries again; the intents of
the run that died still count, so a row that kills its worker is not tried for ever.

    path/intents/batch=B/run=R   rows that run R of batch B set out to try, with the number of the attempt
    path/results/batch=B         the same rows with ok, result and error; there only when whole
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import BooleanType, IntegerType, StringType, StructField, StructType

from siltstone.sources.jsonl import _exists

Call = Callable[[dict], str]
RESULT = [StructField("attempt", IntegerType()), StructField("ok", BooleanType()), StructField("result", StringType()), StructField("error", StringType())]


def _read(spark: SparkSession, path: str, columns: StructType) -> DataFrame:
    """A table of parts, empty if there is none yet."""
    if not _exists(spark, path):
        return spark.createDataFrame([], columns)
    return spark.read.schema(columns).option("recursiveFileLookup", "true").parquet(path)


def _kept(rows: StructType, *more: StructField) -> StructType:
    return StructType([StructField(f.name, f.dataType) for f in rows.fields if f.name not in {m.name for m in more}] + list(more))


def attempt(rows: DataFrame, path: str, batch: str, key: str, call: Call, most: int = 3) -> None:
    """Try each key of ``rows`` that has no result yet, and each that failed before, at most ``most`` times in all.

    ``call`` gets a row as a dict and returns a text; what it raises is kept as the row's error. Rows with
    a null key are left out; of rows with one key any is tried. ``batch`` names this piece of work: the same name again
    does nothing once its results are whole.
    """
    if most < 1:
        raise ValueError("most must be at least 1")
    spark, target = rows.sparkSession, f"{path}/results/batch={batch}"
    if _exists(spark, f"{target}/_SUCCESS"):
        return
    plain = _kept(rows.schema, *RESULT)
    names = [f.name for f in plain.fields[: -len(RESULT)]]
    tried = _read(spark, f"{path}/intents", _kept(rows.schema, RESULT[0])).groupBy(key).agg(F.count("*").cast("int").alias("_tried"))
    past = _read(spark, f"{path}/results", plain)
    new = rows.select(names).where(F.col(key).isNotNull()).dropDuplicates([key])
    failed = past.where("NOT ok").select(names).dropDuplicates([key])
    due = new.union(failed.join(new.select(key), key, "left_anti").select(names))
    due = due.join(past.where("ok").select(key).distinct(), key, "left_anti").join(tried, key, "left")
    due = due.withColumn("attempt", F.coalesce("_tried", F.lit(0)) + 1).where(F.col("attempt") <= most).select(*names, F.col("attempt").cast("int"))
    intents = f"{path}/intents/batch={batch}/run={uuid.uuid4().hex}"
    due.write.parquet(intents)
    due = spark.read.schema(_kept(rows.schema, RESULT[0])).parquet(intents)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for row in b[names].to_dict("records"):
                try:
                    out.append((True, call(row), None))
                except Exception as error:  # the row's own failure
                    out.append((False, None, f"{type(error).__name__}: {error}"))
            yield b.assign(ok=[x[0] for x in out], result=pd.Series([x[1] for x in out], dtype=object, index=b.index), error=pd.Series([x[2] for x in out], dtype=object, index=b.index))

    due.mapInPandas(work, plain).write.mode("overwrite").parquet(target)


def stream(rows: DataFrame, path: str, checkpoint: str, key: str, call: Call, most: int = 3) -> StreamingQuery:
    """The same for a stream: a micro-batch is a batch, and takes the failures of those before with it."""

    def each(batch: DataFrame, number: int) -> None:
        attempt(batch, path, f"s{number}", key, call, most)

    return rows.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def drain(spark: SparkSession, schema: StructType, path: str, key: str, call: Call, most: int = 3) -> int:
    """Try again what failed until it succeeds or has had its attempts; the number of rounds."""
    for round_ in range(most):
        if not outcome(spark, schema, path, key).where(~F.col("ok") & (F.col("attempts") < most)).limit(1).count():
            return round_
        attempt(spark.createDataFrame([], schema), path, f"d{uuid.uuid4().hex}", key, call, most)
    return most


def outcome(spark: SparkSession, schema: StructType, path: str, key: str) -> DataFrame:
    """(key, ok, result, error, attempts) of every key tried: its success, else its last failure; ok is null while a run that died has left none."""
    tried = _read(spark, f"{path}/intents", _kept(schema, RESULT[0])).groupBy(key).agg(F.count("*").cast("int").alias("attempts"))
    done = _read(spark, f"{path}/results", _kept(schema, *RESULT))
    best = done.groupBy(key).agg(F.max(F.struct("ok", "attempt", "result", "error")).alias("x")).select(key, "x.ok", "x.result", "x.error")
    return tried.join(best, key, "left").select(key, "ok", "result", "error", "attempts")
