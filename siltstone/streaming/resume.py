"""Resumable work: keyed tasks that are taken once, over batches or streams of requests."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.operators.keys import pending


def run_once(spark: SparkSession, requests: DataFrame, done_path: str, key: str, work: Callable[[DataFrame], DataFrame]) -> int:
    """Do the requests whose key is not in ``done_path`` yet and append their results; returns how many.

    A second call with the same requests does nothing, so a run that was broken off goes on where it was.
    """
    try:
        done = spark.read.parquet(done_path)
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error) and "UNABLE_TO_INFER_SCHEMA" not in str(error):
            raise
        done = spark.createDataFrame([], f"`{key}` {requests.schema[key].dataType.simpleString()}")
    todo = pending(requests.dropDuplicates([key]), done.select(key), key)
    result = work(todo)
    result.write.mode("append").parquet(done_path)
    return spark.read.parquet(done_path).select(key).distinct().count()


def stream_once(requests: DataFrame, done_path: str, checkpoint: str, key: str, work: Callable[[DataFrame], DataFrame]):
    """The same over a stream: each micro-batch leaves out keys with results, so replays add nothing."""

    def step(batch: DataFrame, _: int) -> None:
        run_once(batch.sparkSession, batch, done_path, key, work)

    return requests.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, time: str, by: str, width: str, late: str) -> DataFrame:
    """Counts per window and group with a watermark, for streams or tables."""
    return events.withWatermark(time, late).groupBy(F.window(time, width), by).agg(F.count("*").alias("n")).select("window.start", "window.end", by, "n")
