"""Intermediate tables in the folder that the driver and every executor share.

The folder is the one the cluster names in ``spark.checkpoint.dir``. Only where that setting is
missing (tests, a laptop) does the session get a folder of its own. A written table cuts the lineage,
survives lost executors and gives the optimizer a true size.
"""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Bytes of one batch of rows that goes to a Python worker, where the session leaves Spark's default of 64 MB.
BATCH_BYTES = "4m"
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
_made: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of this session."""
    try:
        found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    except Exception as error:  # a session without a SparkContext
        raise RuntimeError("no SparkContext to read spark.checkpoint.dir from") from error
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file:///tmp/checkpoints"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


class Scratch:
    """A folder for the tables of one operator call."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        if spark.conf.get(_BATCH) in ("64m", "64MB", "67108864", "67108864b"):
            spark.conf.set(_BATCH, BATCH_BYTES)  # a batch of whole texts has to fit beside the heap
        self.path = f"{shared_dir(spark)}/siltstone-{name}-{uuid.uuid4().hex[:12]}"
        _made.append((spark, self.path))

    def save(self, frame: DataFrame, name: str) -> DataFrame:
        """Write ``frame`` as Parquet and read it again."""
        target = f"{self.path}/{name}"
        frame.write.mode("overwrite").parquet(target)
        return self.spark.read.schema(frame.schema).parquet(target)

    def drop(self, name: str = "") -> None:
        """Delete one table, or all of them."""
        _delete(self.spark, f"{self.path}/{name}" if name else self.path)


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@atexit.register
def _clean() -> None:
    for spark, path in _made:
        try:
            if spark.sparkContext._jsc is not None:
                _delete(spark, path)
        except Exception:  # the session has ended; its folder goes with it
            continue
