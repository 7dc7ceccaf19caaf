from difflib import SequenceMatcher

from pyspark.sql import functions as F

from siltstone.operators.near import near_pairs
from siltstone.streaming.resume import run_once, stream_once

SF = "/root/testdata/sf0.001"


def test_near_pairs_match_brute_force(spark):
    texts = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").limit(12).collect()]
    rows = [(k, t) for k, t in enumerate(texts)] + [(20 + k, t[: len(t) // 2] + "x" + t[len(t) // 2 :]) for k, t in enumerate(texts)] + [(50, None), (51, ""), (52, "")]
    got = {(r.left_id, r.right_id) for r in near_pairs(spark.createDataFrame(rows, "id long, t string"), "id", "t", 0.9).collect()}
    good = [(i, t) for i, t in rows if t is not None]
    want = {(i, j) for i, a in good for j, b in good if i < j and SequenceMatcher(None, a, b).ratio() >= 0.9}
    assert got == want and len(want) >= 12


def test_run_once_resumes(spark, tmp_path):
    d = spark.range(10).withColumnRenamed("id", "k")
    work = lambda x: x.withColumn("v", F.col("k") * 2)
    path = str(tmp_path / "done")
    assert run_once(spark, d.where("k < 4"), path, "k", work) == 4
    assert run_once(spark, d, path, "k", work) == 10
    assert run_once(spark, d, path, "k", work) == 10
    assert spark.read.parquet(path).count() == 10


def test_stream_adds_each_key_once(spark, tmp_path):
    src = str(tmp_path / "src")
    spark.range(6).withColumnRenamed("id", "k").write.parquet(src)
    for c in ("a", "b"):  # a lost checkpoint replays the source
        q = stream_once(spark.readStream.schema("k long").parquet(src), str(tmp_path / "out"), str(tmp_path / c), "k", lambda x: x)
        q.awaitTermination(60)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 6
