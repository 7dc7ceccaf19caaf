"""Finalisation of a reviewed batch in stages: readiness, promotion, release, baseline candidates, evaluation.

A stage writes into a folder of its own beside its place and is moved there when it is whole, with a note of what it was
made from: the digests of the inputs, the parameters, and the stages before. A run that stops at a stage leaves what was done before
it, and the next run goes on from there; a stage whose inputs have changed, and all after it, are done anew.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from hashlib import sha256

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from siltstone.functions.variant import Node
from siltstone.operators import baseline, dataset_rules, review
from siltstone.plans import evaluate, release
from siltstone.scratch import Scratch
from siltstone.sources import jsonl, sinks

NOTE = "stage.json"


class Stopped(Exception):
    """A stage that does not pass: its messages."""


@dataclass
class Finalization:
    ok: bool = True
    done: dict[str, dict] = field(default_factory=dict)
    reused: list[str] = field(default_factory=list)
    errors: list[str] = field(default_factory=list)


def digest(spark: SparkSession, path: str) -> str:
    """SHA-256 of a file's bytes, read by the driver's JVM; "" if there is none."""
    store, target = jsonl._fs(spark, path)
    if not store.exists(target):
        return ""
    jvm = spark.sparkContext._jvm
    found = jvm.java.security.MessageDigest.getInstance("SHA-256")
    source = jvm.java.security.DigestInputStream(store.open(target), found)
    try:
        jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, jvm.java.io.OutputStream.nullOutputStream(), 1 << 16, False)
    finally:
        source.close()
    return bytes(found.digest()).hex()


def _note(spark: SparkSession, folder: str) -> dict:
    path = f"{folder}/{NOTE}"
    return json.loads(spark.read.text(path, wholetext=True).first()[0]) if jsonl._exists(spark, path) else {}


def run_stages(spark: SparkSession, output: str, stages: list[tuple[str, Callable[[str, dict], dict]]], made_from: str, force: bool = False) -> Finalization:
    """Run (name, work) in order. ``work(folder, done)`` writes into a folder and returns what it found; ``Stopped`` ends the run."""
    result, output = Finalization(), output.rstrip("/")
    store, _ = sinks._store(spark, output)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for name, work in stages:
        made_from = sha256(f"{made_from}\0{name}".encode()).hexdigest()
        place = f"{output}/{name}"
        note = {} if force else _note(spark, place)
        if note.get("made_from") == made_from:
            result.done[name] = note["found"]
            result.reused.append(name)
            continue
        force = True  # what follows a stage that is done anew is done anew
        spare = f"{output}/.{name}-{uuid.uuid4().hex}"
        store.mkdirs(path(spare))
        try:
            found = work(spare, result.done)
            sinks.write_text(spark, f"{spare}/{NOTE}", [json.dumps({"made_from": made_from, "found": found}, sort_keys=True) + "\n"])
            store.delete(path(place), True)
            if not store.rename(path(spare), path(place)):
                raise OSError(f"could not move {spare} to {place}")
        except Stopped as error:
            result.ok = False
            result.errors = [f"{name}: {x}" for x in error.args]
            for later, _ in stages[[n for n, _ in stages].index(name) :]:  # outputs of older inputs are no outputs of these
                store.delete(path(f"{output}/{later}"), True)
            break
        finally:
            store.delete(path(spare), True)
        result.done[name] = found
    summary = {"ok": result.ok, "stages": result.done, "errors": result.errors}
    sinks.write_text(spark, f"{output}/summary.json", [json.dumps(summary, indent=2, sort_keys=True) + "\n"])
    return result


def finalize_batch(spark: SparkSession, selected: str, reviewed: str, golden: str, output: str, seed: int = 7, allow_source_overlap: bool = False, force: bool = False) -> Finalization:
    """Take a reviewed batch to an evaluated release below ``output``; a missing input, or an output among the inputs, stops it before anything is written."""
    inputs = {"selected": selected, "reviewed": reviewed, "golden": golden}
    wrong = [f"{k} not found: {p}" for k, p in inputs.items() if not jsonl._exists(spark, p)]
    wrong += [f"{k} lies in the output folder: {p}" for k, p in inputs.items() if p.startswith(output.rstrip("/") + "/")]
    if wrong:
        return Finalization(False, errors=wrong)
    scratch = Scratch(spark, "finalize")
    read = lambda p: jsonl.rows(jsonl.scan(spark, p))

    def readiness(folder: str, done: dict) -> dict:
        asked, given = jsonl.scan(spark, selected), jsonl.scan(spark, reviewed)
        ids, risks = review.readiness(jsonl.rows(asked), jsonl.rows(given))
        open_ = ids.where("status <> 'matched'").union(risks.select("id", "rule")).union(jsonl.rows(given).where(review.is_stub()).select(review.ROW["id"].text(), F.lit("stub")))
        open_ = open_.union(dataset_rules.validate(given).where("severity = 'error'").select("row_id", "rule")).toDF("id", "why")
        open_ = scratch.save(open_, f"open-{uuid.uuid4().hex}")
        sinks.write_ordered(open_.select("id", "why", F.to_json(F.struct("id", "why")).alias("raw")), f"{folder}/open.jsonl", ["id", "why"], scratch)
        n = open_.count()
        if n:
            raise Stopped(f"not all rows are ready: {n} findings; no rows were promoted")
        return {"ready_rows": jsonl.rows(given).count()}

    def promotion(folder: str, done: dict) -> dict:
        good, bad = review.promote(read(reviewed))
        rejected = [f"{r.line}: {r.reason}: {', '.join(r.problems)}" for r in bad.orderBy("line").collect()]
        if rejected:
            raise Stopped("strict promotion failed", *rejected)
        target = f"{folder}/promoted.jsonl"
        kept = sinks.write_ordered(good, target, ["file_ord", "line"], scratch)
        found = dataset_rules.validate(jsonl.scan(spark, target)).collect()
        if found:
            raise Stopped("promoted rows break rules", *[f"{r.line} {r.rule} {r.field}" for r in found])
        return {"accepted_rows": kept["rows"], "rejected_rows": 0}

    def released(folder: str, done: dict) -> dict:
        made = release.build_release(spark, [golden, f"{output.rstrip('/')}/promotion/promoted.jsonl"], folder, seed=seed, allow_source_overlap=allow_source_overlap, force=True)
        if not made.ok:
            raise Stopped("release assembly failed", *made.errors)
        return {"accepted_rows": made.accepted_rows} | made.counts

    def candidates(folder: str, done: dict) -> dict:
        made = baseline.answers(read(f"{output.rstrip('/')}/release/test.jsonl"))
        kept = sinks.write_ordered(made.select("id", F.to_json(F.struct("id", "answer")).alias("raw")), f"{folder}/candidates.jsonl", ["id"], scratch)
        return {"candidates": kept["rows"]}

    def evaluation(folder: str, done: dict) -> dict:
        rows = read(f"{output.rstrip('/')}/release/test.jsonl").select(Node("v")["id"].text().alias("id"), "v")
        given, bad = evaluate.load_candidates(jsonl.scan(spark, f"{output.rstrip('/')}/candidates/candidates.jsonl"))
        found = evaluate.evaluate(rows, given)
        if bad.count() or found["missing"].count() or found["extra"].count():
            raise Stopped("candidates and test rows do not match")
        results = scratch.save(found["results"].select("id", "score", "failures"), f"results-{uuid.uuid4().hex}")
        sinks.write_ordered(results.select("id", F.to_json(F.struct("id", "score", "failures")).alias("raw")), f"{folder}/results.jsonl", ["id"], scratch)
        m = results.agg(F.count("*").alias("n"), F.coalesce(F.round(F.avg("score"), 6), F.lit(0.0)).alias("mean"), F.coalesce(F.sum("failures"), F.lit(0)).alias("failures")).first()
        return {"rows_evaluated": m.n, "mean_score": m["mean"], "safety_failures": int(m.failures)}

    made_from = json.dumps({k: digest(spark, p) for k, p in inputs.items()} | {"seed": seed, "allow_source_overlap": allow_source_overlap}, sort_keys=True)
    stages = [("readiness", readiness), ("promotion", promotion), ("release", released), ("candidates", candidates), ("evaluation", evaluation)]
    return run_stages(spark, output, stages, made_from, force)
