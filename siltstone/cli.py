"""Command line: each command reads JSON files, runs a plan and writes its tables as JSON lines through Spark.

``python -m siltstone COMMAND --output FOLDER ...`` writes one folder per table below FOLDER and prints a
line of JSON with the numbers of rows. The exit code is 1 where the command finds something wrong.
"""

from __future__ import annotations

import argparse
import json
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions.variant import Node
from siltstone.sources import jsonl

SYSTEM = "You review hardware designs. Use only the artifacts you are given, state what is not known, and never invent tool results."
Tables = dict[str, DataFrame]
COMMANDS: dict[str, tuple[Callable, list[tuple[str, dict]]]] = {}


def command(name: str, *options: tuple[str, dict]):
    """Register a function (spark, args) -> (tables, names of the tables that have to be empty)."""

    def put(f):
        COMMANDS[name] = (f, list(options))
        return f

    return put


def files(name: str) -> tuple[str, dict]:
    return f"--{name}", {"nargs": "+", "required": True}


def several(name: str) -> tuple[str, dict]:
    return f"--{name}", {"nargs": "*", "default": []}


def text(name: str, default=None, **kw) -> tuple[str, dict]:
    return f"--{name}", {"default": default, "required": default is None and "type" not in kw and not kw.get("optional"), **{k: v for k, v in kw.items() if k != "optional"}}


def number(name: str, default) -> tuple[str, dict]:
    return f"--{name}", {"type": type(default) if default is not None else int, "default": default}


def flag(name: str) -> tuple[str, dict]:
    return f"--{name}", {"action": "store_true"}


def _rows(spark, paths) -> DataFrame:
    return jsonl.rows(jsonl.scan(spark, paths))


def _items(spark, paths) -> DataFrame:
    """Answer rows of JSON documents and JSON line files: file, row_index, item."""
    lines, whole = [p for p in paths if p.endswith(".jsonl")], [p for p in paths if not p.endswith(".jsonl")]
    out = None
    if lines:
        out = _rows(spark, lines).select("file", F.col("line").alias("row_index"), F.col("v").alias("item"))
    for p in whole:
        one = jsonl.payload_rows(jsonl.documents(spark, p)).select("file", "row_index", "item")
        out = one if out is None else out.unionByName(one)
    return out


def _keyed(rows: DataFrame, name: str) -> DataFrame:
    return rows.select(Node("v")["source_id"].text().alias("source_id"), F.col("v").alias(name))


@command("validate", files("input"), flag("strict"))
def validate(spark, a):
    from siltstone.operators import dataset_rules

    scanned = jsonl.scan(spark, a.input)
    found = dataset_rules.validate(scanned)
    return {"violations": found, "task_types": dataset_rules.by_task_type(scanned, found), "failing": found if a.strict else found.where("severity = 'error'")}, ["failing"]


@command("inspect", files("input"))
def inspect(spark, a):
    from siltstone.plans.inspect import inspect

    return inspect(_rows(spark, a.input)), []


def _outcome(spark, result):
    problems = spark.createDataFrame([(x,) for x in result.errors], "problem string")
    warnings = spark.createDataFrame([(x,) for x in result.warnings], "warning string")
    counts = spark.createDataFrame(list(result.counts.items()), "split string, n long")
    return {"problems": problems, "warnings": warnings, "counts": counts}, ["problems"]


@command("release", files("input"), text("release"), number("seed", 7), number("min-rows", 1), flag("force"), flag("allow-family-overlap"), flag("allow-source-overlap"))
def release(spark, a):
    from siltstone.plans.release import build_release

    return _outcome(spark, build_release(spark, a.input, a.release, seed=a.seed, force=a.force, allow_family_overlap=a.allow_family_overlap, allow_source_overlap=a.allow_source_overlap, min_rows=a.min_rows))


@command("split", text("file"), text("target"), text("ratios", "0.7,0.15,0.15"), number("seed", 7), flag("allow-family-overlap"), flag("allow-unreviewed"))
def split(spark, a):
    from siltstone.plans.release import split_dataset

    return _outcome(spark, split_dataset(spark, a.file, a.target, tuple(map(float, a.ratios.split(","))), a.seed, a.allow_family_overlap, a.allow_unreviewed))


@command("import", text("adapter"), text("path"))
def import_(spark, a):
    from siltstone.operators.construct import draft_rows
    from siltstone.sources.adapters import adapter

    found, rejected = adapter(a.adapter)(spark, a.path)
    tables = {"examples": found, "rejected": rejected}
    return tables | ({"drafts": draft_rows(found)} if {"artifacts", "task_type", "user_goal"} <= set(found.columns) else {}), []


@command("import-records", files("input"), flag("all-modules"))
def import_records(spark, a):
    from siltstone.operators import construct

    index = construct.index_rows(jsonl.scan(spark, a.input))
    good, skipped = construct.tasks(index, not a.all_modules)
    return {"index": index, "tasks": good, "skipped": skipped, "families": index.groupBy("rough_design_family").count()}, []


@command("mutate", files("input"), number("per-row", 1), number("target", None), number("rows", None), number("seed", 42))
def mutate(spark, a):
    from siltstone.operators.synthesize import synthesize

    made = synthesize(jsonl.scan(spark, a.input), a.per_row, a.target, a.rows, a.seed)
    totals = spark.createDataFrame([(made.processed, made.emitted_rows, made.shortfall)], "processed long, emitted long, shortfall long")
    return {"variants": made.emitted.orderBy("rank", "k").select("raw"), "skipped": made.skipped, "totals": totals, "bug_types": made.bug_types(), "reasons": made.reasons()}, []


@command("teacher-export", files("input"), number("size", 5), number("start", 0), number("limit", None))
def teacher_export(spark, a):
    from siltstone.operators.construct import teacher_batches

    rows = _rows(spark, a.input).select(Node("v")["source_id"].text().alias("source_id"), F.to_json("v").alias("task"))
    return {"batches": teacher_batches(rows, "source_id", a.size, a.start, a.limit)}, []


@command("teacher-validate", files("tasks"), files("answers"))
def teacher_validate(spark, a):
    from siltstone.operators.teacher import validate_batch

    return {"issues": validate_batch(_rows(spark, a.tasks), _items(spark, a.answers))}, ["issues"]


@command("teacher-merge", files("tasks"), files("answers"), text("system", SYSTEM))
def teacher_merge(spark, a):
    from siltstone.operators.teacher import merge

    merged, issues = merge(_rows(spark, a.tasks), _items(spark, a.answers), a.system)
    return {"rows": merged, "issues": issues}, ["issues"]


@command("normalize-validate", files("raw"), files("input"))
def normalize_validate(spark, a):
    from siltstone.operators.normalize import validate as run

    issues = run(_items(spark, a.raw), _items(spark, a.input))
    return {"issues": issues, "errors": issues.where("severity = 'error'")}, ["errors"]


def _tasks(spark, a):
    return _rows(spark, a.tasks) if a.tasks else None


@command("audit", files("input"), several("tasks"))
def audit(spark, a):
    from siltstone.operators import audit_rules
    from siltstone.sources import answer_files

    rows, problems = answer_files.read(spark, answer_files.found(spark, a.input))
    issues = audit_rules.audit(rows.select("file", "row_index", F.parse_json("raw").alias("item")), _tasks(spark, a))
    return {"issues": issues, "problems": problems, "errors": issues.where("severity = 'error'"), "by_severity": issues.groupBy("severity").count()}, ["errors", "problems"]


@command("repair", files("input"), several("tasks"), text("target", optional=True))
def repair(spark, a):
    from siltstone.operators import audit_rules
    from siltstone.sources import answer_files

    rows, problems = answer_files.read(spark, answer_files.found(spark, a.input))
    done = audit_rules.repair(rows, _tasks(spark, a))
    if a.target:  # the files by name, in their containers
        answer_files.write(done.withColumn("file", F.element_at(F.split("file", "/"), -1)), a.target)
    left = audit_rules.audit(done.select("file", "row_index", F.parse_json("raw").alias("item")), _tasks(spark, a))
    return {"rows": done.select("file", "row_index", "raw"), "changes": audit_rules.change_rows(done), "manual": left.where("severity = 'manual_review'"), "problems": problems}, ["problems"]


@command("assemble", files("input"), files("tasks"), text("priority", "repaired,combined,batch,other"))
def assemble(spark, a):
    from siltstone.operators.audit import assemble as run
    from siltstone.operators.audit import parse_order

    chosen, others = run(_items(spark, a.input), parse_order(a.priority))
    tasks = _rows(spark, a.tasks).select("file_ord", "line", Node("v")["source_id"].text().alias("source_id"))
    kept = tasks.join(chosen, "source_id").select("file_ord", "line", "source_id", "text")
    return {"rows": kept, "others": others.select("source_id", "file", "row_index", "relation"), "missing": tasks.join(chosen, "source_id", "left_anti"), "extra": chosen.join(tasks, "source_id", "left_anti").select("source_id", "file")}, ["missing"]


@command("distill", files("tasks"), files("answers"), text("sizes"), number("seed", 42), text("system", SYSTEM))
def distill(spark, a):
    from siltstone.operators import distill as D

    tasks, answers = _keyed(_rows(spark, a.tasks), "task"), _items(spark, a.answers).select(Node("item")["source_id"].text().alias("source_id"), F.col("item").alias("answer"))
    sizes = dict(zip(D.SPLITS, map(int, a.sizes.split(","))))
    rows = D.rows(tasks, answers, D.assign(tasks, sizes, a.seed), a.seed, a.system)
    checks = D.row_checks(rows.select(F.parse_json(F.to_json(F.struct("*"))).alias("v")))
    return {"rows": rows, "problems": D.preflight(tasks, answers), "checks": checks}, ["problems"]


@command("inventory", text("root"))
def inventory(spark, a):
    from siltstone.operators import workspace

    found = workspace.inventory(spark, a.root)
    return {"files": found, "duplicates": workspace.duplicates(found), "shared_ids": workspace.shared_ids(found), "roles": found.groupBy("role").count(), "archive": workspace.safe_to_archive(found)}, []


@command("cleanup-plan", text("root"))
def cleanup_plan(spark, a):
    from siltstone.operators import workspace

    return {"moves": workspace.cleanup_plan(workspace.inventory(spark, a.root))}, []


@command("evaluate", files("dataset"), files("candidates"), flag("strict"))
def evaluate(spark, a):
    from siltstone.operators import scoring
    from siltstone.plans import evaluate as E

    data = _rows(spark, a.dataset).select(Node("v")["id"].text().alias("id"), "v")
    good, bad = E.load_candidates(jsonl.scan(spark, a.candidates))
    out = E.evaluate(data, good)
    by = out["results"].withColumn("task", Node("v")["task_family"].text()).withColumn("source", Node("v")["source"].text())
    tables = out | {"results": out["results"].drop("v", "answer"), "problems": bad, "by_task": scoring.summary(by, "task"), "by_source": scoring.summary(by, "source"), "weakest": E.weakest(out["results"].select("id", "score"))}
    return tables, ["problems", "missing", "extra"] if a.strict else ["problems"]


@command("baseline", files("dataset"))
def baseline(spark, a):
    from siltstone.operators.baseline import answers

    return {"candidates": answers(_rows(spark, a.dataset))}, []


@command("prompts", files("dataset"))
def prompts(spark, a):
    from siltstone.operators.construct import prompt_rows

    return {"prompts": prompt_rows(_rows(spark, a.dataset))}, []


@command("score", files("prompts"), files("predictions"))
def score(spark, a):
    from siltstone.operators import predictions as P

    asked, bad = P.load_prompts(jsonl.scan(spark, a.prompts))
    given, odd = P.load_predictions(jsonl.scan(spark, a.predictions))
    rows = P.score(asked, given)
    return {"rows": rows, "categories": P.category_counts(rows), "failures": P.failures_by_source(rows), "extra": P.extra(asked, given), "bad_prompts": bad, "bad_predictions": odd.where("severity = 'error'"), "warnings": odd.where("severity = 'warning'")}, ["bad_prompts", "bad_predictions"]


@command("compare", files("runs"), several("metrics"))
def compare(spark, a):
    from siltstone.plans import evaluate as E

    rows, bad = E.load_results(jsonl.scan(spark, a.runs))
    _, odd = E.load_objects(spark, a.metrics, E.METRICS)
    return E.compare_runs(rows.withColumnRenamed("file", "run")) | {"weakest": E.weakest(rows), "problems": bad, "metric_problems": odd}, ["problems", "metric_problems"]


@command("differences", files("dataset"), files("a"), files("b"))
def differences(spark, a):
    from siltstone.operators import differences as D
    from siltstone.plans.evaluate import load_candidates

    rows = _rows(spark, a.dataset).select(Node("v")["id"].text().alias("id"), "v")
    x, y = (load_candidates(jsonl.scan(spark, p))[0] for p in (a.a, a.b))
    return D.inspect(rows, x, y) | {"exact_a": D.exact_groups(x), "exact_b": D.exact_groups(y)}, []


@command("accept", text("tuned"), text("base"), text("differences"), text("candidates"))
def accept(spark, a):
    from siltstone.plans.config import acceptance

    read = lambda path: json.loads(spark.read.text(path, wholetext=True).first()[0])
    result = acceptance(*map(read, (a.tuned, a.base, a.differences, a.candidates)))
    checks = [(k, float(c["value"]) if isinstance(c["value"], (int, float)) else None, float(c["required"]), c["passed"]) for k, c in result["checks"].items()]
    return {"checks": spark.createDataFrame(checks, "gate string, value double, required double, passed boolean"), "errors": spark.createDataFrame([(x,) for x in result["errors"]], "error string")}, ["errors"]


@command("finetune-check", text("folder"), flag("golden"))
def finetune_check(spark, a):
    from siltstone.operators import finetune as T

    loaded = T.load_splits(spark, a.folder)
    problems = T.check(loaded, a.golden)
    return {"problems": problems, "fields": T.missing_fields(problems), "distributions": T.distributions(loaded), "aliases": T.aliases(loaded), "lengths": T.lengths(loaded)}, ["problems"]


@command("finetune-export", text("folder"), flag("golden"))
def finetune_export(spark, a):
    from siltstone.operators import finetune as T

    rows, problems = T.canonical_rows(T.load_splits(spark, a.folder), a.golden)
    return {"rows": rows, "problems": problems}, ["problems"]


@command("readiness", files("selected"), files("reviewed"))
def readiness(spark, a):
    from siltstone.operators.review import readiness as run

    ids, risks = run(jsonl.scan(spark, a.selected), jsonl.scan(spark, a.reviewed))
    return {"ids": ids, "unmatched": ids.where("status <> 'matched'"), "risks": risks}, ["unmatched", "risks"]


@command("triage", files("reviewed"))
def triage(spark, a):
    from siltstone.operators.review import triage as run

    issues = run(_rows(spark, a.reviewed))
    return {"issues": issues, "critical": issues.where("severity = 'critical'")}, ["critical"]


@command("promote", files("input"), flag("allow-stub"))
def promote(spark, a):
    from siltstone.operators.review import promote as run

    good, bad = run(_rows(spark, a.input), a.allow_stub)
    return {"accepted": good.select("raw"), "rejected": bad.select("file", "line", "reason", "problems"), "reasons": bad.groupBy("reason").count()}, []


@command("finalize", text("selected"), text("reviewed"), text("golden"), text("target"), number("seed", 7), flag("allow-source-overlap"), flag("force"))
def finalize(spark, a):
    from siltstone.plans.finalize import finalize_batch

    made = finalize_batch(spark, a.selected, a.reviewed, a.golden, a.target, a.seed, a.allow_source_overlap, a.force)
    stages = spark.createDataFrame([(k, k in made.reused, json.dumps(x)) for k, x in made.done.items()], "stage string, reused boolean, found string")
    return {"stages": stages, "problems": spark.createDataFrame([(x,) for x in made.errors], "problem string")}, ["problems"]


@command("review-packet", files("input"))
def review_packet(spark, a):
    from siltstone.operators.packet import packets

    return {"packets": packets(_rows(spark, a.input))}, []


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="siltstone", description=__doc__.splitlines()[0])
    commands = p.add_subparsers(dest="command", required=True)
    for name, (f, options) in COMMANDS.items():
        c = commands.add_parser(name, help=(f.__doc__ or name).splitlines()[0])
        c.add_argument("--output", help="folder for the tables; without it only their sizes are printed")
        for option, settings in options:
            c.add_argument(option, **settings)
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"siltstone {a.command}").getOrCreate()
    tables, empty = COMMANDS[a.command][0](spark, a)
    sizes = {}
    for name, frame in tables.items():
        if a.output:
            target = f"{a.output.rstrip('/')}/{name}"
            frame.write.json(target)
            sizes[name] = spark.read.text(target).count()
        else:
            sizes[name] = frame.count()
    ok = not any(sizes[name] for name in empty)
    print(json.dumps({"command": a.command, "ok": ok, "rows": sizes}), file=sys.stdout)
    return 0 if ok else 1
