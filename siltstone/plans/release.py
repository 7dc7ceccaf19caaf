"""Releases of reviewed rows: gates row by row, first seen wins, splits that keep families whole, overlap report, files.

Every row gets a verdict of its own: what bars it from a release, what its own rules report, and whether its id
or its content was seen before, in any row of any input. Rows that pass are split; the driver decides from one
number for each family. Keys that two rows share (family, source, artifacts) are found in one aggregation over
(kind, key) pairs and reported as errors, or as warnings where they are allowed. A release is written whole
even if it is not ok, so that the files show why.
"""

from __future__ import annotations

import json
import random
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone import vocab as V
from siltstone.functions.json_text import canonical_json, dumps_compact, with_value
from siltstone.functions.variant import Node
from siltstone.operators import dataset_rules, duplicates
from siltstone.operators.keys import first_seen, place_number
from siltstone.operators.split import global_rank, shuffled
from siltstone.scratch import Scratch
from siltstone.sources import jsonl, sinks

CREATOR = "siltstone.release"
SPLITS = ("train", "val", "test")
PLACE = ["file_ord", "line"]
# Wording of imported drafts, markers of private origin, licenses that say nothing.
STUBS = ("Imported public dataset draft row requires review", "Treat this as a draft review seed only", "No optimization effect is claimed", "Imported public artifacts may be incomplete")
PRIVATE = ("private", "proprietary", "company_internal", "confidential")
UNCERTAIN = ("unknown", "uncertain", "todo")
READY = ("validated", "reviewed")


def ratios_valid(ratios) -> bool:
    return all(r >= 0 for r in ratios) and abs(sum(ratios) - 1) <= 1e-9


def split_families(sizes: dict[str, int], ratios, seed: int) -> dict[str, tuple[str, int]]:
    """family -> (split, place). Families are shuffled from the order of ``sizes``, sorted by size, and each goes where most is missing.

    ``sizes`` is one number for each family; rows never come to the driver.
    """
    names = list(sizes)
    random.Random(seed).shuffle(names)
    names.sort(key=lambda n: -sizes[n])
    total = sum(sizes.values())
    left = [r * total for r in ratios]
    out = {}
    for place, n in enumerate(names):
        k = max(range(len(SPLITS)), key=lambda i: (left[i], ratios[i], -i))
        out[n] = SPLITS[k], place
        left[k] -= sizes[n]
    return out


def split_rows(rows: DataFrame, ratios, seed: int, allow_family_overlap: bool = False) -> DataFrame:
    """rows (family, file_ord, line, ...) with ``split`` and ``place``, their order in the split.

    Families stay whole, unless ``allow_family_overlap``: then rows are shuffled one by one, and each split
    takes its rounded share.
    """
    spark = rows.sparkSession
    if not allow_family_overlap:
        found = rows.groupBy("family").agg(F.count("*").alias("n"), F.min(F.struct(*PLACE)).alias("first")).orderBy("first").collect()  # one row for each family
        assigned = split_families({r.family: r.n for r in found}, ratios, seed)
        table = spark.createDataFrame([(f, s, p) for f, (s, p) in assigned.items()], "family string, split string, place long")
        return rows.join(table, "family")
    ranked = global_rank(rows.withColumn("_key", F.struct(*PLACE)), "_key", "_n").drop("_key")
    n = rows.count()
    first = round(n * ratios[0])
    second = first + round(n * ratios[1])
    places = shuffled(spark, n, random.Random(seed), "_n", "place")
    split = F.when(F.col("place") < first, "train").when(F.col("place") < second, "val").otherwise("test")
    return ranked.join(places, "_n").drop("_n").withColumn("split", split)


def eligibility() -> Column:
    """What bars a row from any release: an array of messages."""
    v, answer = Node("v"), Node("v")["messages"][2]["content"]
    text = F.lower(F.concat_ws(" ", v["source"].json(), v["license"].json(), v["provenance"].json()))
    license_ = F.lower(F.trim(F.coalesce(v["license"].text(), F.lit(""))))
    tests = [
        (~v["dataset_version"].isin([V.DATASET_VERSION]), f"dataset_version must be {V.DATASET_VERSION}"),
        (~v["review_status"].isin(READY), "review_status must be validated or reviewed"),
        (~v["source"].isin(V.SOURCES), "source must be an allowed source"),
        (~v["license"].filled(), "license must not be empty"),
        (license_.isin(*UNCERTAIN), "license must not be unknown, uncertain or todo"),
        (text.rlike("|".join(PRIVATE)), "private or proprietary marker found"),
        (answer.is_object() & answer.json().rlike("|".join(STUBS)), "answer still has stub text of an import"),
    ]
    return F.filter(F.array(*[F.when(F.coalesce(when, F.lit(False)), F.lit(said)) for when, said in tests]), lambda x: x.isNotNull())


def reason(errors: Column) -> Column:
    """The first of the reasons, by rank, that the errors name."""
    text = F.lower(F.array_join(errors, " "))
    ranks = [
        ("duplicate row id", "duplicate row id"), ("duplicate full-row fingerprint", "duplicate row fingerprint"), ("duplicate artifact fingerprint", "duplicate artifact fingerprint"),
        ("license", "license gate"), ("review_status", "review status gate"), ("stub", "stub answer"), ("private|proprietary", "private source gate"), ("validation|field=", "validation failed"),
    ]
    out = None
    for pattern, name in ranks:
        out = F.when(text.rlike(pattern), name) if out is None else out.when(text.rlike(pattern), name)
    return out.otherwise("release eligibility failed")


def judge(scanned: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(what the rules find in each row, verdicts).

    A verdict is a good row with its keys, its ``errors`` and the ``reason`` of its rejection (null if accepted).
    The rules are evaluated once, into a table that both come from.
    """
    v = Node("v")
    said = lambda x: F.concat(F.lit("validation: "), F.when(x["field"] != "", F.concat(F.lit("field="), x["field"], F.lit(" "))).otherwise(""), F.coalesce(x["message"], x["rule"]))
    found = dataset_rules.judge(scanned).select(
        "file", *PLACE, "raw", "problem", "row_id", "findings", "trains", v["id"].text().alias("id"), F.to_json(v["id"].value).alias("id_json"), F.coalesce(v["id"].text(), F.to_json(v["id"].value), F.lit("None")).alias("shown"),
        *[v[n].text().alias(a) for n, a in (("design_family", "family"), ("source", "source"), ("task_family", "task_family"), ("review_status", "review_status"))],
        duplicates.artifact_fingerprint(v["messages"][1]["content"]["artifacts"]).alias("artifacts"),
        F.filter(F.transform(F.array(*map(F.lit, V.CLAIM_DOMAINS)), lambda d: F.struct(d.alias("domain"), _level(d).alias("level"))), lambda x: x["level"].isNotNull()).alias("claims"),
        F.concat(eligibility(), F.transform("findings", said)).alias("own"),
    )
    found = scratch.save(found, "found")
    rows = found.where("problem IS NULL").drop("problem", "row_id", "findings", "trains").withColumn("fp", F.sha2(canonical_json("raw"), 256))
    # ids and contents seen before, in rows that were rejected as well
    again = first_seen(rows, {"id": "id", "fp": "fp"}, place_number(*PLACE), ["file", "shown"])
    twice = lambda kind: F.coalesce(F.col(f"{kind}_first") != place_number(*PLACE), F.lit(False))
    seen = F.filter(
        F.array(
            F.when(twice("id"), F.concat(F.lit("duplicate row id: "), "id", F.lit("; first seen in "), "id_file")),
            F.when(twice("fp"), F.concat(F.lit("duplicate full-row fingerprint; first seen in "), F.coalesce("fp_shown", F.lit("null")))),
        ),
        lambda x: x.isNotNull(),
    )
    again = again.withColumn("errors", F.concat("own", seen)).withColumn("same_id", twice("id")).withColumn("same_row", twice("fp"))
    return found, again.select(*[c for c in rows.columns if c != "own"], "errors", "same_id", "same_row", F.when(F.size("errors") > 0, reason(F.col("errors"))).alias("reason"))


def _level(domain: Column) -> Column:
    levels = Node("v")["messages"][2]["content"]["claim_levels"].fields()
    return F.try_variant_get(F.element_at(levels, domain), "$", "string")


@dataclass
class Result:
    ok: bool
    input_rows: int = 0
    accepted_rows: int = 0
    rejected_rows: int = 0
    train_rows: int = 0
    val_rows: int = 0
    test_rows: int = 0
    errors: list[str] = field(default_factory=list)
    warnings: list[str] = field(default_factory=list)

    @property
    def counts(self) -> dict[str, int]:
        return {s: getattr(self, f"{s}_rows") for s in SPLITS} | {"rejected": self.rejected_rows}


def _told(found: DataFrame) -> list[str]:
    """Violations as messages, by file and line."""
    return [_said(r) for r in found.orderBy("file", F.col("line").asc_nulls_first(), "ord").collect()]


def _written(spark: SparkSession, target: str, files: dict) -> list[str]:
    """The problems of the written splits."""
    paths = [f"{target}/{s}.jsonl" for s in SPLITS if files[s]["rows"]]
    return _told(dataset_rules.validate(jsonl.scan(spark, paths))) if paths else []


def _said(r) -> str:
    place = r.file + (f":{r.line}" if r.line is not None else "")
    return f"{place}{f' row_id={r.row_id}' if r.row_id else ''}{f' field={r.field}' if r.field else ''}: {r.message or r.rule} ({r.rule})"


def _leakage(split: DataFrame, allow_family: bool, allow_source: bool) -> tuple[DataFrame, dict[str, dict[str, list[str]]], list[str], list[str]]:
    """(overlaps, their splits by kind and key, errors, warnings)."""
    shared = duplicates.overlaps(split, {"family": "family", "source": "source", "artifact_fingerprint": "artifacts"}, "split")
    shared = shared.where("size(splits) > 1 OR kind = 'artifact_fingerprint'")
    found: dict[str, dict[str, list[str]]] = {"artifact_fingerprint": {}, "family": {}, "source": {}}
    errors, warnings = [], []
    for r in shared.orderBy("kind", "key").collect():  # one row for each key in several splits
        found[r.kind][r.key] = list(r.splits)
    for key, where in found["family"].items():
        (warnings if allow_family else errors).append(f"family overlap allowed for {key} across {where}" if allow_family else f"design family appears in multiple splits: {key} {where}")
    for key, where in found["source"].items():
        (warnings if allow_source else errors).append(f"source overlap allowed for {key} across {where}" if allow_source else f"source appears in multiple splits: {key} {where}")
    for key, where in found["artifact_fingerprint"].items():
        if len(where) == 1:
            warnings.append(f"duplicate artifact fingerprint in one split for {key} in {where}")
        elif allow_family:
            warnings.append(f"artifact fingerprint overlap allowed for {key} across {where}")
        else:
            errors.append(f"duplicate artifact fingerprint crosses splits: {key} {where}")
    return shared, found, errors, warnings


def _stats(split: DataFrame, rejected: DataFrame, leakage: dict) -> dict:
    fields = {"rows_by_source": "source", "rows_by_task_type": "task_family", "rows_by_design_family": "family", "rows_by_review_status": "review_status", "rows_by_split": "split"}
    each = F.array(*[F.struct(F.lit(k).alias("what"), F.col(c).alias("value")) for k, c in fields.items()])
    levels = F.transform("claims", lambda x: F.struct(F.concat(F.lit("claim "), x["domain"]).alias("what"), x["level"].alias("value")))
    found = split.select(F.inline(F.concat(each, levels))).groupBy("what", "value").count()
    found = found.union(rejected.select(F.lit("rejected_reasons"), "reason").toDF("what", "value").groupBy("what", "value").count())
    out: dict = {k: {} for k in (*fields, "rejected_reasons")} | {"claim_levels": {}, "duplicate_leakage_checks": leakage}
    out["rows_by_split"] = dict.fromkeys(SPLITS, 0)
    for r in found.orderBy("what", "value").collect():
        target = out["claim_levels"].setdefault(r.what[6:], {}) if r.what.startswith("claim ") else out[r.what]
        target[r.value] = r["count"]
    return out


def _stats_text(stats: dict, shared: DataFrame, split: DataFrame, found: dict) -> Iterator[str]:
    """The statistics as JSON, in pieces: the ids of overlapping rows are streamed in, sorted, and never held whole."""
    mark = "@ids@"
    for kind, keys in found.items():
        stats["duplicate_leakage_checks"][f"{kind}_overlaps"] = {k: {"rows": mark, "splits": s} for k, s in keys.items()}
    pieces = json.dumps(stats, indent=2, sort_keys=True).split(json.dumps(mark))
    ids = iter(())
    if len(pieces) > 1:
        members = duplicates.members(split, shared, {"family": "family", "source": "source", "artifact_fingerprint": "artifacts"}, "shown")
        ids = members.orderBy("kind", "key", "shown").toLocalIterator(prefetchPartitions=True)
    yield pieces[0]
    row = next(ids, None)
    for piece in pieces[1:]:
        key, indent = (row.kind, row.key), " " * 8
        yield "["
        first = True
        while row is not None and (row.kind, row.key) == key:
            yield f"{'' if first else ','}\n{indent}  {json.dumps(row.shown)}"
            first, row = False, next(ids, None)
        yield f"\n{indent}]" + piece
    yield "\n"


def _card(name: str, stats: dict, result: Result, command: str) -> str:
    """A short Markdown card: what a release holds and how it was made."""
    lines = [f"# {name}", "", f"Made by `{command}`.", "", "| split | rows |", "|---|---|", *[f"| {s} | {n} |" for s, n in result.counts.items()]]
    for title, key in (("Sources", "rows_by_source"), ("Tasks", "rows_by_task_type"), ("Design families", "rows_by_design_family"), ("Review status", "rows_by_review_status"), ("Reasons of rejection", "rejected_reasons")):
        lines += ["", f"## {title}", "", *([f"- `{k}`: {n}" for k, n in stats[key].items()] or ["- none"])]
    lines += ["", "## Claim levels", "", *[f"- {d}, `{k}`: {n}" for d, levels in stats["claim_levels"].items() for k, n in levels.items()]]
    lines += ["", "Rows keep the claim levels of their review. A release checks texts and keys; it runs no tool and proves no design correct.", ""]
    return "\n".join(lines)


def build_release(
    spark: SparkSession, inputs: list[str], output: str, ratios=(0.7, 0.15, 0.15), seed: int = 7, force: bool = False, allow_family_overlap: bool = False, allow_source_overlap: bool = False,
    min_rows: int = 1, name: str | None = None,
) -> Result:
    """Write train, val, test, all accepted and rejected rows, stats.json, dataset_card.md and manifest.json to ``output``.

    Files in argument order, rows in line order; the first row of an id and of a content wins, and rejected rows
    hold theirs too. Problems of the inputs, overlaps that are not allowed, fewer than ``min_rows`` accepted rows
    and problems of the written splits are errors; all files are written nevertheless. Nothing is written if the
    arguments are wrong or the folder holds files that this tool did not make.
    """
    errors = [] if ratios_valid(ratios) else ["ratios must be non-negative and sum to 1.0"]
    if min_rows < 1:
        errors.append("min_rows must be at least 1")
    names = [f"{s}.jsonl" for s in (*SPLITS, "rejected_rows", "all_accepted.unsplit")]
    errors += sinks.OutputGuard(CREATOR).problems(output, ["manifest.json", *([] if force else [*names, "stats.json", "dataset_card.md"])], [], force)
    if errors:
        return Result(False, errors=errors)
    scratch, warnings = Scratch(spark, "release"), []
    scanned = jsonl.scan(spark, inputs)
    rules_found, judged = judge(scanned, scratch)
    errors += _told(dataset_rules.violations_of(rules_found))
    judged = scratch.save(judged, "verdicts")
    accepted, rejected = judged.where("reason IS NULL"), judged.where("reason IS NOT NULL")
    totals = judged.agg(F.count("*").alias("n"), F.count_if(F.col("reason").isNull()).alias("good"), F.count_if("same_id").alias("ids"), F.count_if("same_row").alias("rows")).first()
    if totals.good < min_rows:
        errors.append(f"accepted rows {totals.good} is below min_rows {min_rows}")
    split = scratch.save(split_rows(accepted, ratios, seed, allow_family_overlap), "split")
    shared, found, bad, allowed = _leakage(split, allow_family_overlap, allow_source_overlap)
    errors += bad
    warnings += allowed
    files = {}
    target = output.rstrip("/")
    for s in SPLITS:
        rows = split.where(F.col("split") == s).withColumn("raw", with_value("raw", F.lit("split"), F.lit(s)))
        files[s] = sinks.write_ordered(rows, f"{target}/{s}.jsonl", ["place", *PLACE], scratch)
    files["all_accepted"] = sinks.write_ordered(accepted.withColumn("raw", dumps_compact("raw")), f"{target}/all_accepted.unsplit.jsonl", PLACE, scratch)
    odd = rules_found.where("problem IS NOT NULL").select(F.to_json(F.struct(F.lit(None).cast("string").alias("id"), F.lit("input load failed").alias("reason"), F.array("problem").alias("errors"), F.struct(F.col("file").alias("input")).alias("row")), {"ignoreNullFields": "false"}).alias("raw"), "file_ord", F.coalesce("line", F.lit(0)).alias("line"), F.lit(0).alias("part"))
    gone = rejected.select(rejection_text().alias("raw"), *PLACE, F.lit(1).alias("part"))
    files["rejected"] = sinks.write_ordered(odd.union(gone), f"{target}/rejected_rows.jsonl", ["part", *PLACE], scratch)
    errors += _written(spark, target, files)
    leakage = {
        "duplicate_row_ids": totals.ids, "duplicate_row_fingerprints": totals["rows"], "duplicate_artifact_fingerprints": len(found["artifact_fingerprint"]),
        "family_overlap_allowed": allow_family_overlap, "source_overlap_allowed": allow_source_overlap,
    }
    stats = _stats(split, rejected, leakage)
    counts = {f"{s}_rows": files[s]["rows"] for s in SPLITS}
    result = Result(not errors, totals.n, totals.good, files["rejected"]["rows"], **counts, errors=errors, warnings=warnings)
    name = name or target.rsplit("/", 1)[-1]
    files["stats"] = sinks.write_text(spark, f"{target}/stats.json", _stats_text(stats, shared, split, found))
    command = f"python -m siltstone release --input {' '.join(inputs)} --release {output} --seed {seed}"
    files["dataset_card"] = sinks.write_text(spark, f"{target}/dataset_card.md", [_card(name, stats, result, command)])
    manifest = {
        sinks.CREATOR_KEY: CREATOR, "release_name": name, "dataset_version": V.DATASET_VERSION, "schema_versions": {"task": V.TASK_SCHEMA[0], "answer": V.ANSWER_SCHEMA[0]},
        "seed": seed, "ratios": dict(zip(SPLITS, ratios)), "input_files": list(inputs), "files": files, "counts": result.counts,
    }
    sinks.write_text(spark, f"{target}/manifest.json", [json.dumps(manifest, indent=2, sort_keys=True) + "\n"])
    scratch.drop()
    return result


def rejection_text() -> Column:
    """A rejected row as JSON: id, reason, errors, row."""
    parts = {"id": F.coalesce("id_json", F.lit("null")), "reason": F.to_json(F.col("reason").cast("variant")), "errors": F.to_json("errors"), "row": dumps_compact("raw")}
    return F.concat(F.lit("{"), F.concat_ws(",", *[F.concat(F.lit(f'"{k}":'), c) for k, c in parts.items()]), F.lit("}"))


def split_dataset(spark: SparkSession, path: str, output: str, ratios=(0.7, 0.15, 0.15), seed: int = 7, allow_family_overlap: bool = False, allow_unreviewed: bool = False) -> Result:
    """Split one checked file into train, val and test with a split_summary.json.

    Nothing is written if the ratios are wrong, the file has errors (warnings do not count), or rows are neither
    validated nor reviewed and not ``allow_unreviewed``. Problems of the written splits are errors.
    """
    if not ratios_valid(ratios):
        return Result(False, errors=["ratios must be non-negative and sum to 1.0"])
    scanned = jsonl.scan(spark, path)
    found = _told(dataset_rules.validate(scanned).where("severity = 'error'"))
    if found:
        return Result(False, errors=found)
    v = Node("v")
    rows = jsonl.rows(scanned).select(*PLACE, "raw", v["design_family"].text().alias("family"), v["id"].text().alias("id"), v["review_status"].isin(READY).alias("ready"))
    scratch = Scratch(spark, "split")
    rows = scratch.save(rows, "rows")
    if not allow_unreviewed and (late := [r.id for r in rows.where("NOT ready").orderBy(*PLACE).select("id").collect()]):
        return Result(False, errors=[f"rows that are not ready for training need allow_unreviewed: {', '.join(map(str, late))}"])
    split = scratch.save(split_rows(rows, ratios, seed, allow_family_overlap), "split")
    target, files = output.rstrip("/"), {}
    for s in SPLITS:
        part = split.where(F.col("split") == s).withColumn("raw", with_value("raw", F.lit("split"), F.lit(s)))
        files[s] = sinks.write_ordered(part, f"{target}/{s}.jsonl", ["place", *PLACE], scratch)
    paths = [f"{target}/{s}.jsonl" for s in SPLITS if files[s]["rows"]]
    again = _told(dataset_rules.validate(jsonl.scan(spark, paths)).where("severity = 'error'"))
    n = sum(f["rows"] for f in files.values())
    result = Result(not again, n, n, 0, **{f"{s}_rows": files[s]["rows"] for s in SPLITS}, errors=again)
    if result.ok:
        summary = {k: x for k, x in asdict(result).items() if k in ("ok", "input_rows", "train_rows", "val_rows", "test_rows")}
        summary |= {"output_files": {s: f"{target}/{s}.jsonl" for s in SPLITS} | {"summary": f"{target}/split_summary.json"}, "seed": seed, "ratios": dict(zip(SPLITS, ratios))}
        sinks.write_text(spark, f"{target}/split_summary.json", [json.dumps(summary, indent=2) + "\n"])
    scratch.drop()
    return result
