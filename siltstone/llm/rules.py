"""Document quality rules whose cutoffs are chosen under a bound on false rejection.

All per-document work is column expressions. Labelled good documents of each stratum test a fixed
grid of cutoffs per rule: a cutoff is admitted if the hypothesis "more than alpha of good documents
exceed it" is refuted by the exact binomial tail. The cutoffs of a rule are nested, so they are tested
in a fixed sequence, loosest first, until one fails: what passes at the level passes in sequence, and
the level is ``delta`` divided by the number of rules and strata (Bonferroni), not by the cutoffs. The
smallest admitted cutoff rules; without one the rule is off in that stratum. With alpha split over the
rules, the documents rejected wrongly in a stratum stay under the total share for every stratum at
once, with probability 1 - delta.
"""

from __future__ import annotations

from math import exp, floor, lgamma, log

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm._columns import quoted
from siltstone.scratch import Scratch

WS = r"[\x20\x09-\x0D]+"
TRIM = " \\t\\n\\u000b\\f\\r"
#: Rules: name, numerator, denominator; a cutoff c rejects where 1000 * numerator > c * denominator.
RULES = (
    ("symbols", "n_symbols", "n_words"),
    ("repeats", "n_repeat_words", "n_words"),
    ("lines", "n_dup_lines", "n_lines"),
    ("capitals", "n_capitals", "word_chars"),
    ("length", "word_chars", "n_words"),
)
GRID = {
    "symbols": (50, 100, 200, 400, 800, 1600),
    "repeats": (50, 100, 150, 200, 300, 400),
    "lines": (50, 100, 200, 300, 400, 600),
    "capitals": (50, 100, 200, 300, 500, 700),
    "length": (6000, 7000, 8000, 9000, 10000, 12000),
}
ALPHA, DELTA = 0.1, 0.05
#: The table of cutoffs is broadcast only up to this many strata.
BROADCAST_STRATA = 10_000


def _lang(docs: DataFrame):
    return (F.col("lang") if "lang" in [c.lower() for c in docs.columns] else F.lit(None)).cast("string").alias("lang")


def measures(docs: DataFrame) -> DataFrame:
    """Counts of every document: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_capitals,
    beside doc_id and lang (null where docs has none).

    Three-word windows become 64-bit values: a hash above as many low bits as the place needs. After a
    primitive sort, equal windows are neighbours, and their low bits say which words they cover. The
    words of neighbours are compared; a text in which two windows share a value but not their words is
    counted by sorting the windows themselves, so the counts are exact.
    """
    return _measured(docs.select("doc_id", _lang(docs), F.coalesce("text", F.lit("")).alias("text")), ["doc_id", "lang"])


def _measured(d: DataFrame, keep: list[str]) -> DataFrame:
    """The measures of column text, beside the columns to keep."""
    d = d.withColumn("words", F.expr(rf"filter(split(text, '{WS}'), w -> w <> '')".replace("\\", "\\\\")))
    d = d.select(
        *keep,
        "words",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.bin(F.size("words").cast("long"))).alias("bits"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        F.length(F.regexp_replace("text", r"[^A-Z]+", "")).cast("long").alias("n_capitals"),
        F.expr(r"filter(split(text, '\n'), x -> x rlike '[^\x20\x09-\x0D]')".replace("\\", "\\\\")).alias("lines"),
    )
    window = "shiftleft(xxhash64(words[i], words[i + 1], words[i + 2]), bits) | cast(i AS BIGINT)"
    places = "sequence(0, cast(n_words AS INT) - 3)"
    d = d.select(
        *keep, "words", "n_words", "bits", "word_chars", "n_symbols", "n_capitals",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.expr(f"CASE WHEN n_words >= 3 THEN sort_array(transform({places}, i -> {window})) ELSE cast(array() AS array<bigint>) END").alias("w"),
    )
    d = d.withColumn("last", F.size("w") - 1)
    again = (
        "filter(w, (x, k) -> (k > 0 AND shiftrightunsigned(x, bits) = shiftrightunsigned(w[greatest(k - 1, 0)], bits))"
        " OR (k < last AND shiftrightunsigned(x, bits) = shiftrightunsigned(w[least(k + 1, last)], bits)))"
    )
    d = d.withColumn("again", F.expr(again)).withColumn("low", F.expr("shiftleft(1L, bits) - 1"))
    at, before = "cast(x & low AS INT)", "cast(again[greatest(k - 1, 0)] & low AS INT)"
    differ = " OR ".join(f"words[{at} + {j}] <> words[{before} + {j}]" for j in range(3))
    clash = f"size(filter(again, (x, k) -> k > 0 AND shiftrightunsigned(x, bits) = shiftrightunsigned(again[greatest(k - 1, 0)], bits) AND ({differ}))) > 0"
    whole = f"sort_array(transform({places}, i -> struct(words[i] AS a, words[i + 1] AS b, words[i + 2] AS c, i AS i)))"
    d = d.withColumn("sorted", F.expr(f"CASE WHEN {clash} THEN {whole} END"))
    same = " AND ".join(f"x.{c} = sorted[{{0}}].{c}" for c in "abc")
    exact = f"filter(sorted, (x, k) -> (k > 0 AND {same.format('greatest(k - 1, 0)')}) OR (k < last AND {same.format('least(k + 1, last)')}))"
    d = d.withColumn("starts", F.expr(f"CASE WHEN sorted IS NULL THEN transform(again, x -> {at}) ELSE transform({exact}, x -> x.i) END"))
    d = d.withColumn("n_repeat_words", F.expr("CASE WHEN size(starts) = 0 THEN 0L ELSE cast(size(array_distinct(flatten(transform(starts, x -> array(x, x + 1, x + 2))))) AS BIGINT) END"))
    return d.select(*keep, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals")


def tail(k: int, n: int, p: float) -> float:
    """P(Binomial(n, p) <= k), summed term by term."""
    return min(1.0, sum(exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * log(p) + (n - j) * log(1 - p)) for j in range(k + 1)))


def cutoffs(measured: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> dict[str, dict[str, int]]:
    """stratum -> rule -> cutoff. Counts reach the driver only of strata with labels enough for some cutoff to pass.

    ``measured`` has doc_id, stratum, base_failed and the measures.
    """
    good = labels.where("quality = 1 AND doc_id IS NOT NULL").select("doc_id").distinct()
    held = measured.where("NOT base_failed").join(good, "doc_id", "left_semi")
    over = [F.count_if(F.expr(f"1000 * {a} > {c} * {b}")).alias(f"{r}_{c}") for r, a, b in RULES for c in GRID[r]]
    counted = Scratch(measured.sparkSession, "strata").save(held.groupBy("stratum").agg(F.count("*").alias("n"), *over), "counts")
    level, share = delta / (max(1, counted.count()) * len(RULES)), alpha / len(RULES)
    least = log(level) / log(1 - share)  # documents that suffice if none exceeds a cutoff
    out: dict[str, dict[str, int]] = {}
    for row in counted.where(F.col("n") >= floor(least)).toLocalIterator():
        for rule, _, _ in RULES:
            passed = [c for c in GRID[rule] if tail(row[f"{rule}_{c}"], row["n"], share) <= level]
            if passed:
                out.setdefault(row["stratum"], {})[rule] = min(passed)
    return out


def apply(docs: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """One row per document: doc_id, the measures, base_failed, kept, and the rule that rejected it.

    Strata are languages (null, or no column lang: the stratum ''). Null or blank text has no words and
    fails the base rule. A null doc_id is judged like any other but never counts as labelled. Repeated
    rows are judged one by one, repeated labels count once. Ties: a share equal to a cutoff passes, and
    the first rule of ``RULES`` that rejects is named. Without labels no rule is on. Other columns are
    ignored. Empty table: empty result.
    """
    scratch = Scratch(docs.sparkSession, "rules")
    m = scratch.save(measures(docs).withColumns(_base()).drop("lang"), "measured")
    m = _judged(m, cutoffs(m, labels, alpha, delta))
    return m.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", F.col("reason").isNull().alias("kept"), "reason", "n_lines", "n_capitals", "stratum")


def select(docs: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """The rows of docs that ``apply`` keeps, with their columns, whatever their names.

    Nulls, ties, repeated rows and empty tables: as in ``apply``. The measures are taken once and
    written beside the rows, so that no text is shuffled to meet its verdict.
    """
    scratch = Scratch(docs.sparkSession, "rules")
    row = F.struct(*quoted(docs.columns)).alias("row")
    m = _measured(docs.select(row, _lang(docs), F.coalesce("text", F.lit("")).alias("text")), ["row", "lang"]).withColumns(_base())
    m = scratch.save(m.drop("lang"), "measured")
    chosen = cutoffs(m.select(F.col("row.doc_id").alias("doc_id"), *(c for c in m.columns if c != "row")), labels, alpha, delta)
    return _judged(m, chosen).where("reason IS NULL").select("row.*")


def _base() -> dict:
    return {
        "base_failed": (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")),
        "stratum": F.coalesce("lang", F.lit("")),
    }


def _judged(m: DataFrame, chosen: dict[str, dict[str, int]]) -> DataFrame:
    """``m`` with the rule that rejects a row, or null, as reason. The table of cutoffs has a row for each stratum with a rule."""
    schema = "of string, " + ", ".join(f"cut_{r} long" for r, _, _ in RULES)
    table = m.sparkSession.createDataFrame([(k, *(v.get(r) for r, _, _ in RULES)) for k, v in sorted(chosen.items())], schema)
    m = m.join(F.broadcast(table) if len(chosen) <= BROADCAST_STRATA else table, F.col("stratum") == F.col("of"), "left")
    why = F.coalesce(*(F.when(1000 * F.col(a) > F.col(f"cut_{r}") * F.col(b), F.lit(r)) for r, a, b in RULES))
    return m.withColumn("reason", F.when(F.col("base_failed"), F.lit("base")).otherwise(why)).drop(*table.columns)
