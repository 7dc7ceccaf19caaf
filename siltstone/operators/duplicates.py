"""Fingerprints, exact duplicates, leakage across splits and contained texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone import vocab as V
from siltstone.functions.variant import Node
from siltstone.scratch import Scratch
from siltstone.sources.jsonl import WHITE

#: Short texts sought are sent to all workers up to this many characters at once, in blocks.
BLOCK_CHARS = 2_000_000
#: Runs of words of the texts sought are sent to all workers up to this many.
BROADCAST_GRAMS = 2_000_000
#: Words of an anchor, and what stands between words.
GRAM, WORD_ENDS = 4, r"[^\p{L}\p{N}]+"


def fingerprint(rows: DataFrame, column: str) -> DataFrame:
    return rows.withColumn("fp", F.sha2(column, 256))


def duplicate_groups(rows: DataFrame, column: str, key: str) -> DataFrame:
    """(fp, n, first): texts that occur more than once."""
    return rows.where(F.col(column).isNotNull()).groupBy(F.sha2(column, 256).alias("fp")).agg(F.count("*").alias("n"), F.min(key).alias("first")).where("n > 1")


def leaks(rows: DataFrame, column: str, split: str) -> DataFrame:
    """(fp, splits): texts that occur in more than one split."""
    return rows.where(F.col(column).isNotNull()).groupBy(F.sha2(column, 256).alias("fp")).agg(F.sort_array(F.collect_set(split)).alias("splits")).where("size(splits) > 1")


def artifact_fingerprint(artifacts: Node) -> Column:
    """SHA-256 over the names and texts of a task's artifacts, by name; null where none has a text."""
    pieces = F.array(*[F.when(artifacts[n].is_text() & artifacts[n].as_("string").rlike(f"[^{WHITE}]"), F.concat(F.lit(n + "\0"), artifacts[n].as_("string"))) for n in sorted(V.ARTIFACTS)])
    pieces = F.filter(pieces, lambda x: x.isNotNull())
    return F.when(F.size(pieces) > 0, F.sha2(F.array_join(pieces, "\0"), 256))


def _keyed(rows: DataFrame, kinds: dict[str, str], *more: str) -> DataFrame:
    each = F.array(*[F.struct(F.lit(kind).alias("kind"), F.col(c).alias("key")) for kind, c in kinds.items()])
    return rows.select(*[F.col(c).alias(f"_{c}") for c in more], F.inline(each)).where("key IS NOT NULL")


def overlaps(rows: DataFrame, kinds: dict[str, str], split: str) -> DataFrame:
    """(kind, key, n, splits): keys that several rows share, for all kinds of keys in one pass.

    A key's splits are combined before the shuffle, so a key that most rows share costs a few numbers a task.
    Null keys are no keys.
    """
    found = _keyed(rows, kinds, split).groupBy("kind", "key").agg(F.count("*").alias("n"), F.sort_array(F.collect_set(f"_{split}")).alias("splits"))
    return found.where("n > 1")


def members(rows: DataFrame, shared: DataFrame, kinds: dict[str, str], name: str) -> DataFrame:
    """(kind, key, name) of the rows behind some overlaps, one row for each."""
    return _keyed(rows, kinds, name).join(shared.select("kind", "key"), ["kind", "key"], "left_semi").withColumnRenamed(f"_{name}", name)


def _grams(words: Column, n: int) -> Column:
    """Names of all runs of n words."""
    places = F.when(F.size(words) >= n, F.sequence(F.lit(1), F.size(words) - (n - 1)))
    return F.coalesce(F.transform(places, lambda i: F.xxhash64(F.slice(words, i, n))), F.array().cast("array<bigint>"))


def contained(docs: DataFrame, sought: DataFrame, doc_key: str, item_key: str) -> DataFrame:
    """(doc, item) where an item's text lies in a document's text, for each row of documents and item.

    The words of an item but for the outer two stand in any text that holds it as whole words. So a run of
    ``GRAM`` of them (or one, in shorter items) is an anchor: of an item's runs the one that fewest documents
    have is joined with the runs of the documents, and texts are compared only where it matches. Items without
    an inner word are sought by an automaton, in blocks of ``BLOCK_CHARS``. Null and empty items are sought
    nowhere, null documents hold nothing; keys may be null and repeat.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "contained")
    d = docs.select(F.col(doc_key).alias("d"), F.col("text").alias("t")).where("t IS NOT NULL")
    items = sought.where("text IS NOT NULL AND text <> ''").select(F.xxhash64(F.col(item_key), "text").alias("n"), F.col(item_key).alias("i"), F.col("text").alias("s"))
    words = F.split("s", WORD_ENDS)
    items = scratch.save(items.withColumn("inner", F.when(F.size(words) > 2, F.slice(words, F.lit(2), F.size(words) - 2)).otherwise(F.array().cast("array<string>"))), "items")
    runs = F.when(F.size("inner") >= GRAM, _grams(F.col("inner"), GRAM)).otherwise(_grams(F.col("inner"), 1))
    mine = items.select("n", F.explode(F.array_distinct(runs)).alias("h"))
    totals = items.agg(F.count_if(F.size("inner").between(1, GRAM - 1)).alias("single"), F.sum(F.size("inner")).alias("runs"), F.sum(F.when(F.size("inner") == 0, F.length("s"))).alias("plain")).first()
    small = (totals.runs or 0) <= BROADCAST_GRAMS
    sent = (lambda x: F.broadcast(x)) if small else (lambda x: x)
    out = None
    if totals.runs:
        have = F.filter(F.split("t", WORD_ENDS), lambda w: w != "")
        runs = _grams(F.col("w"), GRAM)
        every = d.select("d", have.alias("w")).select("d", F.explode(F.array_distinct(F.concat(runs, _grams(F.col("w"), 1)) if totals.single else runs)).alias("h"))
        met = scratch.save(every.join(sent(mine.select("h").distinct()), "h"), "met")
        often = met.groupBy("h").agg(F.count("*").alias("often"))
        anchors = mine.join(sent(often), "h").groupBy("n").agg(F.min(F.struct("often", "h")).alias("x"), F.count("*").alias("found"))
        whole = mine.groupBy("n").agg(F.count("*").alias("runs"))  # an item with a run that no document has is nowhere
        anchors = anchors.join(whole, "n").where("found = runs").select("n", F.col("x.h").alias("h"))
        pairs = met.join(sent(anchors), "h").select("d", "n").distinct()
        near = pairs.join(items.select("n", "i", "s").distinct(), "n")
        at = near.select(F.col("d").alias("k"), "i", "s")
        out = d.join(at, F.col("d").eqNullSafe(F.col("k"))).where(F.contains("t", "s")).select("d", "i")
    if totals.plain:
        plain = _plain(d, items.where(F.size("inner") == 0), int(totals.plain))
        out = plain if out is None else out.union(plain)
    if out is None:
        out = d.select("d", F.lit(None).cast(items.schema["i"].dataType).alias("i")).limit(0)
    return out.toDF(doc_key, item_key)


def _plain(d: DataFrame, items: DataFrame, chars: int) -> DataFrame:
    """(d, i) for items that are one or two words or none, by an automaton over a block of them."""
    kinds = {f.name: f.dataType.simpleString() for f in (*d.schema, *items.schema)}
    blocks, out = -(-chars // BLOCK_CHARS), None
    for k in range(blocks):
        block = items.where(F.pmod("n", F.lit(blocks)) == k).select("i", "s").collect()  # at most about BLOCK_CHARS characters
        sent = d.sparkSession.sparkContext.broadcast([(r.i, r.s) for r in block])

        def search(batches, sent=sent):
            import ahocorasick
            import pyarrow as pa

            tree, ids = ahocorasick.Automaton(), {}
            for i, s in sent.value:
                ids.setdefault(s, []).append(i)
            for s in ids:
                tree.add_word(s, s)
            tree.make_automaton()
            for b in batches:
                found = [(key, i) for key, t in zip(b.column("d").to_pylist(), b.column("t").to_pylist()) for s in ({s for _, s in tree.iter(t)} if ids else ()) for i in ids[s]]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], b.schema.field("d").type), pa.array([x for _, x in found])], ["d", "i"])

        part = d.mapInArrow(search, f"d {kinds['d']}, i {kinds['i']}")
        out = part if out is None else out.union(part)
    return out
