"""Mixing sources to target weights by a low-discrepancy schedule.

The mix has ``ratio`` times the words of all rows, shared over the sources by weight; a
source gives at most ``repeats`` times its own words, and what it can't give is shared
anew among the others by weight.

* *Slots.*  The mix is 2**k slots of equal size.  Slot i stands for the van der Corput
  point x = bit-reversed i / 2**k, and x falls to the source whose interval of the
  cumulative targets holds it (the slot on a border is shared).  As the points that a
  source holds are a run of bit-reversed numbers, each source lists its own slots; no
  range join is needed.  Slots are ranked per source in two steps, within chunks of
  consecutive slots and over the chunks' counts, so no window holds a whole source.
* *Blocks.*  The rows of a source, shuffled by a hash, lie on a line of words that repeats
  ``repeats`` times and is cut into blocks of a slot's size.  A source's block r goes to
  its slot of rank r.  Offsets on the line come from hash ranges: sums within a range, and
  over the ranges' sums.
* The line ends at the source's target, so taken words meet it to a word.

Words are runs of characters other than ASCII white space; null texts have none and,
like blank ones, are not in the mix.  Null is a source of its own, weighed last.  Rows
that are alike in every column are rows of their own.  An empty table gives an empty mix.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusmill.llm.common import checkpoint, free_name, row_digest

WORD = re.compile(rb"[^\x20\x09-\x0d]+")


def with_size(docs: DataFrame, text: str = "text", out: str = "size") -> DataFrame:
    """``docs`` without its text, with its number of words."""
    keep = [c for c in docs.columns if c != text]
    schema = docs.select(*keep).withColumn(out, F.lit(0).cast("long")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = [len(t.encode("utf-8", "surrogatepass").split()) if t else 0 for t in b.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(n, pa.int64())], names=[*keep, out])

    return docs.mapInArrow(run, schema)


def targets(sizes: DataFrame, weights: tuple[float, ...] = (3, 1, 2), ratio: float = 1.5, repeats: int = 2) -> DataFrame:
    """(source, source_size, target, low, total): one row per source of ``sizes`` (source,
    size).  ``low``: the targets of the sources before it.  These are windows over one
    row per source."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = W.orderBy(F.col("source").isNull(), "source")
    pick = F.array(*(F.lit(float(w)) for w in weights))
    per = per.withColumn("w", F.element_at(pick, ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")))
    everything = W.partitionBy(F.lit(0))
    per = per.withColumn("total", ratio * F.sum("source_size").over(everything))
    full = F.col("source_size") * float(repeats)
    # In order of full / w the sources are filled up until the level that the rest would
    # then have is no higher; the levels rise up to there and fall beyond.
    order = W.partitionBy(F.lit(0)).orderBy(full / F.col("w"), F.col("source").isNull(), "source").rowsBetween(W.unboundedPreceding, -1)
    before, weight = F.coalesce(F.sum(full).over(order), F.lit(0.0)), F.sum("w").over(everything) - F.coalesce(F.sum("w").over(order), F.lit(0.0))
    level = (F.col("total") - before) / weight
    per = per.withColumn("level", F.when(level <= full / F.col("w"), level))
    per = per.withColumn("level", F.max("level").over(everything))
    per = per.withColumn("target", F.when(F.col("level").isNull(), full).otherwise(F.least(full, F.col("level") * F.col("w"))))
    low = F.coalesce(F.sum("target").over(by_name.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    return per.withColumn("low", low).select("source", "source_size", "target", "low", "total")


def line_up(sizes: DataFrame, seed: int, per_range: int = 20_000) -> DataFrame:
    """``sizes`` (with source, size, row_key) shuffled per source, with ``at``, the words
    before the row on the source's line, and ``nth``, the row's place in its hash range
    ``part``."""
    bits = max(0, math.ceil(math.log2(max(1, sizes.count() / per_range))))
    mixed = F.conv(F.substring(F.md5(F.concat(F.col("row_key"), F.lit(f":{seed}"))), 1, 15), 16, 10).cast("long")  # 60 bits
    rows = sizes.withColumn("h", mixed).withColumn("part", F.shiftright("h", 60 - bits) if bits else F.lit(0).cast("long"))
    inside = W.partitionBy("source", "part").orderBy("h", "row_key")
    rows = rows.withColumn("nth", F.row_number().over(inside)).withColumn("inner", F.coalesce(F.sum("size").over(inside.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    parts = rows.groupBy("source", "part").agg(F.sum("size").alias("n"))
    earlier = W.partitionBy("source").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = parts.select("part", F.col("source").alias("s"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("outer"))
    same = rows["source"].eqNullSafe(parts["s"]) & (rows["part"] == parts["part"])
    return rows.join(parts, same).select(rows["*"], (F.col("inner") + F.col("outer")).alias("at")).drop("h", "inner")


def schedule(goal: DataFrame, bits: int, chunk_bits: int = 16) -> DataFrame:
    """(source, slot, rank): each source's slots of the 2**bits, in order."""
    n = float(1 << bits)
    lo, hi = F.floor(F.col("low") / F.col("total") * n), F.ceil((F.col("low") + F.col("target")) / F.col("total") * n) - 1
    own = goal.where("target > 0").select("source", F.greatest(lo, F.lit(0)).alias("lo"), F.least(hi, F.lit((1 << bits) - 1)).alias("hi")).where("hi >= lo")
    step = 1 << 14  # runs of points, so that no row holds a long array
    runs = own.select("source", "lo", "hi", F.explode(F.sequence(F.floor(F.col("lo") / step), F.floor(F.col("hi") / step))).alias("run")).repartition("source", "run")
    points = runs.select("source", F.explode(F.sequence(F.greatest("lo", F.col("run") * step), F.least("hi", F.col("run") * step + step - 1))).alias("point"))
    slots = points.select("source", F.reverse(F.lpad(F.bin("point"), max(bits, 1), "0")).alias("r")).select("source", F.conv("r", 2, 10).cast("long").alias("slot"))
    slots = slots.withColumn("chunk", F.shiftright("slot", chunk_bits))
    counts = slots.groupBy("source", "chunk").agg(F.count(F.lit(1)).alias("n"))
    earlier = W.partitionBy("source").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    counts = counts.select("chunk", F.col("source").alias("s"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = slots.withColumn("inner", F.row_number().over(W.partitionBy("source", "chunk").orderBy("slot")) - 1)
    same = ranked["source"].eqNullSafe(counts["s"]) & (ranked["chunk"] == counts["chunk"])
    return ranked.join(counts, same).select(ranked["source"], "slot", (F.col("inner") + F.col("before")).alias("rank"))


def mix(sizes: DataFrame, weights: tuple[float, ...] = (3, 1, 2), ratio: float = 1.5, repeats: int = 2, block: int = 400, seed: int = 11) -> tuple[DataFrame, DataFrame]:
    """The mix of the rows of ``sizes`` (source, size and row_key, which differs from row
    to row or marks equal rows).  Returns its pieces (source, part, nth, pass, slot, start,
    words: a span of words of row (source, part, nth) in a slot) and the rows with their
    source's source_size and target."""
    goal = checkpoint(targets(sizes, weights, ratio, repeats))
    laid = checkpoint(line_up(sizes, seed))
    total = goal.agg(F.max("total")).first()[0] or 0.0
    bits = max(0, math.ceil(math.log2(max(1.0, total / block))))
    size = total / (1 << bits)  # words of a slot
    g = goal.select(F.col("source").alias("s"), "source_size", "target")
    rows = laid.join(F.broadcast(g) if g.count() <= 10_000 else g, laid["source"].eqNullSafe(g["s"])).drop("s")
    if not total:
        size = 1.0
    passes = rows.where("size > 0").withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    begin = F.col("pass") * F.col("source_size") + F.col("at")
    end = F.least(begin + F.col("size"), F.round("target").cast("long"))
    spans = passes.select("source", "part", "nth", "pass", begin.alias("begin"), end.alias("end")).where("end > begin")
    edge = lambda k: F.floor(k * F.lit(size))
    first, last = F.floor(F.col("begin") / size) - 1, F.floor((F.col("end") - 1) / size) + 1
    cut = spans.withColumn("rank", F.explode(F.sequence(F.greatest(first, F.lit(0)), last)))
    cut = cut.withColumn("from", F.greatest("begin", edge(F.col("rank")))).withColumn("to", F.least("end", edge(F.col("rank") + 1))).where("to > from")
    cut = cut.select("source", "part", "nth", "pass", "rank", (F.col("from") - F.col("begin")).alias("start"), (F.col("to") - F.col("from")).alias("words"))
    slots = schedule(goal, bits).select(F.col("source").alias("s"), F.col("rank").alias("r"), "slot")
    pieces = cut.join(slots, cut["source"].eqNullSafe(slots["s"]) & (cut["rank"] == slots["r"])).drop("s", "r")
    return pieces, rows


def op7_mixing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    sizes = checkpoint(with_size(docs).withColumn("row_key", F.concat_ws(":", F.col("doc_id").cast("string"), "size")))
    pieces, rows = mix(sizes)
    key = ["source", "part", "nth"]
    every = rows.select(*key, "doc_id", "size", "source_size", "target", F.lit(0).cast("long").alias("words"))
    some = pieces.select(*key, "words")
    whole = every.unionByName(some, allowMissingColumns=True).groupBy(*key)
    kept = [F.max(c).alias(c) for c in ("doc_id", "size", "source_size", "target")]
    return whole.agg(*kept, F.sum("words").alias("taken")).select("doc_id", "size", "source_size", "target", "taken")


def mix_documents(docs: DataFrame, text: str = "text", source: str = "source", **options) -> DataFrame:
    """``docs`` as the mix takes them, in its columns and with whole texts: a row for each
    time that a document is taken, in order of slots within a partition.  The one document
    of a source at which its target is met is taken or left, whichever ends nearer to the
    target.  Of rows equal in all columns, each is taken for itself."""
    key = free_name(docs, "row_key")
    keyed = docs.withColumn(key, row_digest(docs))
    slim = keyed.select(F.col(key).alias("row_key"), F.col(source).cast("string").alias("source"), F.col(text).alias("text"))
    pieces, rows = mix(checkpoint(with_size(slim)), **options)
    place = ["source", "part", "nth"]
    taken = pieces.groupBy(*place, "pass").agg(F.sum("words").alias("words"), F.min("slot").alias("slot"))
    r = rows.select("row_key", "size", *(F.col(c).alias(f"r_{c}") for c in place))
    same = taken["source"].eqNullSafe(r["r_source"]) & (taken["part"] == r["r_part"]) & (taken["nth"] == r["r_nth"])
    taken = taken.join(r, same).where(2 * F.col("words") >= F.col("size")).select(F.col("row_key").alias(key), "slot")
    one = free_name(keyed, "take")
    # one row of those that are alike, once for each take of any of them
    full = keyed.dropDuplicates([key]).join(taken.select(key, F.col("slot").alias(one)), key)
    return full.sortWithinPartitions(one).select(*docs.columns)
