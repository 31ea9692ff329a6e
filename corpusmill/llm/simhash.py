"""SimHash near duplicates found through pivot distance tables.

A text's fingerprint is the bitwise majority over the XXH64 values of its word
shingles.  Every distinct fingerprint gets a row of Hamming distances to a fixed set of
reference fingerprints (pivots): zero, a mask for each two-bit block, and random ones.

* By the triangle inequality two fingerprints within ``max_distance`` differ by no more
  than that in any coordinate; a pair with a larger maximum coordinate difference is
  discarded, the rest verified by their exact Hamming distance.
* Candidates: the difference of the distances to zero and to a block's mask is the
  number of bits set in that block, so a pair that agrees in a block agrees in that
  difference.  The 32 blocks form ``max_distance + 2`` groups; a pair within
  ``max_distance`` bits agrees in two groups at least, so it meets under the key made of
  the coordinates of some two groups.  No pair is lost.

Keys with few fingerprints are compared in vectorised runs.  A key with more than
``dense`` of them is linked exactly without comparing pairs: two fingerprints within two
bits share a point within one bit of both, so each is sent to its 65 points (in general:
the points within half the distance) and the least fingerprint of every point becomes the
hub of the others.

Rows with null or blank text have fingerprint zero and link like any other.  Repeated
rows and ids keep a row each.  Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.llm.common import checkpoint, components, free_name, lookup, others

BLOCK_BITS = 2
N_BLOCKS = 64 // BLOCK_BITS
RANDOM_PIVOTS = 31


def pivots() -> np.ndarray:
    masks = [((1 << BLOCK_BITS) - 1) << (BLOCK_BITS * b) for b in range(N_BLOCKS)]
    drawn = np.random.default_rng(42).integers(0, 1 << 64, RANDOM_PIVOTS, dtype=np.uint64)
    return np.concatenate([np.array([0, *masks], np.uint64), drawn])


def fingerprint(text: str | None, words: int = 3, seed: int = 42) -> int:
    """The unsigned fingerprint of one text (A-Z lower-cased, ASCII white space)."""
    toks = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not toks:
        return 0
    line = b" ".join(toks)
    if len(toks) <= words:
        hashes = [xxhash.xxh64_intdigest(line, seed)]
    else:
        ends = np.cumsum(np.fromiter(map(len, toks), np.int64, len(toks)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        digest = xxhash.xxh64_intdigest
        hashes = [digest(line[s:e], seed) for s, e in zip(starts[: len(toks) - words + 1].tolist(), ends[words - 1 :].tolist())]
    h = np.array(hashes, np.uint64)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), 1 << 16):
        part = h[i : i + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, text: str = "text", out: str = "fp", words: int = 3, seed: int = 42) -> DataFrame:
    """``docs`` without its text column, with the signed 64-bit fingerprint as ``out``,
    which replaces a column of that name."""
    kept = others(docs, [text, out])
    keep = kept.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t, words, seed) for t in b.column(text).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(fps)], names=[*keep, out])

    return docs.mapInArrow(run, T.StructType(kept.fields).add(out, "long"))


def keyed(nodes: DataFrame, max_distance: int) -> DataFrame:
    """(combo, key, fp): a row for each pair of coordinate groups."""
    groups = np.array_split(np.arange(N_BLOCKS), max_distance + 2)
    combos = [np.concatenate(p) for p in combinations(groups, 2)]
    refs = pivots()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = b.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            dist = np.bitwise_count(fp[:, None] ^ refs[None, : N_BLOCKS + 1]).astype(np.int64)
            weight = (dist[:, :1] + BLOCK_BITS - dist[:, 1:]) // 2  # bits set in each block
            for k, blocks in enumerate(combos):
                base = np.uint64(BLOCK_BITS + 1) ** np.arange(len(blocks), dtype=np.uint64)
                key = (weight[:, blocks].astype(np.uint64) * base).sum(axis=1, dtype=np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(fp), k, np.int32)), pa.array(key.view(np.int64)), pa.array(fp.view(np.int64))], names=["combo", "key", "fp"]
                )

    return nodes.mapInArrow(run, "combo int, key long, fp long")


def _link_runs(max_distance: int, stats: bool = False):
    """mapInArrow over rows sorted by (combo, key): links within each run as stars."""
    refs = pivots()

    def links(group: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        table = np.bitwise_count(fp[:, None] ^ refs[None, :]).astype(np.int8)
        label = np.arange(len(fp))
        a_all, b_all = [], []
        shift = 1
        live = np.arange(len(fp))
        while True:
            live = live[live + shift < len(fp)]
            live = live[group[live] == group[live + shift]]
            if not len(live):
                break
            a, b = live, live + shift
            near = np.abs(table[a] - table[b]).max(axis=1) <= max_distance  # the filter
            a, b = a[near], b[near]
            near = np.bitwise_count(fp[a] ^ fp[b]) <= max_distance  # the check
            a_all.append(a[near])
            b_all.append(b[near])
            shift += 1
        a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (a_all, b_all))
        while True:  # least member of each set, by pointer jumping
            low = np.minimum(label[a], label[b])
            new = label.copy()
            np.minimum.at(new, a, low)
            np.minimum.at(new, b, low)
            np.minimum.at(new, label[a], low)
            np.minimum.at(new, label[b], low)
            new = new[new]
            if (new == label).all():
                break
            label = new
        moved = np.flatnonzero(label != np.arange(len(fp)))
        return fp[moved], fp[label[moved]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def flush(rows):
            combo, key, fp = rows
            new = np.concatenate(([True], (combo[1:] != combo[:-1]) | (key[1:] != key[:-1])))
            u, v = links(np.cumsum(new), fp.view(np.uint64))
            return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"])

        for b in batches:
            cols = tuple(b.column(c).to_numpy(zero_copy_only=False) for c in ("combo", "key", "fp"))
            if not len(cols[0]):
                continue
            cols = tuple(np.concatenate([*(h[i] for h in held), cols[i]]) for i in range(3))
            # the last run may go on in the next batch
            end = np.flatnonzero((cols[0] != cols[0][-1]) | (cols[1] != cols[1][-1]))
            cut = int(end[-1]) + 1 if len(end) else 0
            if cut:
                yield flush(tuple(c[:cut] for c in cols))
            held = [tuple(c[cut:] for c in cols)]
        if held and len(held[0][0]):
            yield flush(held[0])

    return run


def _points(fp: str, radius: int):
    """Array of all points within ``radius`` bits of column ``fp``."""
    flips = [0]
    for r in range(1, radius + 1):
        flips += [sum(1 << b for b in bits) for bits in combinations(range(64), r)]
    signed = [f - (1 << 64) if f >> 63 else f for f in flips]
    return F.array(*(F.col(fp).bitwiseXOR(F.lit(f).cast("long")) for f in signed))


def near_links(nodes: DataFrame, max_distance: int = 2, dense: int = 1024) -> DataFrame:
    """Links (u, v) between the distinct fingerprints ``nodes.fp`` whose connected
    components are those of all pairs within ``max_distance`` bits, an even number (the
    points halfway between two fingerprints need one)."""
    if max_distance % 2:
        raise ValueError("max_distance must be even")
    rows = checkpoint(keyed(nodes, max_distance))
    size = rows.groupBy("combo", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    rows = rows.join(size, ["combo", "key"])
    runs = rows.where(F.col("n") <= dense).select("combo", "key", "fp").repartition("combo", "key").sortWithinPartitions("combo", "key", "fp")
    links = runs.mapInArrow(_link_runs(max_distance), "u long, v long")
    crowded = rows.where(F.col("n") > dense).select("fp").distinct()
    spread = crowded.select("fp", F.explode(_points("fp", max_distance // 2)).alias("point"))
    hubs = spread.groupBy("point").agg(F.min("fp").alias("v"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    stars = spread.join(hubs, "point").where("fp <> v").select(F.col("fp").alias("u"), "v")
    return links.unionByName(stars).distinct()


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text: str = "text", words: int = 3, max_distance: int = 2) -> DataFrame:
    """(id, fp, component) per row of ``docs``: the fingerprint and the least id among
    all rows reachable over links of at most ``max_distance`` differing bits (null ids
    are passed over; a component of null ids only has null)."""
    fps = checkpoint(with_fingerprint(docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")), words=words))
    return _with_component(fps, max_distance)


def _with_component(fps: DataFrame, max_distance: int) -> DataFrame:
    nodes = checkpoint(fps.groupBy("fp").agg(F.min("id").alias("low"), F.count(F.lit(1)).alias("n")))
    roots = checkpoint(components(near_links(nodes.select("fp"), max_distance)).select(F.col("node").alias("fp"), "root"))
    placed = nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    low = placed.groupBy("root").agg(F.min("low").alias("component"))
    return lookup(fps, checkpoint(placed.join(low, "root").select("fp", "n", "component")), "fp", "n")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", words: int = 3, max_distance: int = 2) -> DataFrame:
    """One row of every component: that with the least id (null last), ties by the
    text's digest; of rows equal in both any one.  Columns and texts stay as they are."""
    mark, out = free_name(docs, "row_key"), docs.columns
    body = F.coalesce(F.col(text), F.lit(""))
    key = F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.lit(":"), F.col(text).isNull().cast("string"), body))
    tagged = docs.withColumn(mark, key)
    slim = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"), key.alias("row_key"))
    fps = checkpoint(with_fingerprint(slim, words=words))
    nodes = fps.groupBy("fp").agg(F.min(F.struct(F.col("id").isNull().alias("no"), "id", "row_key")).alias("low"))
    nodes = checkpoint(nodes)
    roots = components(near_links(nodes.select("fp"), max_distance)).select(F.col("node").alias("fp"), "root")
    first = nodes.join(roots, "fp", "left").groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("low").alias("low"))
    kept = first.select(F.col("low.row_key").alias(mark)).distinct()
    return tagged.join(kept, mark, "left_semi").dropDuplicates([mark]).select(*out)


def op9_simhash(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = simhash_components(docs)
    return rows.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))
