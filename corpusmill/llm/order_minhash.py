"""Order MinHash fingerprints, whose likeness follows edit distance.

A text's k-mers (runs of ``K`` code points; a shorter text is one) are numbered by
occurrence, so repeats differ.  Each of ``ORDERS`` random orders picks the ``PICK``
smallest numbered k-mers; these k-mers, put back in the order of the text, are hashed
as a tuple.  The fingerprint is the list of those hashes, the likeness of two
fingerprints the share of orders with equal hashes: it falls with both the k-mers lost
and those moved.

The orders are XOR permutations of one 64-bit hash: an order's smallest elements are
those that share the longest prefix with its mask, so after one sort they lie in one
short aligned block that binary search finds.  The cost hardly depends on ``ORDERS``.

``fingerprint_edits`` compares each text with an edited version that takes its tail from
the next document by ascending id.  Documents go to ranges of ids, each with a copy of
the next range's first row, and are read there in order: no window spans the table.
Null texts count as empty; the empty text has a fingerprint of its own.  Of rows with the
same id the order is that of the texts' hashes; null ids come first.  A single row is its
own successor.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import free_name

K = 8
ORDERS = 32
PICK = 2
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)
_PLACE = np.uint64(24)  # low bits that hold a position while sorting


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


MASKS = _mix(np.arange(1, ORDERS + 1, dtype=np.uint64) * _ODD)


def kmers(text: str, k: int = K) -> np.ndarray:
    """40-bit hashes of the k-mers, shifted up by 24 bits."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    if len(c) <= k:
        h = np.zeros(1, np.uint64)
        for x in c:
            h = _mix(h + x + _ODD)
        h = _mix(h + np.uint64(len(c)))
    else:
        h, done = _mix(c + _ODD), 1
        while done < k:  # joins two runs of `done`, overlapping at the end
            step = min(done, k - done)
            h = _mix(h[: len(h) - step] * _ODD + h[step:])
            done += step
    return h >> _PLACE << _PLACE


def sketch(text: str | None, k: int = K, pick: int = PICK, masks: np.ndarray = MASKS) -> np.ndarray:
    """The fingerprint as 32-bit numbers, one per order."""
    text = text or ""
    if not text:
        return np.zeros(len(masks), np.uint32)
    h = kmers(text, k)
    n = len(h)
    place = np.arange(n, dtype=np.uint64)
    if n < 1 << int(_PLACE):
        s = np.sort(h | place)
        pos = (s & np.uint64((1 << int(_PLACE)) - 1)).astype(np.int64)
        key = s >> _PLACE
    else:
        pos = np.argsort(h, kind="stable")
        key = h[pos] >> _PLACE
    first = np.concatenate(([True], key[1:] != key[:-1]))
    run = np.arange(n) - np.maximum.accumulate(np.where(first, np.arange(n), 0))
    numbered = _mix(key * _ODD + run.astype(np.uint64) * _MIX2)
    order = np.argsort(numbered)
    v = numbered[order]
    take = min(pick, n)
    out = np.empty((len(masks), take), np.int64)
    bits = max(0, n.bit_length() - 4)
    todo = np.arange(len(masks))
    while len(todo):
        m = masks[todo]
        if bits:
            low = m >> np.uint64(64 - bits) << np.uint64(64 - bits)
            lo = np.searchsorted(v, low)
            hi = np.searchsorted(v, low + np.uint64((1 << (64 - bits)) - 1), side="right")
        else:
            lo, hi = np.zeros(len(m), np.int64), np.full(len(m), n)
        ok = hi - lo >= take
        if ok.any():
            a, size, mm = lo[ok], (hi - lo)[ok], m[ok]
            width = int(size.max())
            at = a[:, None] + np.arange(width)
            inside = np.arange(width) < size[:, None]
            dist = np.where(inside, v[np.minimum(at, n - 1)] ^ mm[:, None], np.uint64(0xFFFFFFFFFFFFFFFF))
            best = np.argsort(dist, axis=1)[:, :take]
            out[todo[ok]] = order[a[:, None] + best]
        todo = todo[~ok]
        bits = max(0, bits - 2)
    where = np.sort(pos[out], axis=1)  # back in the order of the text
    acc = np.zeros(len(masks), np.uint64)
    for j in range(take):
        acc = _mix(acc * _ODD + h[where[:, j]] + np.uint64(j + 1))
    return (acc >> np.uint64(32)).astype(np.uint32)


def as_text(fp: np.ndarray) -> str:
    return fp.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def ranges(docs: DataFrame, id_col: str, text: str, per_range: int = 8_000_000) -> tuple[DataFrame, str, str, str]:
    """``docs`` with its id range, a mark on the copies of the next range's first row,
    and a hash that orders rows of one id."""
    part, guest, tie = (free_name(docs, x) for x in ("part", "guest", "tie"))
    n = docs.agg(F.sum(F.length(text)).alias("c")).first()["c"] or 0
    k = max(1, -(-n // per_range))
    cuts: list = []
    if k > 1:
        cuts = sorted(set(docs.select(F.percentile_approx(id_col, [i / k for i in range(1, k)], 100 * k).alias("q")).first()["q"] or []))
    # two levels of cuts, so that a row is compared with about 2 * sqrt(k) of them
    wide = max(1, int(len(cuts) ** 0.5))
    fine = [cuts[i : i + wide] for i in range(0, len(cuts), wide)] or [[]]
    if cuts:
        below = F.size(F.filter(F.array(*(F.lit(f[-1]) for f in fine)), lambda x: x < F.col(id_col)))
        nested = F.array(*(F.array(*(F.lit(x) for x in f)) for f in fine))
        inner = F.size(F.filter(F.coalesce(F.get(nested, below), F.array().cast(f"array<{docs.schema[id_col].dataType.simpleString()}>")), lambda x: x < F.col(id_col)))
        number = F.when(F.col(id_col).isNull(), F.lit(0)).otherwise(below * wide + inner)
    else:
        number = F.lit(0)
    rows = docs.withColumn(part, number.cast("long")).withColumn(tie, F.xxhash64(F.coalesce(F.col(text), F.lit("")))).withColumn(guest, F.lit(False))
    null_first = F.col(id_col).isNotNull()
    lead = rows.groupBy(part).agg(F.min(F.struct(null_first.alias("a"), F.col(id_col).alias("b"), F.col(tie).alias("c"))).alias("m")).orderBy(part).collect()  # a row per range
    if not lead:
        return rows, part, guest, tie
    plan = [(r[part], lead[i - 1][part], r["m"]["b"], r["m"]["c"]) for i, r in enumerate(lead)]
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    firsts = spark.createDataFrame(plan, f"own long, goal long, b {kind}, c long")
    copies = rows.join(F.broadcast(firsts), (rows[part] == firsts["own"]) & rows[id_col].eqNullSafe(firsts["b"]) & (rows[tie] == firsts["c"]))
    copies = copies.withColumn(part, F.col("goal")).withColumn(guest, F.lit(True)).select(*rows.columns)
    return rows.unionByName(copies), part, guest, tie


def fingerprint_edits(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited version, with their likeness."""
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    rows, part, guest, tie = ranges(slim, "doc_id", "text")
    kind = slim.schema["doc_id"].dataType.simpleString()
    rows = rows.repartition(part).sortWithinPartitions(part, guest, F.col("doc_id").isNotNull(), "doc_id", tie)

    def edit(cur, nxt):
        _, _, body, fp = cur
        n = len(body)
        q = n // 4
        new = body[: n - q] + nxt[2][:q]
        efp = sketch(new)
        sha = hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest()
        return cur[1], n, sha, as_text(fp), as_text(efp), likeness(fp, efp), likeness(fp, nxt[3])

    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the row before: part, id, text, fingerprint
        for b in batches:
            out = []
            for p, i, body, g in zip(*(b.column(c).to_pylist() for c in (part, "doc_id", "text", guest)), strict=True):
                if held is None or held[0] != p:
                    if g:
                        continue  # a further copy of a repeated first row
                    held = (p, i, body or "", sketch(body))
                    continue
                row = (p, i, body or "", sketch(body))
                out.append(edit(held, row))
                held = None if g else row
            cols = list(zip(*out, strict=True)) or [()] * 7
            kinds = [b.schema.field("doc_id").type, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)

    return rows.select(part, guest, "doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def op3_order_minhash(spark, sf_dir: str) -> DataFrame:
    return fingerprint_edits(spark.read.parquet(f"{sf_dir}/documents.parquet"))
