"""N-gram Jaccard join: a blocked sparse product of the document by n-gram incidence.

A document's row of the incidence matrix is its set of distinct word shingles.  Two
documents link when the Jaccard likeness of their sets is at least ``num / den``.  The
result is one row per document with its set size and the least id reachable by links.

* Documents with equal sets are one row of the matrix (a class); copies are never paired.
* Shingles are 64-bit hashes.  All sets follow one order: shingles that are not heavy by
  hash, then the heavy ones by hash.  A link needs an overlap of ``ceil(n * num / den)``
  (the bound by size).  With ``few = max(1, n // 20)``, at least ``few`` of a row's first
  ``n - ceil(n * num / den) + few`` shingles are common to both rows, and where the first
  part of one row ends earlier in the order, these are in both first parts.  So only first
  parts are multiplied, and a pair with less than the smaller ``few`` can't link.  Heavy shingles are
  those that many documents share; which ones count as heavy changes the work, never the
  result.  There are at most ``max_heavy`` of them by their threshold, 8 MB to broadcast.
* Columns with one row yield nothing and go after one count, and so do rows with fewer than
  ``few`` columns left (for the smallest partner that their size allows), which removes
  rows that share a phrase by chance.  In the *star* step each column sends its rows to a
  few pivot rows, and each row joins the family of the pivot that most rows meet, among
  those with which it shares many columns.
* Within a *family* sets are told by what differs from its centre (the shingles that most
  members have).  Sets that differ from it by ``d`` and ``d'`` shingles differ from each
  other by ``d + d'`` less twice what both differences hold.  So members near the centre
  link for certain, with the nearest as their star.  A link of any other member needs an
  overlap of the two differences, which is the larger the further out they are: first
  parts of the differences, rare shingles first, are multiplied instead of those of the
  sets, so that what the whole family has in common makes no pairs.
* The *product* then covers what may still matter: pairs of rows in one column whose
  families differ.  A column with many rows is cut into blocks of rows, and each pair
  of blocks is a key of its own.  Overlaps add up per pair.  A pair is discarded when the
  sizes differ too much, or when its overlap so far plus what can follow (the last common
  shingle, or the end of the first part) stays below the overlap that both sizes need.  The pairs left are checked on
  their whole sets.

So each pair of different texts that links is checked or is already connected; nothing is
capped or sampled.  Which family a row joins changes the work, never the result.  Rows with null or blank text have an empty set and link with nothing
(each is its own component).  Rows without an id take part; a component of such rows only
has a null id.  Repeated rows and ids keep a row each.  Other columns of the input are
not read.  Empty tables give empty results.  Very long texts are processed whole, a text
at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.llm.common import checkpoint, components, lookup
from corpusmill.operators.joins import broadcast_if_small

#: Shingles gathered before they are counted, in a task.
CHUNK = 1 << 22
#: First parts are long enough that one in so many of a row's shingles is common.
FEW = 20
#: Bytes of values of tables that the driver makes a broadcast of, but for the keys of
#: texts, as whole texts would be shuffled instead.
SMALL = 1 << 24
#: A pivot may be a row's if they share at least one in so many of the columns that the row
#: shares with any pivot.
NEAR = 4
#: Shingles that at least one in so many of a family's differences hold are counted apart.
OFTEN = 64
#: A row stays in its family if its set and the pivot's differ in this share of both at most.
APART = 0.9


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return h ^ (h >> np.uint64(27))


def shingle_set(text: str | None, words: int = 5) -> np.ndarray:
    """Sorted hashes of the distinct shingles of one text (A-Z lower-cased, ASCII white
    space); a text with fewer words is one shingle, one without words has none."""
    toks = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not toks:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(xxhash.xxh3_64_intdigest, toks), np.uint64, len(toks))
    size = min(words, len(w))
    h = np.full(len(w) - size + 1, size, np.uint64)
    for k in range(size):
        h = _mix(h ^ w[k : len(w) - size + 1 + k])
    return np.unique(h)


def links(a: np.ndarray, b: np.ndarray, num: int = 4, den: int = 5) -> bool:
    """Is the Jaccard likeness of two sets at least num / den?"""
    common = len(np.intersect1d(a, b, assume_unique=True))
    return den * common >= num * (len(a) + len(b) - common)


def heavy_shingles(docs: DataFrame, words: int, max_heavy: int, least: int = 32) -> np.ndarray:
    """Sorted shingles found in at least ``max(least, all / max_heavy)`` documents as far
    as tasks saw them often, ``all`` being the number of (document, shingle) pairs; so
    ``max_heavy`` at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        total = size = 0

        def flush() -> pa.RecordBatch:
            values, n = np.unique(np.concatenate(held), return_counts=True)
            often = n >= max(4, size // max_heavy)
            return pa.RecordBatch.from_arrays([pa.array(values[often].view(np.int64)), pa.array(n[often].astype(np.int64))], names=["h", "n"])

        for b in batches:
            for text in b.column("text"):
                s = shingle_set(text.as_py(), words)
                held.append(s)
                size += len(s)
                total += len(s)
                if size >= CHUNK:
                    yield flush()
                    held, size = [], 0
        if size:
            yield flush()
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([total], pa.int64())], names=["h", "n"])

    seen = checkpoint(docs.mapInArrow(count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")))
    total = seen.where("h is null").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    cut = max(least, -(-total // max_heavy))
    found = seen.where(F.col("h").isNotNull() & (F.col("n") >= cut)).select("h").toArrow().column("h").to_numpy().astype(np.int64)
    return np.sort(found.view(np.uint64))


def _rows(docs: DataFrame, heavy: np.ndarray, words: int, num: int, den: int) -> DataFrame:
    """(id, key, digest, n, prefix) per row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(heavy)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = shared.value
        for b in batches:
            sizes, digests, prefixes = [], [], []
            for text in b.column("text"):
                s = shingle_set(text.as_py(), words)
                n = len(s)
                digests.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                sizes.append(n)
                if len(often) and n:
                    at = np.minimum(np.searchsorted(often, s), len(often) - 1)
                    late = often[at] == s
                    s = np.concatenate((s[~late], s[late]))
                prefixes.append(s[: n - -(-n * num // den) + max(1, n // FEW) if n else 0].view(np.int64))
            lengths = np.cumsum([0, *map(len, prefixes)]).astype(np.int32)
            flat = np.concatenate(prefixes) if prefixes else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("id"),
                    b.column("key"),
                    pa.array(digests, pa.binary()),
                    pa.array(sizes, pa.int32()),
                    pa.ListArray.from_arrays(pa.array(lengths), pa.array(flat)),
                ],
                names=["id", "key", "digest", "n", "prefix"],
            )

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"id {kind}, key string, digest binary, n int, prefix array<long>")


def _texts(pairs: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """(u, v, left, right): the texts of ``pairs`` (u, v).  Only texts of v, and those of
    u once per 4096 of its pairs, are shuffled."""
    salts = F.ceil(F.col("uses") / 4096).cast("int")
    uses = pairs.groupBy("u").agg(F.count(F.lit(1)).alias("uses")).select("u", salts.alias("salts"))
    dealt = pairs.join(uses, "u").withColumn("salt", F.pmod(F.xxhash64("v"), F.col("salts")).cast("int"))
    place = classes.select("node", "key", "times")
    right = checkpoint(dealt.join(place.withColumnRenamed("node", "v"), "v").select("u", "v", "salt", "key", "times"))
    left = checkpoint(uses.join(place.withColumnRenamed("node", "u"), "u").select("u", "salts", "key", "times"))

    def texts(wanted: DataFrame, row: list[str], out: str) -> DataFrame:
        found = docs.select("key", F.col("text").alias(out)).join(broadcast_if_small(wanted), "key")
        if wanted.where("times > 1").take(1):  # equal in id and text
            found = found.where("times = 1").unionByName(found.where("times > 1").dropDuplicates(row))
        return found.drop("key", "times")

    spread = F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt")
    lefts = texts(left, ["u"], "left").select("u", spread, "left")
    return texts(right, ["u", "v"], "right").join(lefts, ["u", "salt"]).select("u", "v", "left", "right")


def _pair_sets(b: pa.RecordBatch, words: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The two sets of each row of a batch of ``_texts``."""
    last, last_set = None, None
    for u, one, other in zip(b.column("u").to_pylist(), b.column("left"), b.column("right")):
        if u != last:
            last, last_set = u, shingle_set(one.as_py(), words)
        yield last_set, shingle_set(other.as_py(), words)


def _check(pairs: DataFrame, classes: DataFrame, docs: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """The rows of ``pairs`` (u, v) whose whole sets link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            mask = pa.array([links(x, y, num, den) for x, y in _pair_sets(b, words)], pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column("u").filter(mask), b.column("v").filter(mask)], names=["u", "v"])

    return checkpoint(_texts(pairs, classes, docs).mapInArrow(run, "u long, v long"))


def _fits(n: Column, m: Column, num: int, den: int) -> Column:
    """The bound by size: may sets of n and m shingles link?"""
    return F.least(n, m) * den >= F.greatest(n, m) * num


def _few(n: Column) -> Column:
    return F.greatest(F.lit(1), F.floor(n / FEW))


def _enough(c: Column, n: Column, m: Column, num: int, den: int) -> Column:
    """May sets of n and m shingles link whose first parts share c?  A common shingle that
    is not in both first parts comes after the end of one of them."""
    rest = F.greatest(*(F.ceil(x * num / den) - _few(x) for x in (n, m)))
    return ((c + rest) * (num + den) >= (n + m) * num) & (c >= F.least(_few(n), _few(m)))


def _families(cells: DataFrame, pivots: int) -> DataFrame:
    """(node, fam) of the rows that meet a pivot: of the pivots that share enough columns
    with a row, the one that most rows meet, or the one that this pivot has chosen itself.
    A column's pivots are its first rows by ``pivots`` hashes, so columns of the same rows
    have the same pivots."""
    firsts = [F.min_by("node", F.xxhash64("node", F.lit(k))) for k in range(pivots)]
    dealt = cells.select("h", "node").repartition("h")  # one exchange for both sides
    tops = dealt.groupBy("h").agg(F.array_distinct(F.array(*firsts)).alias("tops"))
    met = dealt.join(tops, "h").select("node", F.explode("tops").alias("top")).where("top <> node")
    overlap = met.groupBy("node", "top").agg(F.count(F.lit(1)).alias("c"))
    most = F.max("c").over(Window.partitionBy("node"))  # at most its columns' pivots
    near = checkpoint(overlap.withColumn("most", most).where(F.col("c") * NEAR >= F.col("most")).select("node", "top"))
    known = checkpoint(near.groupBy("top").agg(F.count(F.lit(1)).alias("uses")).withColumn("w", F.col("uses")))
    choices = lookup(near, known, "top", "w", small_bytes=SMALL).unionByName(known.select(F.col("top").alias("node"), "top", "uses"))
    chosen = checkpoint(choices.groupBy("node").agg(F.max_by("top", F.struct("uses", "top")).alias("top")))
    after = chosen.withColumnRenamed("top", "fam").join(known.select(F.col("top").alias("node"), "uses"), "node").withColumnRenamed("node", "top")
    return checkpoint(lookup(chosen, checkpoint(after), "top", "uses", small_bytes=SMALL).select("node", "fam"))


def _differences(families: DataFrame, classes: DataFrame, docs: DataFrame, words: int) -> DataFrame:
    """(node, fam, n, diff) per row of a family of several that is like its pivot: the shingles that only one of
    the row's set and the family's centre has, rare ones in the family's differences
    first.  All of a family have one order."""
    sizes = checkpoint(families.groupBy("fam").agg(F.count(F.lit(1)).alias("size")).where("size > 1"))
    pairs = families.join(broadcast_if_small(sizes, SMALL), "fam").select(F.col("fam").alias("u"), F.col("node").alias("v"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            diffs, ns, near = [], [], []
            for x, y in _pair_sets(b, words):
                d = np.setxor1d(x, y, assume_unique=True).view(np.int64)
                near.append(len(d) <= APART * (len(x) + len(y)))
                if near[-1]:
                    diffs.append(d)
                    ns.append(len(y))
            v, u = (b.column(c).filter(pa.array(near, pa.bool_())) for c in ("v", "u"))
            yield pa.RecordBatch.from_arrays([v, u, pa.array(ns, pa.int32()), pa.array(diffs, pa.list_(pa.int64()))], names=["node", "fam", "n", "diff"])

    diffs = checkpoint(_texts(checkpoint(pairs), classes, docs).mapInArrow(compare, "node long, fam long, n int, diff array<long>"))
    sizes = checkpoint(diffs.groupBy("fam").agg(F.count(F.lit(1)).alias("size")))
    counts = diffs.select("fam", F.explode("diff").alias("h")).groupBy("fam", "h").agg(F.count(F.lit(1)).alias("k"))
    counts = counts.where("k > 1").join(broadcast_if_small(sizes, SMALL), "fam").where(F.col("k") * OFTEN >= F.col("size"))
    held = counts.groupBy("fam").agg(F.max("size").alias("size"), F.collect_list("h").alias("often"), F.collect_list("k").alias("times"))
    held = checkpoint(held.withColumn("w", F.col("size")))

    def centre(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for diff, size, often, times in zip(b.column("diff"), b.column("size").to_pylist(), b.column("often"), b.column("times")):
                d = diff.values.to_numpy()
                if size is not None:
                    h, k = often.values.to_numpy(), times.values.to_numpy()
                    at = np.argsort(h)
                    h, k = h[at], k[at]
                    turned = 2 * k > size  # the centre differs from the pivot in these
                    d = np.setxor1d(d, h[turned], assume_unique=True)
                    k = np.where(turned, size - k, k)
                    at = np.minimum(np.searchsorted(h, d), len(h) - 1)
                    d = d[np.lexsort((d, np.where(h[at] == d, k[at] + 1, 0)))]
                out.append(d)
            yield pa.RecordBatch.from_arrays([b.column("node"), b.column("fam"), b.column("n"), pa.array(out, pa.list_(pa.int64()))], names=["node", "fam", "n", "diff"])

    told = lookup(diffs, held, "fam", "w", small_bytes=SMALL).select("node", "fam", "n", "diff", "size", "often", "times")
    return checkpoint(told.mapInArrow(centre, "node long, fam long, n int, diff array<long>"))


def _within(diffs: DataFrame, num: int, den: int, block: int) -> DataFrame:
    """(u, v) that connect all rows of one family that links connect; each is a link.

    Sets of n and m shingles link if they differ in ``(n + m) * (den - num) / (num + den)``
    at most.  With ``e = (num + den) * d - (den - num) * n``, rows with ``e + e' <= 0`` link
    for certain, and others need ``(e + e') / (2 * (num + den))`` common differences.  The
    first common one has at most ``d - pos`` from there on in each row (``reach``)."""
    one = num + den
    rows = diffs.select("node", "fam", "n", "diff", F.size("diff").alias("d"), (F.size("diff") * one - F.col("n").cast("long") * (den - num)).alias("e"))
    first = checkpoint(rows.groupBy("fam").agg(F.min(F.struct("e", "node")).alias("first"), F.count(F.lit(1)).alias("w")))
    outer = (F.col("node") != F.col("first.node")) & (F.col("e") + F.col("first.e") > 0)
    rows = checkpoint(lookup(rows, first, "fam", "w", small_bytes=SMALL).withColumn("outer", outer))
    sure = rows.where(~F.col("outer") & (F.col("node") != F.col("first.node"))).select(F.col("first.node").alias("u"), F.col("node").alias("v"))
    # rows that are sure are connected: only outer rows meet others
    low = checkpoint(rows.where("outer").groupBy("fam").agg(F.min("e").alias("low")).join(first.select("fam", "w"), "fam"))
    some = lookup(rows, low, "fam", "w", small_bytes=SMALL).where(F.col("low").isNotNull())
    least = F.col("e") + F.when(F.col("outer"), F.col("first.e")).otherwise(F.col("low"))
    common = F.greatest(F.lit(1), F.ceil(least / (2 * one))).cast("int")
    parts = some.withColumn("part", F.greatest(F.lit(0), F.col("d") - common + 1))
    cells = parts.select("node", "fam", "d", "e", "outer", F.posexplode(F.slice("diff", 1, F.col("part"))).alias("pos", "x"))
    cells = cells.select(F.xxhash64("fam", "x").alias("h"), "node", "e", "outer", (2 * one * (F.col("d") - F.col("pos")) - F.col("e")).alias("reach"))
    cells = cells.repartition("h")  # one exchange for both sides
    columns = cells.groupBy("h").agg(
        F.count(F.lit(1)).alias("w"),
        F.max("reach").alias("far"),
        F.min("e").alias("near"),
        F.max(F.when(F.col("outer"), F.col("reach"))).alias("outer_far"),
        F.min(F.when(F.col("outer"), F.col("e"))).alias("outer_near"),
    )
    columns = columns.where((F.col("w") > 1) & F.col("outer_near").isNotNull())
    met = cells.join(columns, "h").where(
        (F.col("outer") & (F.col("far") >= F.col("e")) & (F.col("reach") >= F.col("near")))
        | (~F.col("outer") & (F.col("outer_far") >= F.col("e")) & (F.col("reach") >= F.col("outer_near")))
    )
    pairs = _meet(checkpoint(met), "outer", ["node", "e", "reach", "outer"], block).where(
        (F.col("u_node") != F.col("v_node"))
        & (~F.col("v_outer") | (F.col("u_node") < F.col("v_node")))
        & (F.col("u_reach") >= F.col("v_e"))
        & (F.col("v_reach") >= F.col("u_e"))
    )
    pairs = checkpoint(pairs.select(F.col("u_node").alias("u"), F.col("v_node").alias("v")).distinct())
    for name in ("u", "v"):
        pairs = pairs.join(diffs.select(F.col("node").alias(name), F.col("n").alias(f"{name}_n"), F.col("diff").alias(f"{name}_diff")), name)
    apart = F.size("u_diff") + F.size("v_diff") - 2 * F.size(F.array_intersect("u_diff", "v_diff"))
    linked = pairs.where(apart * one <= (F.col("u_n") + F.col("v_n")) * (den - num))
    return checkpoint(sure.unionByName(linked.select("u", "v")))


def _meet(cells: DataFrame, few: str, names: list[str], block: int) -> DataFrame:
    """Columns u_* and v_*: in each column, its ``few`` rows (u) with all of its rows (v).
    A column of many rows ``w`` is cut into blocks of them."""
    rows = cells.withColumn("blocks", F.ceil(F.col("w") / block).cast("int"))
    rows = rows.withColumn("mine", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))

    def side(name: str, some: DataFrame, first: Column, second: Column) -> DataFrame:
        cols = [F.col(c).alias(f"{name}_{c}") for c in names]
        return some.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)"))).select("h", first.alias("i"), second.alias("j"), *cols)

    left = side("u", rows.where(few), F.col("mine"), F.col("other"))
    return left.join(side("v", rows, F.col("other"), F.col("mine")), ["h", "i", "j"])


def _product(cells: DataFrame, num: int, den: int, block: int) -> DataFrame:
    """(u, v) of different families whose accumulated overlap may still reach what
    their sizes need.  In a column, two rows differ in family only if one of them is
    outside the column's largest family (``major``), so only such rows meet all rows."""
    rows = cells.withColumn("minor", F.col("fam") != F.col("major"))
    pairs = _meet(rows, "minor", ["node", "n", "pos", "fam", "minor"], block).where(
        (F.col("u_fam") != F.col("v_fam"))
        & (~F.col("v_minor") | (F.col("u_node") < F.col("v_node")))
        & _fits(F.col("u_n"), F.col("v_n"), num, den)
    )
    u_first = F.col("u_node") < F.col("v_node")

    def pick(a: str, b: str, c: str):
        return F.when(u_first, F.col(f"{a}_{c}")).otherwise(F.col(f"{b}_{c}"))

    pairs = pairs.select(*(pick("u", "v", c).alias(f"u_{c}") for c in ("node", "n", "pos")), *(pick("v", "u", c).alias(f"v_{c}") for c in ("node", "n", "pos")))
    overlap = pairs.groupBy(F.col("u_node").alias("u"), F.col("v_node").alias("v")).agg(
        F.count(F.lit(1)).alias("c"), F.max("u_pos").alias("up"), F.max("v_pos").alias("vp"), F.max("u_n").alias("un"), F.max("v_n").alias("vn")
    )
    most = F.col("c") + F.least(F.col("un") - F.col("up") - 1, F.col("vn") - F.col("vp") - 1)
    enough = _enough(F.col("c"), F.col("un"), F.col("vn"), num, den)
    return overlap.where(enough & (most * (num + den) >= (F.col("un") + F.col("vn")) * num)).select("u", "v")


def _mixed(cells: DataFrame) -> DataFrame:
    """The cells of columns with several families, with the column's size ``w`` and its
    largest family ``major``."""
    parts = cells.groupBy("h", "fam").agg(F.count(F.lit(1)).alias("n"))
    columns = parts.groupBy("h").agg(F.sum("n").alias("w"), F.max_by("fam", F.struct("n", "fam")).alias("major"), F.count(F.lit(1)).alias("k"))
    columns = checkpoint(columns.where("k > 1").select("h", F.col("w").alias("rows"), "w", "major"))
    return checkpoint(lookup(cells, columns, "h", "rows", small_bytes=SMALL).where("major is not null"))


def jaccard_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    words: int = 5,
    num: int = 4,
    den: int = 5,
    max_heavy: int = 1 << 20,
    block: int = 1024,
    stars: int = 3,
) -> DataFrame:
    """(id, n, component) per row of ``docs``: the size of the row's set and the least id
    among all rows reachable by links.  ``block``: rows of a column in one block of the
    product; ``stars``: pivots of a column in the star step, 0 to go without families (both
    change the work, not the result)."""
    body = F.coalesce(F.col(text), F.lit(""))
    key = F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.lit(":"), body))
    source = docs.select(F.col(id_col).alias("id"), body.alias("text"), key.alias("key"))
    heavy = heavy_shingles(source.select("text"), words, max_heavy)
    rows = checkpoint(_rows(source, heavy, words, num, den).withColumn("row", F.monotonically_increasing_id()))
    equal = rows.groupBy("digest", "key").agg(F.min("row").alias("row"), F.min("id").alias("id"), F.max("n").alias("n"), F.count(F.lit(1)).alias("times"))
    classes = equal.groupBy("digest").agg(
        F.min("row").alias("node"), F.min("id").alias("low"), F.min(F.struct("times", "key")).alias("text"), F.max("n").alias("n"), F.sum("times").alias("copies")
    )
    classes = checkpoint(classes.select("digest", "node", "low", "text.times", "text.key", "n", "copies"))
    chosen = broadcast_if_small(classes.where("n > 0").select(F.col("node").alias("row")), SMALL)
    cells = rows.join(chosen, "row", "left_semi").select(F.col("row").alias("node"), "n", F.posexplode("prefix").alias("pos", "h"))
    cells = cells.repartition("h")  # one exchange for both sides
    shared = cells.join(cells.groupBy("h").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("h"), "h")
    least = _few(F.ceil(F.col("n") * num / den))
    busy = F.count(F.lit(1)).over(Window.partitionBy("node"))  # a first part at most
    cells = checkpoint(shared.withColumn("busy", busy).where(F.col("busy") >= least).drop("busy"))
    if stars:
        families = _families(cells, stars)
        diffs = _differences(families, classes, source, words)
        found = _within(diffs, num, den, block)
        cells = cells.join(broadcast_if_small(diffs.select("node", "fam"), SMALL), "node", "left").withColumn("fam", F.coalesce("fam", -1 - F.col("node")))  # alone
    else:
        found = docs.sparkSession.createDataFrame([], "u long, v long")
        cells = cells.withColumn("fam", F.col("node"))
    linked = _check(checkpoint(_product(_mixed(cells), num, den, block)), classes, source, words, num, den)
    roots = checkpoint(components(found.unionByName(linked)))
    # an empty set is no class of documents: each of its rows stands alone
    own = classes.where("n > 0").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    low = own.groupBy("root").agg(F.min("low").alias("component"))
    table = checkpoint(own.join(low, "root").select("digest", "copies", "component"))
    slim = rows.select("id", "n", "digest")
    return lookup(slim, table, "digest", "copies").select("id", "n", F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component")).alias("component"))


def op11_ngram_join(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = jaccard_components(docs)
    return rows.select(F.col("id").alias("doc_id"), F.col("n").cast("long").alias("n_shingles"), F.col("component").alias("component_id"))
