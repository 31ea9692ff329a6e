"""Source divergence audit: how far the sources of a language differ in their words.

* Terms are runs of ASCII letters and non-ASCII characters, A-Z lower-cased.  Every
  document becomes an exact sparse count vector over the terms of its language, with the
  rules of ``CountVectorizer``: ``minDF`` documents of that language, and no limit on the
  vocabulary (the largest integer as ``vocabSize``).
* Group sums in the manner of ``Summarizer``, but sparse: a task adds the vectors of a
  slice of its rows up by (language, source, term), with the number of documents of each
  term, and one aggregate adds the slices.  ``minDF`` then keeps terms by their sum over
  the language.
* Pairs are evaluated sparsely: terms that neither source has add the same value each, so
  only the terms that a source has, as a histogram of their counts, and the terms that
  both have are visited.

``pyspark.ml``'s own ``CountVectorizer`` gives the same rows but holds the vocabulary on
the driver and on every executor and boxes each token; the README has its figures.  Here
the vocabulary is a table, and vectors are arrays of one slice (``SLICE`` bytes of text or
one document, if that is longer).

All arithmetic is on 64-bit integers; the quotient in ``p`` is a long division by steps
of 1000, exact up to 9e15 terms a group.  Nulls in text, lang or source are read as ''.
Documents without kept terms still make their (language, source) group occur.  Repeated
rows count each time.  Ties rank by item in UTF-8 order.  Other columns of the input are
not read.  Empty tables give empty results.  Very long texts are processed whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.llm.common import checkpoint

#: Bytes of text whose vectors a task holds at once; they take some 15 times as much.
SLICE = 1 << 22
#: Letters lower-cased, other ASCII characters to 0, the rest of UTF-8 as it is.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 else 0 for c in range(256))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))


def vectors(texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """(terms, row, at, n): the sparse count vectors of the texts; text ``row`` has the
    term ``terms[at]`` n times."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    data = np.frombuffer(b"".join(texts).translate(_TABLE), np.uint8)
    inside = data != 0
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    heads = np.cumsum(sizes)[:-1]  # a term ends with its text
    heads = heads[heads < len(data)]
    first[heads] |= inside[heads]
    begins = np.flatnonzero(first)
    offsets = np.zeros(len(begins) + 1, np.int32)
    if len(begins):  # what follows a term up to the next has no characters of terms
        np.cumsum(np.add.reduceat(inside, begins, dtype=np.int32), out=offsets[1:])
    tokens = pa.Array.from_buffers(pa.binary(), len(begins), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside].tobytes())])
    coded = tokens.dictionary_encode()
    of = np.searchsorted(np.cumsum(sizes), begins, "right")
    width = len(coded.dictionary)
    key, n = np.unique(of * width + coded.indices.to_numpy(), return_counts=True)
    return coded.dictionary.to_pylist(), key // max(width, 1), key % max(width, 1), n


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n, df): the sums over each slice of rows."""

    def add(lang: list[str], source: list[str], texts: list[bytes]) -> pa.RecordBatch:
        names = {g: k for k, g in enumerate(dict.fromkeys(zip(lang, source)))}
        group = np.array([names[g] for g in zip(lang, source)], np.int64)
        found, row, at, n = vectors(texts)
        key, where = np.unique(group[row] * len(found) + at, return_inverse=True)
        total = np.bincount(where, n, len(key)).astype(np.int64)
        df = np.bincount(where, minlength=len(key)).astype(np.int64)
        pick = pa.array(key // max(len(found), 1))
        cols = [pa.array([g[i] for g in names], pa.string()).take(pick) for i in (0, 1)]
        cols.append(pa.array(found, pa.binary()).take(pa.array(key % max(len(found), 1))).cast(pa.string()))
        return pa.RecordBatch.from_arrays([*cols, pa.array(total), pa.array(df)], names=["lang", "source", "term", "n", "df"])

    for b in batches:
        lang, source = b.column("lang").to_pylist(), b.column("source").to_pylist()
        start, size, held = 0, 0, []
        for i, text in enumerate(b.column("text")):
            held.append((text.as_buffer() or pa.py_buffer(b"")).to_pybytes())
            size += len(held[-1])
            if size >= SLICE or i + 1 == b.num_rows:
                yield add(lang[start : i + 1], source[start : i + 1], held)
                start, size, held = i + 1, 0, []


def group_counts(texts: DataFrame, min_df: int) -> DataFrame:
    """(lang, source, term, n) with n > 0 of the terms in at least ``min_df`` documents of
    the language."""
    parts = texts.mapInArrow(_sums, "lang string, source string, term string, n long, df long")
    sums = parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))
    # a window holds as many rows at once as the language has sources, and spills beyond
    df = F.sum("df").over(Window.partitionBy("lang", "term"))
    return sums.withColumn("df", df).where(F.col("df") >= min_df).select("lang", "source", "term", "n")


def _p(n: str, size: str) -> Column:
    """1 + floor(10**9 * (n + 2) / size) where n + 2 <= size, without overflow; 1 where
    size is 0."""
    rest, out = f"({n} + 2L)", "0L"
    for _ in range(3):
        out = f"({out} * 1000L + {rest} * 1000L div {size})"
        rest = f"({rest} * 1000L % {size})"
    return F.expr(f"CASE WHEN {size} > 0 THEN 1L + {out} ELSE 1L END")


def _f(p: str, q: str) -> Column:
    return F.expr(f"({p} - {q}) * ({p} - {q}) div ({p} + {q})")


def divergence(docs: DataFrame, min_df: int = 10, top: int = 10) -> DataFrame:
    """(lang, source, part, item, value, rank): per (lang, source) its divergence from
    each other source of the language ('pair', all ranks) and the terms it overuses
    against the whole language ('term', ranks to ``top``)."""
    texts = _texts(docs)
    counts = checkpoint(group_counts(texts, min_df))
    whole = counts.groupBy("lang", "term").agg(F.sum("n").alias("ln"))
    langs = whole.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("ln").alias("lsize"))
    size = counts.groupBy("lang", "source").agg(F.sum("n").alias("gsize"))
    groups = texts.select("lang", "source").distinct().join(size, ["lang", "source"], "left").join(langs, "lang", "left").fillna(0, ["v", "gsize", "lsize"])
    groups = groups.select("lang", "source", "v", (F.col("gsize") + 2 * F.col("v")).alias("d"), (F.col("lsize") + 2 * F.col("v")).alias("ld"))
    groups = checkpoint(groups.withColumn("p0", _p("0L", "d")))
    held = checkpoint(counts.join(groups, ["lang", "source"]).select("lang", "source", "term", "n", "d", "ld", "p0", _p("n", "d").alias("p")))

    other = groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"))
    pairs = groups.select("lang", "source", "v", "p0").join(other, "lang").where("source <> item")
    # what a source's own terms add against a source that lacks them
    bars = held.groupBy("lang", "source", "p", "p0").agg(F.count(F.lit(1)).alias("times"))
    lone = bars.join(other, "lang").where("source <> item").groupBy("lang", "source", "item").agg(F.sum((_f("p", "q0") - _f("p0", "q0")) * F.col("times")).alias("lone"))
    # the correction where both have the term; symmetric, so each pair once
    mine = held.select("lang", "term", "source", "p", "p0")
    theirs = held.select("lang", "term", F.col("source").alias("item"), F.col("p").alias("q"), F.col("p0").alias("q0"))
    delta = _f("p", "q") - _f("p", "q0") - _f("p0", "q") + _f("p0", "q0")
    both = mine.join(theirs, ["lang", "term"]).where("source < item").groupBy("lang", "source", "item").agg(F.sum(delta).alias("both"))
    swap = {"source": F.col("item"), "item": F.col("source")}
    parts = (
        pairs.select("lang", "source", "item", (_f("p0", "q0") * F.col("v")).alias("value"))
        .unionByName(lone.select("lang", "source", "item", F.col("lone").alias("value")))
        .unionByName(lone.withColumns(swap).select("lang", "source", "item", F.col("lone").alias("value")))
        .unionByName(both.select("lang", "source", "item", F.col("both").alias("value")))
        .unionByName(both.withColumns(swap).select("lang", "source", "item", F.col("both").alias("value")))
    )
    pair = parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pair = pair.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank"))

    usual = held.join(whole, ["lang", "term"]).withColumn("q", _p("ln", "ld"))
    over = usual.where("p > q").select("lang", "source", F.col("term").alias("item"), _f("p", "q").alias("value"))
    term = over.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return pair.unionByName(term.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank"))


def op12_divergence(spark, sf_dir: str) -> DataFrame:
    return divergence(spark.read.parquet(f"{sf_dir}/documents.parquet"))
