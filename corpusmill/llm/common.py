"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.operators.joins import value_bytes
from corpusmill.session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def in_fold(key: Column, folds: int, fold: int) -> Column:
    """Is crc32 of the key, as text, ``fold`` modulo ``folds``?  A null key is in no fold."""
    crc = F.crc32(F.encode(key.cast("string"), "UTF-8"))
    return F.coalesce(F.pmod(crc, F.lit(folds)) == fold, F.lit(False))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def others(df: DataFrame, names: list[str]) -> T.StructType:
    """The columns of ``df`` that new columns ``names`` do not replace.  Names are equal
    whatever their case, as in Spark."""
    new = {n.lower() for n in names}
    return T.StructType([f for f in df.schema if f.name.lower() not in new])


def per_row(fn: Callable[[list], dict[str, list]], schema: pa.Schema, text: str = "text") -> Callable:
    """A mapInArrow function: ``fn`` gets a batch's texts (null: None) and returns the
    new columns; the batch's other columns that ``schema`` names pass through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            new = fn(b.column(text).to_pylist())
            cols = [pa.array(new[f.name], f.type) if f.name in new else b.column(f.name).cast(f.type) for f in schema]
            yield pa.RecordBatch.from_arrays(cols, schema=schema)

    return run


def lookup(rows: DataFrame, table: DataFrame, key: str, weight: str, hot: int = 10_000, small_bytes: int = 0) -> DataFrame:
    """Left-join ``table`` (one row per non-null ``key``; ``weight`` is the key's number of
    rows) to ``rows``.  Keys with more than ``hot`` rows and more than a thousandth of
    all, so at most 1000 of them, are joined by a broadcast; the rest by a shuffle in
    which no key is hotter than that.  A table measured at no more than ``small_bytes`` is
    broadcast whole, so that wide ``rows`` stay where they are."""
    if small_bytes and value_bytes(table) <= small_bytes:
        return rows.join(F.broadcast(table.drop(weight)), key, "left")
    total = table.agg(F.sum(weight)).first()[0] or 0
    value = [c for c in table.columns if c not in (key, weight)]
    cut = max(hot, total // 1000)
    few = table.where(F.col(weight) > cut).drop(weight)
    rest = table.where(F.col(weight) <= cut).drop(weight)
    mark = free_name(rows, "is_hot")
    tagged = rows.join(F.broadcast(few.select(key, F.lit(True).alias(mark), *value)), key, "left")
    warm = tagged.where(F.col(mark)).drop(mark)
    cold = tagged.where(F.col(mark).isNull()).drop(mark, *value).join(rest, key, "left")
    return warm.unionByName(cold)


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of an undirected graph given as ``edges`` (u, v): rows
    (node, root) with the least node of each component.  Alternates large-star and
    small-star steps (each a partial aggregate and a join, so no neighbourhood is ever
    gathered in one task) until the edges stop changing; every round is checkpointed."""

    def least(pairs: DataFrame) -> DataFrame:
        return pairs.groupBy("u").agg(F.min("v").alias("m"))

    def state(e: DataFrame):
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    e = checkpoint(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    now = state(e)
    for _ in range(max_rounds):
        if not now[0]:
            break
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = least(both).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = least(large)
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = checkpoint(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        was, now = now, state(e)
        if was == now:
            break
    else:
        raise RuntimeError("components: no fixed point within max_rounds")
    roots = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def row_digest(df: DataFrame) -> Column:
    """A digest of all columns of a row, never null; equal rows have equal digests."""
    plain = [c for c, kind in df.dtypes if not kind.startswith(("array", "map", "struct", "variant"))]
    rest = [c for c in df.columns if c not in plain]
    parts = [x for c in plain for x in (F.col(f"`{c}`").isNull().cast("string"), F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")))]
    if rest:
        parts.append(F.to_json(F.struct(*(F.col(f"`{c}`") for c in rest))))
    return F.md5(F.concat_ws("\x1f", *parts))
