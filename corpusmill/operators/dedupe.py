"""First-occurrence-wins deduplication.

The survivor of each key is the row with the smallest order key, chosen by a
``min_by`` aggregate: Spark runs it as partial + final aggregation around one
exchange, so a hot key collapses to one row per map partition before the shuffle,
and the result does not depend on partitioning (unlike ``dropDuplicates``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.text import norm

# Fixed value: separator between source and target text in the translation key.
PAIR_SEPARATOR = "␟"


def _order(order: Sequence[str] | str) -> Column:
    names = [order] if isinstance(order, str) else list(order)
    return F.struct(*[F.col(n) for n in names])


def key_digest(key: Column) -> Column:
    """32 bytes that stand for a key in an exchange, however long its texts are."""
    return F.unhex(F.sha2(key.cast("string"), 256))


def dedupe_first(df: DataFrame, key: Column, order: Sequence[str] | str) -> DataFrame:
    """Keep, per ``key``, the row that comes first by ``order``.  All columns of ``df``
    cross the exchange, so select what is needed before."""
    names = df.columns
    packed = (
        df.withColumn("_dk", key_digest(key))
        .groupBy("_dk")
        .agg(F.min_by(F.struct(*[F.col(f"`{n}`") for n in names]), _order(order)).alias("_row"))
    )
    return packed.select([F.col("_row").getField(n).alias(n) for n in names])


def dedupe_counts(df: DataFrame, key: Column) -> DataFrame:
    """One row: ``total``, ``kept`` and ``dropped`` for first-wins dedupe on ``key``."""
    per_key = df.groupBy(key_digest(key).alias("_dk")).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("total"),
        F.count(F.lit(1)).cast("long").alias("kept"),
    ).withColumn("dropped", F.col("total") - F.col("kept"))


def dedupe_counts_many(df: DataFrame, keys: dict[str, Column]) -> DataFrame:
    """``(kind, total, kept, dropped)`` for several dedupe keys in one pass: each row
    emits one (kind, key) pair per key; counts are combined before the shuffle."""
    pairs = F.array(*[F.struct(F.lit(k).alias("kind"), key_digest(c).alias("key")) for k, c in keys.items()])
    per_key = df.select(F.inline(pairs)).groupBy("kind", "key").agg(F.count(F.lit(1)).alias("_n"))
    return per_key.groupBy("kind").agg(
        F.sum("_n").cast("long").alias("total"), F.count(F.lit(1)).cast("long").alias("kept")
    ).withColumn("dropped", F.col("total") - F.col("kept"))


def translation_key(source_text: Column | str = "source_text", target_text: Column | str = "target_text") -> Column:
    """``norm(source) + U+241F + norm(target)`` (a string, so separator collisions
    behave exactly like the string key they mirror)."""
    return F.concat(norm(source_text), F.lit(PAIR_SEPARATOR), norm(target_text))


def tts_key(audio_file: Column | str = "audio_file", record_id: Column | str = "record_id") -> Column:
    """``norm(audio_file)`` or, when empty, ``record_id`` (global across sources)."""
    rid = F.col(record_id) if isinstance(record_id, str) else record_id
    return F.coalesce(F.nullif(norm(audio_file), F.lit("")), rid)
