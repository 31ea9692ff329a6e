"""Reproducible train / valid / test split by content hash (a narrow projection:
no shuffle, invariant to partitioning)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.hashing import split_bucket
from corpusmill.functions.text import row_text
from corpusmill.operators.dedupe import PAIR_SEPARATOR

SPLITS = ("train", "valid", "test")


def check_ratios(train_ratio: float, valid_ratio: float) -> None:
    if train_ratio <= 0 or valid_ratio < 0 or train_ratio + valid_ratio >= 1:
        raise ValueError("Invalid split ratios")


def split_column(key: Column, train_ratio: float = 0.9, valid_ratio: float = 0.05) -> Column:
    """``train`` if bucket < train, ``valid`` if bucket < train + valid, else ``test``.
    The boundary ``train + valid`` is the Python double sum (0.9 + 0.05 is
    0.9500000000000001), computed here on the driver and passed as a literal."""
    check_ratios(train_ratio, valid_ratio)
    b = split_bucket(key)
    return (
        F.when(b < F.lit(float(train_ratio)), F.lit("train"))
        .when(b < F.lit(float(train_ratio) + float(valid_ratio)), F.lit("valid"))
        .otherwise(F.lit("test"))
    )


def split_rows(df: DataFrame, key: Column, train_ratio: float = 0.9, valid_ratio: float = 0.05) -> DataFrame:
    return df.withColumn("split", split_column(key, train_ratio, valid_ratio))


def translation_split_key() -> Column:
    """Manifest-level key: ``row_text(source_text) + U+241F + row_text(target_text)``."""
    return F.concat(row_text(F.col("source_text")), F.lit(PAIR_SEPARATOR), row_text(F.col("target_text")))


def tts_split_key() -> Column:
    """Manifest-level key: ``row_text(audio_file)`` or ``row_text(record_id)``."""
    return F.coalesce(F.nullif(row_text(F.col("audio_file")), F.lit("")), row_text(F.col("record_id")))


def split_translation(df: DataFrame, train_ratio: float = 0.9, valid_ratio: float = 0.05) -> DataFrame:
    return split_rows(df, translation_split_key(), train_ratio, valid_ratio)


def split_tts(df: DataFrame, train_ratio: float = 0.9, valid_ratio: float = 0.05) -> DataFrame:
    return split_rows(df, tts_split_key(), train_ratio, valid_ratio)


def last_records(records: DataFrame, order: str, *, id_col: str = "record_id") -> DataFrame:
    """Per id (``_id``) the last record by ``order`` (``_last``) and the number of rows
    (``_n``): one partial + final aggregate."""
    return records.groupBy(F.col(id_col).alias("_id")).agg(
        F.max_by(F.struct(*[F.col(f"`{n}`") for n in records.columns]), F.col(order)).alias("_last"),
        F.count(F.lit(1)).alias("_n"),
    )


def split_records(
    records: DataFrame,
    key: Column,
    order: str,
    *,
    id_col: str = "record_id",
    train_ratio: float = 0.9,
    valid_ratio: float = 0.05,
) -> DataFrame:
    """Record-level split with lookup by id: every input row lands in the split of
    its own key, but carries the *last* record (by ``order``) that has its id.

    One shuffled join of the rows (id, order and split only) with one last record per
    id.  A hot id is one record on the one side; on the other its narrow rows form a
    skewed partition, which adaptive execution splits."""
    rows = records.select(
        F.col(id_col).alias("_id"),
        F.col(order).alias("_row_ord"),
        split_column(key, train_ratio, valid_ratio).alias("split"),
    )
    joined = rows.join(last_records(records, order, id_col=id_col), "_id")
    return joined.select(
        "split", F.col("_row_ord").alias("row_ord"), *[F.col("_last").getField(n).alias(n) for n in records.columns]
    )
