"""Join helpers: broadcast only behind an explicit size check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A broadcast side holds at most this many bytes of values.
MAX_BROADCAST_BYTES = 64 << 20


def value_bytes(df: DataFrame) -> int:
    """Bytes of the values of ``df``: strings and binaries by their length, the rest as
    text, plus eight a value.  One aggregate job."""
    cols = [F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) + 8 for c in df.columns]
    total = cols[0]
    for c in cols[1:]:
        total = total + c
    return int(df.agg(F.coalesce(F.sum(total.cast("long")), F.lit(0))).first()[0])


def broadcast_if_small(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES, size: int | None = None) -> DataFrame:
    """Mark ``df`` for broadcast only if its values take at most ``max_bytes``; beyond
    that the planner shuffles both sides.  ``size``: the bytes, where they are known;
    else they are measured."""
    return F.broadcast(df) if (value_bytes(df) if size is None else size) <= max_bytes else df


def rebalance_small_input(df: DataFrame) -> DataFrame:
    """Spread a scan over the cluster when it plans fewer partitions than there are
    task slots (a small input stored in one or a few Parquet row groups).

    A large input already has far more splits than slots, so this never adds a
    shuffle at scale; for a small input the round-robin shuffle is cheap and lets
    the per-row work (text normalisation, XML, tokenising) use every core."""
    slots = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < slots:
        return df.repartition(slots)
    return df
