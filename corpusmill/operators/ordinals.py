"""Distributed ordinals: the place of each row in a total order, without a window over
all rows.

Rows are range-partitioned and sorted once.  A row's ordinal is the number of rows in the
ranges before its own (a prefix sum over one count per range) plus its place within its
range.  No task ever holds more than one range, and the only thing that is broadcast is
one number per shuffle partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.session import ensure_checkpoint_dir


def with_ordinal(df: DataFrame, order: Sequence[Column], out: str = "ordinal", keep: Sequence[Column | str] | None = None, partitions: int | None = None) -> DataFrame:
    """``df`` (or the columns ``keep`` of it) with the 0-based place of each row in
    ``order`` as ``out``.

    Rows that ``order`` can't tell apart get different ordinals in any order.  The sorted
    rows are checkpointed, as their places must not change when a task is run again;
    ``keep`` is applied before that, so wide columns that only sort need not be stored.
    ``partitions``: number of ranges, by default the session's shuffle partitions."""
    ensure_checkpoint_dir(df.sparkSession)
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    kept = ranged.sortWithinPartitions(*order)
    kept = kept.select(*keep) if keep is not None else kept
    cols = kept.columns
    at = _free("place", cols)
    # the number of the partition above, the row's place within it below, 33 bits
    rows = kept.withColumn(at, F.monotonically_increasing_id()).checkpoint(eager=True)
    part = F.shiftright(F.col(at), 33)
    within = F.col(at).bitwiseAND((1 << 33) - 1)
    sizes = rows.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("part", F.coalesce(before, F.lit(0)).alias("offset"))
    p, o = _free("part", cols), _free("offset", cols)
    offsets = offsets.withColumnsRenamed({"part": p, "offset": o}) if (p, o) != ("part", "offset") else offsets
    # one row per range: at most as many as there are shuffle partitions
    return rows.withColumn(p, part).join(F.broadcast(offsets), p).select(*(F.col(f"`{c}`") for c in cols), (F.col(o) + within).alias(out))


def _free(name: str, taken: Sequence[str]) -> str:
    low = {c.lower() for c in taken}
    while name in low:
        name += "_"
    return name
