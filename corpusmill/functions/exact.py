"""Sums of doubles that don't depend on the order of their rows.

A double is an integer of at most 55 bits times a power of two.  Rows are grouped by that
power (about 2,100 groups at most, whatever the size of the table); within a group the
integers add up exactly as decimals.  The groups' sums are then added as whole numbers and
rounded once, to the nearest double (ties to even).  Partitioning, retries and the order
of rows never change a bit of the result.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def power(x: Column) -> Column:
    """The group of a double: a power of two near its magnitude; NULL for NULL, zero and
    values that are not finite."""
    usual = x.isNotNull() & (x != 0) & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return F.when(usual, F.floor(F.log2(F.abs(x))).cast("int"))


def units(x: Column) -> Column:
    """``x`` in units of 2**(power - 53), an integer; scaled in two steps, as one could
    leave the range of a double."""
    p = power(x)
    half = F.floor(p / 2).cast("int")
    scaled = x * F.pow(F.lit(2.0), 26 - half) * F.pow(F.lit(2.0), 27 - (p - half))
    return scaled.cast("decimal(20,0)").cast("decimal(38,0)")


@F.pandas_udf(T.DoubleType())
def _rounded(powers: pd.Series, sums: pd.Series) -> pd.Series:
    from fractions import Fraction

    def add(ps, ss) -> float:
        total = sum((Fraction(int(s)) * Fraction(2) ** (int(p) - 53) for p, s in zip(ps, ss)), Fraction(0))
        try:
            return float(total)
        except OverflowError:
            return float("inf") if total > 0 else float("-inf")

    return pd.Series([add(p, s) for p, s in zip(powers, sums)])


def group_parts(x: Column) -> list[Column]:
    """Aggregates for rows grouped by ``power(x)``, to be handed to :func:`total`."""
    return [
        F.sum(units(x)).alias("_units"),
        F.count_if(F.isnan(x)).alias("_nan"),
        F.count_if(x == float("inf")).alias("_above"),
        F.count_if(x == float("-inf")).alias("_below"),
    ]


def total(power_col: str) -> Column:
    """The sum over all groups of ``group_parts``; 0.0 without rows.  NaN, or infinities of
    both signs, give NaN."""
    some = F.col("_units").isNotNull()
    pairs = F.collect_list(F.when(some, F.struct(F.col(power_col).alias("p"), F.col("_units").cast("string").alias("s"))))
    finite = _rounded(F.transform(pairs, lambda g: g["p"]), F.transform(pairs, lambda g: g["s"]))
    nan, above, below = (F.coalesce(F.sum(c), F.lit(0)) for c in ("_nan", "_above", "_below"))
    return (
        F.when((nan > 0) | ((above > 0) & (below > 0)), F.lit(float("nan")))
        .when(above > 0, F.lit(float("inf")))
        .when(below > 0, F.lit(float("-inf")))
        .otherwise(finite)
    )
