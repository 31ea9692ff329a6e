import pytest
from pyspark.sql import functions as F

from corpusmill.operators.ordinals import with_ordinal


@pytest.mark.parametrize("partitions", [1, 7, 17])
def test_places_are_those_of_a_global_sort(spark, partitions):
    rows = [(i * 7919 % 1000, None if i % 11 == 0 else str(i)) for i in range(1000)] + [(5, "same")] * 40
    df = spark.createDataFrame(rows, "a int, part string").repartition(5)
    got = with_ordinal(df, [F.col("a").desc(), F.col("part").asc_nulls_first()], "at", partitions=partitions).collect()
    got.sort(key=lambda r: r["at"])
    assert [r["at"] for r in got] == list(range(len(rows)))
    assert [(r["a"], r["part"]) for r in got] == sorted(rows, key=lambda r: (-r[0], r[1] is not None, r[1] or ""))


def test_columns_kept_and_empty_input(spark):
    df = spark.createDataFrame([(2, "b"), (1, "a")], "k int, place string")
    out = with_ordinal(df, [F.col("k")], keep=["place"])
    assert sorted(map(tuple, out.collect())) == [("a", 0), ("b", 1)] and out.columns == ["place", "ordinal"]
    assert with_ordinal(df.limit(0), [F.col("k")]).count() == 0


def test_no_single_partition_exchange_carries_rows(spark):
    df = spark.range(1000).withColumn("x", F.col("id") % 7)
    plan = with_ordinal(df, [F.col("x"), F.col("id")])._jdf.queryExecution().executedPlan().toString()
    # the only single-partition step sums one row per range
    assert plan.count("SinglePartition") <= 1 and "BroadcastHashJoin" in plan
