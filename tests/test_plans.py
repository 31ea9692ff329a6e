"""Plan-shape checks: the properties that matter at scale, asserted on the
physical plans of the registered queries."""

import os

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def lines(df) -> list[str]:
    return [l.strip() for l in df._jdf.queryExecution().executedPlan().toString().splitlines()]


def formatted(spark, df) -> str:
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def ops(df, prefix: str) -> list[str]:
    return [l for l in lines(df) if l.lstrip("+-: ").startswith(prefix)]


def test_flagship_dedupe_is_one_exchange_with_partial_aggregation(spark):
    df = E.queries()["manifest_translation"](spark, SF)
    text = "\n".join(lines(df))
    assert text.count("Exchange hashpartitioning(_dk") == 1
    assert "partial_min_by" in text
    assert "BroadcastExchange" in text  # the registry, after its row-count check
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text  # no row-at-a-time Python
    python_nodes = ops(df, "ArrowEvalPython")
    assert python_nodes and all("_nfc_batch" in l for l in python_nodes)


def test_scans_read_only_needed_columns(spark):
    plan = formatted(spark, E.queries()["summary_facets"](spark, SF))
    schemas = [l.split("ReadSchema:")[1].strip() for l in plan.splitlines() if "ReadSchema:" in l]
    assert schemas == ["struct<doc_id:bigint,text:string,lang:string,source:string>"]  # no n_chars; one scan


def test_split_is_narrow(spark):
    from pyspark.sql import functions as F

    from corpusmill.operators.split import split_rows

    df = spark.range(100).select(F.col("id").cast("string").alias("k"))
    assert not ops(split_rows(df, F.col("k")), "Exchange")


def test_no_cross_joins(spark):
    for name in ("corpus_bleu", "ljspeech_counts", "dedupe_counts", "summary_markdown", "split_records", "download_plan"):
        text = "\n".join(lines(E.queries()[name](spark, SF)))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_bleu_moves_sums_only(spark):
    ls = lines(E.queries()["corpus_bleu"](spark, SF))
    after = next(i for i, l in enumerate(ls) if "MapInArrow" in l or "PythonMapInArrow" in l)
    assert [l for l in ls[:after] if "Exchange" in l] and all("SinglePartition" in l for l in ls[:after] if "Exchange" in l)


def test_texts_are_normalised_once_and_no_raw_key_is_shuffled(spark):
    for name in ("manifest_translation", "split_translation", "tokenize_pairs"):
        text = "\n".join(lines(E.queries()[name](spark, SF)))
        below = text[text.index("Exchange hashpartitioning(_dk"):]
        # form and translation once each, and once more for the two halves of the key
        assert below.count("ArrowEvalPython [") <= 2 and below.count("_nfc_batch(") <= 8, name
        assert "unhex(sha2(" in below and "partial_min_by" in below


def test_building_a_query_runs_no_job(spark):
    sc = spark.sparkContext
    names = ("examples_table", "manifest_translation", "split_tts", "summary_totals", "split_records", "tokenize_pairs", "corpus_bleu")
    E.queries()["record_count"](spark, SF)  # the registry is worked out once
    for name in names:
        sc.setJobGroup(f"build-{name}", name)
        E.queries()[name](spark, SF)
        # reading the footer of the table is a job of the reader's
        assert len(sc.statusTracker().getJobIdsForGroup(f"build-{name}")) <= 1, name
    sc.setLocalProperty("spark.jobGroup.id", None)
