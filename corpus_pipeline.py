"""Documents to packed training sequences: language filter, toxicity filter, one
document of each near-duplicate group, a source mixture, and packing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm import langid, mixing, packing, simhash, toxicity
from corpusmill.llm.common import table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a language is found; learns from all labelled ones."""
    return langid.keep_identified(docs, F.lit(True))


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.3; learns from all rows of ``labels``."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    return toxicity.drop_toxic(docs, labels, F.lit(True))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_duplicates(docs, words=3, max_distance=2)


def source_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix takes them, whole."""
    return mixing.mix_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' token ids, packed into sequences."""
    return packing.pack_documents(docs, *packing.tokenizer_paths())


STAGES: list[tuple[str, Stage]] = [
    ("language", language),
    ("toxicity", toxicity_filter),
    ("near_dedup", near_dedup),
    ("mixture", source_mixture),
    ("packing", pack),
]

#: The classifiers of the first stages can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written and read again."""
    from corpusmill.session import scratch_path

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
