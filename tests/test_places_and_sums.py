import math
import random

import pytest
from pyspark.sql import functions as F

from corpusmill.functions import exact
from corpusmill.operators import summary as A
from corpusmill.plans import adapter
from corpusmill.sinks import writers as W
from corpusmill.sources import jsonl as J


def exact_total(df):
    parts = df.groupBy(exact.power(F.col("x")).alias("p")).agg(*exact.group_parts(F.col("x")))
    return parts.agg(exact.total("p").alias("t")).first().t


def doubles():
    rng = random.Random(1)
    some = [rng.uniform(-1, 1) * 10 ** rng.randint(-20, 20) for _ in range(400)]
    return [*some, 1e16, 1.0, -1e16, 5e-324, 2.2250738585072014e-308, 1.7e308, -1.7e308, 0.0, -0.0, 0.1, None]


@pytest.mark.parametrize("partitions", [1, 3, 7, 16])
def test_sum_is_the_rounded_true_sum(spark, partitions):
    values = doubles()
    random.Random(partitions).shuffle(values)
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(partitions)
    assert exact_total(df) == math.fsum(v for v in values if v is not None)


def test_sum_of_special_values(spark):
    def of(*values):
        return exact_total(spark.createDataFrame([(v,) for v in values], "x double"))

    assert of() == of(None) == of(0.0) == 0.0
    assert of(1e16, *[1.0] * 10) == 1e16 + 10
    assert of(1.7e308, 1.7e308) == math.inf and of(math.inf, 1.0) == math.inf and of(-math.inf, 1.0) == -math.inf
    assert math.isnan(of(math.inf, -math.inf)) and math.isnan(of(math.nan, 1.0))


def test_durations_do_not_depend_on_partitions(spark):
    rows = [("g", "c", "d", "m", "a.wav", "t", "t", v) for v in [1e16, *[0.1] * 1000, -1e16, None]]
    schema = "`group` string, corpus_slug string, dialect string, audio_mode string, audio_file string, translation_zh string, target_text string, duration_seconds double"
    df = spark.createDataFrame(rows, schema)
    seen = {(A.stats_manifest(df.repartition(n))[0].first().total_duration_seconds, A.summary_totals(df.repartition(n)).first().total_duration_seconds) for n in (1, 3, 7, 16)}
    assert seen == {(math.fsum([0.1] * 1000), 100.0)}
    t = A.stats_manifest(df)[0].first()
    assert (t.total_records, t.missing_audio, t.missing_translation, t.n_durations) == (1003, 0, 0, 1002)
    t = A.stats_manifest(df.where("false"))[0].first()
    assert (t.total_records, t.n_durations, t.total_duration_seconds) == (0, 0, 0.0)


@pytest.fixture
def spilling(spark):
    name = "spark.shuffle.spill.numElementsForceSpillThreshold"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "200")
    yield
    spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def test_split_lines_stay_in_order_when_tasks_spill(spark, tmp_path, spilling):
    df = spark.range(12_000).select(F.element_at(F.array(*map(F.lit, ("train", "valid", "test"))), (F.col("id") % 3 + 1).cast("int")).alias("split"), "id", F.col("id").alias("at"))
    path = str(tmp_path / "out")
    W.write_split_manifests(df.repartition(5), path, order=["at"])
    for split in ("train", "valid", "test"):
        lines = J.numbered_lines(spark, f"{path}/split={split}").select("line_no", F.get_json_object("value", "$.id").cast("long").alias("id")).orderBy("line_no").collect()
        assert len(lines) == 4000 and [r.line_no for r in lines] == list(range(4000))
        assert [r.id for r in lines] == sorted(r.id for r in lines)


@pytest.mark.parametrize("size", [8, 40, 1 << 20])
def test_part_numbers_beyond_five_digits(spark, tmp_path, size):
    parts = {"part-99999-x-c000.txt": "b\nc\n", "part-100000-x-c000.txt": "d\n\nf\n", "part-00001-x-c001.txt": "a1\n", "part-00001-x-c000.txt": "a0\n" * 9, "part-00002-x-c000.txt": ""}
    for name, text in parts.items():
        (tmp_path / name).write_text(text)
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]
    try:
        spark.conf.set(names[0], str(size))
        spark.conf.set(names[1], "1")
        got = [(r.line_no, r.value) for r in J.numbered_lines(spark, str(tmp_path)).orderBy("line_no").collect()]
    finally:
        for n, v in zip(names, before):
            spark.conf.set(n, v)
    assert got == list(enumerate(["a0"] * 9 + ["a1", "b", "c", "d", "", "f"]))
    rows = spark.read.text(str(tmp_path)).select("value", J.line_order().alias("o")).orderBy("o").collect()
    assert [r.value for r in rows] == [v for _, v in got]


def test_documents_without_lang_and_source_keep_their_sentences(spark):
    docs = spark.createDataFrame(
        [(1, "a\nb", None, None, 3), (2, "c\nd", "en", None, 3), (5, "e\nf", None, None, 3), (3, "g\nh", "en", "s", 3)],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    ex = adapter.examples_from_documents(docs).collect()
    assert sorted(r.doc_id for r in ex) == [1, 2, 3, 5] and all(r.source_key for r in ex)
    assert adapter.NO_NAME in {r.dialect for r in ex}
