import hashlib

from pyspark.sql import functions as F

from corpusmill.functions.hashing import split_bucket
from corpusmill.operators.dedupe import dedupe_counts, dedupe_first, translation_key, tts_key
from corpusmill.operators.manifest import tts_manifest, translation_manifest
from corpusmill.operators.split import check_ratios, split_rows
from corpusmill.operators.examples import STRING_FIELDS
import pytest

SCHEMA = ", ".join(f"`{c}` string" for c in STRING_FIELDS) + ", audio_start double, audio_end double, ord int"


def make(spark, rows):
    """rows: (record_id, source_text, target_text, audio_file[, source_key])"""
    out = []
    for i, r in enumerate(rows):
        rid, src, tgt, audio = r[:4]
        sk = r[4] if len(r) > 4 else "grp/talks/North"
        d = {c: "" for c in STRING_FIELDS}
        d.update(record_id=rid, source_key=sk, group="grp", corpus_slug="talks", dialect=sk.split("/")[-1],
                 language_code="xyz", audio_mode="whole", original_form=src, standard_form=src,
                 translation_zh=tgt, audio_file=audio, sentence_id=rid)
        out.append(tuple(d[c] for c in STRING_FIELDS) + (0.0, 1.0, i))
    from corpusmill.operators.examples import with_derived

    return with_derived(spark.createDataFrame(out, SCHEMA))


def ids(df):
    return sorted(r.record_id for r in df.select("record_id").collect())


def test_dedupe_by_translation(spark):
    ex = make(spark, [("q1", "kuma", "tua", "x.ogg"), ("q2", "kuma", "tua", "y.ogg"), ("q3", "kuma", "tu", "z.ogg")])
    kept = dedupe_first(ex, translation_key(), "ord")
    assert ids(kept) == ["q1", "q3"]
    c = dedupe_counts(ex, translation_key()).first()
    assert (c.total, c.kept, c.dropped) == (3, 2, 1)


def test_dedupe_by_audio(spark):
    ex = make(spark, [("q1", "kuma", "tua", "x.ogg"), ("q2", "lima", "sa", "x.ogg"), ("q3", "lima", "sa", "y.ogg")])
    assert ids(dedupe_first(ex, tts_key(), "ord")) == ["q1", "q3"]


def test_first_wins_in_order_not_position(spark):
    # T1: the survivor is the smallest order key, whatever the physical row order.
    rows = [(f"r{i}", "same", "pair", f"{i}.wav") for i in range(40)]
    ex = make(spark, rows)
    for parts in (1, 7, 17):
        shuffled = ex.repartition(parts, F.rand(seed=parts))
        assert ids(dedupe_first(shuffled, translation_key(), "ord")) == ["r0"]


def test_tts_filter_after_dedupe(spark):
    # T3: the first row of 1.wav has empty text, so 1.wav vanishes from the manifest.
    ex = make(spark, [("a", "", "t", "1.wav"), ("b", "text", "t", "1.wav"), ("c", "x", "t", "2.wav")])
    out = tts_manifest(ex, "ord")
    assert sorted(r.audio_file for r in out.collect()) == ["2.wav"]


def test_audio_names_collide_across_dialects(spark):
    # T4: the default key is the bare file name, global across sources.
    ex = make(spark, [("a", "x", "t", "1.wav", "ePark/c/Jianhe"), ("b", "y", "t", "1.wav", "ePark/c/Xiqun")])
    assert ids(tts_manifest(ex, "ord")) == ["a"]


def test_translation_manifest_needs_both_texts(spark):
    ex = make(spark, [("a", "x", "", "1.wav"), ("b", "", "y", "2.wav"), ("c", "x", "y", "3.wav")])
    assert ids(translation_manifest(ex, "ord")) == ["c"]


def test_bucket_equals_python(spark):
    keys = [f"id-{i}" for i in range(500)] + ["", "é", "中文", "a␟b"]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    got = {r.k: r.b for r in df.select("k", split_bucket(F.col("k")).alias("b")).collect()}
    for k in keys:
        assert got[k] == int(hashlib.sha256(k.encode("utf-8")).hexdigest()[:8], 16) / 0xFFFFFFFF


def test_split_is_deterministic_and_exhaustive(spark):
    rows = [(f"id-{i}", f"s{i}", f"t{i}") for i in range(50)]
    df = spark.createDataFrame(rows, "record_id string, source_text string, target_text string")
    a = split_rows(df, F.col("record_id"), 0.8, 0.1)
    b = split_rows(df.repartition(7), F.col("record_id"), 0.8, 0.1)
    sa = sorted((r.record_id, r.split) for r in a.collect())
    sb = sorted((r.record_id, r.split) for r in b.collect())
    assert sa == sb and len(sa) == 50

    def py_split(k, tr=0.8, va=0.1):
        x = int(hashlib.sha256(k.encode()).hexdigest()[:8], 16) / 0xFFFFFFFF
        return "train" if x < tr else "valid" if x < tr + va else "test"

    assert sa == sorted((k, py_split(k)) for k, _, _ in rows)


def test_invalid_ratios():
    for tr, va in ((0.0, 0.1), (0.9, -0.1), (0.9, 0.1), (0.95, 0.06)):
        with pytest.raises(ValueError):
            check_ratios(tr, va)
    check_ratios(0.9, 0.05)


def test_split_records_carry_the_last_record_of_their_id(spark):
    from corpusmill.operators.split import split_column, split_records

    rows = [(f"id{i % 3 if i < 30 else i}", i, f"src {i % 5}", f"tgt {i % 7}") for i in range(60)]
    df = spark.createDataFrame(rows, "record_id string, ord int, source_text string, target_text string")
    got = split_records(df, translation_key(), "ord").collect()
    assert len(got) == 60
    by_id = {}
    for rid, o, *_ in rows:
        by_id[rid] = max(by_id.get(rid, -1), o)
    own = {r.ord: r.s for r in df.select("ord", split_column(translation_key()).alias("s")).collect()}
    assert all(r.ord == by_id[r.record_id] and r.split == own[r.row_ord] for r in got)
    assert sorted(r.row_ord for r in got) == list(range(60))
