import random
import re
from collections import Counter

from pyspark.sql import functions as F

from corpusmill.operators import modeldata as MD
from corpusmill.operators import speech as SP
from corpusmill.sources import registry as R

HOST = R.Host("org", "https://x.example/c", "https://hub.example/d")


def test_ljspeech_rows_first_per_file_and_text_defaults(spark):
    rows = [
        (0, "a.wav", " t1 ", "n1"),
        (1, "a.wav", "t2", "n2"),
        (2, None, "t3", "n3"),  # T17: NULL file name is skipped
        (3, "", "t4", "n4"),
        (4, "b.wav", "t5", None),  # T18: NULL normalized_text -> ""
    ]
    df = spark.createDataFrame(rows, "ord int, audio_file string, text string, normalized_text string")
    out = sorted((r.audio_file, r.text, r.normalized_text) for r in SP.ljspeech_rows(df, "ord").collect())
    assert out == [("a.wav", "t1", "n1"), ("b.wav", "t5", "")]
    # column absent -> the text is used
    out2 = SP.ljspeech_rows(df.drop("normalized_text"), "ord").orderBy("ord").collect()
    assert [(r.audio_file, r.normalized_text) for r in out2] == [("a.wav", "t1"), ("b.wav", "t5")]
    c = SP.ljspeech_counts(df).first()
    assert (c.input_rows, c.materialized_rows) == (5, 2)


def test_resolve_audio_path_and_missing(spark):
    rows = [
        ("ePark/corp/Nanwang", "Xiqun", "1.wav"),  # dialect comes from the row
        ("ILRDF_Dicts/Puyuma/Nanwang", "Nanwang", "2.wav"),
        ("", "Nanwang", "3.wav"),
        ("bad", "Nanwang", "4.wav"),
    ]
    df = spark.createDataFrame(rows, "source_key string, dialect string, audio_file string")
    got = {r.audio_file: (r.audio_path, r.problem) for r in SP.resolve_audio_path(df, "/a").collect()}
    assert got["1.wav"] == ("/a/ePark_corp/Puyuma/Xiqun_Puyuma/1.wav", None)
    assert got["2.wav"] == ("/a/ILRDF_Dict_Puyuma/2.wav", None)
    assert got["3.wav"][1] == "Row is missing source_key" and got["4.wav"][0] is None
    inv = spark.createDataFrame([("/a/ILRDF_Dict_Puyuma/2.wav", 10)], "path string, length long")
    missing = sorted(r.audio_file for r in SP.audio_missing(df, inv, "/a").collect())
    assert missing == ["1.wav", "3.wav", "4.wav"]


def test_download_plan_skips_present_files(spark):
    reg = R.supported_sources(spark, org="org")
    recs = spark.createDataFrame(
        [("ePark/hui_ben_ping_tai_picture_book_platform/Nanwang", "x.wav"), ("ePark/hui_ben_ping_tai_picture_book_platform/Nanwang", "")],
        "source_key string, audio_file string",
    )
    inv = spark.createDataFrame(
        [("x/ePark/XML/hui_ben_ping_tai_picture_book_platform/Puyuma/Nanwang_Puyuma.xml", 5)], "path string, length long"
    )
    plan = SP.download_plan(reg, recs, HOST, inv, xml_root="x", audio_root="a", limit=2)
    kinds = sorted((r.kind, r.dest) for r in plan.collect())
    assert kinds == [
        ("audio", "a/ePark_hui_ben_ping_tai_picture_book_platform/Puyuma/Nanwang_Puyuma/x.wav"),
        ("xml", "x/ePark/XML/jiu_jie_jiao_cai_nine_level_materials/Puyuma/Jianhe_Puyuma.xml"),
    ]
    assert SP.download_plan(reg, recs, HOST, inv, xml_root="x", audio_root="a", limit=0).count() == 0
    # the limit counts positions in the given registry
    late = SP.download_plan(reg.where("source_ord >= 41"), recs, HOST, inv, xml_root="x", audio_root="a", limit=1).collect()
    assert [r.dest for r in late] == ["x/ILRDF_Dicts/XML/Puyuma/Puyuma.xml"]
    assert SP.download_plan(reg, recs, HOST, inv, xml_root="x", audio_root="a", limit=1, overwrite=True).count() == 2


def test_byte_tokens(spark):
    df = spark.createDataFrame([("aé", "x"), ("", "y"), ("é" * 300, "z")], "source_text string, target_text string")
    out = MD.tokenize_pairs(df, max_source_length=256, max_target_length=4).collect()
    assert out[0].input_ids == [100, 198, 172, 1] and out[0].labels == [123, 1]
    assert out[1].input_ids == [1]
    assert len(out[2].input_ids) == 256 and out[2].input_ids[-1] == 1


def test_label_restore_decodes_and_drops_partial_bytes(spark):
    df = spark.createDataFrame([("a", "aé中"), ("b", "")], "source_text string, target_text string")
    tok = MD.tokenize_pairs(df, max_target_length=5)  # keeps 4 bytes: a, é (2 bytes), first byte of 中
    padded = tok.select(MD.restore_labels(MD.pad_labels(F.col("labels"), 8)).alias("ids"))
    out = [r.t for r in padded.select(MD.decode_ids(F.col("ids")).alias("t")).collect()]
    assert out == ["aé", ""]


def test_13a_tokens():
    assert MD.tokens_13a("The cat sat.") == ["The", "cat", "sat", "."]
    assert MD.tokens_13a("1,000-2 items (approx.)") == ["1,000", "-", "2", "items", "(", "approx", ".", ")"]
    assert MD.tokens_13a("&amp; x &lt;y&gt; a-b 3.5, 7.") == ["&", "x", "<", "y", ">", "a-b", "3.5", ",", "7", "."]
    assert MD.tokens_13a("end-\nofline\nnext<skipped>") == ["endofline", "next"] and MD.tokens_13a(None) == []


def test_corpus_bleu_values(spark):
    schema = "pair_id int, prediction string, reference string"
    same = spark.createDataFrame([(0, "a b c d e", "a b c d e"), (1, "x y z w", "x y z w")], schema)
    got = MD.corpus_bleu(same).first()
    assert (got.score, got.bp, got.sys_len, got.ref_len, got.correct_4, got.total_4) == (100.0, 1.0, 9, 9, 3, 3)
    # 4 of 5 words, 3 of 4 pairs, 2 of 3 triples, 1 of 2 quadruples; five words against six
    one = MD.corpus_bleu(spark.createDataFrame([(0, "a b c d x", "a b c d e f")], schema)).first()
    assert [one[f"correct_{n}"] for n in range(1, 5)] == [4, 3, 2, 1] and [one[f"total_{n}"] for n in range(1, 5)] == [5, 4, 3, 2]
    assert one.bp == 0.8187 and one.score == 54.7518
    # clipping is per pair: the spare "a" of the first pair doesn't help the second
    clip = MD.corpus_bleu(spark.createDataFrame([(0, "a a", "a b"), (0, "b", "a a")], schema)).first()
    assert (clip.correct_1, clip.total_1, clip.correct_2, clip.total_2) == (1, 3, 0, 1)
    # no match at all: 100 / (2 * 5), 100 / (4 * 4), 100 / (8 * 3), 100 / (16 * 2)
    none = MD.corpus_bleu(spark.createDataFrame([(0, "p q r s t", "a b c d e")], schema)).first()
    assert [round(none[f"precision_{n}"], 6) for n in range(1, 5)] == [10.0, 6.25, round(100 / 24, 6), 3.125]
    empty = MD.corpus_bleu(spark.createDataFrame([(0, "", "a")], schema)).first()
    assert (empty.score, empty.bp, empty.sys_len, empty.ref_len) == (0.0, 0.0, 0, 1)


def test_training_pairs_need_both_splits(spark, tmp_path):
    import pytest

    df = spark.createDataFrame([("train", 1), ("valid", 2), ("test", 3)], "split string, v int")
    got = MD.training_pairs(df, str(tmp_path / "both"))
    assert got.columns == df.columns and sorted(map(tuple, got.collect())) == [("train", 1), ("valid", 2)]
    with pytest.raises(ValueError, match="Validation set is empty"):
        MD.training_pairs(df.where("v = 1"), str(tmp_path / "one"))
    with pytest.raises(ValueError, match="Training set is empty"):
        MD.training_pairs(df.where("v = 3"), str(tmp_path / "none"))


def test_gen_len(spark):
    df = spark.createDataFrame([("  a b  c ",), ("",), ("x",)], "prediction string")
    assert MD.gen_len(df).first().gen_len == round((3 + 0 + 1) / 3, 4)
    assert MD.gen_len(df.limit(0)).first().gen_len == 0.0


def test_require_rows(spark):
    import pytest

    with pytest.raises(ValueError):
        MD.require_rows(spark.createDataFrame([], "a int"), "Training set")


def _tokens_by_rules(text):
    x = text.strip()
    for old, new in (("<skipped>", ""), ("-\n", ""), ("\n", " "), ("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")):
        x = x.replace(old, new)
    x = f" {x} "
    for pattern, new in ((MD.RE_13A_PUNCT, r" \1 "), (MD.RE_13A_PERIOD_BEFORE, r"\1 \2 "), (MD.RE_13A_PERIOD_AFTER, r" \1 \2"), (MD.RE_13A_DASH, r"\1 \2 ")):
        x = re.sub(pattern, new, x)
    return x.split()


def test_pair_statistics_are_those_of_the_rules(monkeypatch):
    rng = random.Random(4)
    parts = [*"ab1.,-- '(/~\n", "&amp;", "&quot;", "<skipped>", "-\n", "é", "　"]
    for _ in range(5000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert MD.tokens_13a(text) == _tokens_by_rules(text), text
    for _ in range(2000):
        ref = [rng.choice("abcd") for _ in range(rng.randint(0, 20))]
        hyp = [w for w in ref if rng.random() < 0.8] + [rng.choice("ab")] * rng.randint(0, 2)
        correct = []
        for n in range(1, 5):
            mine, theirs = (Counter(zip(*(t[k:] for k in range(n)))) for t in (hyp, ref))
            correct.append((mine & theirs).total())
        got = MD._pair_stats(" ".join(hyp), " ".join(ref))
        assert got == [len(hyp), len(ref), *correct, *(max(len(hyp) - n, 0) for n in range(4))]
    # equal texts are cut once and counted by their length
    calls = []
    monkeypatch.setattr(MD, "tokens_13a", lambda text: calls.append(text) or text.split())
    assert MD._pair_stats("a b a b", "a b a b") == [4, 4, 4, 3, 2, 1, 4, 3, 2, 1] and len(calls) == 1
