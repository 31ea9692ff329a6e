import json
import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from corpusmill.plans import jobs
from corpusmill.sources import jsonl as J
from corpusmill.sources import registry as R

HOST = R.Host("org", "https://x.example/c", "https://hub.example/d")

XML = """<?xml version="1.0" encoding="UTF-8"?>
<TEXT xml:lang="pyu" source="demo" audio="diarized">
  <S id="1"><FORM kindOf="original">maranger</FORM><TRANSL xml:lang="zho">你好</TRANSL><AUDIO file="1.wav" start="0" end="1.5"/></S>
  <S id="2"><FORM kindOf="original">maranger</FORM><TRANSL xml:lang="zho">你好</TRANSL><AUDIO file="2.wav" start="1.5" end="3"/></S>
  <S id="3"><FORM kindOf="original">  ulaya  </FORM><TRANSL xml:lang="zho">有</TRANSL><AUDIO file="1.wav"/></S>
</TEXT>
"""


def _setup(tmp_path):
    xml_root = tmp_path / "xml"
    p = xml_root / "ePark/XML/hui_ben_ping_tai_picture_book_platform/Puyuma/Nanwang_Puyuma.xml"
    os.makedirs(p.parent)
    p.write_text(XML, encoding="utf-8")
    audio_root = tmp_path / "audio"
    adir = audio_root / "ePark_hui_ben_ping_tai_picture_book_platform/Puyuma/Nanwang_Puyuma"
    os.makedirs(adir)
    for name in ("1.wav", "2.wav"):
        (adir / name).write_bytes(b"RIFF" + name.encode())
    return str(xml_root), str(audio_root)


def _lines(path):
    out = []
    for f in sorted(os.listdir(path)):
        if f.startswith("part-"):
            with open(os.path.join(path, f), encoding="utf-8", newline="") as x:
                out += x.read().splitlines()
    return out


def test_extract_split_stats_prepare_tts(spark, tmp_path):
    xml_root, audio_root = _setup(tmp_path)
    out = str(tmp_path / "processed")
    res = jobs.extract(spark, xml_root, out, HOST)
    assert res.examples.count() == 3
    assert res.translation.count() == 2  # duplicate text pair dropped
    assert res.tts.count() == 2  # 1.wav kept once
    assert res.examples.first().xml_source_url.startswith("https://x.example/c/ePark/XML/")
    assert _lines(f"{out}/summary.md")[:3] == ["# Puyuma Corpus Summary", "", "- Total records: 3"]
    assert J.read_jsonl(spark, f"{out}/translation", J.TRANSLATION_SCHEMA).count() == 2
    assert sorted(f for f in os.listdir(f"{out}/tts") if f.startswith("split=")) == ["split=test", "split=train", "split=valid"]

    counts = {r.split: r.n for r in jobs.split(spark, f"{out}/tts_all", str(tmp_path / "split"), mode="tts").collect()}
    assert sum(counts.values()) == 2 and set(counts) == {"train", "valid", "test"}
    assert sorted(f for f in os.listdir(tmp_path / "split/tts") if f.startswith("split=")) == ["split=test", "split=train", "split=valid"]

    totals, _ = jobs.stats(spark, f"{out}/tts_all")
    assert totals.first().total_records == 2

    tts = J.read_ordered(spark, f"{out}/tts_all", J.TTS_SCHEMA)
    for i, root in enumerate((audio_root, "file://" + audio_root, os.path.relpath(audio_root))):
        lj = str(tmp_path / f"lj{i}")
        assert jobs.prepare_tts(spark, tts, root, lj, order="line_ord").count() == 0
        assert [(p.name, p.read_bytes()) for p in sorted(Path(lj, "wavs").iterdir())] == [("1.wav", b"RIFF1.wav"), ("2.wav", b"RIFF2.wav")]
        assert _lines(f"{lj}/metadata") == ["1.wav|maranger|maranger", "2.wav|maranger|maranger"]
    jobs.prepare_tts(spark, tts, audio_root, lj, order="line_ord")  # nothing is added twice
    assert sorted(os.listdir(f"{lj}/wavs")) == ["1.wav", "2.wav"]
    (tmp_path / "audio/ePark_hui_ben_ping_tai_picture_book_platform/Puyuma/Nanwang_Puyuma/2.wav").unlink()
    with pytest.raises(FileNotFoundError, match="2.wav"):
        jobs.prepare_tts(spark, tts, audio_root, str(tmp_path / "lj9"), order="line_ord")


def test_manifests_are_in_corpus_order(spark, tmp_path):
    root = tmp_path / "xml/ILRDF_Dicts/XML/Puyuma/Puyuma.xml"
    os.makedirs(root)
    for part in range(5):
        body = "".join(f'<S id="{part * 80 + i}"><FORM kindOf="original">f{(part * 80 + i) % 150}</FORM><TRANSL xml:lang="zho">t</TRANSL><AUDIO file="{part * 80 + i}.wav"/></S>' for i in range(80))
        (root / f"part-{part:04d}.xml").write_text(f"<T>{body}</T>", encoding="utf-8")
    kept = None
    for parts in (1, 7, 17):
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        try:
            out = str(tmp_path / f"out{parts}")
            jobs.extract(spark, str(tmp_path / "xml"), out, HOST)
            ids = [json.loads(x)["record_id"].rsplit(":", 1)[1] for x in _lines(f"{out}/translation_all")]
            assert ids == [str(i) for i in range(150)]  # the first of each text, in order
            jobs.split(spark, f"{out}/tts_all", str(tmp_path / f"s{parts}"), mode="tts")
            train = _lines(tmp_path / f"s{parts}/tts/split=train")
            ids = [int(json.loads(x)["record_id"].rsplit(":", 1)[1]) for x in train]
            assert ids == sorted(ids) and len(ids) > 300
            assert kept is None or kept == train
            kept = train
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_large_files_give_the_same_outputs(spark, tmp_path):
    xml_root, _ = _setup(tmp_path)
    part = tmp_path / "xml/ILRDF_Dicts/XML/Puyuma/Puyuma.xml/part-1 a+b%20é.xml"
    os.makedirs(part.parent)
    part.write_text(XML.replace("ulaya", "other"), encoding="utf-8")
    seen = []
    for name, limit in (("whole", 1 << 30), ("pieces", 1), ("mixed", part.stat().st_size)):
        out = str(tmp_path / name)
        res = jobs.extract(spark, xml_root, out, HOST, whole_bytes=limit)
        rows = sorted(map(str, res.examples.collect()))
        seen.append((rows, _lines(f"{out}/examples"), _lines(f"{out}/translation_all"), _lines(f"{out}/summary.md")))
    assert len(seen[0][0]) == 6 and seen[0] == seen[1] == seen[2]


def test_first_missing_file_in_manifest_order_is_named(spark, tmp_path):
    rows = [(f"r{i}", "ePark/hui_ben_ping_tai_picture_book_platform/Nanwang", "Nanwang", f"{(i * 7) % 40}.wav", "t", i) for i in range(40)]
    tts = spark.createDataFrame(rows, "record_id string, source_key string, dialect string, audio_file string, text string, at int").withColumn("normalized_text", F.col("text"))
    os.makedirs(tmp_path / "audio")
    with pytest.raises(FileNotFoundError, match="/0.wav"):
        jobs.prepare_tts(spark, tts.repartition(7), str(tmp_path / "audio"), str(tmp_path / "lj"), order="at")


def test_limit_takes_the_first_sources(spark, tmp_path):
    xml_root, _ = _setup(tmp_path)
    assert jobs.extract(spark, xml_root, str(tmp_path / "o0"), HOST, limit=0).examples.count() == 0
    assert jobs.extract(spark, xml_root, str(tmp_path / "o1"), HOST, limit=1).examples.count() == 3


MANIFEST = """{"group": "z", "corpus_slug": "c", "dialect": "d", "audio_file": "x", "target_text": "t", "duration_seconds": 3.234}

\t\u3000
{"group": "a", "corpus_slug": "c", "dialect": "d", "duration_seconds": "x", "audio_file": 0, "translation_zh": []}
{"group": null, "dialect": " d ", "duration_seconds": 1, "extra": {"k": [1]}, "audio_file": "", "target_text": "u"}
"""


def test_stats_text(spark, tmp_path):
    (tmp_path / "m.jsonl").write_text(MANIFEST, encoding="utf-8")
    totals, _ = jobs.stats(spark, str(tmp_path / "m.jsonl"), str(tmp_path / "md"))
    t = totals.first()
    assert (t.total_records, t.missing_audio, t.missing_translation, t.total_duration_seconds) == (3, 2, 1, 4.234)
    assert _lines(tmp_path / "md") == [
        "# Puyuma Corpus Summary", "",
        "- Total records: 3", "- Missing audio: 2", "- Missing translation: 1", "- Total duration seconds: 4.234", "",
        "## by_group", "- z: 1", "- a: 1", "- : 1", "",
        "## by_corpus", "- z/c: 1", "- a/c: 1", "- /: 1", "",
        "## by_dialect", "- d: 3", "",
        "## by_audio_mode", "- : 3",
    ]


def test_split_passes_lines_through_and_rejects_malformed(spark, tmp_path):
    (tmp_path / "m.jsonl").write_text(MANIFEST, encoding="utf-8")
    counts = jobs.split(spark, str(tmp_path / "m.jsonl"), str(tmp_path / "s"))
    assert sum(r.n for r in counts.collect()) == 3
    got = sorted(x for s in ("train", "valid", "test") for x in _lines(tmp_path / f"s/translation/split={s}"))
    assert got == sorted(x for x in MANIFEST.splitlines() if x.strip())
    for bad in ("{not json", "[1]", "3"):
        (tmp_path / "bad.jsonl").write_text('{"a": 1}\n' + bad + "\n", encoding="utf-8")
        with pytest.raises(Exception):
            jobs.split(spark, str(tmp_path / "bad.jsonl"), str(tmp_path / "sb"))


def test_download_plan_job(spark, tmp_path):
    xml_root, audio_root = _setup(tmp_path)
    recs = spark.createDataFrame(
        [("ePark/hui_ben_ping_tai_picture_book_platform/Nanwang", "1.wav"), ("ePark/hui_ben_ping_tai_picture_book_platform/Nanwang", "9.wav")],
        "source_key string, audio_file string",
    )
    for x, a in ((xml_root, audio_root), ("file://" + xml_root, "file:" + audio_root + "/"), (os.path.relpath(xml_root), os.path.relpath(audio_root))):
        plan = jobs.plan_downloads(spark, recs, x, a, HOST, download_audio=True, limit=1)
        assert [r.dest.rsplit("/", 1)[-1] for r in plan.collect()] == ["9.wav"]


def test_split_ranges_lines_before_it_parses_them(spark, tmp_path, monkeypatch):
    plans = []
    parse = J.parsed_lines

    def seen(lines):
        plans.append(lines._jdf.queryExecution().optimizedPlan().toString())
        return parse(lines)

    monkeypatch.setattr(J, "parsed_lines", seen)
    (tmp_path / "m.jsonl").write_text("".join(f'{{"source_text": "a{i}", "target_text": "b"}}\n\u00a0\n' for i in range(50)))
    counts = jobs.split(spark, str(tmp_path / "m.jsonl"), str(tmp_path / "s")).collect()
    assert sum(r.n for r in counts) == 50
    assert len(plans) == 1 and "RepartitionByExpression" in plans[0] and "parse_json" not in plans[0]


def test_stats_read_their_input_once(spark, tmp_path):
    path = tmp_path / "m.jsonl"
    path.write_text('\u3000{"group": "g", "audio_file": "a", "duration_seconds": 1.5} \u2003\n{"group": "h", "target_text": "t"}\n')
    totals, facets = jobs.stats(spark, str(path))
    path.unlink()
    t = totals.first()
    assert (t.total_records, t.missing_audio, t.missing_translation, t.total_duration_seconds) == (2, 1, 1, 1.5)
    assert {(r.key, r.n) for r in facets.where("facet = 'by_group'").collect()} == {("g", 1), ("h", 1)}
