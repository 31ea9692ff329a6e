import os
import urllib.parse

from pyspark.sql import functions as F

from corpusmill.functions.urls import url_quote
from corpusmill.sources import registry as R
from corpusmill.sources import xml as X

HOST = R.Host("org", "https://x.example/c", "https://hub.example/d")


def test_registry_has_42_sources_in_generator_order(spark):
    reg = R.with_source_paths(R.supported_sources(spark, org="org"), HOST).orderBy("source_ord").collect()
    assert len(reg) == 42
    assert reg[0].corpus_slug == "hui_ben_ping_tai_picture_book_platform" and reg[0].dialect == "Nanwang"
    assert reg[1].corpus_slug == "jiu_jie_jiao_cai_nine_level_materials" and reg[1].dialect == "Jianhe"
    assert reg[-1].group == "ILRDF_Dicts" and reg[-1].xml_relative_path == "ILRDF_Dicts/XML/Puyuma/Puyuma.xml"
    assert reg[0].source_key == "ePark/hui_ben_ping_tai_picture_book_platform/Nanwang"
    assert reg[0].xml_relative_path == "ePark/XML/hui_ben_ping_tai_picture_book_platform/Puyuma/Nanwang_Puyuma.xml"
    assert reg[0].local_xml_relative_dir == "ePark/XML/hui_ben_ping_tai_picture_book_platform/Puyuma"
    assert reg[0].audio_repo_slug == "ePark_hui_ben_ping_tai_picture_book_platform"
    assert sum(1 for r in reg if r.group == "ePark") == 41


def test_audio_of_a_lesson_corpus_lies_in_its_dialect_folder(spark):
    reg = R.with_source_paths(R.supported_sources(spark, org="org"), HOST).where("source_ord = 0")
    row = reg.select(
        R.audio_url(F.col("group"), F.col("audio_repo"), F.col("dialect"), F.lit("k7/l.ogg"), hub_base=HOST.hub_base).alias("u"),
        R.local_audio_dir("/snd", F.col("group"), F.col("audio_repo_slug"), F.col("dialect")).alias("d"),
    ).first()
    assert "/resolve/main/Puyuma/Nanwang_Puyuma/k7/l.ogg" in row.u
    assert row.d == "/snd/ePark_hui_ben_ping_tai_picture_book_platform/Puyuma/Nanwang_Puyuma"


def test_dictionary_audio_is_flat(spark):
    reg = R.with_source_paths(R.supported_sources(spark, org="org"), HOST).where("`group` = 'ILRDF_Dicts'")
    u = reg.select(R.audio_url(F.col("group"), F.col("audio_repo"), F.col("dialect"), F.lit("x y.wav"), hub_base=HOST.hub_base).alias("u")).first().u
    assert u.endswith("/ILRDF_Dict_Puyuma/resolve/main/x%20y.wav")


def test_url_quote_matches_python(spark):
    values = ["a b.wav", "a+b", "~x*y", "dir/f.wav", "é中.wav", "100%", "a&b=c?d#e", "tab\there", "(1)'!,;:@$"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = {r.v: r.q for r in df.select("v", url_quote(F.col("v")).alias("q")).collect()}
    assert got == {v: urllib.parse.quote(v) for v in values}


DOC = """<?xml version="1.0" encoding="UTF-8"?>
<TEXT xml:lang=" pyu " source="Src" citation="C" copyright="(c)" glottocode="puyu1239" audio="segmented">
  <S id="1">
    <FORM kindOf="original">semu'an</FORM>
    <FORM kindOf="standard">semuan</FORM>
    <TRANSL xml:lang="zho">山谷</TRANSL>
    <AUDIO file="k7.ogg" url="far" start=" 2.25 " end="soon"/>
  </S>
  <S id="2">
    <FORM kindOf="standard"></FORM>
    <FORM kindOf="standard">second</FORM>
    <FORM kindOf="original">orig</FORM>
    <W><FORM kindOf="original">nested</FORM></W>
  </S>
  <S id="3"/>
  <X><S id="nested-sentence"/></X>
</TEXT>
"""


def _parse(spark, text):
    files = spark.createDataFrame([("f.xml", text)], "rel_path string, content string")
    return X.extract_sentences(files).orderBy("sent_pos").collect()


def test_child_pick_by_kind_and_language(spark):
    rows = _parse(spark, DOC)
    assert len(rows) == 3  # only direct S children, <S/> kept (T12: root tag not checked)
    r = rows[0]
    assert (r.original_form, r.standard_form, r.translation_zh) == ("semu'an", "semuan", "山谷")
    assert (r.audio_file, r.audio_url, r.audio_start, r.audio_end) == ("k7.ogg", "far", 2.25, None)
    assert r.language_code == "pyu" and r.root_audio_mode == "segmented" and r.root_source_label == "Src"


def test_first_match_wins_even_if_empty_and_nested_ignored(spark):
    r = _parse(spark, DOC)[1]
    assert r.standard_form == ""  # T10
    assert r.original_form == "orig"  # T13: W/FORM ignored
    assert r.audio_file == "" and r.audio_start is None  # absent AUDIO
    empty = _parse(spark, DOC)[2]
    assert (empty.sentence_id, empty.original_form, empty.translation_zh) == ("3", "", "")


def test_load_corpus_from_files_skips_absent_sources(spark, tmp_path):
    reg = R.supported_sources(spark, org="org")
    root = tmp_path / "xml"
    p1 = root / "ePark/XML/hui_ben_ping_tai_picture_book_platform/Puyuma/Nanwang_Puyuma.xml"
    p2 = root / "ILRDF_Dicts/XML/Puyuma/Puyuma.xml"
    for p, word in ((p1, "first"), (p2, "dict")):
        os.makedirs(p.parent, exist_ok=True)
        p.write_text(DOC.replace("semu'an", word), encoding="utf-8")
    files = X.read_xml_files(spark, str(root))
    ex = X.load_corpus(files, reg, HOST, xml_root=str(root)).orderBy("source_ord", "sent_pos").collect()
    assert len(ex) == 6
    assert [r.original_form for r in ex][:1] == ["first"] and ex[3].original_form == "dict"
    assert ex[0].record_id == "ePark/hui_ben_ping_tai_picture_book_platform/Nanwang:1"
    assert ex[3].audio_mode == "segmented" and ex[0].source_text == "semuan"
    assert ex[0].duration_seconds is None


def test_element_text_is_the_parsers(spark):
    doc = """<T source="A &gt; &#66; > C" citation='q "x"'><S id="1"><FORM kindOf="original">c<!-- k -->d</FORM>
<FORM kindOf="standard"><b>x</b>tail</FORM><TRANSL xml:lang=" zho&#8203;">a<![CDATA[<&>]]>&#233;<i>no</i>z</TRANSL></S>
<X><S id="deep"><FORM kindOf="original">no</FORM></S></X><S id="2"><S id="inner"/></S></T>"""
    rows = _parse(spark, doc)
    assert [(r.sentence_id, r.sent_pos) for r in rows] == [("1", 1), ("2", 2)]
    assert (rows[0].original_form, rows[0].standard_form, rows[0].translation_zh) == ("cd", "", "a<&>\u00e9")
    assert (rows[0].root_source_label, rows[0].citation) == ("A > B > C", 'q "x"')


def test_declared_encoding_and_huge_root_tag(spark):
    long = "x" * 70_000
    latin = f'<?xml version="1.0" encoding="ISO-8859-1"?><T BibTeX_citation="{long} a > b" xml:lang="ami"><S id="1"><FORM kindOf="original">\u00e9t\u00e9</FORM></S></T>'
    wide = latin.replace("ISO-8859-1", "UTF-16")
    files = spark.createDataFrame([(1, bytearray(latin.encode("latin-1"))), (2, bytearray(wide.encode("utf-16")))], "n int, content binary")
    for r in X.extract_sentences(files, keep=("n",)).collect():
        assert r.original_form == "\u00e9t\u00e9" and r.language_code == "ami" and r.bibtex_citation == f"{long} a > b"


def test_broken_file_fails(spark):
    import pytest

    with pytest.raises(Exception, match="ParseError"):
        _parse(spark, "<T><S id='1'></T>")


def test_many_sentences_of_a_file(spark):
    body = "".join(f'<S id="{i}"><FORM kindOf="original">w{i} &amp; x</FORM><AUDIO file="{i}.wav" start="0" end="{i}"/></S>\n' for i in range(10_000))
    rows = _parse(spark, f'<?xml version="1.0"?>\n<!-- c -->\n<T source="A &amp; B">\n{body}</T>\n')
    assert len(rows) == 10_000 and all((r.sent_pos, r.original_form, r.audio_end) == (i + 1, f"w{i} & x", float(i)) for i, r in enumerate(rows))


def test_roots_of_any_form_give_the_same_rows(spark, tmp_path, monkeypatch):
    p = tmp_path / "deep/xml/xml/ePark/XML/hui_ben_ping_tai_picture_book_platform/Puyuma/Nanwang_Puyuma.xml"
    os.makedirs(p.parent)
    p.write_text(DOC, encoding="utf-8")
    root = str(tmp_path / "deep/xml/xml")
    got = [sorted(r.rel_path for r in X.read_xml_files(spark, r).collect()) for r in (root, root + "/", "file://" + root, "file:" + root)]
    relative = os.path.relpath(root)
    got.append(sorted(r.rel_path for r in X.read_xml_files(spark, relative).collect()))
    assert all(g == ["ePark/XML/hui_ben_ping_tai_picture_book_platform/Puyuma/Nanwang_Puyuma.xml"] for g in got)


def test_direct_registry_equals_corpus_builder(spark):
    from corpusmill.plans import adapter

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    a = adapter.registry_from_documents(docs)
    b = adapter.registry_from_documents_direct(docs)
    assert sorted(a.collect()) == sorted(b.collect())
