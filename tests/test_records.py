import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from corpusmill.sources import csv_records as C
from corpusmill.sources import xml as X
from corpusmill.sources import xml_split as S


@pytest.fixture
def cuts(spark):
    """Sets how many bytes a split holds."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    before = {n: spark.conf.get(n, None) for n in names}

    def size(n):
        spark.conf.set(names[0], str(n))
        spark.conf.set(names[1], "1")
        spark.conf.set(names[2], "1")

    yield size
    for n, value in before.items():
        spark.conf.unset(n) if value is None else spark.conf.set(n, value)


def sentence(i, rng):
    inner = rng.choice(["", "<!-- </S> <S> -->", "<W><S id='no'><FORM kindOf='original'>inner</FORM></S></W>", "<![CDATA[</S><x>]]>", "<?pi </S> ?>"])
    return (
        f"<S id='s{i}'>{inner}<FORM kindOf=\"original\">f{i} &lt;é&#x4e00;</FORM>\n<TRANSL xml:lang='zho'>t{i}</TRANSL>"
        f"<AUDIO file='a{i}.wav' start='1' url='x>y' z:q='1'/></S{rng.choice(['', ' ', chr(10)])}>" + rng.choice(["", "\n", "<S/>", "<note>no sentence</note>", "text"])
    )


def documents():
    rng = random.Random(3)
    head = "<?xml version='1.0' encoding='utf-8'?>\n<!-- </S> -->\n<corpus xml:lang='en' source='a > b &amp; c' citation='\"q\"' xmlns:z='urn:z'>"
    yield "many", head + "".join(sentence(i, rng) for i in range(120)) + "</corpus>\n"
    yield "one", head + sentence(1, rng) + "</corpus>"
    yield "none", head + "</corpus>"
    yield "empty", "<corpus/>"
    yield "large", head + "<S id='big'><FORM kindOf='original'>" + "x" * 5000 + "</FORM></S><S id='end'/></corpus><!-- after </S> -->"
    yield "bom", "﻿<corpus source='b'><S id='1'/><S id='2'></S></corpus>"


@pytest.mark.parametrize("size", [64, 333, 1000, 1 << 20])
def test_split_xml_equals_whole_files(spark, cuts, tmp_path, size):
    for name, text in documents():
        (tmp_path / f"{name}.xml").write_text(text, encoding="utf-8")
    cuts(size)
    got = S.split_sentences(spark, str(tmp_path))
    if size == 64:
        assert spark.read.option("lineSep", "</S>").text(str(tmp_path)).rdd.getNumPartitions() > 100
    got = sorted((r["file"].rsplit("/", 1)[1], *tuple(r)[1:]) for r in got.collect())
    want = sorted(
        (f"{name}.xml", pos, *fields) for name, text in documents() for pos, fields in enumerate(X.sentences_of(text.encode("utf-8")), start=1)
    )
    assert len(want) > 125 and sorted(map(str, got)) == sorted(map(str, want))


@pytest.mark.parametrize(
    "text",
    [
        "<corpus><S></corpus>", "<corpus><S></S>", "<corpus><S></S></other>", "<corpus><S>&nope;</S></corpus>", "<corpus><S></S><b></corpus>",
        "<!DOCTYPE c><c><S></S></c>", "<?xml version='1.0' encoding='big5'?><c><S></S></c>", "", "<corpus><S a=1></S></corpus>",
    ],
)
def test_broken_or_unfit_files_fail(spark, tmp_path, text):
    (tmp_path / "a.xml").write_text(text, encoding="utf-8")
    (tmp_path / "b.xml").write_text("<corpus><S/></corpus>", encoding="utf-8")
    if text:
        with pytest.raises(Exception):  # noqa: B017
            S.split_sentences(spark, str(tmp_path)).collect()


def csv_rows():
    rng = random.Random(9)
    alphabet = ["a", "é", ",", '"', "\n", "\r\n", "\r", " ", "|", "\\", "", "long " * 30]
    rows = [tuple("".join(rng.choice(alphabet) for _ in range(rng.randint(0, 6))) for _ in range(3)) for _ in range(300)]
    return [*rows, ("", "", ""), (None, "x", None), ('"', '""', "\n\n")]


def by_module(rows, names, sep=","):
    buf = io.StringIO(newline="")
    w = csv.writer(buf, delimiter=sep)
    w.writerow(names)
    w.writerows([["" if v is None else v for v in r] for r in rows])
    return buf.getvalue()


def test_written_csv_is_the_modules(spark, tmp_path):
    rows = csv_rows()
    for sep in (",", "|"):
        df = spark.createDataFrame(rows, 'k string, `v,"` string, w string').coalesce(1)
        C.write_records(df, str(tmp_path / "out"), sep=sep)
        (part,) = [p for p in (tmp_path / "out").iterdir() if p.name.startswith("part-")]
        assert part.read_bytes().decode("utf-8") == by_module(rows, ["k", 'v,"', "w"], sep)


@pytest.mark.parametrize("size", [50, 700, 1 << 20])
def test_csv_read_by_many_tasks(spark, cuts, tmp_path, size):
    rows = csv_rows()
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "x.csv").write_bytes(by_module(rows, ["k", "v", "w"]).encode("utf-8"))
    cuts(size)
    got = C.read_csv(spark, str(tmp_path / "in"), ["k", "v", "w"]).collect()
    got.sort(key=lambda r: tuple(r["place"]))
    assert [tuple(r)[:3] for r in got] == [tuple("" if v is None else v for v in r) for r in rows]


def test_csv_round_trip_of_several_parts(spark, tmp_path):
    rows = csv_rows()
    df = spark.createDataFrame(rows, "k string, v string, w string").repartition(5)
    C.write_records(df, str(tmp_path / "out"))
    back = C.read_csv(spark, str(tmp_path / "out"), ["k", "v", "w"]).drop("place")
    assert sorted(map(tuple, back.collect())) == sorted(tuple(v or "" for v in r) for r in rows)
    C.write_records(df.where("false"), str(tmp_path / "none"))
    assert C.read_csv(spark, str(tmp_path / "none"), ["k", "v", "w"]).count() == 0
    C.write_records(df.select("k").where(F.col("k") == ""), str(tmp_path / "single"))
    assert C.read_csv(spark, str(tmp_path / "single"), ["k"]).where("k = ''").count() == sum(not r[0] and r[0] is not None for r in rows)


@pytest.mark.parametrize("text", ["k,v,w\r\n1,2\r\n", "a,b,c\r\n1,2,3\r\n", 'k,v,w\r\n1,2,"3\r\n'])
def test_unfit_csv_fails(spark, tmp_path, text):
    (tmp_path / "x.csv").write_bytes(text.encode())
    with pytest.raises(Exception):  # noqa: B017
        C.read_csv(spark, str(tmp_path), ["k", "v", "w"]).collect()


def test_xml_lines_are_lexed_three_times(spark, monkeypatch, tmp_path):
    lines = 200
    (tmp_path / "a.xml").write_text("<corpus>" + "".join(f"<S id='{i}'></S>" for i in range(lines)) + "</corpus>")
    steps = spark.sparkContext.accumulator(0)

    class Counted(S.Children):
        states = ("content",)

        def step(self, line, state):
            steps.add(1)
            return super().step(line, state)

    monkeypatch.setattr(S, "Children", Counted)
    assert S.split_sentences(spark, str(tmp_path)).count() == lines
    # how splits begin, the pieces of records at their edges, whole records
    assert steps.value == 3 * (lines + 1)
