"""Large XML corpora: one file read by many tasks.

A file's direct children are cut apart by :mod:`records`, with ``</S>`` as separator and a
small lexer that knows comments, CDATA sections, processing instructions and depth.  Each
piece then goes, between the file's own root tag and its end tag, through the same parser
as whole files, so names, entities and texts are exactly the parser's.  A piece that is
not well-formed fails the job.

Needs UTF-8 without a document type; files with one, or in another encoding, are errors
here and are read whole by :func:`corpusmill.sources.xml.read_sentences`.
"""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusmill.operators.joins import broadcast_if_small
from corpusmill.session import scratch_path
from corpusmill.sources.files import below, file_inventory
from corpusmill.sources.records import records_and_firsts
from corpusmill.sources.xml import ROOT_FIELDS, SENTENCE_FIELDS, sentences_of

_OPEN = re.compile(rb"<(?:(!--)|(!\[CDATA\[)|(\?)|(/)|(!)|)")
_TAG_REST = re.compile(rb"""(?:[^>"']|"[^"]*"|'[^']*')*>""")
_CLOSERS = {"comment": b"-->", "cdata": b"]]>", "instruction": b"?>"}
_BATCH = 2048


def _tags(text: bytes, state: str) -> Iterator[tuple[str, int, int]]:
    """('start' | 'end' | 'empty', from, to) of each tag of ``text``, then (state, n, n)."""
    at = 0
    while True:
        if state != "content":
            close = _CLOSERS[state]
            end = text.find(close, at)
            if end < 0:
                break
            at, state = end + len(close), "content"
        m = _OPEN.search(text, at)
        if m is None:
            break
        if m[1] or m[2] or m[3]:
            at, state = m.end(), "comment" if m[1] else "cdata" if m[2] else "instruction"
            continue
        if m[5]:
            raise ValueError("a document type: the file must be read whole")
        rest = _TAG_REST.match(text, m.end())
        if rest is None:
            raise ValueError(f"a tag without an end: {text[m.start() : m.start() + 100]!r}")
        at = rest.end()
        yield "end" if m[4] else "empty" if text[at - 2 : at] == b"/>" else "start", m.start(), at
    yield state, len(text), len(text)


class Children:
    """Lines that end with ``</S>``; a record is complete at depth 1."""

    separator = "</S>"
    states = ("content", "comment", "cdata", "instruction")

    def step(self, line: bytes, state: str) -> tuple[str, int]:
        change = 0
        for kind, _, _ in _tags(line + b"</S>", state):
            change += (kind == "start") - (kind == "end")
        return kind, change

    def ends(self, state: str, depth: int) -> bool:
        return state == "content" and depth == 1


def root_tag(text: bytes) -> bytes:
    """The root's start tag, from the first bytes of a file."""
    if text[:2] in (b"\xfe\xff", b"\xff\xfe"):
        raise ValueError("not UTF-8: the file must be read whole")
    declared = re.match(rb"""(?:\xef\xbb\xbf)?<\?xml[^>]*?encoding\s*=\s*["']([^"']*)""", text)
    if declared and declared[1].lower() not in (b"utf-8", b"utf8", b"us-ascii"):
        raise ValueError(f"encoding {declared[1].decode()}: the file must be read whole")
    for kind, start, end in _tags(text, "content"):
        if kind in ("start", "empty"):
            return text[start:end]
    raise ValueError("no root element")


def _name(tag: bytes) -> bytes:
    return re.match(rb"<\s*([^\s/>]+)", tag)[1]


def large_files(spark: SparkSession, xml_root: str, more_than: int, pattern: str = "*.xml") -> DataFrame | None:
    """``split_sentences`` of the files below ``xml_root`` with more than ``more_than``
    bytes, with ``rel_path`` for ``file``; None if there is none."""
    paths = [r.uri for r in file_inventory(spark, xml_root, pattern).where(F.col("length") > more_than).select("uri").collect()]
    if not paths:
        return None
    found = split_sentences(spark, paths)
    return found.withColumn("rel_path", below(spark, xml_root, F.url_decode(F.replace("file", F.lit("+"), F.lit("%2B"))))).drop("file")


def split_sentences(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(file, sent_pos, raw fields): the rows of ``read_sentences`` for files of any size.
    ``file`` is the path as Spark lists it, ``sent_pos`` counts the root's ``S`` children
    from 1.  The parsed rows are written once below the shared scratch folder, as their
    places need the number of sentences in all splits before."""
    records, first = records_and_firsts(spark, paths, Children())

    def tag_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            tags = [root_tag(r.as_py() + b"</S>") for r in b.column("record")]
            yield pa.RecordBatch.from_arrays([b.column("file"), pa.array(tags, pa.binary())], names=["file", "root"])

    roots = first.select("file", "record").mapInArrow(tag_of, "file string, root binary")
    fields = [*ROOT_FIELDS, *SENTENCE_FIELDS]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["file", "block", "seq", "nth", *fields]
        for b in batches:
            rows: list[tuple] = []

            def batch() -> pa.RecordBatch:
                cols = list(zip(*rows)) or [()] * len(names)
                rows.clear()
                kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64()] + [pa.string()] * len(fields)
                return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

            for file, block, seq, ended, root, record in zip(*(b.column(c).to_pylist() for c in ("file", "block", "seq", "ended", "root", "record"))):
                text = record
                if ended:
                    text = text + b"</S>" + b"</" + _name(root) + b">"
                if block or seq:
                    text = root + text
                try:
                    found = list(sentences_of(text.decode("utf-8")))
                except ET.ParseError as error:
                    raise ValueError(f"{file}: not well-formed: {error}: {record[:200]!r}") from error
                rows += [(file, block, seq, k, *values) for k, values in enumerate(found)]
                if not ended:
                    rows.append((file, block, seq, -1, *[None] * len(fields)))
                if len(rows) >= _BATCH:
                    yield batch()
            yield batch()

    kinds = ", ".join(["file string, block long, seq long, nth long", *(f"{f} string" for f in fields)])
    # one root tag per file, each of a few attributes
    parsed = records.join(broadcast_if_small(roots), "file").select("file", "block", "seq", "ended", "root", "record").mapInArrow(parse, kinds)
    path = scratch_path(spark, "sentences")
    parsed.write.parquet(path)
    rows = spark.read.parquet(path)
    # what follows the last sentence holds the root's end; a file that lacks it is cut off
    closed = rows.where("nth = -1").select("file")
    broken = rows.select("file").join(closed, "file", "left_anti").first()
    if broken is not None:
        raise ValueError(f"{broken.file}: not well-formed: the root has no end")
    rows = rows.where("nth >= 0")
    # places: sentences in earlier splits, then within the split
    sizes = rows.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select("file", "block", before.alias("before"))
    within = F.row_number().over(Window.partitionBy("file", "block").orderBy("seq", "nth"))
    placed = rows.withColumn("within", within).join(offsets, ["file", "block"])
    return placed.select("file", (F.col("before") + F.col("within")).cast("long").alias("sent_pos"), *fields)
