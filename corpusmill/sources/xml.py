"""XML corpus reader.

A corpus file is one XML document: root attributes carry corpus metadata, each
direct ``S`` child is one sentence with ``FORM`` / ``PHON`` (by ``kindOf``),
``TRANSL`` (by ``xml:lang``) and ``AUDIO`` children.  Files are read with the
``binaryFile`` source (or come as any DataFrame of ``(rel_path, content)`` rows) and
parsed by the standard library's incremental parser inside Arrow batches, so element
text, entities, comments and declared encodings are exactly the parser's.  A broken file
fails the job.  Nested elements such as ``W/FORM`` or ``X/S`` are not children and are
passed over.
"""

from __future__ import annotations

import io
import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.functions.text import ZWSP, norm, safe_float
from corpusmill.operators.examples import DEFAULT_LANGUAGE, EXAMPLE_COLUMNS, default_fill, record_key, with_derived
from corpusmill.operators.joins import broadcast_if_small
from corpusmill.sources.files import below
from corpusmill.sources.registry import Host, local_xml_path, with_source_paths

# Fixed value: the attribute xml:lang as the standard parser names it.
XML_LANG = "{http://www.w3.org/XML/1998/namespace}lang"

ROOT_FIELDS = ("root_source_label", "citation", "copyright", "bibtex_citation", "root_glottocode", "root_audio_mode", "language_code")
_ROOT_ATTRS = ("source", "citation", "copyright", "BibTeX_citation", "glottocode", "audio", XML_LANG)
SENTENCE_FIELDS = (
    "sentence_id", "original_form", "standard_form", "original_phonetic", "standard_phonetic", "translation_zh",
    "audio_file", "audio_url", "audio_start", "audio_end",
)
#: (tag, attribute, value): the child whose text a field takes.
_PICKED = (
    ("FORM", "kindOf", "original"), ("FORM", "kindOf", "standard"), ("PHON", "kindOf", "original"), ("PHON", "kindOf", "standard"),
    ("TRANSL", XML_LANG, "zho"),
)
_ROWS = 4096


def _same(attribute: str | None, value: str) -> bool:
    """Is the normalised attribute ``value``?  (NFC maps nothing else to ASCII letters.)"""
    return " ".join((attribute or "").replace(ZWSP, "").split()) == value


def picked_text(sentence: ET.Element, tag: str, attribute: str, value: str) -> str | None:
    """Text before the first child element of the first ``tag`` child whose attribute is
    ``value``, even if empty; None if there is none."""
    return next((c.text for c in sentence if c.tag == tag and _same(c.get(attribute), value)), None)


def sentence_fields(sentence: ET.Element) -> list[str | None]:
    audio = next((c.attrib for c in sentence if c.tag == "AUDIO"), {})
    texts = [picked_text(sentence, *p) for p in _PICKED]
    return [sentence.get("id"), *texts, *(audio.get(k) for k in ("file", "url", "start", "end"))]


def sentences_of(content: bytes | str) -> Iterator[list[str | None]]:
    """Raw fields of every ``S`` that is a child of the root, in document order, with the
    root's attributes before them.  The declared encoding holds for bytes.  Sentences are
    dropped once read, so memory holds one of them and the file's bytes."""
    if isinstance(content, str):
        source, parser = io.BytesIO(content.encode("utf-8")), ET.XMLParser(encoding="utf-8")
    else:
        source, parser = io.BytesIO(content), None
    depth, root = 0, None
    for event, element in ET.iterparse(source, events=("start", "end"), parser=parser):
        if event == "start":
            depth += 1
            root = element if root is None else root
            continue
        depth -= 1
        if depth == 1:
            if element.tag == "S":
                yield [*(root.get(k) for k in _ROOT_ATTRS), *sentence_fields(element)]
            del root[:]


def read_sentences(files: DataFrame, keep: tuple[str, ...] = (), content: str = "content") -> DataFrame:
    """One row per sentence of each file (``content``: bytes or text), with the file's
    ``keep`` columns, ``sent_pos`` (from 1) and the raw fields.  A file that is not
    well-formed fails the job; it is never silently dropped."""
    slim = files.select(*keep, F.col(content).alias("content"))
    names = [*keep, "sent_pos", *ROOT_FIELDS, *SENTENCE_FIELDS]
    schema = T.StructType([slim.schema[c] for c in keep] + [T.StructField("sent_pos", T.LongType())] + [T.StructField(n, T.StringType()) for n in names[len(keep) + 1 :]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kinds = [b.schema.field(c).type for c in keep] + [pa.int64()] + [pa.string()] * (len(names) - len(keep) - 1)
            rows: list[tuple] = []

            def batch() -> pa.RecordBatch:
                cols = list(zip(*rows, strict=True)) or [()] * len(names)
                rows.clear()
                return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)

            for i in range(b.num_rows):
                own = [b.column(c)[i].as_py() for c in keep]
                for pos, fields in enumerate(sentences_of(b.column("content")[i].as_py()), start=1):
                    rows.append((*own, pos, *fields))
                    if len(rows) >= _ROWS:
                        yield batch()
            yield batch()

    return slim.mapInArrow(run, schema)


def extract_sentences(files: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per direct ``S`` child: root attributes and sentence fields, normalised,
    and ``sent_pos`` (document order)."""
    return normalised(read_sentences(files, keep), keep)


def normalised(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Raw sentence rows with the fields' values as the corpus means them."""
    texts = [n for n in (*ROOT_FIELDS, *SENTENCE_FIELDS) if n not in ("language_code", "audio_start", "audio_end")]
    return raw.select(
        *keep,
        "sent_pos",
        *[norm(F.col(n)).alias(n) for n in texts],
        default_fill(F.col("language_code"), DEFAULT_LANGUAGE).alias("language_code"),
        safe_float(F.col("audio_start")).alias("audio_start"),
        safe_float(F.col("audio_end")).alias("audio_end"),
    )


def read_xml_files(spark: SparkSession, xml_root: str, pattern: str = "*.xml", max_bytes: int | None = None) -> DataFrame:
    """``(path, rel_path, content)`` for every XML file under ``xml_root`` (recursive) of at
    most ``max_bytes``.  A file is one row, so it may hold 2 GB at most (``binaryFile``'s
    limit, an error beyond); :func:`xml_split.large_files` reads larger ones."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(xml_root)
    )
    if max_bytes is not None:
        files = files.where(F.col("length") <= max_bytes)  # pushed down: larger files are not opened
    files = files.select("path", "content")
    return files.withColumn("rel_path", below(spark, xml_root, F.col("path")))


def source_path_of(rel_path: Column) -> Column:
    """The registry path a file belongs to: the file itself, or, for a corpus stored
    as a folder of parts (``.../Nanwang_Puyuma.xml/part-0001.xml``), the folder."""
    return F.regexp_replace(rel_path, r"/part-[^/]*$", "")


def load_corpus(
    files: DataFrame, registry: DataFrame, host: Host, *, xml_root: str = "data/raw/xml", registry_bytes: int | None = None,
    sentences: DataFrame | None = None,
) -> DataFrame:
    """Examples of every registry source whose XML is present (absent ones are
    skipped: inner join).  Order keys: ``source_ord``, ``file_path``, ``sent_pos``.
    ``sentences``: raw rows (``rel_path``, ``sent_pos``, fields) of further files.

    The registry is broadcast after a check of its size; per-file rows are joined to
    it before the sentences are exploded, so the join touches one row per file."""
    reg = broadcast_if_small(
        with_source_paths(registry, host).select(
            "source_ord", "group", "corpus_slug", "dialect", "xml_relative_path", "xml_url", "source_key",
            F.col("audio_mode").alias("reg_audio_mode"),
        ),
        size=registry_bytes,
    )
    f = files.withColumn("xml_relative_path", source_path_of(F.col("rel_path")))
    joined = f.join(reg, "xml_relative_path")
    keep = (
        "source_ord", "group", "corpus_slug", "dialect", "source_key", "xml_url", "xml_relative_path",
        "reg_audio_mode", "rel_path",
    )
    sent = extract_sentences(joined, keep=keep)
    if sentences is not None:  # of files that were read in pieces
        raw = sentences.withColumn("xml_relative_path", source_path_of(F.col("rel_path"))).join(reg, "xml_relative_path")
        sent = sent.unionByName(normalised(raw, keep))
    out = sent.select(
        "*",
        record_key(F.col("source_key"), F.col("sentence_id")).alias("record_id"),
        default_fill(F.col("root_audio_mode"), F.col("reg_audio_mode")).alias("audio_mode"),
        F.col("xml_url").alias("xml_source_url"),
        local_xml_path(xml_root, F.col("xml_relative_path")).alias("xml_path"),
    )
    return with_derived(out).select(
        *EXAMPLE_COLUMNS, F.col("source_ord").cast("long").alias("source_ord"), F.col("rel_path").alias("file_path"), "sent_pos"
    )
