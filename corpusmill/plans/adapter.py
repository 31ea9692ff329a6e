"""Adapter: the driver's ``documents`` table -> corpus ``examples``.

Each document is one corpus file.  Its lines are read in pairs: line 2j-1 is the
sentence, line 2j its translation (empty when the line count is odd), so every line
of every document is used.  Document attributes pick the source: every fifth
document belongs to the dictionary group, the rest to an ePark corpus named after
``source``; ``lang`` is the dialect.  Deterministic variations inject the text traps
(NBSP / ideographic space, decomposed accents, zero-width spaces, U+001C..U+001F),
empty fields, NaN and NULL audio bounds and audio file names that up to three
documents, of different sources, share.  Sentence ids
are positions inside a document (``s1``, ``s2`` ...), so record ids repeat across the
documents of one source, as they do in real corpora.

The same formulas are written in DuckDB SQL in :mod:`corpusmill.plans.oracle`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.text import norm
from corpusmill.operators.examples import DEFAULT_LANGUAGE, EXAMPLE_COLUMNS, with_derived
from corpusmill.operators.examples import default_fill, record_key
from corpusmill.operators.joins import broadcast_if_small, rebalance_small_input, value_bytes
from corpusmill.session import ensure_checkpoint_dir
from corpusmill.sources.registry import (
    DICT_CORPUS,
    DICT_GROUP,
    EPARK_GROUP,
    Host,
    registry_from_corpora,
    with_source_paths,
)

XML_ROOT = "/data/raw/xml"
# A made-up host of the test corpora.
HOST = Host("corpus-org", "https://raw.githubusercontent.com/corpus-org/corpus-org/main/Corpora", "https://huggingface.co/datasets")
GLOTTOCODE = "puyu1239"
COPYRIGHT = "CC BY-NC 4.0"
OPEN_O = "\u0254"
ORDER = ("source_ord", "doc_id", "sent_pos")
NO_NAME = "unnamed"


def documents(spark, sf_dir: str) -> DataFrame:
    """The documents table, spread over all task slots when the scan is small."""
    return rebalance_small_input(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def doc_source(docs: DataFrame) -> DataFrame:
    """Document-level source attributes: group, corpus, dialect.  A null source or lang is
    called ``NO_NAME``, so that its sentences find their registry row."""
    is_dict = F.col("doc_id") % 5 == 0
    return docs.fillna(NO_NAME, ["source", "lang"]).withColumns(
        {
            "group": F.when(is_dict, F.lit(DICT_GROUP)).otherwise(F.lit(EPARK_GROUP)),
            "corpus_slug": F.when(is_dict, F.lit(DICT_CORPUS)).otherwise(F.col("source")),
            "dialect": F.col("lang"),
        }
    )


def registry_from_documents(docs: DataFrame) -> DataFrame:
    """Registry derived from the data: each ePark corpus with its sorted dialects
    (corpora in name order), then one dictionary source per dialect.  Its size is
    the number of distinct (corpus, dialect) pairs, not the number of documents."""
    d = doc_source(docs.select("doc_id", "source", "lang"))
    ep = (
        d.where(F.col("group") == EPARK_GROUP)
        .groupBy("corpus_slug")
        .agg(F.array_sort(F.collect_set("dialect")).alias("dialects"))
    )
    from pyspark.sql import Window

    corpora = ep.select(
        (F.row_number().over(Window.orderBy("corpus_slug")) - 1).cast("int").alias("corpus_ord"),
        "corpus_slug",
        "dialects",
    )
    dictionary = (
        d.where(F.col("group") == DICT_GROUP)
        .select("group", "corpus_slug", "dialect")
        .distinct()
        .select(
            "corpus_slug",
            "dialect",
            registry_path(F.col("group"), F.col("corpus_slug"), F.col("dialect")).alias("xml_relative_path"),
        )
    )
    return registry_from_corpora(corpora, dictionary, org=HOST.org)


# Fixed values of the adapter: the injected characters.
NBSP_GAP = "\u00a0 \u3000"          # NBSP, space, ideographic space
E_ACUTE = "\u00e9"                   # precomposed e-acute
E_DECOMPOSED = "e\u0301"             # e + combining acute
E_SPLIT = "e\u200b\u0301"           # e + zero-width space + combining acute
ZW = "\u200b"
FS, US = "\x1c", "\x1f"             # file separator, unit separator


def registry_from_documents_direct(docs: DataFrame) -> DataFrame:
    """The same registry as :func:`registry_from_documents` (same rows, same
    ``source_ord``) in fewer stages: one ``distinct`` over the document sources and one
    ordinal over that small set (ePark corpora first, by name, then dialect)."""
    from pyspark.sql import Window

    from corpusmill.sources.registry import DICT_AUDIO_MODE, EPARK_AUDIO_MODE

    d = doc_source(docs.select("doc_id", "source", "lang")).select("group", "corpus_slug", "dialect").distinct()
    is_ep = F.col("group") == EPARK_GROUP
    w = Window.orderBy(F.when(is_ep, 0).otherwise(1), "corpus_slug", "dialect")
    return d.select(
        (F.row_number().over(w) - 1).cast("int").alias("source_ord"),
        "group",
        "corpus_slug",
        "dialect",
        registry_path(F.col("group"), F.col("corpus_slug"), F.col("dialect")).alias("xml_relative_path"),
        F.when(is_ep, F.concat(F.lit(f"{HOST.org}/ePark_"), F.col("corpus_slug")))
        .otherwise(F.concat(F.lit(f"{HOST.org}/ILRDF_Dict_"), F.col("corpus_slug")))
        .alias("audio_repo"),
        F.when(is_ep, F.lit(EPARK_AUDIO_MODE)).otherwise(F.lit(DICT_AUDIO_MODE)).alias("audio_mode"),
    )


def _raw(x: Column, k: Column) -> Column:
    m = k % 17
    return (
        F.when(m == 0, F.replace(x, F.lit(" "), F.lit(NBSP_GAP)))
        .when(m == 1, F.replace(x, F.lit(E_ACUTE), F.lit(E_DECOMPOSED)))
        .when(m == 2, F.replace(x, F.lit(E_ACUTE), F.lit(E_SPLIT)))
        .when(m == 3, F.concat(F.lit(ZW), F.replace(x, F.lit(" "), F.lit(FS)), F.lit(US)))
        .otherwise(x)
    )


def _line_pairs(text: Column) -> Column:
    """``[(line1, line2), ...]`` for the lines of ``text`` taken two by two (the
    second of the last pair is NULL when the count is odd).  Built with filters on
    the element index and a zip, so no lambda refers to the whole line array."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n", -1)
    odd = F.filter(lines, lambda x, i: i % 2 == 0)
    even = F.filter(lines, lambda x, i: i % 2 == 1)
    return F.arrays_zip(odd.alias("line1"), even.alias("line2"))


def sentences(docs: DataFrame) -> DataFrame:
    """One row per line pair: ``doc_id, sent_pos, line1, line2`` plus document columns.

    The line array is a column of its own (referenced several times, so the
    optimiser keeps it computed once per document) and the lambda only indexes it."""
    d = doc_source(docs).withColumn("_lines", F.split(F.coalesce(F.col("text"), F.lit("")), "\n", -1))
    lines = F.col("_lines")
    n = F.floor((F.size(lines) + 1) / 2).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(1), n),
        lambda j: F.struct(
            j.alias("sent_pos"),
            F.get(lines, j * 2 - 2).alias("line1"),
            F.coalesce(F.get(lines, j * 2 - 1), F.lit("")).alias("line2"),
        ),
    )
    return d.select("doc_id", "source", "lang", "n_chars", "group", "corpus_slug", "dialect", F.inline(pairs))


def _sentence_fields(doc_id: Column, n_chars: Column, dialect: Column, sent_pos: Column, line1: Column, line2: Column) -> dict:
    """Raw XML-level fields of one sentence (JVM expressions only, so they also work
    inside the higher-order functions that build XML documents)."""
    k = doc_id + sent_pos
    r1 = F.when(k % 23 == 0, F.lit("")).otherwise(_raw(line1, k))
    r2 = _raw(line2, k)
    audio = F.when(k % 7 == 0, F.lit("")).otherwise(
        F.concat(F.lit("a "), ((doc_id - doc_id % 3) * 4096 + sent_pos).cast("string"), F.lit(".wav"))
    )
    return {
        "id_attr": F.concat(F.lit("s"), sent_pos.cast("string")),
        "form_raw": r1,
        "standard_blank": k % 3 == 0,
        "transl_raw": r2,
        "transl_blank": k % 13 == 0,
        "phon_blank": k % 4 == 0,
        "std_phon_blank": k % 2 == 0,
        "audio_file_attr": audio,
        "audio_url_attr": F.when(audio == "", F.lit("")).otherwise(
            F.concat(F.lit("https://audio.example.org/"), dialect, F.lit("/"), audio)
        ),
        "audio_start": F.when(k % 11 == 0, F.lit(None).cast("double")).otherwise((k % 10).cast("double") * F.lit(0.5)),
        "audio_end": F.when(k % 19 == 0, F.lit(float("nan"))).otherwise(
            (n_chars % 7919).cast("double") / F.lit(1000.0) + sent_pos.cast("double") * F.lit(0.25)
        ),
    }


def _doc_fields() -> dict:
    return {
        "lang_attr": F.when(F.col("doc_id") % 9 == 0, F.lit("")).otherwise(F.col("lang")),
        "audio_attr": F.when(F.col("doc_id") % 6 == 0, F.lit("segmented")).otherwise(F.lit("")),
        "source_attr": F.col("source"),
        "citation_attr": F.concat(F.lit("Corpus "), F.col("source"), F.lit(" document "), F.col("doc_id").cast("string")),
    }


def raw_examples(docs: DataFrame) -> DataFrame:
    """Sentence rows with the raw (pre-normalisation) XML-level fields."""
    s = sentences(docs)
    fields = _sentence_fields(F.col("doc_id"), F.col("n_chars"), F.col("dialect"), F.col("sent_pos"), F.col("line1"), F.col("line2"))
    return s.select(
        "doc_id",
        F.col("sent_pos").cast("long").alias("sent_pos"),
        "group",
        "corpus_slug",
        "dialect",
        *[c.alias(n) for n, c in _doc_fields().items()],
        *[c.alias(n) for n, c in fields.items()],
    )


def registry_path(group: Column, corpus_slug: Column, dialect: Column) -> Column:
    """Registry XML path of a document's source (same rule as the derived registry)."""
    return F.when(
        group == EPARK_GROUP,
        F.concat(F.lit("ePark/XML/"), corpus_slug, F.lit("/Puyuma/"), dialect, F.lit("_Puyuma.xml")),
    ).otherwise(F.concat(F.lit("ILRDF_Dicts/XML/"), corpus_slug, F.lit("/"), dialect, F.lit("/"), corpus_slug, F.lit(".xml")))


def _xml_escape(x: Column) -> Column:
    # XML 1.0 cannot carry C0 controls other than tab, LF and CR; the ones the adapter
    # injects are whitespace, so a space keeps the normalised text unchanged.
    x = F.regexp_replace(x, "[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f]", " ")
    for old, new in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        x = F.replace(x, F.lit(old), F.lit(new))
    return x


def _attr(name: str, value: Column) -> Column:
    return F.when(value == "", F.lit("")).otherwise(F.concat(F.lit(f' {name}="'), _xml_escape(value), F.lit('"')))


def _elem(tag: str, attrs: str, text: Column, blank: Column | None = None) -> Column:
    body = F.concat(F.lit(f"<{tag} {attrs}>"), _xml_escape(text), F.lit(f"</{tag}>"))
    return body if blank is None else F.when(blank, F.lit("")).otherwise(body)


def xml_files_from_documents(docs: DataFrame) -> DataFrame:
    """One XML corpus part per document: ``(rel_path, content)``.  A source is a
    folder of parts named after its registry path; parts are numbered by doc id."""
    d = doc_source(docs)

    def sentence_xml(p: Column, i: Column) -> Column:
        l1 = p.getField("line1")
        l2 = F.coalesce(p.getField("line2"), F.lit(""))
        f = _sentence_fields(F.col("doc_id"), F.col("n_chars"), F.col("dialect"), (i + 1).cast("long"), l1, l2)
        std = F.lower(f["form_raw"])
        audio_attrs = F.concat(
            _attr("file", f["audio_file_attr"]),
            _attr("url", f["audio_url_attr"]),
            F.coalesce(F.concat(F.lit(' start="'), f["audio_start"].cast("string"), F.lit('"')), F.lit("")),
            F.coalesce(F.concat(F.lit(' end="'), f["audio_end"].cast("string"), F.lit('"')), F.lit("")),
        )
        return F.concat(
            F.lit("<S"),
            _attr("id", f["id_attr"]),
            F.lit(">"),
            _elem("FORM", 'kindOf="original"', f["form_raw"]),
            _elem("FORM", 'kindOf="standard"', std, f["standard_blank"]),
            _elem("PHON", 'kindOf="original"', F.replace(f["form_raw"], F.lit("o"), F.lit(OPEN_O)), f["phon_blank"]),
            _elem("PHON", 'kindOf="standard"', F.replace(std, F.lit("o"), F.lit(OPEN_O)),
                  f["standard_blank"] | f["std_phon_blank"]),
            _elem("TRANSL", 'xml:lang="zho"', f["transl_raw"], f["transl_blank"]),
            F.concat(F.lit("<AUDIO"), audio_attrs, F.lit("/>")),
            F.lit("</S>"),
        )

    df = _doc_fields()
    root = F.concat(
        F.lit('<?xml version="1.0" encoding="UTF-8"?>\n<corpus'),
        _attr("xml:lang", df["lang_attr"]),
        _attr("source", df["source_attr"]),
        _attr("citation", df["citation_attr"]),
        _attr("copyright", F.lit(COPYRIGHT)),
        _attr("glottocode", F.lit(GLOTTOCODE)),
        _attr("audio", df["audio_attr"]),
        F.lit(">"),
    )
    body = F.array_join(F.transform(_line_pairs(F.col("text")), sentence_xml), "")
    return d.select(
        "doc_id",
        F.concat(
            registry_path(F.col("group"), F.col("corpus_slug"), F.col("dialect")),
            F.lit("/part-"),
            F.lpad(F.col("doc_id").cast("string"), F.greatest(F.lit(12), F.length(F.col("doc_id").cast("string"))), F.lit("0")),
            F.lit(".xml"),
        ).alias("rel_path"),
        F.concat(root, body, F.lit("</corpus>")).alias("content"),
    )


def write_large_xml(docs: DataFrame, path: str) -> None:
    """XML files of many documents each: every task writes one file, a root with the
    sentences of all its documents."""
    body = F.regexp_extract("content", r"(?s)<corpus[^>]*>(.*)</corpus>$", 1)
    lines = xml_files_from_documents(docs).select(body.alias("line"))
    head = f'<?xml version="1.0" encoding="UTF-8"?>\n<corpus xml:lang="mul" source="all" glottocode="{GLOTTOCODE}">'

    def framed(batches):
        import pyarrow as pa

        def single(text):
            return pa.RecordBatch.from_pydict({"line": pa.array([text], pa.string())})

        yield single(head)
        yield from batches
        yield single("</corpus>")

    lines.mapInArrow(framed, "line string").write.text(path)


def computed_once(df: DataFrame, *names: str) -> DataFrame:
    """``df`` with the columns ``names`` put through a one-row generator: an expression
    behind it is evaluated once, however often and wherever it is used above."""
    rest = [c for c in df.columns if c not in names]
    return df.select(*rest, F.inline(F.array(F.struct(*names))))


def examples_from_documents(
    docs: DataFrame, registry: DataFrame | None = None, *, registry_bytes: int | None = None, texts: bool = False
) -> DataFrame:
    """The ``examples`` table (28 columns) plus order keys ``source_ord, doc_id, sent_pos``.
    ``texts``: the normalised texts are used several times, so they are fixed; otherwise
    the optimiser may drop them."""
    if registry is None:
        registry = registry_from_documents_direct(docs)
    reg = broadcast_if_small(
        with_source_paths(registry, HOST).select(
            "source_ord", "group", "corpus_slug", "dialect", "xml_relative_path", "xml_url", "source_key",
            F.col("audio_mode").alias("reg_audio_mode"),
        ),
        size=registry_bytes,
    )
    raw = raw_examples(docs).join(reg, ["group", "corpus_slug", "dialect"])
    form = norm(F.col("form_raw"))
    ex = raw.select(
        F.col("source_ord").cast("long").alias("source_ord"),
        "doc_id",
        "sent_pos",
        record_key(F.col("source_key"), F.col("id_attr")).alias("record_id"),
        "source_key",
        "group",
        "corpus_slug",
        "dialect",
        default_fill(F.col("lang_attr"), DEFAULT_LANGUAGE).alias("language_code"),
        default_fill(F.col("audio_attr"), F.col("reg_audio_mode")).alias("audio_mode"),
        F.col("xml_url").alias("xml_source_url"),
        F.concat(F.lit(XML_ROOT + "/"), F.col("xml_relative_path")).alias("xml_path"),
        F.col("citation_attr").alias("citation"),
        F.lit(COPYRIGHT).alias("copyright"),
        F.lit("").alias("bibtex_citation"),
        F.col("source_attr").alias("root_source_label"),
        F.lit(GLOTTOCODE).alias("root_glottocode"),
        F.col("id_attr").alias("sentence_id"),
        form.alias("original_form"),
        F.col("standard_blank"),
        F.col("phon_blank"),
        F.col("std_phon_blank"),
        F.when(F.col("transl_blank"), F.lit("")).otherwise(norm(F.col("transl_raw"))).alias("translation_zh"),
        F.col("audio_file_attr").alias("audio_file"),
        F.col("audio_url_attr").alias("audio_url"),
        "audio_start",
        "audio_end",
    )
    if texts:
        ex = computed_once(ex, "original_form", "translation_zh")
    ex = ex.withColumn(
        "standard_form", F.when(F.col("standard_blank"), F.lit("")).otherwise(F.lower(F.col("original_form")))
    )
    ex = ex.withColumns(
        {
            "original_phonetic": F.when(F.col("phon_blank"), F.lit("")).otherwise(
                F.replace(F.col("original_form"), F.lit("o"), F.lit(OPEN_O))
            ),
            "standard_phonetic": F.when(F.col("std_phon_blank"), F.lit("")).otherwise(
                F.replace(F.col("standard_form"), F.lit("o"), F.lit(OPEN_O))
            ),
        }
    )
    return with_derived(ex).select(*EXAMPLE_COLUMNS, *ORDER)


_REGISTRIES: dict[tuple[str, str], tuple[DataFrame, int]] = {}


def load_registry(spark, sf_dir: str) -> tuple[DataFrame, int]:
    """The registry of a table and its size in bytes, worked out once per application
    and path (a few rows, kept as a checkpoint in the shared folder)."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _REGISTRIES:
        ensure_checkpoint_dir(spark)
        reg = registry_from_documents_direct(documents(spark, sf_dir)).checkpoint(eager=True)
        _REGISTRIES[key] = reg, value_bytes(reg)
    return _REGISTRIES[key]


def load_examples(spark, sf_dir: str, *, texts: bool = False) -> DataFrame:
    registry, size = load_registry(spark, sf_dir)
    return examples_from_documents(documents(spark, sf_dir), registry, registry_bytes=size, texts=texts)
