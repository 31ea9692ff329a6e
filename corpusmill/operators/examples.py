"""The ``examples`` table: one row per sentence, 24 stored + 4 derived columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.text import duration, norm, safe_float

STRING_FIELDS = (
    "record_id",
    "source_key",
    "group",
    "corpus_slug",
    "dialect",
    "language_code",
    "audio_mode",
    "xml_source_url",
    "xml_path",
    "citation",
    "copyright",
    "bibtex_citation",
    "root_source_label",
    "root_glottocode",
    "sentence_id",
    "original_form",
    "standard_form",
    "original_phonetic",
    "standard_phonetic",
    "translation_zh",
    "audio_file",
    "audio_url",
)
FLOAT_FIELDS = ("audio_start", "audio_end")
STORED_FIELDS = STRING_FIELDS + FLOAT_FIELDS
DERIVED_FIELDS = ("source_text", "source_phonetic", "target_text", "duration_seconds")
EXAMPLE_COLUMNS = STORED_FIELDS + DERIVED_FIELDS

# Fixed value: language code used when the corpus root carries no xml:lang.
DEFAULT_LANGUAGE = "pyu"


def prefer(primary: Column | str, fallback: Column | str) -> Column:
    """``primary or fallback`` for non-null strings: empty falls back."""
    p = F.col(primary) if isinstance(primary, str) else primary
    f = F.col(fallback) if isinstance(fallback, str) else fallback
    return F.coalesce(F.nullif(p, F.lit("")), f)


def default_fill(value: Column, fallback: Column | str) -> Column:
    """Normalised value, or ``fallback`` when it normalises to empty."""
    fb = F.lit(fallback) if isinstance(fallback, str) else fallback
    return F.coalesce(F.nullif(norm(value), F.lit("")), fb)


def record_key(source_key: Column, sentence_id: Column) -> Column:
    """``source_key:sentence_id``; not unique when sentence ids repeat or are blank."""
    return F.concat(source_key, F.lit(":"), sentence_id)


def with_derived(df: DataFrame) -> DataFrame:
    """Add ``source_text``, ``source_phonetic``, ``target_text``, ``duration_seconds``."""
    return df.withColumns(
        {
            "source_text": prefer("standard_form", "original_form"),
            "source_phonetic": prefer("standard_phonetic", "original_phonetic"),
            "target_text": F.col("translation_zh"),
            "duration_seconds": duration("audio_start", "audio_end"),
        }
    )


def record_coerce(df: DataFrame, *, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rebuild typed records from loose rows (e.g. a JSONL manifest).

    Strings: missing column or NULL -> ""; other types are cast to string.
    ``audio_start``/``audio_end``: doubles pass through, anything else goes through
    :func:`safe_float`.  Derived columns are recomputed."""
    cols = set(df.columns)
    types = dict(df.dtypes)
    out = []
    for name in STRING_FIELDS:
        if name in cols:
            out.append(F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("")).alias(name))
        else:
            out.append(F.lit("").alias(name))
    for name in FLOAT_FIELDS:
        if name not in cols:
            out.append(F.lit(None).cast("double").alias(name))
        elif types[name] in ("double", "float"):
            out.append(F.col(name).cast("double").alias(name))
        else:
            out.append(safe_float(F.col(name)).alias(name))
    return with_derived(df.select(*out, *keep))
