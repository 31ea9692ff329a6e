"""Translation and speech (TTS) manifests: first-wins dedupe, then filter, then a
fixed projection.  The order dedupe -> filter is part of the semantics: for TTS,
if the first row of an audio file has empty text the file disappears."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.operators.dedupe import dedupe_first, translation_key, tts_key

TRANSLATION_COLUMNS = (
    "record_id",
    "source_key",
    "group",
    "corpus_slug",
    "dialect",
    "language_code",
    "source_text",
    "source_phonetic",
    "target_text",
    "translation_zh",
    "audio_file",
    "audio_url",
    "audio_start",
    "audio_end",
    "duration_seconds",
    "xml_path",
    "xml_source_url",
    "citation",
    "copyright",
    "bibtex_citation",
)

TTS_COLUMNS = (
    "record_id",
    "source_key",
    "group",
    "corpus_slug",
    "dialect",
    "language_code",
    "text",
    "phonetic",
    "normalized_text",
    "audio_file",
    "audio_url",
    "audio_start",
    "audio_end",
    "duration_seconds",
    "xml_path",
    "xml_source_url",
    "citation",
    "copyright",
    "bibtex_citation",
)


def translation_projection(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in TRANSLATION_COLUMNS], *keep)


def tts_projection(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    renamed = {"text": "source_text", "phonetic": "source_phonetic", "normalized_text": "source_text"}
    return df.select(*[F.col(f"`{renamed.get(c, c)}`").alias(c) for c in TTS_COLUMNS], *keep)


def translation_manifest(
    examples: DataFrame, order: Sequence[str] | str, *, dedupe: bool = True, keep: Sequence[str] = ()
) -> DataFrame:
    """Rows with non-empty source and target text, first-wins deduped on the normalised
    text pair.  The key holds both texts, so rows of one key are empty or not together
    and the filter may come first; only the manifest's columns cross the exchange."""
    orders = [order] if isinstance(order, str) else list(order)
    extra = [c for c in orders if c not in keep]
    rows = examples.filter((F.col("target_text") != "") & (F.col("source_text") != ""))
    rows = translation_projection(rows, [*keep, *(extra if dedupe else ())])
    rows = dedupe_first(rows, translation_key(), order) if dedupe else rows
    return rows.drop(*extra)


def tts_manifest(
    examples: DataFrame, order: Sequence[str] | str, *, dedupe: bool = True, keep: Sequence[str] = ()
) -> DataFrame:
    """Rows with an audio file and non-empty text, first-wins deduped on the audio
    file name (or record id when there is none); dedupe first, then filter."""
    orders = [order] if isinstance(order, str) else list(order)
    extra = [c for c in orders if c not in keep]
    rows = tts_projection(examples, [*keep, *(extra if dedupe else ())])
    rows = dedupe_first(rows, tts_key(), order) if dedupe else rows
    return rows.filter((F.col("audio_file") != "") & (F.col("text") != "")).drop(*extra)
