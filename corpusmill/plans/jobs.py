"""Composite jobs: the reference's commands as functions over a session.

``extract``      XML corpus folder -> examples, manifests, splits, summary
``split``        JSONL manifest -> one JSONL folder per split (unknown keys kept)
``stats``        JSONL manifest -> totals + facets (+ markdown)
``prepare_tts``  JSONL manifest + audio folder -> LJSpeech metadata + audio files
``plan_downloads`` registry + records + file inventory -> files still to fetch

Roots may be relative, absolute or URIs; files are matched by their place below the root.
Manifests are written in corpus order (the part files by name, the lines within them) and
read back in it.  Intermediate results with several readers are Parquet in the output
folder, so a lost executor never forces a recomputation from the XML.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions.text import row_text
from corpusmill.operators import manifest as M
from corpusmill.operators import speech as SP
from corpusmill.operators import split as S
from corpusmill.operators import summary as A
from corpusmill.operators.dedupe import PAIR_SEPARATOR
from corpusmill.session import scratch_path
from corpusmill.sinks import writers as W
from corpusmill.sinks.named_files import write_named_files
from corpusmill.sources import jsonl as J
from corpusmill.sources import registry as R
from corpusmill.sources import xml as X
from corpusmill.sources import xml_split as XS
from corpusmill.sources.files import check_scheme, file_inventory, make_dir, qualified

ORDER = ["source_ord", "file_path", "sent_pos"]


@dataclass
class ExtractResult:
    examples: DataFrame
    translation: DataFrame
    tts: DataFrame
    totals: DataFrame
    facets: DataFrame


def _stored(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def extract(
    spark: SparkSession,
    xml_root: str,
    output_dir: str,
    host: R.Host,
    *,
    registry: DataFrame | None = None,
    limit: int | None = None,
    train_ratio: float = 0.9,
    valid_ratio: float = 0.05,
    no_dedupe: bool = False,
    whole_bytes: int = 256 << 20,
) -> ExtractResult:
    """Parse every registry source (the first ``limit`` of them) present under
    ``xml_root`` and write ``examples/``, ``translation/split=*``, ``tts/split=*``,
    ``translation_all/``, ``tts_all/`` (JSONL, in corpus order) and ``summary.md`` below
    ``output_dir``; ``_work/`` holds the same as Parquet.  An XML file of more than
    ``whole_bytes`` is read by several tasks (it must be UTF-8 without a document type)."""
    S.check_ratios(train_ratio, valid_ratio)
    out = output_dir.rstrip("/")
    reg = registry if registry is not None else R.supported_sources(spark, org=host.org)
    files = X.read_xml_files(spark, xml_root, max_bytes=whole_bytes)
    large = XS.large_files(spark, xml_root, whole_bytes)
    examples = _stored(X.load_corpus(files, R.first_sources(reg, limit), host, xml_root=xml_root, sentences=large), f"{out}/_work/examples")
    W.write_jsonl(examples.orderBy(*ORDER).drop(*ORDER), f"{out}/examples")
    split = {}
    for name, build, deal in (("translation", M.translation_manifest, S.split_translation), ("tts", M.tts_manifest, S.split_tts)):
        rows = deal(build(examples, ORDER, dedupe=not no_dedupe, keep=tuple(ORDER)), train_ratio, valid_ratio)
        split[name] = _stored(rows.orderBy(*ORDER), f"{out}/_work/{name}")
        W.write_split_manifests(split[name], f"{out}/{name}", order=ORDER)
        W.write_jsonl(split[name].orderBy(*ORDER).drop("split", *ORDER), f"{out}/{name}_all")
    totals, facets = A.summary_totals(examples), A.summary_facets(examples)
    W.write_lines(A.summary_markdown(totals, facets), f"{out}/summary.md")
    return ExtractResult(examples, split["translation"].drop("split"), split["tts"].drop("split"), totals, facets)


def split(
    spark: SparkSession,
    input_path: str,
    output_dir: str,
    *,
    mode: str = "translation",
    train_ratio: float = 0.9,
    valid_ratio: float = 0.05,
) -> DataFrame:
    """Split a JSONL manifest by content hash.  Lines pass through unchanged, in order
    (any keys survive); blank lines are skipped, a malformed one is an error.  Every
    split has a folder.  Returns split counts (all three names, zero when empty)."""
    S.check_ratios(train_ratio, valid_ratio)

    def field(name: str):
        return row_text(J.field_text(name))

    if mode == "translation":
        key = F.concat(field("source_text"), F.lit(PAIR_SEPARATOR), field("target_text"))
    elif mode == "tts":
        key = F.coalesce(F.nullif(field("audio_file"), F.lit("")), field("record_id"))
    else:
        raise ValueError(f"unknown mode {mode!r}")
    target = f"{output_dir.rstrip('/')}/{mode}"
    # ranged first: the ranges are found by reading once more, which then parses nothing
    ranged = J.ordered_lines(spark, input_path).repartitionByRange("line_ord")
    out = J.parsed_lines(ranged).select("value", "line_ord", S.split_column(key, train_ratio, valid_ratio).alias("split"))
    out.sortWithinPartitions("split", "line_ord").select("value", "split").write.mode("overwrite").partitionBy("split").text(target)
    for name in S.SPLITS:
        make_dir(spark, f"{target}/split={name}")
    return A.split_counts(spark.read.schema("value string, split string").option("basePath", target).text(target))


def stats(spark: SparkSession, input_path: str, markdown_path: str | None = None):
    """Totals and facet counts of a JSONL manifest with the ``stats`` rules; the markdown
    lists keys in order of first appearance and the duration unrounded."""
    totals, facets = A.stats_lines(J.read_lines(spark, input_path), scratch_path(spark, "stats-lines"))
    if markdown_path:
        W.write_lines(A.summary_markdown(totals, facets, first_seen=True), markdown_path)
    return totals, facets


def prepare_tts(
    spark: SparkSession,
    manifest: DataFrame,
    audio_root: str,
    output_dir: str,
    *,
    order: list[str] | str,
    strict: bool = True,
) -> DataFrame:
    """LJSpeech layout: ``metadata`` (``audio_file|text|normalized_text`` CSV) and
    the audio files ``wavs/<audio_file>``; those there already stay.  ``strict`` raises when a referenced
    audio file is missing, like the reference; otherwise missing files are only
    reported.  Returns the missing-audio report."""
    from corpusmill.operators.modeldata import require_rows

    require_rows(manifest, "TTS manifest")
    out = output_dir.rstrip("/")
    check_scheme(qualified(spark, audio_root))
    check_scheme(qualified(spark, out))
    inv = file_inventory(spark, audio_root)
    rows = _stored(SP.ljspeech_rows(manifest, order, keep=("source_key", "dialect")), f"{out}/_work/rows")
    missing = SP.audio_missing(rows, inv, audio_root)
    names = [order] if isinstance(order, str) else list(order)
    first = missing.orderBy(*names).select("problem").first() if strict else None
    if first is not None:
        raise FileNotFoundError(first.problem)
    W.write_ljspeech_metadata(rows.orderBy(*names), f"{out}/metadata")
    wavs = f"{out}/wavs"
    make_dir(spark, wavs)
    present = file_inventory(spark, wavs).select(F.col("rel_path").alias("audio_file"))
    wanted = SP.wanted_audio(rows, audio_root, present)
    found = wanted.join(inv.select(F.col("path").alias("audio_path"), "uri"), "audio_path")
    write_named_files(found.select(F.col("audio_file").alias("name"), "uri"), wavs)
    return missing


def plan_downloads(
    spark: SparkSession,
    records: DataFrame,
    xml_root: str,
    audio_root: str,
    host: R.Host,
    *,
    registry: DataFrame | None = None,
    download_audio: bool = False,
    overwrite: bool = False,
    limit: int | None = None,
) -> DataFrame:
    """Files still to fetch (``kind, url, dest``) given what is on disk; the byte
    transfer itself is left to a download tool."""
    reg = registry if registry is not None else R.supported_sources(spark, org=host.org)
    inv = file_inventory(spark, xml_root).unionByName(file_inventory(spark, audio_root)).select("path", "length")
    return SP.download_plan(reg, records, host, inv, xml_root=xml_root, audio_root=audio_root,
                            download_audio=download_audio, overwrite=overwrite, limit=limit)
