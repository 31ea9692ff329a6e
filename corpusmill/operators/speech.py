"""Speech datasets: audio path resolution, missing-audio report, LJSpeech
metadata, audio materialisation and the download plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.text import row_text
from corpusmill.operators.dedupe import dedupe_first
from corpusmill.operators.joins import broadcast_if_small
from corpusmill.sources.registry import (
    DICT_AUDIO_REPO_NAME,
    DICT_CORPUS,
    DICT_GROUP,
    EPARK_GROUP,
    LANGUAGE_DIR,
    Host,
    audio_url,
    first_sources,
    local_audio_dir,
    local_xml_path,
    with_source_paths,
)


def _opt(df: DataFrame, name: str) -> Column:
    return F.col(f"`{name}`") if name in df.columns else F.lit(None).cast("string")


def resolve_audio_path(df: DataFrame, audio_root: str) -> DataFrame:
    """Add ``audio_path`` (local file of the row's audio) and ``problem``.

    ``source_key`` must split into three parts on ``/``; the repository folder is the
    dictionary's for the dictionary corpus, else ``ePark_{corpus}``; ePark audio sits
    in a per-dialect folder named from the row's ``dialect`` column."""
    sk = F.coalesce(_opt(df, "source_key").cast("string"), F.lit(""))
    parts = F.split(sk, "/", 3)
    group, corpus = F.get(parts, 0), F.get(parts, 1)
    dialect = F.coalesce(_opt(df, "dialect").cast("string"), F.lit(""))
    afile = F.coalesce(_opt(df, "audio_file").cast("string"), F.lit(""))
    slug = F.when((group == DICT_GROUP) & (corpus == DICT_CORPUS), F.lit(DICT_AUDIO_REPO_NAME)).otherwise(
        F.concat(F.lit("ePark_"), corpus)
    )
    nested = F.concat(F.lit(f"/{LANGUAGE_DIR}/"), dialect, F.lit(f"_{LANGUAGE_DIR}"))
    path = F.concat(
        F.lit(audio_root.rstrip("/") + "/"), slug, F.when(group == EPARK_GROUP, nested).otherwise(F.lit("")), F.lit("/"), afile
    )
    problem = (
        F.when(sk == "", F.lit("Row is missing source_key"))
        .when(F.size(parts) < 3, F.lit("source_key has fewer than three parts"))
    )
    return df.withColumns({"audio_path": F.when(problem.isNull(), path), "problem": problem})


def audio_missing(rows: DataFrame, inventory: DataFrame, audio_root: str) -> DataFrame:
    """Rows whose audio file is absent from the inventory (``path`` column), or whose
    path cannot be resolved.

    One pass over the rows: a left outer join with the distinct inventory paths, then
    a filter on "no match or no path".  The inventory side has one row per path; a
    path referenced by very many rows is a skewed partition of the row side, which
    adaptive execution splits (skew-join handling covers left outer joins)."""
    r = resolve_audio_path(rows, audio_root)
    inv = inventory.select(F.col("path").alias("audio_path")).distinct().withColumn("_present", F.lit(True))
    j = r.join(inv, "audio_path", "left")
    out = j.where(F.col("problem").isNotNull() | F.col("_present").isNull())
    return out.withColumn(
        "problem", F.coalesce(F.col("problem"), F.concat(F.lit("Missing audio file: "), F.col("audio_path")))
    ).drop("_present")


def ljspeech_rows(
    rows: DataFrame,
    order: list[str] | str,
    *,
    text_field: str = "text",
    normalized_text_field: str = "normalized_text",
    audio_file_field: str = "audio_file",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """LJSpeech metadata rows: skip rows without an audio file (NULL counts as
    empty), keep the first row per exact file name, re-normalise the texts.  When
    the normalized-text column is absent the text is used; a NULL value gives ""."""
    a = F.coalesce(F.col(f"`{audio_file_field}`").cast("string"), F.lit(""))
    kept = dedupe_first(rows.withColumn("_audio", a).where(F.col("_audio") != ""), F.col("_audio"), order)
    text = row_text(_opt(kept, text_field))
    ntext = row_text(F.col(f"`{normalized_text_field}`")) if normalized_text_field in kept.columns else text
    ords = [order] if isinstance(order, str) else list(order)
    return kept.select(F.col("_audio").alias("audio_file"), text.alias("text"), ntext.alias("normalized_text"), *ords, *keep)


def ljspeech_counts(rows: DataFrame, audio_file_field: str = "audio_file") -> DataFrame:
    """Input row count and materialised (first per non-empty audio file) row count,
    in one pass: counts per file name, then a global sum."""
    a = F.coalesce(F.col(f"`{audio_file_field}`").cast("string"), F.lit(""))
    per_file = rows.groupBy(a.alias("_audio")).agg(F.count(F.lit(1)).alias("_n"))
    return per_file.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("input_rows"),
        F.count_if(F.col("_audio") != "").alias("materialized_rows"),
    )


def wanted_audio(rows: DataFrame, audio_root: str, present: DataFrame | None = None) -> DataFrame:
    """``(audio_file, audio_path)``: one source path per target name (the least, if rows
    of one name differ), minus names already present in the target."""
    r = resolve_audio_path(rows, audio_root).where(F.col("problem").isNull())
    refs = r.groupBy("audio_file").agg(F.min("audio_path").alias("audio_path"))
    if present is not None:
        refs = refs.join(present.select("audio_file").distinct(), "audio_file", "left_anti")
    return refs


def audio_materialize(rows: DataFrame, inventory: DataFrame, audio_root: str, present: DataFrame | None = None) -> DataFrame:
    """``(audio_file, audio_path, content)`` for every distinct referenced audio file
    found in the inventory (``path``, ``content``), minus files already present in
    the target (``present`` with ``audio_file``)."""
    inv = inventory.select(F.col("path").alias("audio_path"), "content")
    return wanted_audio(rows, audio_root, present).join(inv, "audio_path")


def download_plan(
    registry: DataFrame,
    records: DataFrame,
    host: Host,
    inventory: DataFrame,
    *,
    xml_root: str,
    audio_root: str,
    download_audio: bool = True,
    overwrite: bool = False,
    limit: int | None = None,
) -> DataFrame:
    """Files to fetch: ``(kind, url, dest)``.

    The XML file of each of the first ``limit`` sources (registry order), and, when
    ``download_audio``, each non-empty audio file of their records.  Targets present
    in the inventory (``path``, ``length`` > 0) are skipped unless ``overwrite``."""
    reg = with_source_paths(first_sources(registry, limit), host)
    xml = reg.select(
        F.lit("xml").alias("kind"),
        F.col("xml_url").alias("url"),
        local_xml_path(xml_root, F.col("xml_relative_path")).alias("dest"),
    )
    plan = xml
    if download_audio:
        rec = records.where(F.col("audio_file") != "").select("source_key", "audio_file").distinct()
        src = reg.select("source_key", "group", "dialect", "audio_repo", "audio_repo_slug")
        joined = rec.join(broadcast_if_small(src), "source_key")
        audio = joined.select(
            F.lit("audio").alias("kind"),
            audio_url(F.col("group"), F.col("audio_repo"), F.col("dialect"), F.col("audio_file"), hub_base=host.hub_base).alias("url"),
            F.concat(
                local_audio_dir(audio_root, F.col("group"), F.col("audio_repo_slug"), F.col("dialect")),
                F.lit("/"),
                F.col("audio_file"),
            ).alias("dest"),
        )
        plan = plan.unionByName(audio)
    if not overwrite:
        have = inventory.where(F.col("length") > 0).select(F.col("path").alias("dest"))
        plan = plan.join(have, "dest", "left_anti")
    return plan.select("kind", "url", "dest")
