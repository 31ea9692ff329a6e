"""Corpus summaries: totals, facet counts, manifest statistics, split counts and
the markdown rendering, all as one-pass aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from corpusmill.functions import exact
from corpusmill.functions.text import row_text
from corpusmill.session import ensure_checkpoint_dir
from corpusmill.operators.dedupe import key_digest, translation_key, tts_key
from corpusmill.operators.split import SPLITS, split_column, translation_split_key, tts_split_key
from corpusmill.sources.jsonl import field_kind, field_text

# Facet names and markdown labels of the summary.
FACETS = ("by_group", "by_corpus", "by_dialect", "by_audio_mode")
MARKDOWN_TITLE = "# Puyuma Corpus Summary"
TOTAL_LABELS = (
    ("total_records", "Total records"),
    ("missing_audio", "Missing audio"),
    ("missing_translation", "Missing translation"),
    ("total_duration_seconds", "Total duration seconds"),
)


def summary_totals(examples: DataFrame) -> DataFrame:
    """One row: total records, rows without audio, rows without translation, and
    the duration sum (NULL counts as 0) rounded to two decimals."""
    totals = _totals(
        examples,
        F.col("duration_seconds"),
        total_records=F.count(F.lit(1)),
        missing_audio=F.count_if(F.col("audio_file") == ""),
        missing_translation=F.count_if(F.col("translation_zh") == ""),
    )
    return totals.withColumn("total_duration_seconds", F.round("total_duration_seconds", 2))


def _totals(df: DataFrame, seconds: Column, **counts: Column) -> DataFrame:
    """One row: the counts and the exact sum of ``seconds`` (bit-equal for any order and
    partitioning of the rows), by one aggregate on the power of two of the seconds."""
    parts = df.withColumn("_seconds", seconds).groupBy(exact.power(F.col("_seconds")).alias("_power"))
    parts = parts.agg(*(c.alias(name) for name, c in counts.items()), *exact.group_parts(F.col("_seconds")))
    sums = [F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in counts]
    return parts.agg(*sums, exact.total("_power").alias("total_duration_seconds"))


def _facet_pairs(group: Column, corpus: Column, dialect: Column, audio_mode: Column) -> Column:
    keys = (group, F.concat(group, F.lit("/"), corpus), dialect, audio_mode)
    return F.array(
        *[
            F.struct(F.lit(i).alias("facet_ord"), F.lit(name).alias("facet"), key.alias("key"))
            for i, (name, key) in enumerate(zip(FACETS, keys))
        ]
    )


def summary_facets(examples: DataFrame) -> DataFrame:
    """Tall ``(facet_ord, facet, key, n)`` counts for the four facets in one pass
    (each row expands into four facet keys; partial aggregation before the shuffle).
    Within a facet, keys sort by code point, as in the reference."""
    pairs = examples.select(
        F.inline(_facet_pairs(F.col("group"), F.col("corpus_slug"), F.col("dialect"), F.col("audio_mode")))
    )
    return pairs.groupBy("facet_ord", "facet", "key").agg(F.count(F.lit(1)).alias("n"))


def _opt(df: DataFrame, name: str) -> Column:
    return F.col(f"`{name}`") if name in df.columns else F.lit(None).cast("string")


def _falsy(df: DataFrame, name: str) -> Column:
    """Python truthiness of a JSON value read as string/number: NULL, "" or 0."""
    if name not in df.columns:
        return F.lit(True)
    c = F.col(f"`{name}`")
    dtype = dict(df.dtypes)[name]
    if dtype == "string":
        return c.isNull() | (c == "")
    if dtype in ("double", "float", "bigint", "int", "long", "smallint", "tinyint"):
        return c.isNull() | (c == 0)
    if dtype == "boolean":
        return c.isNull() | ~c
    return c.isNull()


def stats_lines(lines: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """:func:`stats_manifest` for parsed JSON lines (``json``, ``line_ord``) of any keys:
    whether a value counts is decided value by value, as their types may differ.  Totals
    and facets read the few typed columns, which are written to ``path`` (Parquet) once."""

    def empty(name: str) -> Column:
        kind, text = field_kind(name), field_text(name)
        number = kind.rlike("^(TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL)")
        return F.coalesce(
            F.when(number, text.cast("double") == 0)
            .when(kind == "BOOLEAN", text == "false")
            .when(kind == "STRING", text == "")
            .when(kind.startswith("ARRAY") | kind.startswith("OBJECT"), text.isin("[]", "{}")),
            F.lit(True),
        )

    kind, text = field_kind("duration_seconds"), field_text("duration_seconds")
    seconds = F.when(kind.rlike("^(TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL)"), text.cast("double")).when(
        kind == "BOOLEAN", (text == "true").cast("double")  # a Python bool is a number
    )
    names = ("group", "corpus_slug", "dialect", "audio_mode")
    typed = lines.select(
        *[field_text(n).alias(n) for n in names],
        F.when(empty("audio_file"), "").otherwise("x").alias("audio_file"),
        F.when(empty("translation_zh") & empty("target_text"), "").otherwise("x").alias("translation_zh"),
        seconds.alias("duration_seconds"),
        "line_ord",
    )
    typed.write.parquet(path)
    return stats_manifest(lines.sparkSession.read.schema(typed.schema).parquet(path), order="line_ord")


def stats_manifest(manifest: DataFrame, order: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Statistics of a manifest with the rules of the ``stats`` command.

    Returns ``(totals, facets)``.  Facet keys are normalised (NULL -> ""); a row
    misses translation only if both ``translation_zh`` and ``target_text`` are
    falsy; the duration sum takes numeric values only and is exact before its one rounding to a
    double; facet
    rows carry ``first_ord`` (the first-seen position) when ``order`` is given."""
    g = row_text(_opt(manifest, "group"))
    c = row_text(_opt(manifest, "corpus_slug"))
    d = row_text(_opt(manifest, "dialect"))
    m = row_text(_opt(manifest, "audio_mode"))
    dur = (
        F.col("duration_seconds").cast("double")
        if "duration_seconds" in manifest.columns
        and dict(manifest.dtypes)["duration_seconds"] in ("double", "float", "bigint", "int")
        else F.lit(None).cast("double")
    )
    totals = _totals(
        manifest,
        dur,
        total_records=F.count(F.lit(1)),
        missing_audio=F.count_if(_falsy(manifest, "audio_file")),
        missing_translation=F.count_if(_falsy(manifest, "translation_zh") & _falsy(manifest, "target_text")),
        n_durations=F.count(dur),
    )
    totals = totals.select("total_records", "missing_audio", "missing_translation", "total_duration_seconds", "n_durations")
    ordc = F.col(order) if order else F.lit(0)
    pairs = manifest.select(F.inline(_facet_pairs(g, c, d, m)), ordc.alias("_ord"))
    facets = pairs.groupBy("facet_ord", "facet", "key").agg(
        F.count(F.lit(1)).alias("n"), F.min("_ord").alias("first_ord")
    )
    return totals, facets


def summary_markdown_from_examples(examples: DataFrame) -> DataFrame:
    """Markdown lines of an examples table.  Totals and facet counts come from one
    pass (each row emits its facet keys plus its total contributions); the rendering
    reads the small aggregate several times, so it is checkpointed."""
    ensure_checkpoint_dir(examples.sparkSession)
    f = F.col
    contrib = F.array(
        F.struct(F.lit(-1).alias("facet_ord"), F.lit("total_records").alias("facet"), F.lit("").alias("key"), F.lit(1.0).alias("v")),
        F.struct(F.lit(-1).alias("facet_ord"), F.lit("missing_audio").alias("facet"), F.lit("").alias("key"),
                 F.when(f("audio_file") == "", F.lit(1.0)).otherwise(F.lit(0.0)).alias("v")),
        F.struct(F.lit(-1).alias("facet_ord"), F.lit("missing_translation").alias("facet"), F.lit("").alias("key"),
                 F.when(f("translation_zh") == "", F.lit(1.0)).otherwise(F.lit(0.0)).alias("v")),
        F.struct(F.lit(-1).alias("facet_ord"), F.lit("total_duration_seconds").alias("facet"), F.lit("").alias("key"),
                 F.coalesce(f("duration_seconds"), F.lit(0.0)).alias("v")),
        *[
            F.struct(x["facet_ord"].alias("facet_ord"), x["facet"].alias("facet"), x["key"].alias("key"), F.lit(1.0).alias("v"))
            for x in [
                {"facet_ord": F.lit(i), "facet": F.lit(name), "key": key}
                for i, (name, key) in enumerate(
                    zip(FACETS, (f("group"), F.concat(f("group"), F.lit("/"), f("corpus_slug")), f("dialect"), f("audio_mode")))
                )
            ]
        ],
    )
    tall = examples.select(F.inline(contrib)).groupBy("facet_ord", "facet", "key").agg(F.sum("v").alias("v")).checkpoint(eager=True)
    totals_row = tall.where(f("facet_ord") == -1).groupBy().agg(
        *[
            F.max(F.when(f("facet") == name, f("v"))).alias(name)
            for name, _ in TOTAL_LABELS
        ]
    )
    totals = totals_row.select(
        *[F.coalesce(f(name), F.lit(0.0)).cast("long").alias(name) for name, _ in TOTAL_LABELS[:3]],
        F.round(F.coalesce(f("total_duration_seconds"), F.lit(0.0)), 2).alias("total_duration_seconds"),
    )
    facets = tall.where(f("facet_ord") >= 0).select("facet_ord", "facet", "key", f("v").cast("long").alias("n"))
    return summary_markdown(totals, facets)


def split_counts(split_df: DataFrame) -> DataFrame:
    """Rows per split, with all three split names present (zero when empty)."""
    spark = split_df.sparkSession
    names = spark.createDataFrame([(i, s) for i, s in enumerate(SPLITS)], "split_ord int, split string")
    counts = split_df.groupBy("split").agg(F.count(F.lit(1)).alias("n"))
    return names.join(counts, "split", "left").select(
        "split_ord", "split", F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n")
    )


def manifest_split_counts(examples: DataFrame, order: Sequence[str], train_ratio: float = 0.9, valid_ratio: float = 0.05) -> DataFrame:
    """Rows per split of both manifests: (manifest, split_ord, split, n), in one pass.

    Each example emits its dedupe key, its order, whether the manifest takes it and its
    split, once a manifest; the first of a key decides.  No text crosses an exchange."""
    full = {c: F.col(c) != "" for c in ("source_text", "target_text", "audio_file")}
    manifests = (
        ("translation", translation_key(), full["source_text"] & full["target_text"], translation_split_key()),
        ("tts", tts_key(), full["audio_file"] & full["source_text"], tts_split_key()),
    )
    emitted = F.array(*[
        F.struct(
            F.lit(name).alias("manifest"), key_digest(key).alias("key"), F.struct(*order).alias("at"),
            F.when(taken, split_column(split_key, train_ratio, valid_ratio)).alias("split"),
        )
        for name, key, taken, split_key in manifests
    ])
    first = examples.select(F.inline(emitted)).groupBy("manifest", "key").agg(F.min_by("split", "at").alias("split"))
    counts = first.where(F.col("split").isNotNull()).groupBy("manifest", "split").agg(F.count(F.lit(1)).alias("n"))
    names = [(name, i, s) for name, *_ in manifests for i, s in enumerate(SPLITS)]
    every = examples.sparkSession.createDataFrame(names, "manifest string, split_ord int, split string")
    return every.join(counts, ["manifest", "split"], "left").select(
        "manifest", "split_ord", "split", F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n")
    )


def py_float(x: Column) -> Column:
    """Python's ``str()`` of a double between 1e-4 and 1e16, and of zero: the shortest
    digits that give it back (Spark's cast to string has them), never an exponent."""
    text = x.cast("string")
    plain = F.regexp_replace(F.format_string("%.16f", x), r"(\.[0-9]+?)0+$", "$1")
    whole = F.concat(F.round(x).cast("decimal(38,0)").cast("string"), F.lit(".0"))
    return F.when(~text.contains("E"), text).when(x == F.round(x), whole).when(F.abs(x) < 1, plain).otherwise(x.cast("decimal(38,6)").cast("string"))


def py_float_2(x: Column) -> Column:
    """Python's ``str()`` of a value already rounded to two decimals (``974.1``,
    ``974.0``, ``974.07``), for magnitudes below 1e16."""
    return F.regexp_replace(F.format_string("%.2f", x), r"(\.[0-9])0$", "$1")


def _seen_duration(totals: DataFrame) -> Column:
    total = F.col("total_duration_seconds")
    if "n_durations" in totals.columns:
        return F.when(F.col("n_durations") == 0, F.lit("0")).otherwise(py_float(total))
    return py_float(total)


def summary_markdown(totals: DataFrame, facets: DataFrame, *, first_seen: bool = False) -> DataFrame:
    """The summary as markdown lines ``(line_no, line)``.

    Facet rows are ordered by key within each facet (code-point order) and the duration
    has two decimals; with ``first_seen`` (manifest statistics) they are in order of
    ``first_ord`` and the duration is printed as it is, an integer 0 if nothing was
    added.  A facet without rows prints ``- none``; the trailing blank line is dropped.  Both inputs
    are small (one row; one row per distinct facet key)."""
    spark: SparkSession = totals.sparkSession
    t = totals.select(
        *[F.col(name).cast("string").alias(name) for name, _ in TOTAL_LABELS[:3]],
        (_seen_duration(totals) if first_seen else py_float_2(F.col("total_duration_seconds"))).alias("total_duration_seconds"),
    )
    texts = [F.lit(MARKDOWN_TITLE), F.lit("")]
    texts += [F.concat(F.lit(f"- {label}: "), F.col(name)) for name, label in TOTAL_LABELS]
    texts += [F.lit("")]
    head = t.select(
        F.inline(F.array(*[F.struct(F.lit(i).cast("long").alias("pos"), x.alias("line")) for i, x in enumerate(texts)]))
    ).select(F.lit(-1).alias("sec"), "pos", "line")
    sections = spark.createDataFrame([(i, f) for i, f in enumerate(FACETS)], "sec int, facet string")
    w = Window.partitionBy("facet_ord").orderBy("first_ord" if first_seen else "key", "key")
    entries = facets.select(
        F.col("facet_ord").alias("sec"),
        (F.row_number().over(w) + 1).cast("long").alias("pos"),
        F.concat(F.lit("- "), F.col("key"), F.lit(": "), F.col("n").cast("string")).alias("line"),
    )
    present = facets.select(F.col("facet_ord").alias("sec")).distinct()
    none_rows = sections.join(present, "sec", "left_anti").select(
        "sec", F.lit(2).cast("long").alias("pos"), F.lit("- none").alias("line")
    )
    titles = sections.select("sec", F.lit(0).cast("long").alias("pos"), F.concat(F.lit("## "), F.col("facet")).alias("line"))
    counts = facets.groupBy(F.col("facet_ord").alias("sec")).agg(F.count(F.lit(1)).alias("k"))
    blanks = (
        sections.join(counts, "sec", "left")
        .where(F.col("sec") < len(FACETS) - 1)
        .select("sec", (F.greatest(F.coalesce(F.col("k"), F.lit(1)), F.lit(1)) + 2).cast("long").alias("pos"), F.lit("").alias("line"))
    )
    lines = head.unionByName(titles).unionByName(entries).unionByName(none_rows).unionByName(blanks)
    w2 = Window.orderBy("sec", "pos")
    return lines.select((F.row_number().over(w2)).cast("long").alias("line_no"), "line")
