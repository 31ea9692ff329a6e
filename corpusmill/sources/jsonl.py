"""JSONL manifests: UTF-8, one JSON object per line, blank lines skipped, a
malformed line fails the read (FAILFAST).  Known manifests are read with an
explicit schema (no inference: an inferred ``"002"`` id would become a number)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.functions.text import WHITESPACE_CLASS, strip_ws
from corpusmill.operators.manifest import TRANSLATION_COLUMNS, TTS_COLUMNS

_DOUBLES = {"audio_start", "audio_end", "duration_seconds"}


def manifest_schema(columns: tuple[str, ...], extra: tuple[tuple[str, T.DataType], ...] = ()) -> T.StructType:
    fields = [T.StructField(c, T.DoubleType() if c in _DOUBLES else T.StringType()) for c in columns]
    return T.StructType(fields + [T.StructField(n, t) for n, t in extra])


TRANSLATION_SCHEMA = manifest_schema(TRANSLATION_COLUMNS)
TTS_SCHEMA = manifest_schema(TTS_COLUMNS)


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read JSONL with a fixed schema; malformed lines raise."""
    return spark.read.schema(schema).option("mode", "FAILFAST").option("encoding", "UTF-8").json(path)


def line_order() -> Column:
    """Position of a line in a folder or file read by ``spark.read.text``: part files by
    their numbers (Spark pads them to five digits, so names alone would sort part 100000
    before part 99999), then the split's offset, then the line in the split.  Take it
    right after the scan; unlike a row id alone it doesn't depend on how Spark packs splits
    into tasks."""
    path = F.col("_metadata.file_path")

    def number(pattern: str) -> Column:
        return F.nullif(F.regexp_extract(path, pattern, 1), F.lit("")).cast("long")

    return F.struct(
        F.regexp_extract(path, "^(.*)/[^/]*$", 1).alias("folder"),
        number(r"/part-([0-9]+)[^/]*$").alias("part"),
        number(r"/part-[^/]*[-.]c([0-9]+)[^/]*$").alias("nth"),
        path.alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    )


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(value, line_no)``: every line with its 0-based place in the whole folder.  Lines
    are counted per split, the counts summed up over the splits before (one row per split,
    so 128 MB of text, is broadcast), and places taken from the split's first line."""
    at = F.col("line_ord")
    split = F.struct(at["folder"].alias("folder"), at["part"].alias("part"), at["nth"].alias("nth"), at["file"].alias("file"), at["block"].alias("block"))
    lines = spark.read.text(path).select("value", line_order().alias("line_ord")).select("value", split.alias("split"), at["line"].alias("line"))
    sizes = lines.groupBy("split").agg(F.min("line").alias("first"), F.count(F.lit(1)).alias("n"))
    over = Window.orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("split", F.coalesce(F.sum("n").over(over), F.lit(0)).alias("before"))
    # within a split, a row's id minus the least id is its place, however splits are packed
    placed = lines.join(F.broadcast(sizes.select("split", "first")), "split").join(F.broadcast(offsets), "split")
    return placed.select("value", (F.col("before") + F.col("line") - F.col("first")).alias("line_no"))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(value, json, line_ord)``: the non-blank lines with their parsed value and place.
    White space is Python's; a line that is not a JSON object is an error."""
    return parsed_lines(ordered_lines(spark, path))


def ordered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(value, line_ord)``: the non-blank lines with their place."""
    lines = spark.read.text(path).select("value", line_order().alias("line_ord"))
    return lines.where(F.col("value").rlike(f"[^{WHITESPACE_CLASS[1:-1]}]"))


def parsed_lines(lines: DataFrame) -> DataFrame:
    """``lines`` with ``json``, the parsed ``value``.  Valid JSON is an object exactly if
    it begins with a brace."""
    text = strip_ws(F.col("value"))
    bad = F.raise_error(F.concat(F.lit("not a JSON object: "), F.substring("value", 1, 200))).cast("variant")
    return lines.withColumn("json", F.when(F.startswith(text, F.lit("{")), F.parse_json(text)).otherwise(bad))


def field_text(name: str) -> Column:
    """A field of ``json`` as text (NULL if it is absent or null)."""
    return F.variant_get(F.col("json"), f"$.{name}", "string")


def field_kind(name: str) -> Column:
    """Type of a field of ``json``: STRING, BIGINT, DOUBLE, DECIMAL(...), BOOLEAN, VOID ...;
    NULL if it is absent."""
    return F.schema_of_variant(F.variant_get(F.col("json"), f"$.{name}", "variant"))


def read_ordered(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A manifest with fixed columns plus ``line_ord``; malformed lines raise."""
    rows = read_lines(spark, path)
    return rows.select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("r"), "line_ord").select("r.*", "line_ord")
