"""CSV as Python's ``csv`` module writes it: CRLF after records, QUOTE_MINIMAL, doubled
quotes, and line breaks inside quoted fields kept as they are.  Files are split among
tasks, whatever their fields hold."""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.sources.records import read_records


class QuotedLines:
    """Lines of text; a record goes on while a quoted field is open."""

    separator = "\n"
    states = ("plain", "quoted")

    def step(self, line: bytes, state: str) -> tuple[str, int]:
        odd = line.count(b'"') % 2
        return self.states[odd ^ (state == "quoted")], 0

    def ends(self, state: str, depth: int) -> bool:
        return state == "plain"


def csv_record(columns: Sequence[Column | str], sep: str = ",") -> Column:
    """A record without its CRLF: a field is quoted if it holds the separator, a quote or
    a line break; NULL is an empty field."""
    special = "[" + ("\\" + sep if sep in "|^]\\-" else sep) + '"\r\n]'

    def field(c: Column) -> Column:
        text = F.coalesce(c.cast("string"), F.lit(""))
        return F.when(text.rlike(special), F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(text)

    fields = [field(F.col(c) if isinstance(c, str) else c) for c in columns]
    if len(fields) == 1:  # an empty line would be no record
        return F.when(fields[0] == "", '""').otherwise(fields[0])
    return F.concat_ws(sep, *fields)


def write_records(df: DataFrame, path: str, *, sep: str = ",", header: bool = True, mode: str = "overwrite") -> None:
    """CSV part files, each with a header of the column names if ``header``.  A table
    without rows gives one file with the header."""
    names = sep.join(_plain(c, sep) for c in df.columns)
    line = csv_record([F.col(f"`{c}`") for c in df.columns], sep)
    rows = df.select(line.alias("line"))
    if header:
        place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
        rows = rows.select(F.when(place == 0, F.concat(F.lit(names + "\r\n"), "line")).otherwise(F.col("line")).alias("line"))
        if df.isEmpty():
            rows = df.sparkSession.createDataFrame([(names,)], "line string").coalesce(1)
    rows.write.mode(mode).option("lineSep", "\r\n").text(path)


def _plain(name: str, sep: str) -> str:
    return '"' + name.replace('"', '""') + '"' if any(c in name for c in sep + '"\r\n') else name


def read_csv(spark: SparkSession, paths: str | list[str], columns: Sequence[str], *, sep: str = ",", header: bool = True) -> DataFrame:
    """The columns as text, plus ``place`` (file, block, seq: the order of records).  Each
    file's header must name the columns; a record with another number of fields or an open
    quote at a file's end is an error, as are bytes that are not UTF-8.  Blank lines are
    passed over."""
    records = read_records(spark, paths, QuotedLines())
    columns = list(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep, rows = [], []
            for i, (file, block, seq, record, ended) in enumerate(zip(*(b.column(c).to_pylist() for c in ("file", "block", "seq", "record", "ended")))):
                if not ended:
                    raise ValueError(f"{file}: a quoted field is open at the end")
                text = record.decode("utf-8").removesuffix("\r")
                if not text:
                    continue
                fields = next(csv.reader(io.StringIO(text, newline=""), delimiter=sep, strict=True))
                if header and block == 0 and seq == 0:
                    if fields != columns:
                        raise ValueError(f"{file}: header {fields} instead of {columns}")
                    continue
                if len(fields) != len(columns):
                    raise ValueError(f"{file}: {len(fields)} fields instead of {len(columns)}: {text[:200]}")
                keep.append(i)
                rows.append(fields)
            at = pa.array(keep, pa.int64())
            places = [b.column(c).take(at) for c in ("file", "block", "seq")]
            cols = [pa.array(c, pa.string()) for c in zip(*rows)] or [pa.array([], pa.string()) for _ in columns]
            place = pa.StructArray.from_arrays(places, names=["file", "block", "seq"])
            yield pa.RecordBatch.from_arrays([*cols, place], names=[*(f"c{k}" for k in range(len(columns))), "place"])

    kinds = ", ".join(f"c{k} string" for k in range(len(columns)))
    parsed = records.mapInArrow(run, f"{kinds}, place struct<file:string,block:long,seq:long>")
    return parsed.toDF(*columns, "place")
