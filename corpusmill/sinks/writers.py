"""Writers.  Each writes a folder of part files (Spark's output layout); readers
in :mod:`corpusmill.sources` read such folders back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.operators.split import SPLITS
from corpusmill.sources.csv_records import write_records
from corpusmill.sources.files import make_dir


def write_jsonl(df: DataFrame, path: str, *, mode: str = "overwrite") -> None:
    """JSONL, UTF-8 without escaping of non-ASCII, NULL fields written as ``null``."""
    df.write.mode(mode).option("ignoreNullFields", "false").option("encoding", "UTF-8").json(path)


def by_split(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """``df`` ranged by ``order`` and sorted within each task by split, then ``order``.  A
    writer partitioned by split needs no sort of its own then; with a global sort alone it
    would add one on the split, which loses the order as soon as it spills."""
    return df.repartitionByRange(*order).sortWithinPartitions("split", *order)


def write_split_manifests(df: DataFrame, path: str, *, order: Sequence[str] = (), mode: str = "overwrite") -> None:
    """One JSONL folder per split (``split=train`` ...), partition-pruned on read.  A split
    without rows has an empty folder.  With ``order``, lines are written in the order of
    these columns, which are left out."""
    rows = by_split(df, order).drop(*order) if order else df
    rows.write.mode(mode).partitionBy("split").option("ignoreNullFields", "false").json(path)
    for name in SPLITS:
        make_dir(df.sparkSession, f"{path}/split={name}")


def write_csv(df: DataFrame, path: str, *, mode: str = "overwrite") -> None:
    """CSV with a header of the column names, NULL as "", as Python's ``csv`` module writes
    it: CRLF after records, line breaks in quoted fields as they are."""
    write_records(df, path, mode=mode)


def write_lines(df: DataFrame, path: str, *, col: str = "line", order: str = "line_no", mode: str = "overwrite") -> None:
    """Text lines in ``order`` (small outputs such as the markdown summary)."""
    df.orderBy(order).select(col).coalesce(1).write.mode(mode).text(path)


def write_ljspeech_metadata(df: DataFrame, path: str, *, mode: str = "overwrite") -> None:
    """``audio_file|text|normalized_text`` rows, no header, csv-module quoting."""
    write_records(df.select("audio_file", "text", "normalized_text"), path, sep="|", header=False, mode=mode)
