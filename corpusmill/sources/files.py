"""File inventories: which files exist and how large they are, without reading
their bytes (``binaryFile`` with ``content`` pruned)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with scheme and absolute, as Spark's readers name files, whatever form
    (relative, absolute, URI) the caller used."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.makeQualified(p).toString().rstrip("/")


def make_dir(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(p)


# Schemes that tasks can open through Arrow, and Arrow's names for them.
ARROW_SCHEMES = {"hdfs": "hdfs", "viewfs": "viewfs", "s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs", "abfs": "abfs", "abfss": "abfss"}


def check_scheme(uri: str) -> None:
    """An error, before any task runs, for a file system that tasks cannot open."""
    scheme = uri.partition(":")[0]
    if not uri.startswith("/") and scheme != "file" and scheme not in ARROW_SCHEMES:
        raise ValueError(f"tasks cannot open files of scheme {scheme!r}: {uri}")


class FileSystems:
    """A task's Arrow file systems, one per scheme and authority."""

    def __init__(self):
        self.known = {}

    def open(self, uri: str):
        """The file system of ``uri`` and the path there.  Spark lists paths as they are,
        not percent-encoded, so they are not decoded."""
        from pyarrow import fs

        check_scheme(uri)
        scheme, _, rest = uri.partition(":")
        if uri.startswith("/") or scheme == "file":
            return fs.LocalFileSystem(), "/" + (uri if uri.startswith("/") else rest).lstrip("/")
        authority, _, path = rest.removeprefix("//").partition("/")
        root = f"{ARROW_SCHEMES[scheme]}://{authority}/"
        if root not in self.known:
            self.known[root] = fs.FileSystem.from_uri(root)
        where, base = self.known[root]
        return where, f"{base.rstrip('/')}/{path}"


def below(spark: SparkSession, root: str, path: Column) -> Column:
    """The part of a listed file's ``path`` below ``root``; a file that is not below it
    is an error, never a silent miss."""
    base = qualified(spark, root) + "/"
    plain = F.replace(path, F.lit("file:///"), F.lit("file:/"))
    return F.when(F.startswith(plain, F.lit(base)), F.substr(plain, F.lit(len(base) + 1))).otherwise(
        F.raise_error(F.concat(F.lit(f"not below {base}: "), path)).cast("string")
    )


def file_inventory(spark: SparkSession, root: str, pattern: str = "*", recursive: bool = True) -> DataFrame:
    """``(path, rel_path, uri, length, modificationTime)`` of every file under ``root``:
    ``path`` in the caller's form of the root, ``uri`` as Spark lists it."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", pattern)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    files = reader.load(root).select(F.col("path").alias("uri"), "length", "modificationTime")
    files = files.withColumn("rel_path", below(spark, root, F.col("uri")))
    return files.select(F.concat(F.lit(root.rstrip("/") + "/"), "rel_path").alias("path"), "rel_path", "uri", "length", "modificationTime")
