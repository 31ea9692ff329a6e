"""A Spark data source that writes files by name, so that other tools can open them, and
reads them back.

``df.write.format("named_files").mode("append").save(folder)`` takes rows (name, content)
or (name, uri) and puts each content, or a copy of the file at ``uri``, at
``folder/name``.  A file that is there already stays as it is.  A task writes to a staging
folder and moves whole files into place, so a reader never sees half a file, and a task
that is lost, run again or run twice leaves one file a name.  A name may have folders, but
none that leads out of ``folder``.  Names should be distinct: of rows of one name any may
be the one that is kept.  Memory: a row's content, or one chunk of the file being copied.

``spark.read.format("named_files").load(folder)`` gives rows (name, length, content).
Tasks list the folders right below ``folder`` and read what is in them, so neither the
names nor the files pass through the driver.  Files in ``folder`` itself are one task's;
many of them should be named in folders.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from corpusmill.sources.files import FileSystems, check_scheme, qualified

CHUNK = 4 << 20
#: Tasks of a read at most, and rows and bytes of a batch.
READERS = 256
BATCH_ROWS, BATCH_BYTES = 2048, 16 << 20
STAGING = "_staging-"


@dataclass
class Written(WriterCommitMessage):
    files: int


class NamedFilesWriter(DataSourceWriter):
    def __init__(self, folder: str, copied: bool):
        self.folder, self.copied = folder.rstrip("/"), copied
        self.staging = f"{self.folder}/{STAGING}{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[Row]) -> Written:
        from pyarrow import fs

        systems, files = FileSystems(), 0
        where, folder = systems.open(self.folder)
        # each task in a folder of its own; folders are made once a task, not once a file
        staging = f"{systems.open(self.staging)[1]}/{uuid.uuid4().hex}"
        made = set()

        def make(path: str) -> None:
            if path not in made:
                where.create_dir(path)
                made.add(path)

        for name, what in iterator:
            steps = (name or "").split("/")
            if "" in steps or "." in steps or ".." in steps:
                raise ValueError(f"not a file name below the folder: {name!r}")
            target = f"{folder}/{name}"
            if where.get_file_info(target).type != fs.FileType.NotFound:
                continue
            part = f"{staging}/{uuid.uuid4().hex}"
            make(staging)
            with where.open_output_stream(part) as out:
                if self.copied:
                    origin, path = systems.open(what)
                    with origin.open_input_stream(path) as source:
                        while chunk := source.read(CHUNK):
                            out.write(chunk)
                else:
                    out.write(what or b"")
            make(target.rpartition("/")[0])
            where.move(part, target)
            files += 1
        return Written(files)

    def _clear(self) -> None:
        from pyarrow import fs

        where, staging = FileSystems().open(self.staging)
        if where.get_file_info(staging).type == fs.FileType.Directory:
            where.delete_dir(staging)

    def commit(self, messages: list[Written | None]) -> None:
        self._clear()

    def abort(self, messages: list[Written | None]) -> None:
        self._clear()


@dataclass
class Folders(InputPartition):
    names: list[str | None]  # None: the files of the folder itself


class NamedFilesReader(DataSourceReader):
    def __init__(self, folder: str):
        self.folder = folder.rstrip("/")

    def _list(self, path: str, recursive: bool) -> list:
        from pyarrow import fs

        where, _ = FileSystems().open(self.folder)
        return where.get_file_info(fs.FileSelector(path, recursive=recursive))

    def partitions(self) -> list[Folders]:
        from pyarrow import fs

        found = self._list(FileSystems().open(self.folder)[1], False)
        names = sorted(f.base_name for f in found if f.type == fs.FileType.Directory and not f.base_name.startswith(STAGING))
        own = [None] if any(f.type == fs.FileType.File for f in found) else []
        dealt = [names[k::READERS] for k in range(READERS)] + [own]
        return [Folders(some) for some in dealt if some] or [Folders([])]

    def read(self, partition: Folders) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        where, folder = FileSystems().open(self.folder)
        names, contents, size = [], [], 0

        def batch() -> pa.RecordBatch:
            cols = [pa.array(names, pa.string()), pa.array(map(len, contents), pa.int64()), pa.array(contents, pa.binary())]
            return pa.RecordBatch.from_arrays(cols, names=["name", "length", "content"])

        for some in partition.names:
            for f in self._list(folder if some is None else f"{folder}/{some}", some is not None):
                if f.type != fs.FileType.File:
                    continue
                with where.open_input_stream(f.path) as source:
                    contents.append(source.read())
                names.append(f.path.removeprefix(folder + "/"))
                size += len(contents[-1])
                if len(names) >= BATCH_ROWS or size >= BATCH_BYTES:
                    yield batch()
                    names, contents, size = [], [], 0
        yield batch()


class NamedFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "named_files"

    def schema(self) -> str:
        return "name string, length long, content binary"

    def reader(self, schema: StructType) -> NamedFilesReader:
        return NamedFilesReader(self.options["path"])

    def writer(self, schema: StructType, overwrite: bool) -> NamedFilesWriter:
        if overwrite or schema.fieldNames() not in (["name", "content"], ["name", "uri"]):
            raise ValueError("named_files appends rows of (name, content) or (name, uri)")
        return NamedFilesWriter(self.options["path"], schema.fieldNames()[1] == "uri")


def write_named_files(df: DataFrame, folder: str) -> None:
    """Files ``folder/name`` from rows (name, content) or (name, uri).  The folder's file
    system must be one that tasks can open, which is checked before anything runs."""
    spark = df.sparkSession
    folder = qualified(spark, folder)
    check_scheme(folder)
    spark.dataSource.register(NamedFiles)
    df.write.format("named_files").mode("append").save(folder)


def read_named_files(spark: SparkSession, folder: str) -> DataFrame:
    """(name, length, content) of the files below ``folder``."""
    folder = qualified(spark, folder)
    check_scheme(folder)
    spark.dataSource.register(NamedFiles)
    return spark.read.format("named_files").load(folder)
