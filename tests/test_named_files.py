import os

import pytest
from pyspark.sql import functions as F

from corpusmill.sinks import named_files
from corpusmill.sinks.named_files import NamedFilesWriter, read_named_files, write_named_files
from corpusmill.sources.files import FileSystems, check_scheme


def _tree(folder):
    return {os.path.relpath(os.path.join(d, f), folder): open(os.path.join(d, f), "rb").read() for d, _, fs in os.walk(folder) for f in fs}


def test_contents_and_copies(spark, tmp_path):
    rows = spark.createDataFrame([("a b.wav", bytearray(b"1")), ("é%20.wav", bytearray(b"22")), ("x/y.wav", None)], "name string, content binary")
    write_named_files(rows, str(tmp_path / "one"))
    want = {"a b.wav": b"1", "é%20.wav": b"22", "x/y.wav": b""}
    assert _tree(tmp_path / "one") == want
    # copies by the names that Spark lists (it lists no empty files)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(str(tmp_path / "one"))
    rows = files.select(F.concat(F.lit("c/"), F.element_at(F.split("path", "/"), -1)).alias("name"), F.col("path").alias("uri"))
    write_named_files(rows.repartition(3), f"file://{tmp_path}/two")
    assert _tree(tmp_path / "two") == {f"c/{k.rpartition('/')[2]}": v for k, v in want.items() if v}


def test_files_that_are_there_stay(spark, tmp_path):
    (tmp_path / "a").write_bytes(b"old")
    rows = spark.createDataFrame([("a", bytearray(b"new")), ("b", bytearray(b"new"))], "name string, content binary")
    for _ in range(2):
        write_named_files(rows, str(tmp_path))
    assert _tree(tmp_path) == {"a": b"old", "b": b"new"}
    write_named_files(rows.limit(0), str(tmp_path / "empty"))
    assert _tree(tmp_path) == {"a": b"old", "b": b"new"}


def test_lost_task_leaves_one_whole_file_a_name(tmp_path):
    rows = [(f"{i}.wav", bytes([i]) * 1000) for i in range(20)]

    def dying():
        yield from rows[:7]
        raise OSError("executor lost")

    writer = NamedFilesWriter(str(tmp_path), copied=False)
    with pytest.raises(OSError, match="lost"):
        writer.write(dying())
    (tmp_path / os.path.basename(writer.staging) / "half").write_bytes(b"?")  # of an attempt that was cut off
    assert writer.write(iter(rows)).files == 13
    assert writer.write(iter(rows)).files == 0  # a second attempt of the same task
    writer.commit([])
    assert _tree(tmp_path) == dict(rows)


def test_names_and_schemes_are_checked(spark, tmp_path):
    for name in ("", None, "../a", "/a", "a//b", "a/./b"):
        with pytest.raises(ValueError, match="not a file name"):
            NamedFilesWriter(str(tmp_path / "d"), copied=False).write(iter([(name, b"x")]))
    for uri in ("dbfs:/a", "wasbs://c@h/a", "oss://b/a"):
        with pytest.raises(ValueError, match="scheme"):
            check_scheme(uri)
    for uri in ("/a", "file:/a", "file:///a", "s3a://b/a", "hdfs://n/a", "abfss://c@h/a"):
        check_scheme(uri)
    assert [FileSystems().open(u)[1] for u in ("/a b", "file:/a%20b", "file:///a")] == ["/a b", "/a%20b", "/a"]
    with pytest.raises(Exception, match="appends rows"):
        spark.createDataFrame([(1, "x")], "n int, content string").write.format("named_files").mode("append").save(str(tmp_path / "d"))


def test_read_lists_and_reads_in_tasks(spark, tmp_path):
    want = {"top.wav": b"t", "0/a b.wav": b"1", "0/é%20.wav": b"", "7/x/y.wav": b"333"}
    rows = spark.createDataFrame([(k, bytearray(v)) for k, v in want.items()], "name string, content binary")
    write_named_files(rows, str(tmp_path / "one"))
    (tmp_path / "one" / "_staging-lost").mkdir()
    (tmp_path / "one" / "_staging-lost" / "part").write_bytes(b"half")
    found = read_named_files(spark, str(tmp_path / "one"))
    assert {r.name: (r.length, bytes(r.content)) for r in found.collect()} == {k: (len(v), v) for k, v in want.items()}
    assert found.rdd.getNumPartitions() == 3  # 0, 7 and the folder's own files
    (tmp_path / "none").mkdir()
    assert read_named_files(spark, f"file://{tmp_path}/none").count() == 0


def test_no_more_readers_than_asked_for(tmp_path, monkeypatch):
    monkeypatch.setattr(named_files, "READERS", 3)
    for k in range(10):
        (tmp_path / str(k)).mkdir()
        (tmp_path / str(k) / "f").write_bytes(bytes([k]))
    reader = named_files.NamedFilesReader(str(tmp_path))
    parts = reader.partitions()
    assert len(parts) == 3
    assert sorted(n for p in parts for b in reader.read(p) for n in b.column("name").to_pylist()) == [f"{k}/f" for k in range(10)]
