"""Records that span lines, read from files of any size by many tasks.

Spark's text source cuts a file into splits at a separator of the caller's choice.  That
separator may also occur inside a record (a newline in a quoted CSV field, an end tag in a
comment), so a task can't know on its own whether its split begins inside a record.

1. Every split is read once for each state it might begin in; it yields where each ends
   (one row per split).
2. These rows are composed per file, which gives the state in which each split begins.
3. Every split is read again from its true state.  Records that begin and end in a split
   are ready; pieces of others (one or two per split) are put together by the split in
   which the record began.

What a separator means is said by a :class:`Grammar`.  Bytes are read by Spark's own
source, so any file system and scheme will do, and a compressed file is one split.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Protocol

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusmill.session import ensure_checkpoint_dir


class Grammar(Protocol):
    """How records are told apart.  A state is one of ``states`` (the first is that of a
    file's start) and a depth, 0 at a file's start."""

    separator: str
    states: tuple[str, ...]

    def step(self, line: bytes, state: str) -> tuple[str, int]:
        """The state after ``line`` and its separator, and by how much the depth changes."""

    def ends(self, state: str, depth: int) -> bool:
        """Is a record complete after a line that leaves this state and depth?"""


def read_raw(spark: SparkSession, paths: str | list[str], separator: str) -> DataFrame:
    """(file, block, value): the lines' bytes, without separators, in file order within a
    split, which ``file`` and ``block`` (its first byte) name."""
    lines = spark.read.option("lineSep", separator).text(paths)
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("value"))


def _runs(batches: Iterator[pa.RecordBatch], extra: tuple[str, ...] = ()) -> Iterator[tuple[tuple, Iterator[bytes]]]:
    """Consecutive lines of each split: ((file, block, *extra), lines)."""

    def rows():
        for b in batches:
            keys = list(zip(*(b.column(c).to_pylist() for c in ("file", "block", *extra))))
            yield from zip(keys, b.column("value"))

    source = rows()
    head = next(source, None)
    while head is not None:
        key = head[0]
        after = None

        def lines(first=head, key=key):
            nonlocal after
            yield first[1].as_py()
            for k, value in source:
                if k != key:
                    after = (k, value)
                    return
                yield value.as_py()

        run = lines()
        yield key, run
        for _ in run:  # what the caller left
            pass
        head = after


def split_starts(lines: DataFrame, grammar: Grammar) -> DataFrame:
    """(file, block, state, depth): how each split begins; one row per split."""
    states = grammar.states

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (file, block), run in _runs(batches):
            at = [(s, 0) for s in states]
            for line in run:
                done: dict[str, tuple[str, int]] = {}
                for i, (state, depth) in enumerate(at):
                    if state not in done:
                        done[state] = grammar.step(line, state)
                    after, change = done[state]
                    at[i] = (after, depth + change)
            ends, depths = [states.index(s) for s, _ in at], [d for _, d in at]
            yield pa.RecordBatch.from_pydict(
                {"file": [file], "block": [block], "ends": pa.array([ends], pa.list_(pa.int32())), "depths": pa.array([depths], pa.list_(pa.int64()))}
            )

    probed = lines.mapInArrow(probe, "file string, block long, ends array<int>, depths array<long>")

    def compose(rows):
        rows = rows.sort_values("block")
        state, depth, first = 0, 0, []
        for ends, depths in zip(rows["ends"], rows["depths"]):
            first.append((state, depth))
            state, depth = int(ends[state]), depth + int(depths[state])
        rows["state"], rows["depth"] = [s for s, _ in first], [d for _, d in first]
        return rows[["file", "block", "state", "depth"]]

    return probed.groupBy("file").applyInPandas(compose, "file string, block long, state int, depth long")


def _kept(df: DataFrame) -> DataFrame:
    """A few rows a split, worked out once, as they have several readers."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def read_records(spark: SparkSession, paths: str | list[str], grammar: Grammar) -> DataFrame:
    """(file, block, seq, record, ended): every record of the files.  It began in split
    ``block`` as the ``seq``-th; ``ended`` is false for what follows the last record of a
    file.  Separators between a record's lines are kept."""
    return records_and_firsts(spark, paths, grammar)[0]


def records_and_firsts(spark: SparkSession, paths: str | list[str], grammar: Grammar) -> tuple[DataFrame, DataFrame]:
    """:func:`read_records`, and of it the first record of each file, which is kept."""
    lines = read_raw(spark, paths, grammar.separator)
    starts = _kept(split_starts(lines, grammar))
    states, glue = grammar.states, grammar.separator.encode("utf-8")

    def cut(batches: Iterator[pa.RecordBatch], whole: bool) -> Iterator[pa.RecordBatch]:
        # piece: 0 a whole record, 1 the end of an earlier one, 2 one that goes on, 3 both
        out: list[tuple] = []
        size = 0

        def batch() -> pa.RecordBatch:
            nonlocal size
            cols = list(zip(*out)) or [()] * 5
            out.clear()
            size = 0
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["file", "block", "seq", "piece", "bytes"])

        for (file, block, state, depth), run in _runs(batches, ("state", "depth")):
            now, held, seq = states[state], [], 0
            inside = block > 0 and not grammar.ends(now, depth)
            for line in run:
                held.append(line)
                now, change = grammar.step(line, now)
                depth += change
                if grammar.ends(now, depth):
                    if whole != inside or not (block or seq):
                        text = glue.join(held)
                        out.append((file, block, seq, 1 if inside else 0, text))
                        size += len(text)
                    inside, held, seq = False, [], seq + 1
                    if len(out) >= 4096 or size > 1 << 24:
                        yield batch()
            if held and not whole:
                out.append((file, block, seq, 3 if inside else 2, glue.join(held)))
        yield batch()

    # one row per split, 128 MB of text each by default; a shuffle would lose the order
    placed = lines.join(F.broadcast(starts), ["file", "block"])
    schema = "file string, block long, seq long, piece int, bytes binary"
    whole = placed.mapInArrow(lambda b: cut(b, True), schema)
    whole = whole.select("file", "block", "seq", F.col("bytes").alias("record"), F.lit(True).alias("ended"))
    # at most two pieces per split and a file's first record, kept; those of a record share the split in which it began
    pieces = _kept(placed.mapInArrow(lambda b: cut(b, False), schema))
    began = F.when(F.col("piece") == 2, F.struct("block", "seq"))
    over = Window.partitionBy("file").orderBy("block", "seq")
    parts = pieces.where("piece > 0").withColumn("from", F.last(began, True).over(over))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "seq", F.hex("bytes").alias("x")))), lambda p: p["x"]), glue.hex())
    joined = parts.groupBy("file", "from").agg(F.unhex(text).alias("record"), (F.max(F.when(F.col("piece") == 1, 1).otherwise(0)) == 1).alias("ended"))
    joined = joined.select("file", F.col("from.block").alias("block"), F.col("from.seq").alias("seq"), "record", "ended")
    first = pieces.where("piece = 0").select("file", "block", "seq", F.col("bytes").alias("record"), F.lit(True).alias("ended"))
    return whole.unionByName(joined), first.unionByName(joined.where("block = 0 and seq = 0"))
