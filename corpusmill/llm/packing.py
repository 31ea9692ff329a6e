"""Vector bin packing of token sequences under several limits at once.

Every document becomes token ids plus an end id.  Whole sequences are cut off a long
document's front; the rest of it, and every short document, is an item with a demand in
three dimensions: tokens, segments (one) and loss-bearing tokens (``loss_of``; by default
all but a segment's first, which nothing predicts).  The dot-product heuristic fills one
sequence after another: of the items that fit, that with the largest dot product of its
demand and the sequence's remaining room, both as shares of the limits, goes in.  When
none fits, the largest is cut to fill the room, so a sequence is full unless it runs out
of segments or loss-bearing tokens.  The last, partly filled sequence of a group is cut
into sequences whose lengths are powers of two, which need no padding.

Items are packed in groups of about ``group_tokens`` ids within a partition of the
input: nothing is shuffled, and a task holds one group.  The sequence ids are unique over
partitions.

Null texts count as empty and hold the end id only.  Repeated rows are packed each.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

SPECIAL = "<|endoftext|>"
LONG_RUN = 100_000  # white space; the faster library fails on runs of about a million
PIECES = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def encoder(json_path: str, ranks_path: str, pattern: str) -> Callable[[str], np.ndarray]:
    """Ids of a text as the tokenizer file ``json_path`` gives them.  ``ranks_path``
    holds the same vocabulary as merge ranks, which a faster library reads.  To the slower
    one go texts with the special token's string, which only the first file knows, texts
    with a run of white space that the faster one's regex may have no stack for, and any
    text on which it raises."""
    import tiktoken
    from tokenizers import Tokenizer

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f)}
    fast = tiktoken.Encoding("byte_bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    long_run = re.compile(rf"(?<!\s)\s{{{LONG_RUN}}}")  # tried once a run
    slow: list = []

    def ids(text: str) -> np.ndarray:
        if SPECIAL not in text and not (len(text) >= LONG_RUN and long_run.search(text)):
            try:
                return np.array(fast.encode_to_numpy(text, disallowed_special=()), np.uint32)
            except Exception:  # the other library knows every text
                pass
        if not slow:
            slow.append(Tokenizer.from_file(json_path))
        return np.array(slow[0].encode(text, add_special_tokens=False).ids, np.uint32)

    return ids


def all_but_first(length: int) -> int:
    return max(0, length - 1)


def pack(lengths: list[int], tokens: int = 2048, segments: int = 64, loss: int = 2048, loss_of: Callable[[int], int] = all_but_first) -> list[list[tuple[int, int, int]]]:
    """Sequences as lists of (document, start, length) for documents of ``lengths``."""
    out: list[list[tuple[int, int, int]]] = []
    limits = np.array([tokens, segments, loss], float)
    most = tokens  # longest piece that any sequence can hold
    while most > 1 and loss_of(most) > loss:
        most -= 1
    # demand classes: items of one length have one demand
    pools: list[list[tuple[int, int]]] = [[] for _ in range(most + 1)]
    count = np.zeros(most + 1, np.int64)
    for doc, n in enumerate(lengths):
        at = 0
        while n - at >= most and most == tokens:
            out.append([(doc, at, most)])
            at += most
        while n - at > most:
            pools[most].append((doc, at))
            count[most] += 1
            at += most
        if n > at:
            pools[n - at].append((doc, at))
            count[n - at] += 1
    demand = np.stack([np.arange(most + 1), np.ones(most + 1), [loss_of(i) for i in range(most + 1)]], axis=1) / limits
    left = int(count.sum())
    seq: list[tuple[int, int, int]] = []
    room = np.ones(3)
    eps = 1e-9
    fill = 0

    def put(doc: int, start: int, length: int) -> None:
        nonlocal room, fill
        seq.append((doc, start, length))
        room = room - demand[length]
        fill += length

    while left:
        have = np.flatnonzero(count)
        fits = have[(demand[have] <= room + eps).all(axis=1)]
        if len(fits):
            n = int(fits[np.argmax(demand[fits] @ room)])
            doc, at = pools[n].pop()
            count[n] -= 1
            left -= 1
            put(doc, at, n)
        else:
            cut = min(int(have[-1]) - 1, tokens - fill)
            while cut > 0 and not (demand[cut] <= room + eps).all():
                cut -= 1
            if cut > 0:
                n = int(have[-1])
                doc, at = pools[n].pop()
                count[n] -= 1
                put(doc, at, cut)
                pools[n - cut].append((doc, at + cut))
                count[n - cut] += 1
            if cut <= 0 or fill < tokens:
                if not seq:
                    raise ValueError("the limits admit no piece of one token")
                out.extend(powers(seq, fill, tokens))
                seq, room, fill = [], np.ones(3), 0
        if fill == tokens:
            out.append(seq)
            seq, room, fill = [], np.ones(3), 0
    if seq:
        out.extend(powers(seq, fill, tokens))
    return out


def powers(seq: list[tuple[int, int, int]], fill: int, tokens: int) -> list[list[tuple[int, int, int]]]:
    """A partly filled sequence as sequences whose lengths are powers of two."""
    if fill == tokens:
        return [seq]
    out, queue = [], list(reversed(seq))
    for bit in range(fill.bit_length() - 1, -1, -1):
        want = fill & (1 << bit)
        part = []
        while want:
            doc, at, n = queue.pop()
            took = min(n, want)
            part.append((doc, at, took))
            if took < n:
                queue.append((doc, at + took, n - took))
            want -= took
        if part:
            out.append(part)
    return out


def pack_documents(docs: DataFrame, json_path: str, ranks_path: str, pattern: str, id_col: str = "doc_id", text: str = "text", tokens: int = 2048, segments: int = 64, loss: int = 2048, end_id: int = 1, group_tokens: int = 1 << 21) -> DataFrame:
    """A row per piece: the document's id, the piece's span of its ids and their CRC-32,
    the document's number of ids, and the piece's place in its sequence."""
    slim = docs.select(id_col, text)
    id_type = slim.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(json_path, ranks_path, pattern)
        base = TaskContext.get().partitionId() << 32
        held_ids: list = []
        held: list[np.ndarray] = []
        size = serial = 0
        id_field = None

        def flush() -> pa.RecordBatch:
            nonlocal serial, size
            sequences = pack([len(x) for x in held], tokens, segments, loss)
            rows = [(d, s, n, k, sum(x[2] for x in seq[:i])) for k, seq in enumerate(sequences) for i, (d, s, n) in enumerate(seq)]
            own = [held_ids[r[0]] for r in rows]
            crc = [zlib.crc32(held[d][s : s + n].astype("<u4").tobytes()) for d, s, n, _, _ in rows]
            cols = [[r[1] for r in rows], [r[2] for r in rows], crc, [len(held[r[0]]) for r in rows], [base + serial + r[3] for r in rows], [r[4] for r in rows]]
            serial += len(sequences)
            held.clear()
            held_ids.clear()
            size = 0
            return pa.RecordBatch.from_arrays([pa.array(own, id_field.type), *(pa.array(c, pa.int64()) for c in cols)], names=[id_field.name, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

        for b in batches:
            id_field = b.schema.field(0)
            for key, body in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                held_ids.append(key)
                held.append(np.append(encode(body) if body else np.zeros(0, np.uint32), np.uint32(end_id)))
                size += len(held[-1])
                if size >= group_tokens:
                    yield flush()
        if held:
            yield flush()

    return slim.mapInArrow(run, f"`{id_col}` {id_type}, {PIECES}")


def tokenizer_paths() -> tuple[str, str, str]:
    import public_tokenizers as P

    return P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN


def op4_packing(spark, sf_dir: str) -> DataFrame:
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), *tokenizer_paths())
