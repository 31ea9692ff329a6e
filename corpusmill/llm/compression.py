"""Quality rules from compression: repetitive text compresses too well, noise too badly.

A text's zstandard ratio (compressed over raw bytes) is taken over the whole document and
over fixed chunks.  The limits depend on length, because short inputs compress worse:
each band has a lowest and a highest whole-document ratio.  Chunks of ``CHUNK`` bytes (a
tail shorter than half a chunk joins the one before) have their band's limits by their
own length; a document is rejected if chunks outside them hold more than
``MAX_BAD`` of its bytes.

Beside the verdict come the base counts.  Words are runs of characters other than ASCII
white space.  Null texts count as empty: all counts 0, failed, ratio 1.  Repeated rows get equal
results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from corpusmill.llm.common import others

LEVEL = 3
CHUNK = 2048
MAX_BAD = 0.25
#: (bytes below which the band holds, lowest ratio, highest ratio)
BANDS = ((256, 0.30, 1.10), (512, 0.27, 0.90), (1024, 0.24, 0.80), (4096, 0.20, 0.74), (16384, 0.17, 0.68), (float("inf"), 0.13, 0.64))
SPACE = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
COLUMNS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, ratio double, bad_share double"


def in_band(raw: int, packed: int) -> bool:
    lo, hi = next((lo, hi) for below, lo, hi in BANDS if raw < below)
    return lo * raw <= packed <= hi * raw


def ratios(raw: bytes, z: zstandard.ZstdCompressor) -> tuple[float, float, bool]:
    """Whole ratio, share of bytes in chunks outside their band, whole in its band."""
    if not raw:
        return 1.0, 0.0, False
    packed = len(z.compress(raw))
    edges = list(range(0, len(raw), CHUNK))
    if len(edges) > 1 and len(raw) - edges[-1] < CHUNK // 2:
        edges.pop()
    bad = 0
    if len(edges) > 1:
        for a, b in zip(edges, [*edges[1:], len(raw)], strict=True):
            if not in_band(b - a, len(z.compress(raw[a:b]))):
                bad += b - a
    return packed / len(raw), bad / len(raw), in_band(len(raw), packed)


def repeated_words(words: list[bytes]) -> int:
    """Words in 3-word windows that occur twice or more."""
    n = len(words)
    if n < 4:
        return 0
    ids: dict[bytes, int] = {}
    w = np.fromiter((ids.setdefault(x, len(ids)) for x in words), np.int64, n)
    pair = w[:-1] * len(ids) + w[1:]
    if len(ids) ** 3 >= 1 << 62:  # renumber, so that the next product fits
        pair = np.unique(pair, return_inverse=True)[1]
    key = pair[:-1] * len(ids) + w[2:]
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    twice = np.zeros(n - 2, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    cover = np.zeros(n, bool)
    for k in range(3):
        cover[k : n - 2 + k] |= twice
    return int(cover.sum())


def measure(text: str | None, z: zstandard.ZstdCompressor) -> tuple:
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    seen: set[str] = set()
    dup = 0
    for line in text.split("\n"):
        if line in seen:
            dup += 1
        elif line.strip(" \t\n\x0b\x0c\r"):
            seen.add(line)
    repeat = repeated_words(words)
    n = len(words)
    failed = n < 50 or 100 * repeat > 50 * n
    whole, bad, ok = ratios(raw, z)
    spaces = len(raw) - len(raw.translate(None, SPACE))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    return n, len(text) - spaces, symbols, dup, repeat, failed, not failed and ok and bad <= MAX_BAD, whole, bad


def compression_rules(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without its text, with the counts, the ratio and the verdict, which
    replace columns of these names."""
    new = T.StructType.fromDDL(COLUMNS)
    kept = others(docs, [text, *new.fieldNames()])
    keep = kept.fieldNames()
    names = [*keep, *new.fieldNames()]
    kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()] * 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdCompressor(level=LEVEL)
        for b in batches:
            cols = list(zip(*(measure(t, z) for t in b.column(text).to_pylist()), strict=True)) or [()] * 9
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], names=names)

    return docs.mapInArrow(run, T.StructType([*kept.fields, *new.fields]))


def op8_compression(spark, sf_dir: str) -> DataFrame:
    return compression_rules(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
