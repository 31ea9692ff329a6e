"""Model data: byte-level tokenisation, label restoration, generation length and
corpus BLEU, re-expressed as Spark jobs.

Tokenisation follows the published byte-level (ByT5) scheme: token id = UTF-8 byte
+ 3, end-of-sequence id 1, pad id 0, and truncation keeps the first
``max_length - 1`` bytes before EOS.  BLEU follows Papineni et al. (2002) with the
defaults of Post (2018): the "13a" tokenizer, exponential smoothing, n = 1..4, one
reference per segment.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.functions.text import collapse_ws, strip_ws

# Fixed values of the byte-level vocabulary.
PAD_ID = 0
EOS_ID = 1
UNK_ID = 2
BYTE_OFFSET = 3
IGNORE_INDEX = -100
# Fixed values of the 13a tokenizer (Post 2018): punctuation class, then period and
# comma unless next to a digit, then a dash after a digit.
RE_13A_PUNCT = r"([\{-\~\[-\` -\&\(-\+\:-\@\/])"
RE_13A_PERIOD_BEFORE = r"([^0-9])([\.,])"
RE_13A_PERIOD_AFTER = r"([\.,])([^0-9])"
RE_13A_DASH = r"([0-9])(-)"
LOG_ZERO = -9999999999.0
MAX_ORDER = 4


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Fail when ``df`` is empty (an empty training or validation set is an error)."""
    if df.isEmpty():
        raise ValueError(f"{what} is empty")
    return df


def training_pairs(pairs: DataFrame, path: str) -> DataFrame:
    """The train and valid rows of split pairs; an empty split of either is an error.  The
    rows are worked out once: they are written to ``path`` (Parquet, a folder per split),
    where the check looks for a first row of each."""
    pairs.where(F.col("split").isin("train", "valid")).write.partitionBy("split").parquet(path)
    stored = pairs.sparkSession.read.schema(pairs.schema).parquet(path).select(*(F.col(f"`{c}`") for c in pairs.columns))
    for split, what in (("train", "Training set"), ("valid", "Validation set")):
        require_rows(stored.where(F.col("split") == split), what)
    return stored


def _byte_ids(max_length: int):
    """Arrow function: the first ``max_length - 1`` UTF-8 bytes of each text + 3, then
    EOS, worked out on the batch's buffers."""

    def run(texts: pa.Array) -> pa.Array:
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        size = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
        kept = np.minimum(np.diff(size), max_length - 1)
        ends = np.concatenate(([0], np.cumsum(kept + 1)))
        place = np.arange(ends[-1]) - np.repeat(ends[:-1], kept + 1)
        is_end = place == np.repeat(kept, kept + 1)
        out = np.full(ends[-1], EOS_ID, np.int32)
        out[~is_end] = data[(np.repeat(size[:-1], kept + 1) + place)[~is_end]].astype(np.int32) + BYTE_OFFSET
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(out))

    return F.arrow_udf(run, T.ArrayType(T.IntegerType()))


def byte_token_ids(text: Column, max_length: int) -> Column:
    """Token ids of ``text``: the first ``max_length - 1`` UTF-8 bytes + 3, then EOS."""
    return _byte_ids(max_length)(text.cast("string"))


def tokenize_pairs(
    df: DataFrame,
    *,
    source_field: str = "source_text",
    target_field: str = "target_text",
    max_source_length: int = 256,
    max_target_length: int = 256,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """``input_ids`` from the source field, ``labels`` from the target field; all
    other columns are dropped (except ``keep``)."""
    return df.select(
        *keep,
        byte_token_ids(F.col(source_field), max_source_length).alias("input_ids"),
        byte_token_ids(F.col(target_field), max_target_length).alias("labels"),
    )


def pad_labels(labels: Column, length: int) -> Column:
    """Right-pad labels with the ignore index to ``length`` (as a seq2seq collator does)."""
    pad = F.array_repeat(F.lit(IGNORE_INDEX), F.greatest(F.lit(length) - F.size(labels), F.lit(0)))
    return F.concat(labels, pad)


def restore_labels(labels: Column) -> Column:
    """Replace the ignore index by the pad id."""
    return F.transform(labels, lambda x: F.when(x == IGNORE_INDEX, F.lit(PAD_ID)).otherwise(x))


def _decode_batch(ids: pa.Array) -> pa.Array:
    """Bytes of the ordinary ids, cut out of the batch's values; only rows that are not
    valid UTF-8 are decoded one by one."""
    counts = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = pc.fill_null(pc.list_flatten(ids), -1).to_numpy(zero_copy_only=False)
    ordinary = (flat >= BYTE_OFFSET) & (flat < BYTE_OFFSET + 256)
    before = np.concatenate(([0], np.cumsum(ordinary)))
    ends = before[np.concatenate(([0], np.cumsum(counts)))]
    data = (flat[ordinary] - BYTE_OFFSET).astype(np.uint8)
    offsets = pa.py_buffer(ends.astype(np.int64).tobytes())
    raw = pa.Array.from_buffers(pa.large_binary(), len(counts), [None, offsets, pa.py_buffer(data.tobytes())])
    try:
        text = raw.cast(pa.large_string()).cast(pa.string())
    except pa.ArrowInvalid:
        text = pa.array([b.decode("utf-8", errors="ignore") for b in raw.to_pylist()], pa.string())
    return pc.if_else(pc.is_null(ids), pa.scalar(None, pa.string()), text)


_decode_udf = F.arrow_udf(_decode_batch, T.StringType())


def decode_ids(ids: Column) -> Column:
    """Text of byte-level ids, skipping special ids; invalid UTF-8 bytes are dropped."""
    return _decode_udf(ids)


def word_count(text: Column) -> Column:
    """``len(text.split())`` with Python's whitespace set."""
    c = collapse_ws(F.coalesce(text, F.lit("")))
    return F.when(c == "", F.lit(0)).otherwise(F.size(F.split(c, " ")))


def gen_len(predictions: DataFrame, col: str = "prediction") -> DataFrame:
    """Mean whitespace-token count of the stripped predictions, 0.0 when there are
    none, rounded to four decimals."""
    return predictions.agg(
        F.round(F.coalesce(F.avg(word_count(strip_ws(F.col(col))).cast("double")), F.lit(0.0)), 4).alias("gen_len")
    )


# The class without the space, whose doubling changes no token.
_PUNCT_13A = re.compile(RE_13A_PUNCT.replace(" -", "!-"))
_POINTS_13A = re.compile(r"[.,][.,]*")
_DASH_13A = re.compile(RE_13A_DASH)
_DIGITS = frozenset("0123456789")
_REPLACED_13A = (("<skipped>", ""), ("-\n", ""), ("\n", " "), ("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"))


def _points(m: re.Match) -> str:
    """What the rules for a period or comma after, then before, a non-digit make of a whole
    run of them.  The first rule takes two characters at a time, so the last of a run may
    stay with a digit behind it."""
    text, run = m.string, m[0]
    if text[m.end()] in _DIGITS and (text[m.start() - 1] in _DIGITS) == len(run) % 2:
        return f" {' '.join(run[:-1])} {run[-1]}" if len(run) > 1 else run
    return f" {' '.join(run)} "


def tokens_13a(text: str | None) -> list[str]:
    """Tokens of the 13a tokenizer."""
    x = (text or "").strip()
    for old, new in _REPLACED_13A:
        x = x.replace(old, new)
    x = _POINTS_13A.sub(_points, _PUNCT_13A.sub(r" \1 ", f" {x} "))
    return (_DASH_13A.sub(r"\1 \2 ", x) if "-" in x else x).split()


_STATS = ("sys_len", "ref_len", *(f"correct_{n}" for n in range(1, MAX_ORDER + 1)), *(f"total_{n}" for n in range(1, MAX_ORDER + 1)))


def _in_both(mine: list[tuple], theirs: list[tuple]) -> int:
    """The size of the intersection, as multisets."""
    a, b = set(mine), set(theirs)
    common = a & b
    if len(a) == len(mine) or len(b) == len(theirs):  # one side has no n-gram twice
        return len(common)
    n, m = Counter(mine), Counter(theirs)
    return sum(min(n[g], m[g]) for g in common)


def _pair_stats(prediction: str | None, reference: str | None) -> list[int]:
    hyp = tokens_13a(prediction)
    ref = hyp if prediction == reference else tokens_13a(reference)
    total = [max(len(hyp) - n, 0) for n in range(MAX_ORDER)]
    if hyp == ref:
        return [len(hyp), len(ref), *total, *total]
    # n-grams within a common beginning or end are in both as often; the rest is counted
    short = min(len(hyp), len(ref))
    head = next((i for i in range(short) if hyp[i] != ref[i]), short)
    tail = next((i for i in range(short - head) if hyp[-1 - i] != ref[-1 - i]), short - head)
    correct = []
    for n in range(MAX_ORDER):
        mine, theirs = (t[max(head - n, 0) : len(t) - tail + n] for t in (hyp, ref))
        same = _in_both(*(list(zip(*(t[k:] for k in range(n + 1)))) for t in (mine, theirs)))
        correct.append(max(head - n, 0) + max(tail - n, 0) + same)
    return [len(hyp), len(ref), *correct, *total]


def bleu_stats(pairs: DataFrame, pred_col: str = "prediction", ref_col: str = "reference") -> DataFrame:
    """Corpus n-gram statistics: one row with ``sys_len``, ``ref_len`` and
    ``correct_n`` / ``total_n`` for n = 1..4.

    Clipping is per pair, so a pair's statistics need no other row: each Arrow batch
    becomes one row of sums, and only those are aggregated.  No text and no n-gram
    crosses an exchange."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [_pair_stats(p, r) for p, r in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
            total = np.array(rows, np.int64).reshape(-1, len(_STATS)).sum(axis=0)
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in total.tolist()], names=list(_STATS))

    per_batch = pairs.select(F.col(pred_col).cast("string"), F.col(ref_col).cast("string")).mapInArrow(sums, ", ".join(f"{n} long" for n in _STATS))
    return per_batch.agg(*[F.coalesce(F.sum(n), F.lit(0)).cast("long").alias(n) for n in _STATS])


def bleu_score(stats: DataFrame) -> DataFrame:
    """BLEU from the one-row statistics: precisions with exponential smoothing,
    brevity penalty, geometric mean over n = 1..4; ``score`` and ``bp`` rounded to
    four decimals as the reference reports them."""
    precisions = []
    smooth = F.lit(1.0)
    for n in range(1, MAX_ORDER + 1):
        c, t = F.col(f"correct_{n}").cast("double"), F.col(f"total_{n}").cast("double")
        zero = (F.col(f"correct_{n}") == 0) & (F.col(f"total_{n}") > 0)
        smooth = F.when(zero, smooth * F.lit(2.0)).otherwise(smooth)
        p = (
            F.when(F.col(f"total_{n}") == 0, F.lit(0.0))
            .when(F.col(f"correct_{n}") == 0, F.lit(100.0) / (smooth * t))
            .otherwise(F.lit(100.0) * c / t)
        )
        precisions.append(p)
    logs = [F.when(p == 0, F.lit(LOG_ZERO)).otherwise(F.log(p)) for p in precisions]
    sys_len, ref_len = F.col("sys_len").cast("double"), F.col("ref_len").cast("double")
    bp = F.when(F.col("sys_len") >= F.col("ref_len"), F.lit(1.0)).when(
        F.col("sys_len") > 0, F.exp(F.lit(1.0) - ref_len / sys_len)
    ).otherwise(F.lit(0.0))
    mean_log = (logs[0] + logs[1] + logs[2] + logs[3]) / F.lit(float(MAX_ORDER))
    return stats.select(
        F.round(bp * F.exp(mean_log), 4).alias("score"),
        F.round(bp, 4).alias("bp"),
        "sys_len",
        "ref_len",
        *[F.col(f"correct_{n}") for n in range(1, MAX_ORDER + 1)],
        *[F.col(f"total_{n}") for n in range(1, MAX_ORDER + 1)],
        *[p.alias(f"precision_{i + 1}") for i, p in enumerate(precisions)],
    )


def corpus_bleu(pairs: DataFrame, pred_col: str = "prediction", ref_col: str = "reference") -> DataFrame:
    return bleu_score(bleu_stats(pairs, pred_col, ref_col))
