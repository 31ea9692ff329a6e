"""Weakly supervised toxicity scores.

0. *Families.*  A sampled row counts 1/m where m rows of the sample share a minimum of
   its hashed word shingles (the largest m of four hash functions), so that many copies
   of one text do not pass for evidence.
1. *Terms.*  Words and word beginnings that labelled toxic texts hold far more often than
   labelled clean ones are mined with Spark aggregates from a bounded, documented sample
   of the allowed labelled rows (``max_toxic`` and ``max_clean`` rows, chosen by hash).
2. *Voters.*  Each lexicon voter holds every G-th mined term of one kind and votes toxic
   if the text has one of them; pattern voters look at surface forms (shouting,
   exclamation runs, second-person address, long repeats, masked letters); a further voter
   is the label itself.
3. *Label model.*  A generative model with a hidden class estimates by expectation
   maximisation how often each voter votes toxic in either class (its accuracies).  The
   voters' correlations given the class are estimated from the residuals of the same
   posteriors, and a voter's evidence is divided by the number of voters that it repeats.
4. *Classifier.*  A linear (logistic) classifier over term presence is fitted to the
   posterior labels and scores every text.

Only word-level features of a text enter a score.  Null texts count as empty; an empty text gets
the classifier's intercept; without toxic and clean training rows every score is 0.
Repeated rows get equal scores.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.llm.common import checkpoint, free_name, in_fold, others

WORD = re.compile(r"[^\W\d_]+")
KINDS = (0, 4, 5, 6)  # whole words, and beginnings of so many letters
GROUPS = 6  # lexicon voters of a kind
PATTERNS = tuple(
    re.compile(p)
    for p in (
        r"!!+",
        r"\?!|!\?",
        r"\b[A-Z]{4,}\b.*\b[A-Z]{4,}\b",
        r"(?i)\b(?:you|your|you're|tu|vous|du|dich|ihr|usted)\b",
        r"(.)\1{4,}",
        r"\w[*#@$%]{2,}\w?",
        r"(?i)\b(?:hate|kill|die|shut)\b",
    )
)


def term_sets(text: str | None) -> list[set[str]]:
    """The distinct terms of each kind."""
    words = set(WORD.findall((text or "").lower()))
    return [words if not k else {w[:k] for w in words if len(w) >= k} for k in KINDS]


def _votes(text: str | None) -> list[int]:
    return [int(p.search(text or "") is not None) for p in PATTERNS]


@dataclass
class Scorer:
    terms: list[dict[str, float]]  # weight of each term, by kind
    bias: float

    def __call__(self, text: str | None) -> float:
        total = self.bias
        for weights, have in zip(self.terms, term_sets(text), strict=True):
            for t in weights.keys() & have:
                total += weights[t]
        return float(1 / (1 + np.exp(-np.clip(total, -60, 60))))


def label_model(votes: np.ndarray, prior: float, weight: np.ndarray, start: np.ndarray, rounds: int = 50):
    """Posterior of the hidden class of each row of 0/1 ``votes`` (rows with ``weight``),
    with the voters' rates by class and the correlations used.  ``start``: first
    posteriors."""
    post = start.astype(float)
    share = np.ones(votes.shape[1])
    rates = np.zeros((2, votes.shape[1]))
    corr = np.eye(votes.shape[1])
    for _ in range(rounds):
        by = np.stack([(1 - post) * weight, post * weight])
        rates = (by @ votes + 0.01) / (by.sum(axis=1, keepdims=True) + 0.5)
        rates = np.clip(rates, 1e-4, 1 - 1e-4)
        res = np.zeros((votes.shape[1],) * 2)
        for c in (0, 1):  # what the class leaves unexplained
            r = votes - rates[c]
            res += (r * by[c][:, None]).T @ r
        sd = np.sqrt(np.maximum(np.diag(res), 1e-9))
        corr = np.abs(res / sd[:, None] / sd[None, :])
        share = 1 / np.maximum(1.0, np.where(corr > 0.2, corr, 0).sum(axis=1))
        ratio = np.log(rates[1] / rates[0]) * votes + np.log((1 - rates[1]) / (1 - rates[0])) * (1 - votes)
        logit = np.log(prior / (1 - prior)) + ratio @ share
        new = 1 / (1 + np.exp(-np.clip(logit, -50, 50)))
        if np.abs(new - post).max() < 1e-6:
            break
        post = new
    return post, rates, corr


def logistic(rows: np.ndarray, cols: np.ndarray, shape: tuple[int, int], y: np.ndarray, weight: np.ndarray, l2: float = 0.003, steps: int = 400, rate: float = 0.1):
    """Weights and intercept of a logistic regression on the 0/1 matrix with ones at
    (rows, cols), soft labels ``y``; Adam on the full gradient."""
    w, b = np.zeros(shape[1]), float(np.log(max(np.average(y, weights=weight), 1e-4) / max(1 - np.average(y, weights=weight), 1e-4)))
    m, v = np.zeros(shape[1] + 1), np.zeros(shape[1] + 1)
    total = weight.sum()
    for step in range(1, steps + 1):
        z = np.bincount(rows, weights=w[cols], minlength=shape[0]) + b
        err = (1 / (1 + np.exp(-np.clip(z, -50, 50))) - y) * weight / total
        g = np.concatenate([np.bincount(cols, weights=err[rows], minlength=shape[1]) + l2 * w / shape[1], [err.sum()]])
        m += 0.1 * (g - m)
        v += 0.01 * (g * g - v)
        d = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-10)
        w -= d[:-1]
        b -= d[-1]
    return w, float(b)


def training_rows(docs: DataFrame, labels: DataFrame, allowed: Column, max_toxic: int, max_clean: int) -> tuple[DataFrame, dict[int, float]]:
    """(text, toxic) of the bounded sample, and the weight of a row of each class.
    ``labels``: doc_id, toxic; ids are compared as they are, null ids match nothing.  Of
    several labels of an id the largest counts."""
    lab = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")).where(allowed)
    n = {r["toxic"]: r["n"] for r in lab.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    most = {1: max_toxic, 0: max_clean}
    share = {c: min(1.0, most[c] / n[c]) if n.get(c) else 0.0 for c in (0, 1)}
    u = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("sample")), F.lit(1 << 20)) / float(1 << 20)
    drawn = lab.where(u < F.when(F.col("toxic") == 1, F.lit(share[1])).otherwise(F.lit(share[0])))
    # at most max_toxic + max_clean ids, but for the hash's spread: small enough to send;
    # one text an id, however many rows repeat it
    rows = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    return rows.select("text", "toxic"), {c: 1 / share[c] if share[c] else 0.0 for c in (0, 1)}


def families(text: str | None, words: int = 3, hashes: int = 4) -> list[int]:
    """Minima of ``hashes`` hash functions over the text's word shingles."""
    toks = (text or "").lower().split()
    grams = {" ".join(toks[i : i + words]) for i in range(max(1, len(toks) - words + 1))}
    h = np.fromiter((xxhash.xxh64_intdigest(g) for g in grams), np.uint64, len(grams))
    odd = np.random.default_rng(3).integers(0, 1 << 63, hashes, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return [int((h * a).min() >> np.uint64(1)) for a in odd]


def with_weight(rows: DataFrame) -> DataFrame:
    """The sample with ``w``: one over the size of a row's family."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = [families(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(keys, pa.list_(pa.int64()))], names=["text", "toxic", "keys"])

    keyed = checkpoint(rows.mapInArrow(run, "text string, toxic int, keys array<long>"))
    seen: Counter = Counter()
    for r in keyed.select("keys").collect():  # four numbers a sampled row
        seen.update(enumerate(r["keys"]))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            w = [1.0 / max(seen[x] for x in enumerate(k)) for k in b.column("keys").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("text"), b.column("toxic"), pa.array(w, pa.float64())], names=["text", "toxic", "w"])

    return keyed.mapInArrow(weigh, "text string, toxic int, w double")


def mine(rows: DataFrame, least: float, top: int) -> list[list[str]]:
    """By kind, the terms that tell toxic from clean rows best (toxic rows times log ratio of shares)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pos: Counter = Counter()
        neg: Counter = Counter()
        for b in batches:
            for text, y, w in zip(*(b.column(c).to_pylist() for c in ("text", "toxic", "w")), strict=True):
                into = pos if y else neg
                for k, have in enumerate(term_sets(text)):
                    for t in have:
                        into[k, t] += w
            if len(pos) + len(neg) > 2_000_000:
                yield pack(pos, neg)
        yield pack(pos, neg)

    def pack(pos, neg):
        keys = list(pos.keys() | neg.keys())
        cols = [pa.array([k for k, _ in keys], pa.int32()), pa.array([t for _, t in keys], pa.string())]
        cols += [pa.array([float(c[x]) for x in keys], pa.float64()) for c in (pos, neg)]
        pos.clear()
        neg.clear()
        return pa.RecordBatch.from_arrays(cols, names=["kind", "term", "p", "n"])

    size = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.sum("w").alias("n")).collect()}
    n1, n0 = size.get(1, 0), size.get(0, 0)
    if not n1 or not n0:
        return []
    terms = rows.mapInArrow(count, "kind int, term string, p double, n double").groupBy("kind", "term").agg(F.sum("p").alias("p"), F.sum("n").alias("n"))
    p, n = F.col("p"), F.col("n")
    share = n1 / (n1 + n0)

    def part(x, expected):
        return F.when(x > 0, x * F.log(x / expected)).otherwise(0.0)

    g = 2 * (part(p, (p + n) * share) + part(n, (p + n) * (1 - share)))
    best = terms.where(p > (p + n) * share).withColumn("s", g).where(F.col("s") >= least)
    out: list[list[str]] = [[] for _ in KINDS]
    for r in best.orderBy(F.desc("s"), "kind", "term").limit(top).collect():
        out[r["kind"]].append(r["term"])
    return out


def fit(docs: DataFrame, labels: DataFrame, allowed: Column, max_toxic: int = 2500, max_clean: int = 5000, top: int = 2000, least: float = 24.0) -> Scorer | None:
    """Mine terms, run the label model, fit the classifier.  None without both classes."""
    rows, scale = training_rows(docs, labels, allowed, max_toxic, max_clean)
    rows = checkpoint(with_weight(rows))
    lex = mine(rows, least, top)
    if not any(lex):
        return None
    index, voter = {}, {}
    for k, terms in enumerate(lex):
        for i, t in enumerate(terms):
            index[(k, t)] = len(index)
            voter[(k, t)] = k * GROUPS + i % GROUPS
    kinds = [set(x) for x in lex]
    n_lex = len(KINDS) * GROUPS

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            feats, votes = [], []
            for text in b.column("text").to_pylist():
                hits = [(k, t) for k, have in enumerate(term_sets(text)) for t in kinds[k] & have]
                feats.append(sorted(index[h] for h in hits))
                lexical = {voter[h] for h in hits}
                votes.append([*(int(j in lexical) for j in range(n_lex)), *_votes(text)])
            yield pa.RecordBatch.from_arrays([b.column("toxic"), b.column("w"), pa.array(feats, pa.list_(pa.int32())), pa.array(votes, pa.list_(pa.int8()))], names=["toxic", "w", "feats", "votes"])

    # bounded by the sample: max_toxic + max_clean rows of a few numbers
    got = rows.mapInArrow(encode, "toxic int, w double, feats array<int>, votes array<tinyint>").collect()
    got.sort(key=lambda r: (r["toxic"], r["feats"], r["votes"], r["w"]))
    label = np.array([r["toxic"] for r in got])
    weight = np.where(label == 1, scale[1], scale[0]) * np.array([r["w"] for r in got])
    votes = np.array([r["votes"] for r in got], float)
    prior = float(np.clip(np.average(label, weights=weight), 0.005, 0.5))
    start = np.where(label == 1, 0.9, 0.1 * prior)
    post, _, _ = label_model(np.column_stack([votes, label]), prior, weight, start)
    cols = np.array([f for r in got for f in r["feats"]], np.int64)
    at = np.repeat(np.arange(len(got)), [len(r["feats"]) for r in got])
    w, b = logistic(at, cols, (len(got), len(index)), post, weight)
    by_kind: list[dict[str, float]] = [{} for _ in KINDS]
    for (k, t), i in index.items():
        by_kind[k][t] = float(w[i])
    return Scorer(by_kind, b)


def score(docs: DataFrame, scorer: Scorer | None, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with each text's score, which replaces a column of that name."""
    kept = others(docs, [out])
    names = kept.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = [scorer(t) if scorer else 0.0 for t in b.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(s, pa.float64())], names=[*names, out])

    return docs.mapInArrow(run, T.StructType(kept.fields).add(out, "double"))


def drop_toxic(docs: DataFrame, labels: DataFrame, allowed: Column, limit: float = 0.3) -> DataFrame:
    """The rows of ``docs`` scored below ``limit``, in its columns."""
    out = free_name(docs, "toxicity_of_row")
    return score(docs, fit(docs, labels, allowed), out=out).where(F.col(out) < limit).select(*docs.columns)


def op2_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    held = in_fold(F.col("doc_id"), 4, 2)
    scorer = fit(docs, labels, ~held)
    rows = score(docs.select("doc_id", held.alias("held_out"), "text"), scorer).drop("text")
    return rows.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))
