"""Language identification with a bidirectional gated recurrent network over bytes.

The network reads UTF-8 bytes in both directions, labels every position with a language
and is trained in numpy by backpropagation through time (Adam, cross-entropy at every
position).  A document's probabilities are the mean of its positions' probabilities, over
all bytes of the whole text, read in windows of ``Net.span`` bytes.

Training reads a bounded sample: about ``per_lang`` documents of each language (chosen by
a hash of id and text, alike on every run), four windows each.  Only these windows, a few
hundred KB per language, reach the driver.

Null texts and texts without a letter get ``und`` and score 0.  So does every text if
there is no labelled row to learn from.  Repeated rows get equal results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.llm.common import free_name, in_fold, others

UNKNOWN = "und"


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


@dataclass
class Net:
    """Weights; the first axis is the direction (forward, backward)."""

    langs: list[str]
    emb: np.ndarray  # 2, 3H, 256: what each byte adds to the gates
    rec: np.ndarray  # 2, 2H, H: update and reset gates
    cand: np.ndarray  # 2, H, H: candidate state
    out: np.ndarray  # 2, C, H
    bias: np.ndarray  # C
    span: int = 128

    @classmethod
    def new(cls, langs: list[str], hidden: int, span: int, rng: np.random.Generator) -> Net:
        def init(*shape):
            return (rng.normal(size=shape) / np.sqrt(shape[-1])).astype(np.float32)

        emb = rng.normal(size=(2, 3 * hidden, 256)).astype(np.float32) * 0.3
        return cls(langs, emb, init(2, 2 * hidden, hidden), init(2, hidden, hidden), init(2, len(langs), hidden), np.zeros(len(langs), np.float32), span)

    def params(self) -> list[np.ndarray]:
        return [self.emb, self.rec, self.cand, self.out, self.bias]

    def steps(self, x: np.ndarray, keep: list | None = None) -> np.ndarray:
        """x: (2, T, B) bytes, the second one reversed.  Returns (2, T, C, B) logits and
        puts what the backward pass needs into ``keep``."""
        _, span, batch = x.shape
        hid = self.rec.shape[2]
        h = np.zeros((2, hid, batch), np.float32)
        logits = np.empty((2, span, len(self.langs), batch), np.float32)
        g = np.empty((2, 3 * hid, batch), np.float32)
        for t in range(span):
            for d in (0, 1):
                np.take(self.emb[d], x[d, t], axis=1, out=g[d], mode="clip")
            gate = self.rec @ h
            gate += g[:, : 2 * hid]
            gate *= 0.5
            np.tanh(gate, out=gate)
            gate *= 0.5
            gate += 0.5
            z, r = gate[:, :hid], gate[:, hid:]
            rh = r * h
            c = self.cand @ rh
            c += g[:, 2 * hid :]
            np.tanh(c, out=c)
            if keep is not None:
                keep.append((h, z, r, rh, c))
            new = c - h
            new *= z
            new += h
            h = new
            np.matmul(self.out, h, out=logits[:, t])
        return logits

    def label(self, data: np.ndarray, lens: np.ndarray) -> np.ndarray:
        """data: (B, T) bytes, zero beyond ``lens``.  Sums over positions of the label
        probabilities: (B, C)."""
        batch, span = data.shape
        at = np.arange(span)[:, None]
        back = np.clip(lens[None, :] - 1 - at, 0, None)  # (T, B): position read at a step
        fwd = np.ascontiguousarray(data.T)
        full = bool((lens == span).all())
        rev = fwd[::-1] if full else np.take_along_axis(fwd, back, axis=0)
        both = self.steps(np.stack([fwd, rev]))
        other = both[1][::-1] if full else np.take_along_axis(both[1], back[:, None, :], axis=0)
        p = both[0] + other
        p += self.bias[:, None]
        p -= p.max(axis=1, keepdims=True)
        np.exp(p, out=p)
        p /= p.sum(axis=1, keepdims=True)
        if not full:
            p *= (at < lens[None, :])[:, None, :]
        return p.sum(axis=0).T

    def texts(self, texts: list[str | None], block: int = 2048) -> np.ndarray:
        """Mean position probabilities of each text: (n, C); zero for an empty one."""
        raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        total = np.zeros((len(raw), len(self.langs)))
        starts, lens, owner = [], [], []
        base = 0
        for i, r in enumerate(raw):
            s = np.arange(0, len(r), self.span)
            starts.append(s + base)
            lens.append(np.minimum(len(r) - s, self.span))
            owner.append(np.full(len(s), i))
            base += len(r)
        buf = np.frombuffer(b"".join(raw) + bytes(self.span), np.uint8)
        starts, lens, owner = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (starts, lens, owner))
        order = np.argsort(lens < self.span, kind="stable")  # full windows first
        at = np.arange(self.span)
        for k in range(0, len(order), block):
            pick = order[k : k + block]
            data = buf[starts[pick][:, None] + at]
            n = lens[pick]
            if n.min() < self.span:
                data = data * (at < n[:, None]).astype(np.uint8)
            np.add.at(total, owner[pick], self.label(data, n))
        return total / np.maximum(np.array([len(r) for r in raw]), 1)[:, None]


def gradients(net: Net, data: np.ndarray, lens: np.ndarray, y: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean cross-entropy over all positions and its gradients, by backpropagation
    through time."""
    batch, span = data.shape
    hid = net.rec.shape[2]
    at = np.arange(span)[:, None]
    back = np.clip(lens[None, :] - 1 - at, 0, None)
    fwd = np.ascontiguousarray(data.T)
    x = np.stack([fwd, np.take_along_axis(fwd, back, axis=0)])
    keep: list = []
    both = net.steps(x, keep)
    p = both[0] + np.take_along_axis(both[1], back[:, None, :], axis=0) + net.bias[:, None]
    p -= p.max(axis=1, keepdims=True)
    p = np.exp(p)
    p /= p.sum(axis=1, keepdims=True)
    mask = (at < lens[None, :]).astype(np.float32)
    n = float(mask.sum())
    loss = float(-(np.log(np.maximum(p[:, y, np.arange(batch)], 1e-9)) * mask).sum() / n)
    p[:, y, np.arange(batch)] -= 1
    dl = p * (mask / n)[:, None, :]  # (T, C, B) in order of position
    dlogits = np.stack([dl, np.take_along_axis(dl, back[:, None, :], axis=0) * mask[:, None, :]])
    g_emb, g_rec, g_cand, g_out = (np.zeros_like(a) for a in (net.emb, net.rec, net.cand, net.out))
    g_bias = dl.sum(axis=(0, 2))
    dh = np.zeros((2, hid, batch), np.float32)
    out_t, rec_t, cand_t = (np.ascontiguousarray(a.transpose(0, 2, 1)) for a in (net.out, net.rec, net.cand))
    dgs = np.empty((2, 3 * hid, span, batch), np.float32)
    for t in range(span - 1, -1, -1):
        h, z, r, rh, c = keep[t]
        now = h + z * (c - h)
        g_out += dlogits[:, t] @ now.transpose(0, 2, 1)
        dh = dh + out_t @ dlogits[:, t]
        dc = dh * z * (1 - c * c)
        drh = cand_t @ dc
        dgate = np.concatenate([dh * (c - h) * z * (1 - z), drh * h * r * (1 - r)], axis=1)
        g_cand += dc @ rh.transpose(0, 2, 1)
        g_rec += dgate @ h.transpose(0, 2, 1)
        dgs[:, : 2 * hid, t], dgs[:, 2 * hid :, t] = dgate, dc
        dh = dh * (1 - z) + drh * r + rec_t @ dgate
    for d in (0, 1):
        flat, cols = x[d].reshape(-1), dgs[d].reshape(3 * hid, -1)
        for k in range(3 * hid):
            g_emb[d, k] = np.bincount(flat, weights=cols[k], minlength=256)
    return loss, [g_emb, g_rec, g_cand, g_out, g_bias]


def fit(langs: list[str], data: np.ndarray, lens: np.ndarray, y: np.ndarray, hidden: int = 12, steps: int = 300, batch: int = 192, rate: float = 0.02, seed: int = 7, span: int = 128) -> Net:
    """Adam over balanced batches of windows."""
    rng = np.random.default_rng(seed)
    net = Net.new(langs, hidden, span, rng)
    m, v = ([np.zeros_like(p) for p in net.params()] for _ in range(2))
    pools = [np.flatnonzero(y == k) for k in range(len(langs))]
    for step in range(1, steps + 1):
        cls = rng.integers(0, len(langs), batch)
        pick = np.array([pools[k][rng.integers(0, len(pools[k]))] for k in cls])
        _, grads = gradients(net, data[pick], lens[pick], y[pick])
        norm = np.sqrt(sum(float((g.astype(np.float64) ** 2).sum()) for g in grads))
        lr = rate * min(1.0, 3 * (1 - step / (steps + 1)))
        for p, g, a, b in zip(net.params(), grads, m, v, strict=True):
            g = g / max(1.0, norm)
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            p -= (lr * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return net


def sample_windows(docs: DataFrame, id_col: str, text: str, lang: str, allowed: Column, per_lang: int, width: int, each: int = 4):
    """(langs, windows, lengths, labels) of the training sample."""
    rows = docs.where(allowed & F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}")).select(F.col(lang).alias("y"), F.col(text).alias("t"), F.xxhash64(F.col(id_col).cast("string"), F.length(text)).alias("h"))
    counts = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    langs = sorted(counts)
    if not langs:
        return [], None, None, None
    share = F.create_map(*(x for k in langs for x in (F.lit(k), F.lit(min(1.0, per_lang / counts[k])))))
    drawn = rows.where((F.pmod("h", F.lit(1 << 20)) / float(1 << 20)) < share[F.col("y")])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ys, ws = [], []
            for y, t, h in zip(*(b.column(c).to_pylist() for c in ("y", "t", "h")), strict=True):
                raw = t.encode("utf-8", "surrogatepass")
                rng = np.random.default_rng(h & 0x7FFFFFFF)
                for s in rng.integers(0, max(1, len(raw) - width + 1), each) if len(raw) > width else [0]:
                    ys.append(y)
                    ws.append(raw[s : s + width])
            yield pa.RecordBatch.from_arrays([pa.array(ys, pa.string()), pa.array(ws, pa.binary())], names=["y", "w"])

    # rows that repeat give windows that repeat: one of each is enough, however many there are
    got = sorted((r["y"], bytes(r["w"])) for r in drawn.mapInArrow(cut, "y string, w binary").distinct().collect())
    langs = sorted({y for y, _ in got}) or langs
    if not got:
        return [], None, None, None
    data = np.zeros((len(got), width), np.uint8)
    for i, (_, w) in enumerate(got):
        data[i, : len(w)] = np.frombuffer(w, np.uint8)
    return langs, data, np.array([len(w) for _, w in got]), np.array([langs.index(y) for y, _ in got])


def train(docs: DataFrame, allowed: Column, id_col: str = "doc_id", text: str = "text", lang: str = "lang", per_lang: int = 700, width: int = 64, **kw) -> Net | None:
    """Fit on the rows where ``allowed``; None if there is nothing to learn from."""
    langs, data, lens, y = sample_windows(docs, id_col, text, lang, allowed, per_lang, width)
    return fit(langs, data, lens, y, **kw) if langs else None


def identify(docs: DataFrame, net: Net | None, text: str = "text", pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` with the predicted language and its pooled probability, which replace
    columns of these names."""
    kept = others(docs, [pred, score])
    names = kept.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t if has_letter(t) else None for t in b.column(text).to_pylist()]
            if net is None:
                preds, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
            else:
                p = net.texts(texts)
                best = p.argmax(axis=1)
                preds = [net.langs[k] if t is not None else UNKNOWN for t, k in zip(texts, best.tolist(), strict=True)]
                scores = [float(min(1.0, q[k])) if t is not None else 0.0 for t, q, k in zip(texts, p, best.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(preds, pa.string()), pa.array(scores, pa.float64())], names=[*names, pred, score])

    return docs.mapInArrow(run, T.StructType(kept.fields).add(pred, "string").add(score, "double"))


def keep_identified(docs: DataFrame, allowed: Column, min_score: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that have a language, in its columns: rejects texts without
    a letter and those whose best language has a pooled probability below ``min_score``."""
    net = train(docs, allowed)
    pred, score = free_name(docs, "lang_pred_of_row"), free_name(docs, "lang_score_of_row")
    rows = identify(docs, net, pred=pred, score=score)
    ok = F.col(pred) != UNKNOWN if net is not None else F.lit(True)
    return rows.where(ok & (F.col(score) >= (min_score if net is not None else 0.0))).select(*docs.columns)


def op6_langid(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    held = in_fold(F.col("doc_id"), 4, 2)
    net = train(docs, ~held)
    return identify(docs.select("doc_id", held.alias("held_out"), "text"), net).drop("text").select("doc_id", "held_out", "lang_pred", "score")
