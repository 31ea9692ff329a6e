"""Hierarchical Pitman-Yor language model: word pairs, words, base measure.

Every word (or the boundary of texts) u that precedes a token has a restaurant whose
customers are the training tokens after it; each of its tables sends a customer to the
root restaurant, which all contexts share as their parent, and whose tables draw from the
base measure H (half of its mass on the unknown token, the rest even over the training
vocabulary).  Seating is sampled by blocked Gibbs sweeps: a sweep takes the customers of
one dish out of a restaurant and seats them one after another given the other dishes'
tables; a customer opens a table with probability proportional to (strength + discount *
tables) * P(dish).  Dishes are handled side by side: the tables of the other dishes and
the parent's probabilities are those of the sweep before.  (Dishes with many customers
are seated in strides of an eighth of those seated.)  Table counts are averaged over the
sweeps after burn-in.  The predictive probability is linear in them, so the averages give
the averaged predictive probability, which sums to one over the vocabulary and the
unknown token.

On Spark: tasks count pairs (context, token) in blocks of documents and send each block's
pairs, with their training counts, to shards by context, so a shard holds a row per pair
and block, not document; the rows per document go to the block's own place.  Contexts with
many tokens (at most ``8 * shards``, found by a first pass) are dealt over several shards
by token.  Before each sweep the words' owners sum the tables of tokens and of split
contexts over all shards and send them back, so a shard seats its restaurants as if it had
all of them, however many shards there are.  Then the words' counts and averaged tables
are summed in the same way by the owners, which seat the root restaurant.  Finally each
shard sends the pairs' probabilities to their blocks, which add up the documents' scores.
Nothing but two sums a shard and sweep, four sums and the list of frequent contexts
reaches the driver.  Every step can be repeated: blocks, seeds and orders are fixed.

Null texts count as empty: one end token.  Repeated rows are documents each.  Without
training rows every token is unknown and has H's share for it.
"""

from __future__ import annotations

import ctypes
import operator
import pickle
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import xxhash
import zstandard
from pyspark import RDD, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.llm.common import in_fold

SEATS, TABLES, REPLY, LONE, ASKED, NOW = range(6)
END = 0  # hash that stands for the boundary of texts
BLOCK_TOKENS = 1_500_000
PACKED_WORDS = 1 << 23  # places of words that fit a sort key of 64 bits with two of them
SCALE = 1 << 26  # log10 probabilities travel as whole multiples of its inverse
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


@dataclass(frozen=True)
class Model:
    discount: float = 0.8
    strength: float = 1.0
    root_discount: float = 0.7
    root_strength: float = 1.0
    unknown: float = 0.5  # mass of H on the unknown token
    burn_in: int = 2
    samples: int = 3
    shard_bytes: int = 20_000_000
    seed: int = 5


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _M1
    x = (x ^ (x >> np.uint64(29))) * _M2
    return x ^ (x >> np.uint64(32))


def tokens(text: str | None) -> np.ndarray:
    """Hashes of a text's words, A-Z in lower case, and the end token."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    h = np.fromiter((xxhash.xxh64_intdigest(w) for w in words), np.uint64, len(words))
    h[h == END] = 1
    return np.append(h, np.uint64(END))


# -- blobs: arrays, compressed by byte planes


def dump(*arrays: np.ndarray) -> bytes:
    z = zstandard.ZstdCompressor(level=1)
    parts = []
    for a in arrays:
        parts += [a.dtype.str[1:].encode().ljust(4), len(a).to_bytes(8, "little")]
        planes = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), -1).T if len(a) else ()
        for body in (z.compress(plane.tobytes()) for plane in planes):  # each with codes of its own
            parts += [len(body).to_bytes(8, "little"), body]
    return b"".join(parts)


def load(blob: bytes) -> list[np.ndarray]:
    z, at, out = zstandard.ZstdDecompressor(), 0, []
    while at < len(blob):
        kind = np.dtype(blob[at : at + 4].strip().decode())
        n = int.from_bytes(blob[at + 4 : at + 12], "little")
        at += 12
        raw = np.empty((n, kind.itemsize), np.uint8)
        for plane in range(kind.itemsize if n else 0):
            size = int.from_bytes(blob[at : at + 8], "little")
            raw[:, plane] = np.frombuffer(z.decompress(blob[at + 8 : at + 8 + size]), np.uint8)
            at += 8 + size
        out.append(raw.view(kind).reshape(n))
    return out


def deltas(x: np.ndarray) -> np.ndarray:
    return np.diff(x, prepend=np.uint64(0))


def run_deltas(x: np.ndarray, runs: np.ndarray) -> np.ndarray:
    """Steps within ascending runs of the given lengths; a run begins with its first value."""
    out, first = np.diff(x.astype(np.int64), prepend=0), np.cumsum(runs) - runs
    out[first] = x[first]
    return out.astype(np.uint32)


def run_sums(steps: np.ndarray, runs: np.ndarray) -> np.ndarray:
    """The values of ``run_deltas``."""
    runs, total = runs.astype(np.int64), np.cumsum(steps, dtype=np.int64)
    first = np.cumsum(runs) - runs
    return total - np.repeat(total[first] - steps[first], runs)


# -- blocks of documents


def blocks(rows: Iterator[tuple]) -> Iterator[tuple[list, np.ndarray, list[np.ndarray]]]:
    """(ids, training flags, token hashes) of runs of documents (id, text, train)."""
    ids, train, toks, size = [], [], [], 0
    for i, text, t in rows:
        ids.append(i)
        train.append(t)
        toks.append(tokens(text))
        size += len(toks[-1])
        if size >= BLOCK_TOKENS or len(ids) >= 1 << 18:
            yield ids, np.array(train, bool), toks
            ids, train, toks, size = [], [], [], 0
    if ids:
        yield ids, np.array(train, bool), toks


def give_back() -> None:
    """Return freed memory to the system: a worker is kept for later stages, and what its
    allocator holds on to would add up over them."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def count_block(toks: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """Distinct (context, token, document) with counts; words as places in a sorted
    vocabulary."""
    flat = np.concatenate(toks)
    doc = np.repeat(np.arange(len(toks), dtype=np.uint64), [len(t) for t in toks])
    vocab, w = np.unique(flat, return_inverse=True)
    w = w.astype(np.uint64)
    u = np.empty_like(w)
    u[1:] = w[:-1]
    u[0] = 0  # END is the smallest hash, so its place is 0; the token before a text is END
    if len(vocab) > PACKED_WORDS or len(toks) > 1 << 18:  # one text with more words than a packed key has room for
        order = np.lexsort((doc, w, u))
        u, w, doc = u[order], w[order], doc[order]
        first = np.flatnonzero(np.concatenate(([True], (u[1:] != u[:-1]) | (w[1:] != w[:-1]) | (doc[1:] != doc[:-1]))))
        return vocab, u[first], w[first], doc[first], np.diff(np.append(first, len(u)))
    key, n = np.unique(u << np.uint64(41) | w << np.uint64(18) | doc, return_counts=True)
    return vocab, key >> np.uint64(41), key >> np.uint64(18) & np.uint64((1 << 23) - 1), key & np.uint64((1 << 18) - 1), n


def shard_of(u: np.ndarray, w: np.ndarray, split: np.ndarray, shards: int) -> np.ndarray:
    """Shard of context hashes; a context split in k goes to k shards by its token."""
    step = mix(w ^ np.uint64(77)) % split
    return ((mix(u) + step * np.uint64(0x9E37)) % np.uint64(shards)).astype(np.int64)


def splits(words: np.ndarray, hot: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    out = np.ones(len(words), np.uint64)
    if len(hot[0]):
        at = np.minimum(np.searchsorted(hot[0], words), len(hot[0]) - 1)
        out = np.where(hot[0][at] == words, hot[1][at], out)
    return out


def cut_block(block: int, train: np.ndarray, toks: list[np.ndarray], hot, shards: int) -> tuple[list[tuple[int, bytes]], bytes]:
    """A block's distinct pairs with their training counts for the shards, and what stays
    with the block: the documents of each pair, pairs in the order in which they are sent."""
    vocab, u, w, doc, n = count_block(toks)
    first = np.flatnonzero(np.concatenate(([True], (u[1:] != u[:-1]) | (w[1:] != w[:-1]))))
    per = np.diff(np.append(first, len(u)))
    c = np.add.reduceat(n * train[doc.astype(np.int64)], first)
    u, w = u[first], w[first]
    at = shard_of(vocab[u], vocab[w], splits(vocab, hot)[u], shards)
    order = np.argsort(at, kind="stable")
    edges = np.searchsorted(at[order], np.arange(shards + 1))
    u, w, c, per = u[order], w[order], c[order], per[order]
    rows = np.repeat(first[order] - (np.cumsum(per) - per), per) + np.arange(len(doc))
    parts, runs = [], [np.zeros(0, np.uint32)]
    for s in np.flatnonzero(np.diff(edges)):
        pick = slice(edges[s], edges[s + 1])
        uu, many = np.unique(u[pick], return_counts=True)
        ww, wat = np.unique(w[pick], return_inverse=True)
        runs.append(many.astype(np.uint32))  # a context's tokens ascend
        parts.append((int(s), dump(np.array([block], np.int64), deltas(vocab[uu]), runs[-1], deltas(vocab[ww]), run_deltas(wat, many), c[pick].astype(np.uint32))))
    runs = np.concatenate(runs)
    return parts, dump(edges.astype(np.int64), runs, run_deltas(w, runs.astype(np.int64)), per.astype(np.uint32), doc[rows].astype(np.uint32), n[rows].astype(np.uint32))


def block_rows(block: int, ids: list, train: np.ndarray, toks: list[np.ndarray], hot, shards: int) -> Iterator[tuple[int, bytes]]:
    yield from cut_block(block, train, toks, hot, shards)[0]


def block_scores(own: bytes, replies: dict[int, bytes], docs: int, sums) -> tuple[np.ndarray, ...]:
    """Per document of a block: known tokens, base score and score."""
    edges, runs, w, per, doc, n = load(own)
    w = run_sums(w, runs)
    prob, c = np.zeros(len(w)), np.zeros(int(w.max(initial=0)) + 1, np.int64)
    for s, blob in replies.items():
        pick = slice(edges[s], edges[s + 1])
        prob[pick], c[np.unique(w[pick])] = load(blob)
    base = np.log10((c + 1) / (sums[0] + sums[1] + 1))
    return tuple(np.bincount(doc, n * np.repeat(x, per), docs) for x in (c[w] > 0, base[w], prob / SCALE))


# -- seating


def seat(c: np.ndarray, weight, discount: float, rng: np.random.Generator) -> np.ndarray:
    """Tables of dishes with ``c`` >= 1 customers, seated one after another;
    ``weight(i, t)``: weight of a new table for dishes ``i`` that have ``t`` tables."""
    t = (c > 0).astype(np.int64)
    live = np.flatnonzero(c > 1)
    m = 1
    while len(live):
        step = max(1, m // 8)
        a = weight(live, t[live])
        p = a / (a + np.maximum(m - discount * t[live], 1e-9))
        k = np.minimum(step, c[live] - m)
        t[live] += rng.binomial(k, p) if step > 1 else rng.random(len(live)) < p
        m += step
        live = live[c[live] > m]
    return t


def by_owner(vocab: np.ndarray, at: np.ndarray, shards: int) -> Iterator[tuple[int, np.ndarray]]:
    owner = (mix(vocab[at] ^ np.uint64(99)) % np.uint64(shards)).astype(np.int64)
    order = np.argsort(owner, kind="stable")
    edges = np.searchsorted(owner[order], np.arange(shards + 1))
    for o in np.flatnonzero(np.diff(edges)):
        yield int(o), at[order[edges[o] : edges[o + 1]]]


class Seats:
    """A shard's pairs with several customers between two sweeps.  The words that it
    exchanges sums of are these pairs' tokens and split contexts."""

    def __init__(self, blob: bytes, tables: bytes | None):
        h, split, self.u, self.w, c, self.lone = load(blob)
        self.vocab, self.split, self.c = np.cumsum(h, dtype=np.uint64), split > 0, c.astype(np.int64)
        self.t, self.total = (x.astype(np.int64) for x in load(tables)) if tables else (np.ones(len(self.c), np.int64), np.zeros(len(self.c), np.int64))

    def places(self, shards: int) -> list[tuple[int, np.ndarray]]:
        asked = self.split.copy()
        asked[self.w] = True
        return list(by_owner(self.vocab, np.flatnonzero(asked), shards))

    def words(self, shards: int) -> list[tuple[int, bytes]]:
        return [(o, dump(deltas(self.vocab[pick]))) for o, pick in self.places(shards)] or [(0, dump(np.zeros(0, np.uint64)))]

    def sums(self, shards: int) -> list[tuple[int, bytes]]:
        t_w, t_u = (np.bincount(x, self.t, len(self.vocab)).astype(np.uint32) for x in (self.w, self.u))
        t_u[~self.split] = 0
        return [(o, dump(t_w[pick], t_u[pick])) for o, pick in self.places(shards)] or [(0, dump(*[np.zeros(0, np.uint32)] * 2))]

    def sweep(self, number: int, sweep: int, replies: dict[int, bytes], shards: int, total: tuple[int, int], model: Model) -> bytes:
        """Seats the customers given all shards' tables; ``total``: tables, words that have some."""
        d, s = model.discount, model.strength
        tables, known = total
        t_w, t_u = np.zeros(len(self.vocab)), self.lone + np.bincount(self.u, self.t, len(self.vocab))
        for o, pick in self.places(shards):
            w, u = load(replies[o])
            t_w[pick] = w
            t_u[pick] = np.where(self.split[pick], u, t_u[pick])
        fresh = (model.root_strength + model.root_discount * known) * (1 - model.unknown) / max(1, known)
        p_w = (np.maximum(t_w - model.root_discount, 0) + fresh) / (model.root_strength + tables)
        others = t_u[self.u] - self.t
        p = p_w[self.w]
        self.t = seat(self.c, lambda i, now: (s + d * (others[i] + now)) * p[i], d, np.random.default_rng([model.seed, number, sweep]))
        if sweep >= model.burn_in:
            self.total += self.t
        return dump(self.t.astype(np.uint32), self.total.astype(np.uint32))


class Sums:
    """Tables of an owner's words over all shards in a sweep, from (shard, 0: lone tables
    or 1: words that it asks for, blob) and (shard, blob of these words' tables)."""

    def __init__(self, fixed: list[tuple[int, int, bytes]], now: list[tuple[int, bytes]]):
        parts = [(s, kind, load(blob)) for s, kind, blob in sorted(fixed, key=lambda x: x[:2])]
        now = {s: load(blob) for s, blob in now}
        hashes = [np.cumsum(x[0], dtype=np.uint64) for _, _, x in parts]
        self.words = np.unique(np.concatenate(hashes)) if hashes else np.zeros(0, np.uint64)
        self.t_w, self.t_u = (np.zeros(len(self.words), np.int64) for _ in range(2))
        self.asked = []
        for (s, kind, x), h in zip(parts, hashes, strict=True):
            at = np.searchsorted(self.words, h)
            t_w, t_u = now[s] if kind else x[1:]
            self.t_w[at] += t_w
            self.t_u[at] += t_u
            if kind:
                self.asked.append((s, at))

    def total(self) -> tuple[int, int]:
        return int(self.t_w.sum()), int((self.t_w > 0).sum())

    def replies(self) -> list[tuple[int, bytes]]:
        return [(s, dump(self.t_w[at], self.t_u[at])) for s, at in self.asked]


class Shard:
    """The restaurants of a shard, rebuilt from its blobs; ``tables``: what the sweeps
    made of them, empty before these."""

    def __init__(self, number: int, blobs: list[bytes], hot, model: Model, tables: bytes | None = None):
        parts = sorted((load(b) for b in blobs), key=lambda p: int(p[0][0]))
        words = [np.cumsum(p[i], dtype=np.uint64) for p in parts for i in (1, 3)]
        self.vocab = np.unique(np.concatenate(words)) if words else np.zeros(0, np.uint64)
        keys, self.blocks = [], []  # blocks: number, pairs, places of its tokens
        for k, p in enumerate(parts):
            u = np.repeat(np.searchsorted(self.vocab, words[2 * k]), p[2])
            tokens = np.searchsorted(self.vocab, words[2 * k + 1])
            keys.append(u.astype(np.uint64) << np.uint64(32) | tokens[run_sums(p[4], p[2])].astype(np.uint64))
            self.blocks.append((int(p[0][0]), len(u), tokens.astype(np.uint32)))
        n = np.concatenate([p[5] for p in parts])
        del parts, words
        order = np.argsort(key := np.concatenate(keys))
        del keys
        key = key[order]
        new = np.concatenate(([True], key[1:] != key[:-1]))
        first = np.flatnonzero(new)
        self.pair = np.empty(len(key), np.uint32)
        self.pair[order] = np.cumsum(new) - 1
        self.c = np.add.reduceat(n[order].astype(np.int64), first)
        del n, order
        self.u, self.w = (key[first] >> np.uint64(32)).astype(np.int64), (key[first] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        size = len(self.vocab)
        self.c_w = np.bincount(self.w, self.c, size)
        self.c_u = np.bincount(self.u, self.c, size)
        self.split = splits(self.vocab, hot) > 1
        self.many = np.flatnonzero(self.c > 1)
        if tables is None:  # the only shard
            tables = self.sample(number, model)
        if len(tables):
            self.t = (self.c > 0).astype(float)
            self.t[self.many] = load(tables)[1] / model.samples
            self.t_u = np.bincount(self.u, self.t, size)
            self.t_w = np.bincount(self.w, self.t, size)

    def sample(self, number: int, model: Model) -> bytes:
        """All sweeps of a shard that has every token."""
        blob, lone, _ = self.seats()
        seats, tables = Seats(blob, None), b""
        for sweep in range(model.burn_in + model.samples):
            owner = Sums([(0, 0, dump(*lone)), (0, 1, seats.words(1)[0][1])], [(0, seats.sums(1)[0][1])])
            tables = seats.sweep(number, sweep, dict(owner.replies()), 1, owner.total(), model)
        return tables

    def seats(self) -> tuple[bytes, list[np.ndarray], np.ndarray]:
        """For the sweeps: the pairs with several customers; and the words' tables that
        other pairs have for good, as (hashes, tables of the token, of a split context)."""
        size, one = len(self.vocab), (self.c == 1).astype(np.int64)
        t_w, t_u = (np.bincount(x, one, size).astype(np.uint32) for x in (self.w, self.u))
        u, w = self.u[self.many], self.w[self.many]
        used = np.unique(np.concatenate([u, w]))
        at = np.searchsorted(used, u), np.searchsorted(used, w)
        blob = dump(deltas(self.vocab[used]), self.split[used].astype(np.uint8), *(x.astype(np.uint32) for x in at), self.c[self.many].astype(np.uint32), t_u[used])
        part = np.where(self.split, t_u, 0).astype(np.uint32)
        lone = np.flatnonzero((t_w > 0) | (part > 0))
        return blob, [deltas(self.vocab[lone]), t_w[lone], part[lone]], lone

    def start(self, shards: int) -> Iterator[tuple[str, int, bytes]]:
        """The seats' blob, and the lone tables by owner."""
        blob, (_, t_w, part), lone = self.seats()
        yield "seats", 0, blob
        place = np.zeros(len(self.vocab), np.int64)
        place[lone] = np.arange(len(lone))
        for o, pick in self.by_owner(lone, shards):
            yield "lone", o, dump(deltas(self.vocab[pick]), t_w[place[pick]], part[place[pick]])

    def asked(self) -> np.ndarray:
        """Places of the words whose sums the shard needs: its tokens and split contexts."""
        need = np.zeros(len(self.vocab), bool)
        need[self.w] = True
        used = np.zeros(len(self.vocab), bool)
        used[self.u] = True
        return np.flatnonzero(need | (self.split & used))

    def requests(self, shards: int) -> Iterator[tuple[int, bytes]]:
        at = self.asked()
        for o, pick in self.by_owner(at, shards):
            part = np.where(self.split[pick], self.t_u[pick], 0).astype(np.float32)
            yield o, dump(deltas(self.vocab[pick]), self.c_w[pick].astype(np.uint32), self.t_w[pick].astype(np.float32), part)

    def by_owner(self, at: np.ndarray, shards: int) -> Iterator[tuple[int, np.ndarray]]:
        return by_owner(self.vocab, at, shards)

    def scores(self, replies: dict[int, bytes], shards: int, model: Model) -> Iterator[tuple[int, bytes]]:
        """(block, log10 probabilities of its pairs and training counts of their tokens)."""
        size = len(self.vocab)
        c, p, t_u = np.zeros(size), np.ones(size), self.t_u.copy()
        c_u = self.c_u.copy()
        for o, pick in self.by_owner(self.asked(), shards):
            counts, prob, tables = load(replies[o])
            c[pick], p[pick] = counts, prob
            hot = self.split[pick]
            t_u[pick[hot]], c_u[pick[hot]] = tables[hot], counts[hot]
        d, s = model.discount, model.strength
        seen = c_u[self.u] > 0
        back = np.where(seen, (s + d * t_u[self.u]) / (s + c_u[self.u]), 1.0)
        prob = np.where(self.c > 0, (self.c - d * self.t) / (s + c_u[self.u]), 0.0) + back * p[self.w]
        score = np.rint(np.log10(prob) * SCALE).astype(np.int32)
        at = 0
        for block, pairs, words in self.blocks:
            yield block, dump(score[self.pair[at : at + pairs]], c[words].astype(np.int64))
            at += pairs


class Owner:
    """The words of an owner, with their sums over the shards and the root's tables."""

    def __init__(self, number: int, asks: list[tuple[int, bytes]], model: Model):
        self.asks = []
        for s, blob in sorted(asks, key=lambda x: x[0]):
            h, c, t, part = load(blob)
            self.asks.append((s, np.cumsum(h, dtype=np.uint64), c, t, part))
        self.words = np.unique(np.concatenate([a[1] for a in self.asks]))
        self.c, self.t, self.t_u = (np.zeros(len(self.words)) for _ in range(3))
        for _, h, c, t, part in self.asks:
            at = np.searchsorted(self.words, h)
            self.c[at] += c
            self.t[at] += t
            self.t_u[at] += part
        rng = np.random.default_rng([model.seed, 1, number])
        customers = np.rint(self.t).astype(np.int64)
        fresh = model.root_discount * (1 - model.unknown)  # (strength + discount * tables) * H, as there are about as many tables as words
        self.tables = np.mean([seat(customers, lambda i, t: np.full(len(i), fresh), model.root_discount, rng) for _ in range(model.samples)], axis=0)

    def sums(self) -> list[float]:
        return [float(self.c.sum()), float((self.c > 0).sum()), float(self.t.sum()), float(self.tables.sum())]

    def replies(self, sums, model: Model) -> Iterator[tuple[int, bytes]]:
        _, vocab, customers, tables = sums
        back = model.root_strength + model.root_discount * tables
        h = np.where(self.c > 0, (1 - model.unknown) / max(vocab, 1.0), model.unknown if vocab else 1.0)
        p = (np.where(self.c > 0, self.t - model.root_discount * np.minimum(self.tables, self.t), 0) + back * h) / (model.root_strength + customers)
        if not vocab:
            p = h
        for s, words, *_ in self.asks:
            at = np.searchsorted(self.words, words)
            yield s, dump(self.c[at].astype(np.int64), p[at].astype(np.float64), self.t_u[at])


# -- the job


def frequent(docs: RDD, share: float) -> tuple[np.ndarray, np.ndarray]:
    """Words with at least ``share`` of all tokens, sorted by hash, and their shares.  Such
    a word has half that share in some block at least, so blocks list those only."""

    def run(rows):
        for _, _, toks in blocks(rows):
            h, n = np.unique(np.concatenate(toks), return_counts=True)
            big = n >= share * n.sum() / 2
            yield -1, int(n.sum())
            yield from zip(h[big].tolist(), n[big].tolist(), strict=True)
        give_back()

    counts = docs.mapPartitions(run).reduceByKey(operator.add)
    total = sum(counts.filter(lambda x: x[0] == -1).values().collect()) or 1
    # 1 / share words at most
    got = sorted((w, n / total) for w, n in counts.filter(lambda x: x[0] >= 0 and x[1] >= share * total).collect())
    return np.array([g[0] for g in got], np.uint64), np.array([g[1] for g in got])


def by_key(items) -> dict[int, list]:
    out = defaultdict(list)
    for k, v in items:
        out[k].append(v)
    return out


def hierarchical_scores(docs: DataFrame, model: Model = Model()) -> DataFrame:
    """Per row of ``docs`` (id, text, train): id, train, n_tokens, n_known, train_tokens,
    base_score and score, the latter two log10 probabilities."""
    spark = docs.sparkSession
    slim = docs.select("id", "text", F.coalesce("train", F.lit(False)).alias("train"))
    size = slim.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-size // model.shard_bytes))
    rows = slim.rdd
    words, share = frequent(rows, 1 / (8 * shards)) if shards > 1 else (np.zeros(0, np.uint64), np.zeros(0))
    hot = words, np.maximum(1, np.minimum(shards, np.ceil(share * 8 * shards))).astype(np.uint64)

    def pieces(part):
        base = TaskContext.get().partitionId() << 24
        for k, (ids, train, toks) in enumerate(blocks(part)):
            parts, own = cut_block(base + k, train, toks, hot, shards)
            for s, blob in parts:
                yield s, (0, 0, blob)
            yield owner_of_block(base + k), (1, base + k, pickle.dumps((ids, train, np.array([len(t) for t in toks]), own)))
        give_back()

    def place(k: int) -> int:
        return k

    def owner_of_block(block: int) -> int:
        return int(mix(np.array([block], np.uint64))[0] % np.uint64(shards))

    # kind 0: counts for a shard; kind 1: a block's documents, for whoever adds them up
    dealt = rows.mapPartitions(pieces).partitionBy(shards, place)

    def start(part):
        for s, items in by_key(x for x in part if x[1][0] != 1).items():
            blobs = [bytes(x[2]) for x in items if x[0] == 0]
            if blobs:
                for kind, o, blob in Shard(s, blobs, hot, model, b"").start(shards):
                    if kind == "lone":
                        yield o, (LONE, s, blob)
                        continue
                    yield s, (SEATS, s, blob)
                    for owner, words in Seats(blob, None).words(shards):
                        yield owner, (ASKED, s, words)
        give_back()

    # of a shard: SEATS, TABLES, REPLY; of an owner: LONE, ASKED, NOW
    fixed = dealt.mapPartitions(start).partitionBy(shards, place)
    state = fixed

    def seats_of(items) -> Seats | None:
        kept = {kind: blob for kind, _, blob in items if kind in (SEATS, TABLES)}
        return Seats(kept[SEATS], kept.get(TABLES)) if SEATS in kept else None

    def tell(part):
        for s, items in by_key(part).items():
            seats = seats_of(items)
            if seats:
                for o, blob in seats.sums(shards):
                    yield o, (NOW, s, blob)
        give_back()

    def sums_of(items) -> Sums:
        return Sums([(s, int(kind == ASKED), blob) for kind, s, blob in items if kind in (LONE, ASKED)], [(s, blob) for kind, s, blob in items if kind == NOW])

    def total_tables(part):
        for items in by_key(part).values():
            yield sums_of(items).total()

    def tell_back(part):
        for o, items in by_key(part).items():
            for s, blob in sums_of(items).replies():
                yield s, (REPLY, o, blob)

    def seat_all(sweep, both):
        def run(part):
            for s, items in by_key(part).items():
                seats = seats_of(items)
                if seats:
                    yield s, (TABLES, s, seats.sweep(s, sweep, {o: blob for kind, o, blob in items if kind == REPLY}, shards, both, model))
            give_back()

        return run

    for sweep in range(model.burn_in + model.samples):
        now = fixed.union(state.mapPartitions(tell).partitionBy(shards, place))
        both = tuple(map(sum, zip(*now.mapPartitions(total_tables).collect()))) or (0, 0)  # two numbers a shard
        back = now.mapPartitions(tell_back).partitionBy(shards, place)
        tables = state.union(back).mapPartitions(seat_all(sweep, both)).partitionBy(shards, place)
        state = fixed.union(tables)
    seated = dealt.union(tables.mapValues(lambda x: (3, x[1], x[2])))

    def shard(s, items):
        blobs = [bytes(x[2]) for x in items if x[0] == 0]
        return Shard(s, blobs, hot, model, next(x[2] for x in items if x[0] == 3)) if blobs else None

    def ask(part):
        for s, items in by_key(x for x in part if x[1][0] != 1).items():
            if here := shard(s, items):
                for o, blob in here.requests(shards):
                    yield o, (s, blob)
        give_back()

    asked = seated.mapPartitions(ask).partitionBy(shards, place)

    def add(part):
        for o, asks in by_key(part).items():
            yield Owner(o, asks, model).sums()

    sums = np.zeros(4)
    for row in asked.mapPartitions(add).collect():  # four numbers a shard
        sums += row
    sums = sums.tolist()

    def reply(part):
        for o, asks in by_key(part).items():
            for s, blob in Owner(o, asks, model).replies(sums, model):
                yield s, (2, o, blob)

    replied = asked.mapPartitions(reply).partitionBy(shards, place)

    def finish(part):
        for s, items in by_key(x for x in part if x[1][0] != 1).items():
            replies = {x[1]: x[2] for x in items if x[0] == 2}
            if here := shard(s, items):
                for block, blob in here.scores(replies, shards, model):
                    yield owner_of_block(block), (4, block, (s, blob))
        give_back()

    def total(part):
        kept = by_key((x[1], x[::2]) for _, x in part if x[0] in (1, 4))
        for _, rows in sorted(kept.items()):
            ids, train, n, own = pickle.loads(next(bytes(x) for kind, x in rows if kind == 1))
            known, base, score = block_scores(own, dict(x for kind, x in rows if kind == 4), len(ids), sums)
            for i, key in enumerate(ids):
                yield key, bool(train[i]), int(n[i]), int(known[i]), int(sums[0]), float(base[i]), float(score[i])
        give_back()

    answers = seated.union(replied).mapPartitions(finish).partitionBy(shards, place)
    scored = dealt.union(answers).mapPartitions(total)
    long, real = T.LongType(), T.DoubleType()
    fields = [("id", slim.schema["id"].dataType), ("train", T.BooleanType()), ("n_tokens", long), ("n_known", long), ("train_tokens", long), ("base_score", real), ("score", real)]
    return spark.createDataFrame(scored, T.StructType([T.StructField(n, k) for n, k in fields]), verifySchema=False)


def op5_pitman_yor(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held = in_fold(F.col("doc_id"), 7, 2)
    rows = hierarchical_scores(docs.select(F.col("doc_id").alias("id"), "text", (~held).alias("train")))
    return rows.select(F.col("id").alias("doc_id"), (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
