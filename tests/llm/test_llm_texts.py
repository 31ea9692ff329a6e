import hashlib
import math
import random
import time
from collections import Counter

import numpy as np
import zlib
import zstandard
from pyspark.sql import functions as F

from corpusmill.llm import compression as C
from corpusmill.llm import mixing as M
from corpusmill.llm import order_minhash as O
from corpusmill.llm import packing as P
from corpusmill.llm import pitman_yor as Y
from corpusmill.llm import wrapper as W
from corpusmill.llm.common import in_fold

DOCS = "doc_id long, text string, lang string, source string, n_chars long, part string, slot int, size string"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), "x", 1, "y") for i, t, s in rows], DOCS)


def prose(rng, n, v=400):
    return " ".join(f"w{min(int(rng.paretovariate(0.7)), v)}" for _ in range(n))


def sample(seed=1, n=40):
    rng = random.Random(seed)
    rows = [(i, prose(rng, rng.randint(1, 200)), f"s{i % 4}") for i in range(n)]
    return [*rows, (100, None, "s0"), (101, "", None), (102, rows[3][1], None), (102, rows[3][1], None), (103, "é " * 40_000, "s1")]


# -- Order MinHash


def brute_sketch(t):
    h = O.kmers(t)
    seen, num = Counter(), []
    for x in h.tolist():
        num.append((x >> 24, seen[x]))
        seen[x] += 1
    v = O._mix(np.array([a for a, _ in num], np.uint64) * O._ODD + np.array([b for _, b in num], np.uint64) * O._MIX2)
    out = []
    for m in O.MASKS:
        acc = np.zeros(1, np.uint64)
        for j, p in enumerate(np.sort(np.argsort(v ^ m)[: O.PICK])):
            acc = O._mix(acc * O._ODD + h[p] + np.uint64(j + 1))
        out.append(int(acc[0] >> np.uint64(32)))
    return np.array(out, np.uint32)


def test_sketch_picks_the_smallest_of_each_order():
    rng = random.Random(2)
    for t in ["a", "abc", "abcdefgh", "abcdefghi", "ab" * 90, "x" * 300, *(prose(rng, n) for n in (3, 30, 300))]:
        assert (O.sketch(t) == brute_sketch(t)).all()
    assert O.likeness(O.sketch(""), O.sketch(None)) == 1 and O.likeness(O.sketch(""), O.sketch("a")) == 0


def test_sketch_feels_order():
    rng = random.Random(3)
    words = [f"word{i}" for i in range(400)]
    rng.shuffle(words)
    a, moved = " ".join(words), " ".join([*words[200:], *words[:200]])
    one = " ".join([*words[:200], "other", *words[201:]])
    assert O.likeness(O.sketch(a), O.sketch(one)) > 0.85 > 0.75 > O.likeness(O.sketch(a), O.sketch(moved))


def test_edits_use_the_next_document(spark, monkeypatch):
    rows = sample()
    d = docs(spark, rows)
    ordered = sorted(rows, key=lambda r: r[0])
    monkeypatch.setattr(O.ranges, "__defaults__", (5_000,))  # many ranges
    for frame in (d, d.repartition(7)):
        got = sorted(frame.transform(O.fingerprint_edits).collect(), key=lambda r: r["doc_id"])
        assert len(got) == len(rows)
        for k, (r, (i, t, _)) in enumerate(zip(got, ordered)):
            t, nxt = t or "", ordered[(k + 1) % len(ordered)][1] or ""
            q = len(t) // 4
            new = t[: len(t) - q] + nxt[:q]
            assert r["doc_id"] == i and r["n_chars"] == len(t)
            assert r["edited_sha256"] == hashlib.sha256(new.encode()).hexdigest()
            assert r["fingerprint"] == O.as_text(O.sketch(t)) and r["edited_fingerprint"] == O.as_text(O.sketch(new))
            assert r["near_edited"] == O.likeness(O.sketch(t), O.sketch(new)) and r["near_next"] == O.likeness(O.sketch(t), O.sketch(nxt))


def test_edits_of_few_rows(spark):
    assert O.fingerprint_edits(docs(spark, [])).count() == 0
    one = O.fingerprint_edits(docs(spark, [(None, "abcdefgh", "s")])).collect()
    assert one[0]["edited_sha256"] == hashlib.sha256(b"abcdefab").hexdigest() and one[0]["near_next"] == 1.0
    two = O.fingerprint_edits(docs(spark, [(5, "abcd" * 9, "s"), (None, "wxyz" * 9, "s")])).orderBy("doc_id").collect()
    assert two[0]["edited_sha256"] == hashlib.sha256((("wxyz" * 9)[:27] + "abcdabcda").encode()).hexdigest()


# -- compression


def brute_counts(text):
    t = text or ""
    w = [x for x in t.encode().split()]
    win = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    cover = {i + k for i in range(len(w) - 2) if win[tuple(w[i : i + 3])] > 1 for k in range(3)}
    lines = t.split("\n")
    dup = sum(1 for i, x in enumerate(lines) if x.encode().split() and x in lines[:i])
    return len(w), sum(len(x.decode()) for x in w), sum(t.count(c) for c in "#*$%&|<>"), dup, len(cover)


def test_counts_and_verdicts(spark):
    rng = random.Random(4)
    import base64

    clean = [(i, "".join(rng.choice("etaoinshrdlu     ") for _ in range(rng.randint(600, 9000))), "s") for i in range(20)]
    noise = [(i, " ".join(base64.b85encode(rng.randbytes(15)).decode() for _ in range(300)), "s") for i in range(100, 105)]
    chunked = "".join(rng.choice("etaoinshrdlu     ") for _ in range(9000)) + " " + "\n".join(f"{i:04d} ab" * 1 + "-" * 40 for i in range(300))
    odd = [(200, None, "s"), (201, "", "s"), (202, "a b c a b c # <x>\nq\nq\n \n \n", "s"), (203, "same line\n" * 9000, "s"), (204, "ä b c\x1cd e " * 20, "s")]
    rows = [*clean, *noise, *odd, (300, chunked, "s")]
    got = {r["doc_id"]: r for r in C.compression_rules(docs(spark, rows).select("doc_id", "text")).collect()}
    for i, t, _ in rows:
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == brute_counts(t)
        n, rep = r["n_words"], r["n_repeat_words"]
        assert r["base_failed"] == (n < 50 or 100 * rep > 50 * n) and not (r["kept"] and r["base_failed"])
    assert all(got[i]["kept"] for i, _, _ in clean)
    assert not any(got[i]["kept"] for i, _, _ in noise) and not got[300]["kept"] and not got[300]["base_failed"]
    assert C.compression_rules(docs(spark, []).select("doc_id", "text")).count() == 0


def test_repeated_words_of_large_vocabularies():
    rng = random.Random(5)
    words = [f"{i}".encode() for i in range(30_000)]
    words += words[100:105] + [b"z", b"z", b"z", b"z"]
    rng.shuffle(words[:10])
    win = Counter(zip(words, words[1:], words[2:]))
    cover = {i + k for i in range(len(words) - 2) if win[tuple(words[i : i + 3])] > 1 for k in range(3)}
    assert C.repeated_words(words) == len(cover) > 8


# -- packing


def test_packing_is_an_exact_partition(spark):
    from tokenizers import Tokenizer

    json_path, ranks, pattern = P.tokenizer_paths()
    rows = [*sample(), (500, "some <|endoftext|> text", "s"), (None, "no id", "s")]
    by_id = {i: t for i, t, _ in rows}
    for group in (3_000, 1 << 21):
        got = P.pack_documents(docs(spark, rows).repartition(3), json_path, ranks, pattern, group_tokens=group).collect()
        tok = Tokenizer.from_file(json_path)
        pieces, seqs = {}, {}
        for r in got:
            pieces.setdefault(r["doc_id"], []).append(r)
            seqs.setdefault(r["sequence_id"], []).append(r)
        assert set(pieces) == set(by_id)
        for i, ps in pieces.items():
            ids = np.array([*tok.encode(by_id[i] or "", add_special_tokens=False).ids, 1], "<u4")
            copies = 2 if i == 102 else 1
            assert sum(p["length"] for p in ps) == copies * len(ids)
            for p in ps:
                assert p["doc_tokens"] == len(ids) and p["length"] > 0
                assert p["ids_crc32"] == zlib.crc32(ids[p["start"] : p["start"] + p["length"]].tobytes())
            covered = Counter(x for p in ps for x in range(p["start"], p["start"] + p["length"]))
            assert set(covered.values()) == {copies}
        for ps in seqs.values():
            ps.sort(key=lambda p: p["offset"])
            n = sum(p["length"] for p in ps)
            assert [p["offset"] for p in ps] == [sum(q["length"] for q in ps[:k]) for k in range(len(ps))]
            assert n == 2048 or n & (n - 1) == 0
    assert P.pack_documents(docs(spark, []), json_path, ranks, pattern).count() == 0


def test_long_white_space_is_packed(spark):
    from tokenizers import Tokenizer

    json_path, ranks, pattern = P.tokenizer_paths()
    rows = [(1, "a" + " " * 1_100_000 + "b", "s"), (2, "\n" * 1_100_000, "s"), (3, "plain words", "s")]
    tok = Tokenizer.from_file(json_path)
    want = {i: np.array([*tok.encode(t, add_special_tokens=False).ids, 1], "<u4") for i, t, _ in rows}
    got = P.pack_documents(docs(spark, rows), json_path, ranks, pattern).collect()
    for i, ids in want.items():
        ps = [p for p in got if p["doc_id"] == i]
        assert sum(p["length"] for p in ps) == len(ids)
        assert all(p["ids_crc32"] == zlib.crc32(ids[p["start"] : p["start"] + p["length"]].tobytes()) for p in ps)


def test_encoder_falls_back_where_the_fast_library_raises(monkeypatch):
    import tiktoken
    from tokenizers import Tokenizer

    def fail(*args, **kw):
        raise ValueError("Max stack size exceeded for backtracking")

    json_path, ranks, pattern = P.tokenizer_paths()
    encode = P.encoder(json_path, ranks, pattern)
    monkeypatch.setattr(tiktoken.Encoding, "encode_to_numpy", fail)
    assert encode("some text").tolist() == Tokenizer.from_file(json_path).encode("some text", add_special_tokens=False).ids


def test_packing_keeps_every_limit():
    rng = random.Random(6)
    lengths = [rng.choice([1, 2, 3, 50, 700, 2048, 5000]) for _ in range(500)]
    for segments, loss, loss_of in ((4, 2048, P.all_but_first), (64, 1000, P.all_but_first), (8, 300, lambda n: n // 2)):
        out = P.pack(lengths, 2048, segments, loss, loss_of)
        seen = Counter()
        for seq in out:
            assert sum(n for _, _, n in seq) <= 2048 and len(seq) <= segments and sum(loss_of(n) for _, _, n in seq) <= loss
            for doc, at, n in seq:
                seen.update((doc, x) for x in range(at, at + n))
        assert len(seen) == sum(lengths) and set(seen.values()) == {1}
    full = P.pack(lengths)
    assert sum(sum(n for _, _, n in s) == 2048 for s in full) >= sum(lengths) // 2048 - 1


def test_dot_product_prefers_what_suits_the_room():
    seq = P.pack([1500, 500, 48, 600, 300])[0]
    assert [n for _, _, n in seq] == [1500, 500, 48]


# -- mixing


def waterfill(sizes, total, weights, most):
    capped = set()
    while True:
        rest = total - sum(most[s] for s in capped)
        w = sum(weights[s] for s in sizes if s not in capped)
        t = {s: most[s] if s in capped else rest * weights[s] / w for s in sizes}
        new = {s for s in sizes if t[s] > most[s] + 1e-9}
        if not new:
            return t
        capped |= new


def test_mix_meets_the_targets(spark):
    rng = random.Random(7)
    rows = [(i, prose(rng, rng.randint(0, 60)), rng.choice(["a", "b", "b", "b", "b", "é", "Z", None])) for i in range(400)]
    rows += [(900, None, "only null"), (901, "x y", "b"), (901, "x y", "b")]
    d = docs(spark, rows)
    size = lambda t: len((t or "").encode().split())
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += size(t)
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    want = waterfill(names, 1.5 * sum(sizes.values()), weights, {s: 2 * sizes[s] for s in names})
    slim = M.with_size(d.select("doc_id", "source", "text")).withColumn("row_key", F.col("doc_id").cast("string"))
    for block in (7, 400):
        pieces, placed = M.mix(slim, block=block)
        goal = {r["source"]: r["target"] for r in placed.select("source", "target").distinct().collect()}
        assert all(abs(goal[s] - want[s]) < 1e-6 for s in names)
        got = pieces.collect()
        taken = Counter()
        for r in got:
            taken[r["source"]] += r["words"]
        assert all(abs(taken[s] - want[s]) <= 1 for s in names)
        per_slot = Counter((r["source"], r["slot"]) for r in got)
        assert len({r["slot"] for r in got}) <= 1 << math.ceil(math.log2(sum(want.values()) / block)) and per_slot
        # every row at most twice, each of its words once a pass
        at = {}
        for r in got:
            at.setdefault((r["source"], r["part"], r["nth"], r["pass"]), []).append((r["start"], r["words"]))
        for spans in at.values():
            spans.sort()
            assert spans[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:]))
    # the schedule mixes: every eighth of the slots holds about an eighth of the large source
    big = max((s for s in names), key=lambda s: want[s])
    pieces, _ = M.mix(slim, block=7)
    slots = [r["slot"] for r in pieces.where(F.col("source").eqNullSafe(F.lit(big))).select("slot", "words").collect() for _ in range(r["words"])]
    top = max(slots) + 1
    assert max(abs(n / len(slots) - 1 / 8) for n in Counter(s * 8 // top for s in slots).values()) < 0.03


def test_mixed_documents(spark):
    rng = random.Random(8)
    rows = [(i, " \n" + prose(rng, rng.randint(1, 60)).replace(" w1 ", "\tw1\n"), f"s{i % 3}") for i in range(90)] + [(200, None, "s0"), (201, " ", "s1"), (202, "a b", "s2"), (202, "a b", "s2")]
    d = docs(spark, rows)
    out = M.mix_documents(d)
    assert out.columns == d.columns
    got = out.collect()
    by_id = {i: t for i, t, _ in rows}
    n = lambda t: len(t.split())
    assert all(r["text"] == by_id[r["doc_id"]] for r in got)  # never cut
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += n(t or "")
    want = waterfill(sorted(sizes), 1.5 * sum(sizes.values()), {"s0": 3, "s1": 1, "s2": 2}, {s: 2 * sizes[s] for s in sizes})
    taken = Counter()
    for r in got:
        taken[r["source"]] += n(r["text"])
    # the border document is taken or left, whichever is nearer
    assert all(abs(taken[s] - want[s]) <= 1 + max(n(t or "") for _, t, x in rows if x == s) / 2 for s in sizes)
    assert M.mix_documents(docs(spark, [])).count() == 0 and M.mix_documents(docs(spark, [(1, None, None)])).count() == 0


# -- language model


def scored(spark, rows, **kw):
    d = docs(spark, rows)
    return {r["id"]: r for r in Y.hierarchical_scores(d.select(F.col("doc_id").alias("id"), "text", (~in_fold(F.col("doc_id"), 7, 2)).alias("train")), Y.Model(**kw)).collect()}


def test_model_counts_base_and_shards(spark):
    rows = sample(9, 80)
    toks = {i: [*(t or "").encode().lower().split(), None] for i, t, _ in rows}
    train = [i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 7 != 2]
    c = Counter(x for i in train for x in toks[i])
    total, vocab = sum(c.values()), len(c)
    one, many = scored(spark, rows), scored(spark, rows, shard_bytes=30_000)
    for i, t in toks.items():
        for r in (one[i], many[i]):
            assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["train"]) == (len(t), sum(x in c for x in t), total, i in train)
            assert math.isclose(r["base_score"], sum(math.log10((c[x] + 1) / (total + vocab + 1)) for x in t), rel_tol=1e-9)
        if i != 103:  # one word pair outweighs the rest of its small shard there
            assert abs(one[i]["score"] - many[i]["score"]) < 0.15 * abs(one[i]["score"]) + 0.5
    held = [i for i in toks if i not in train]
    assert sum(one[i]["score"] for i in held) > sum(one[i]["base_score"] for i in held)
    assert one == scored(spark, rows)  # reruns agree


def test_seating_does_not_depend_on_the_number_of_shards(spark):
    rng = random.Random(12)
    rows = [(i, prose(rng, rng.randint(50, 400), 3000), "s") for i in range(300)] + [(1000, "é " * 40_000, "s")]
    runs = [scored(spark, rows, samples=6, **kw) for kw in ({}, {"seed": 6}, {"shard_bytes": 12_000})]
    whole = [sum(r["score"] for r in run.values()) for run in runs]
    each = [max(abs(run[i]["score"] / runs[0][i]["score"] - 1) for i in runs[0]) for run in runs[1:]]
    print(whole, each)
    assert abs(whole[2] / whole[0] - 1) < 0.001
    assert each[1] < 0.01


def test_shards_hold_a_pair_once_a_block():
    none = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    sent = []
    for n in (50, 20_000):
        toks = [Y.tokens(f"same line {i % 40}") for i in range(n)]
        sent.append(sum(len(blob) for _, blob in Y.block_rows(0, list(range(n)), np.arange(n) % 7 != 2, toks, none, 3)))
    assert sent[1] < 1.5 * sent[0]


def test_model_without_rows(spark):
    assert scored(spark, []) == {}
    # doc 3 is held out, so nothing is learned
    held = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 7 == 2)
    r = scored(spark, [(held, "a b", "s")])[held]
    assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["score"]) == (3, 0, 0, 0.0)


def test_predictions_sum_to_one():
    rng = random.Random(10)
    toks = [Y.tokens(prose(rng, 300)) for _ in range(20)]
    model, hot = Y.Model(), (np.zeros(0, np.uint64), np.zeros(0, np.uint64))
    rows = list(Y.block_rows(0, list(range(20)), np.arange(20) != 3, toks, hot, 1))
    shard = Y.Shard(0, [b for _, b in rows], hot, model)
    unknown = Y.dump(Y.deltas(np.array([12345], np.uint64)), np.zeros(1, np.uint32), np.zeros(1, np.float32), np.zeros(1, np.float32))
    owner = Y.Owner(0, [(0, next(shard.requests(1))[1]), (1, unknown)], model)
    replies = dict(owner.replies(owner.sums(), model))
    c, p, _ = Y.load(replies[0])
    assert abs(p[c > 0].sum() + Y.load(replies[1])[1][0] - 1) < 1e-6
    rest = 1 - np.bincount(shard.u, np.where(shard.c > 0, (shard.c - model.discount * shard.t) / (model.strength + shard.c_u[shard.u]), 0), len(shard.vocab))
    back = (model.strength + model.discount * shard.t_u) / (model.strength + shard.c_u)
    assert np.allclose(rest[shard.c_u > 0], back[shard.c_u > 0])


def test_seating_bounds_and_mean():
    rng = np.random.default_rng(11)
    c = np.array([0, 1, 2, 5, 5000])
    t = np.array([Y.seat(c, lambda i, now: np.full(len(i), 0.5), 0.0, rng) for _ in range(400)])
    assert (t[:, 0] == 0).all() and (t[:, 1] == 1).all() and (t <= c).all()
    exact = [sum(0.5 / (0.5 + m) for m in range(n)) for n in c[2:]]
    assert np.allclose(t[:, 2:].mean(axis=0), exact, rtol=0.12)


def test_blobs_round_trip():
    arrays = [np.array([], np.uint32), np.arange(5, dtype=np.uint64), np.array([1.5, -2]), np.array([7], np.uint8)]
    assert all((a == b).all() and a.dtype == b.dtype for a, b in zip(arrays, Y.load(Y.dump(*arrays))))


def test_steps_within_runs():
    x, runs = np.array([7, 9, 2, 2**32 - 1, 0, 5, 6]), np.array([2, 2, 3], np.uint32)
    steps = Y.run_deltas(x, runs)
    assert steps.tolist() == [7, 2, 2, 2**32 - 3, 0, 5, 1] and Y.run_sums(steps, runs).tolist() == x.tolist()
    none = np.zeros(0, np.uint32)
    assert len(Y.run_sums(Y.run_deltas(none, none), none)) == 0


# -- wrapper induction


def page(body, k=0):
    return (
        f"<!DOCTYPE html><html><head><title>t {k}</title><style>p{{}}</style><script>var a='<p>x</p>'</script></head><body><header>Top {k}</header>"
        f"<nav><ul><li><a href='/'>Home {k}</a></li><li>More</li></ul></nav>{body}<aside>Side {k}</aside><form>Name <input></form><footer>&copy; Us {k}</footer>"
    )


def test_main_text_of_pages(spark):
    rows = []
    for k in range(12):
        art = f"<article><h1>Title&nbsp;{k}</h1><p>First <b>bold</b>\n text {k} &amp; more<br>line<p>Second {k}<div class='ad'>Buy {k}</div><ul><li>a{k}<li>b{k}</ul><section id='comments'><p>Nice {k}!</p></section></article>"
        rows.append((k, f"http://h.example/{k}", page(art, k)))
    plain = [(100 + k, "http://p.example/x", page(f"<div><div class='cookie-notice'>ok</div><div><p>Only words {k} {k * 7}.</p><p>Subscribe now.</p><p>Long tail {k} of it.</p></div></div>", k)) for k in range(12)]
    odd = [(200, None, None), (201, "http://e.example/", ""), (202, "bad url", "no markup &lt;at all&gt;"), (None, "http://h.example/q", page("<article><p>x</article>")), (203, "http://d.example", "<div>" * 3000 + "deep")]
    df = spark.createDataFrame([(*r, "clash", 1) for r in [*rows, *plain, *odd, rows[0]]], "page_id long, url string, html string, host string, n int")
    got = {}
    for r in W.main_text(df).collect():
        got.setdefault(r["page_id"], []).append(r["text"])
    for k in range(12):
        assert set(got[k]) == {f"Title {k}\nFirst bold text {k} & more line\nSecond {k}\na{k}\nb{k}"}
        assert got[100 + k] == [f"Only words {k} {k * 7}.\nLong tail {k} of it."]  # the line that all pages share goes
    assert len(got[0]) == 2 and got[200] == [""] and got[201] == [""] and got[202] == ["no markup <at all>"] and got[None] == ["x"] and got[203] == ["deep"]
    assert W.main_text(df.limit(0)).count() == 0


def test_groups_of_a_hot_host_agree_with_one_group(spark, monkeypatch):
    rows = [(k, "http://hot.example/", page(f"<article><p>Text {k}.</p><p>Shared line.</p></article>", k)) for k in range(90)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    monkeypatch.setattr(W, "GROUP", 10)
    got = {r["page_id"]: r["text"] for r in W.main_text(df, hot=20).collect()}
    assert got == {k: f"Text {k}." for k in range(90)}


def test_names_do_not_make_a_wrapper_boilerplate():
    words = "alpha beta gamma delta epsilon zeta".split()
    text = [f"{words[k % 6]} {k} tells a long enough story." for k in range(12)]
    opens = ["<form id='aspnetForm'>", "<div class='content-sidebar-wrap'>", "<div class='no-sidebar'>", "<div id='has-header'>", "<div class='widget'><form>", "<div role='form'>"]
    for tag in opens:
        shut = "</form></div>" if tag.endswith("<form>") else "</form>" if tag.startswith("<form") else "</div>"
        for inner in ("<article><p>{}</p><div class='ad'>Buy {k}</div></article>", "<main><p>{}</p></main>", "<div><p>{}</p><p class='share'>No {k}</p></div>"):
            for n in (12, 3):
                got = W.induce([f"<body class='has-sidebar'><nav>Menu</nav>{tag}{inner.format(t, k=k)}{shut}<footer>Foot {k}</footer>" for k, t in enumerate(text[:n])])
                assert got == text[:n], (tag, inner, n)
    # within an article, too
    inside = W.induce([f"<article><div class='content-sidebar-wrap'><p>{t}</p></div><div class='related'>More {k}</div></article>" for k, t in enumerate(text)])
    assert inside == text
    # teasers in a sidebar are no article of the page
    teasers = W.induce([f"<article><p>{t}</p></article><aside><article>Teaser {k}</article></aside><div class='related'><article>See {k} and its story</article></div>" for k, t in enumerate(text)])
    assert teasers == text
    assert W.induce(["<body style='display:none'><aside><main>Only here.</main></aside>"]) == ["Only here."]


def test_copies_of_an_article_are_evidence_once():
    story = "".join(f"<p>Paragraph {j} of the one story that this host has.</p>" for j in range(20))
    text = "\n".join(f"Paragraph {j} of the one story that this host has." for j in range(20))
    # copies that differ outside of the article, or in an advert
    copies = [page(f"<article>{story}<div class='ad'>Buy {k}</div></article><script>track({k})</script>", k) for k in range(40)]
    assert W.induce(copies) == [text] * 40
    divs = [f"<nav>Menu {k}</nav><div>{story}<div class='ad'>ad {k}</div></div><footer>Us {k}</footer>" for k in range(40)]
    assert W.induce(divs) == [text] * 40
    # variants with a session's id in the article
    variants = [page(f"<article>{story}<p>Session {k}</p></article>", k) for k in range(40)]
    assert W.induce(variants) == [f"{text}\nSession {k}" for k in range(40)]
    # copies beside other articles that share a line with them
    other = [page(f"<article><p>Text {k} of its own.</p><p>Shared line.</p></article>", k) for k in range(20)]
    mostly = [page(f"<article>{story}<p>Shared line.</p></article>", k) for k in range(200)]
    assert W.induce(other + mostly) == [f"Text {k} of its own." for k in range(20)] + [text] * 200


def test_tree_matching_size():
    a, b = W.slots(W.parse("<div><p>x</p><ul><li>1</li></ul><p>y</p></div>")), W.slots(W.parse("<div><ul><li>1</li><li>2</li></ul><p>z</p><table></table></div>"))
    t = W.Template()
    t.align(a)
    size, _ = t.match(b, 0, {})
    assert size == 5  # root, div, ul, li, p


def both(make, want):
    """With a template and without."""
    for n in (12, 1):
        assert W.induce([make(k) for k in range(n)]) == [want(k) for k in range(n)]


def story(k):
    return f"Story {k} about {'abcdefghijklmnop'[k]} is long enough to be read as content."


def test_inline_elements_stay_in_their_block():
    both(
        lambda k: f"<nav>M</nav><article><p>See <a class='related-link'>the guide</a> for {story(k)}</p><p>x <b class='notice'>now</b> {k}</p><div><a class='share'>Post</a></div></article>",
        lambda k: f"See the guide for {story(k)}\nx now {k}",
    )
    both(lambda k: f"<article><p>Area is <math><mi>x</mi><mo>+</mo><mn>{k}</mn></math> exactly.</p></article>", lambda k: f"Area is x+{k} exactly.")
    both(lambda k: f"<article><p>Area <svg><text>no</text></svg>is {k}<script>x</script> exactly.</p></article>", lambda k: f"Area is {k} exactly.")
    both(lambda k: f"<article><script src='x.js'/>var a=1;</script><p>{story(k)}</p></article>", story)


def test_titles_and_shared_headings_stay():
    for head in ("header class='entry-header'", "div class='post-header'"):
        end = head.split()[0]
        title = f"<{head}><h1>My Title {{}}</h1></{end}>"
        both(lambda k, t=title: f"<article>{t.format(k)}<p>{story(k)}</p></article>", lambda k: f"My Title {k}\n{story(k)}")
        both(
            lambda k, t=title: f"<header><h1>Site</h1></header><div>{t.format(k)}<div class='body'><p>{story(k)}</p><p>{story(k)[::-1]}</p></div></div><footer>f</footer>",
            lambda k: f"My Title {k}\n{story(k)}\n{story(k)[::-1]}",
        )
    pages = [f"<article><h1>T {k}</h1><h2>Introduction</h2><p>{story(k)}</p><h2>Share this</h2><ul class='share'><li>a</ul></article>" for k in range(12)]
    assert W.induce(pages) == [f"T {k}\nIntroduction\n{story(k)}" for k in range(12)]


def test_comments_longer_than_the_story_go():
    talk = "".join(f"<p>Reader {j} says a lot of things in this very long comment.</p>" for j in range(20))
    both(lambda k: f"<article><p>{story(k)}</p><section id='comments'>{k}{talk}</section></article>", story)
    both(lambda k: f"<nav>M</nav><div><p>{story(k)}</p></div><div id='comments'>{k}{talk}</div>", story)
    both(lambda k: f"<main><p>{story(k)}</p></main><ol class='comment-list'><li><article class='comment'>{k}{talk}</article></ol>", story)
    both(lambda k: f"<body class='has-comments'><div class='comments-open'><p>{story(k)}</p></div>", story)


def test_any_depth_and_hostile_markup():
    both(lambda k: "<div>" * 300 + f"<nav>Menu here</nav><p>{story(k)}</p>", story)
    both(lambda k: "<article>" + "<div>" * 300 + f"<div class='ad'>Buy</div><aside>side</aside><p>{story(k)}</p>", story)
    for part in ("<a ", "<!x", "<a x='", "<script></script ", "<!--", "</b", "<p title="):
        start = time.process_time()
        W.induce([part * (1_000_000 // len(part))])
        assert time.process_time() - start < 5, part
    assert W.induce(["a <!--> b <!-- <p>no --> c <br/> d > e <f"]) == ["a b c d > e <f"]


def test_large_pages_make_smaller_groups(spark, monkeypatch):
    monkeypatch.setattr(W, "GROUP_CHARS", 2000)
    rows = [(k, "http://big.example/", page(f"<article><p>Text {k}.</p></article>", k)) for k in range(60)]
    got = W.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r["page_id"]: r["text"] for r in got} == {k: f"Text {k}." for k in range(60)} and len(got) == 60


def test_tree_matching_against_all_matchings(monkeypatch):
    rng = random.Random(5)

    def tree(depth):
        s = W.Slot(rng.choice("ab"), "x", 0)
        s.kids = [tree(depth - 1) for _ in range(rng.randint(0, 3))] if depth else []
        return s

    def brute(a, b):
        def best(x, y):
            if not x or not y:
                return 0
            return max(best(x[1:], y), best(x, y[1:]), best(x[1:], y[1:]) + brute(x[0], y[0]))

        return 1 + best(a.kids, b.kids) if a.label == b.label else 0

    for _ in range(200):
        a, b = tree(3), tree(3)
        a.label = b.label = "#"
        t = W.Template()
        t.align(a)
        assert t.match(b, 0, {})[0] == brute(a, b)
    monkeypatch.setattr(W, "WIDE", 0)  # lists too long for a table
    t = W.Template()
    t.align(a)
    assert t.match(a, 0, {})[0] == len(a.kids) + 1


# -- names that clash


def test_new_columns_replace_columns_of_their_names(spark):
    from corpusmill.llm.compression import compression_rules
    from corpusmill.llm.langid import identify
    from corpusmill.llm.simhash import with_fingerprint
    from corpusmill.llm.toxicity import score

    df = spark.createDataFrame(
        [(1, "some text", "x", "y", "z", "v", "w")], "doc_id long, text string, Ratio string, lang_pred string, SCORE string, fp string, kept string"
    )
    got = {name: f(df) for name, f in (("c", compression_rules), ("l", lambda d: identify(d, None)), ("t", lambda d: score(d, None)), ("s", with_fingerprint))}
    for out in got.values():
        names = [c.lower() for c in out.columns]
        assert len(set(names)) == len(names)
    c, lang, t, s = (got[k].first() for k in "clts")
    assert c["ratio"] > 0 and c["kept"] is False and c["SCORE"] == "z" and "text" not in got["c"].columns
    assert lang["lang_pred"] == "und" and lang["score"] == 0.0 and lang["Ratio"] == "x" and lang["text"] == "some text"
    assert t["score"] == 0.0 and t["lang_pred"] == "y" and isinstance(s["fp"], int) and s["kept"] == "w"


# -- blocks of the language model


def test_pairs_of_a_block_with_too_many_words_for_one_key(monkeypatch):
    toks = [Y.tokens(t) for t in ("a b a b c", "", "b c a b", " ".join(f"w{k % 700}" for k in range(3000)))]
    packed = Y.count_block(toks)
    monkeypatch.setattr(Y, "PACKED_WORDS", 10)
    for x, y in zip(packed, Y.count_block(toks), strict=True):
        assert x.tolist() == y.tolist()


def test_compression_rejects_junk_that_passes_the_base_rules():
    rng = random.Random(3)
    z = zstandard.ZstdCompressor(level=C.LEVEL)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    noise = " ".join("".join(rng.choice(letters) for _ in range(40)) for _ in range(120))
    counted = " ".join(f"item{'0' * 60}{k}" for k in range(2000))  # no window twice
    plain = " ".join(rng.choice(["ka", "lo", "mi", "ne"]) + rng.choice(["ta", "ru", "si", "vo", "pe"]) * rng.randint(1, 2) + rng.choice("aeiou") for _ in range(600))
    for text, base, kept in ((noise, False, False), (counted, False, False), (plain, False, True)):
        got = C.measure(text, z)
        assert (got[5], got[6]) == (base, kept), text[:50]
