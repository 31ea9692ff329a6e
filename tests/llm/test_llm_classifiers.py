import random

import numpy as np
from pyspark.sql import functions as F

from corpusmill.llm import langid as L
from corpusmill.llm import toxicity as X
from corpusmill.llm.common import in_fold

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, lang_pred string, toxic string"
SYLLABLES = {"aa": "ba da ga la ma".split(), "ee": "ké té pé né sé".split(), "oo": "xo zo qo wo jo".split()}


def docs(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", len(t or ""), "x", "y", "z") for i, t, lang in rows], DOCS)


def prose(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(n))


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    net = L.Net.new(["a", "b", "c"], 4, 16, rng)
    for k in ("emb", "rec", "cand", "out", "bias"):
        setattr(net, k, getattr(net, k).astype(np.float64))
    data = rng.integers(0, 256, (5, 16)).astype(np.uint8)
    lens, y = np.array([16, 9, 16, 3, 12]), np.array([0, 1, 2, 1, 0])
    _, grads = L.gradients(net, data, lens, y)
    for name, g in zip(("emb", "rec", "cand", "out", "bias"), grads):
        p = getattr(net, name)
        i = np.unravel_index(np.abs(g).argmax(), p.shape)
        old = p[i]
        p[i] = old + 1e-2
        up = L.gradients(net, data, lens, y)[0]
        p[i] = old - 1e-2
        down = L.gradients(net, data, lens, y)[0]
        p[i] = old
        assert abs((up - down) / 0.02 - g[i]) < 1e-3 * max(1, abs(g[i]))


def test_windows_of_a_text_pool_like_single_labels():
    net = L.Net.new(["a", "b"], 4, 8, np.random.default_rng(1))
    text = "abcdefghijklmnopqrst"
    parts = [text[i : i + 8].encode() for i in range(0, 20, 8)]
    total = sum(net.label(np.frombuffer(p, np.uint8)[None, :], np.array([len(p)]))[0] for p in parts)
    assert np.allclose(net.texts([text, None, "x"])[0], total / 20, atol=1e-5)


def test_languages_are_learned_and_held_out_rows_found(spark):
    rng = random.Random(3)
    rows = [(i, prose(rng, lang, rng.randint(5, 60)), lang) for i in range(120) for lang in [list(SYLLABLES)[i % 3]]]
    odd = [(500, None, "aa"), (501, "", "aa"), (502, "12 34 !!", "ee"), (503, prose(rng, "oo", 30_000), None), (None, "", None)]
    d = docs(spark, [*rows, *odd, *odd])
    held = in_fold(F.col("doc_id"), 4, 2)
    net = L.train(d, ~held, hidden=8, steps=120, batch=64)
    assert net.langs == sorted(SYLLABLES)
    got = L.identify(d.select("doc_id", held.alias("held"), "text"), net).collect()
    want = {i: lang for i, _, lang in rows}
    assert all(r["lang_pred"] == want[r["doc_id"]] for r in got if r["held"] and r["doc_id"] in want)
    assert {r["lang_pred"] for r in got if r["doc_id"] in (500, 501, 502, None)} == {"und"}
    assert {r["lang_pred"] for r in got if r["doc_id"] == 503} == {"oo"} and all(0 <= r["score"] <= 1 for r in got)


def test_language_filter_keeps_columns_and_rejects_letterless(spark):
    rng = random.Random(4)
    rows = [(i, prose(rng, lang, 30), lang) for i in range(40) for lang in [list(SYLLABLES)[i % 3]]]
    d = docs(spark, [*rows, (90, None, "aa"), (91, "...", "aa")])
    out = L.keep_identified(d, F.lit(True))
    assert out.columns == d.columns and {r["doc_id"] for r in out.collect()} == set(range(40))


def test_samples_stay_bounded_when_one_row_repeats(spark):
    rng = random.Random(12)
    rows = [(i, prose(rng, lang, 30), lang) for i in range(60) for lang in [list(SYLLABLES)[i % 3]]]
    d = docs(spark, rows + [rows[0]] * 3000)
    _, data, _, y = L.sample_windows(d, "doc_id", "text", "lang", F.lit(True), 10_000, 32)
    assert len(y) <= 4 * len(rows)
    lab = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    sample, _ = X.training_rows(d, lab, F.lit(True), 100, 100)
    assert sample.count() == 60


def test_language_without_rows_or_labels(spark):
    assert L.identify(docs(spark, []), L.train(docs(spark, []), F.lit(True)), pred="p", score="q").count() == 0
    d = docs(spark, [(1, "abc", None)])
    assert [(r["p"], r["q"]) for r in L.identify(d, L.train(d, F.lit(True)), pred="p", score="q").collect()] == [("und", 0.0)]
    assert L.keep_identified(d, F.lit(True)).count() == 1


def toxic_corpus(n=600):
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(n):
        words = prose(rng, "aa", rng.randint(5, 80)).split()
        bad = i % 6 == 0
        if bad:
            for _ in range(rng.randint(1, 3)):
                words.insert(rng.randrange(len(words)), rng.choice(["grrk", "Blarg!", "snortule"]))
        rows.append((i, " ".join(words), "aa"))
        if i % 10:
            labels.append((i, 1, int(bad)))
    return rows, labels


def test_toxic_texts_are_found_and_clean_ones_left(spark):
    rows, labels = toxic_corpus()
    rows += [(900 + k, rows[0][1], "aa") for k in range(40)]  # many copies of one toxic text
    labels += [(900 + k, 1, 1) for k in range(40)]
    odd = [(2000, None, None), (2001, "", "aa"), (2002, "la " * 50_000 + "grrk", "aa"), (None, "ba", "aa")]
    d = docs(spark, rows + odd)
    lab = spark.createDataFrame([*labels, (None, 1, 1), (3, 1, None), (5, None, 0)], "doc_id long, quality int, toxic int")
    held = in_fold(F.col("doc_id"), 4, 2)
    scorer = X.fit(d, lab, ~held)
    got = {r["doc_id"]: r["s"] for r in X.score(d.select("doc_id", "text", "score"), scorer, out="s").collect()}
    held_ids = {r["doc_id"] for r in d.where(held).select("doc_id").collect()}
    for i, _, _ in rows[:600]:
        if i in held_ids:
            assert (got[i] >= 0.3) == (i % 6 == 0)
    assert got[2000] == got[2001] < 0.3 <= got[2002] and got[None] < 0.3
    kept = X.drop_toxic(d, lab, F.lit(True))
    assert kept.columns == d.columns and {r["doc_id"] for r in kept.where("doc_id < 600").collect()} == {i for i in range(600) if i % 6}


def test_toxicity_without_evidence(spark):
    lab = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert X.fit(docs(spark, []), lab, F.lit(True)) is None
    d = docs(spark, [(1, "a", "aa")])
    assert [r["s"] for r in X.score(d, X.fit(d, lab, F.lit(True)), out="s").collect()] == [0.0]
    assert X.drop_toxic(d, lab, F.lit(True)).count() == 1


def test_label_model_recovers_accuracies_and_discounts_copies():
    rng = np.random.default_rng(6)
    y = rng.random(4000) < 0.2
    rate = {1: [0.8, 0.7, 0.6, 0.75, 0.5], 0: [0.05, 0.1, 0.02, 0.2, 0.5]}
    votes = np.where(y[:, None], rng.random((4000, 5)) < rate[1], rng.random((4000, 5)) < rate[0]).astype(float)
    copied = np.column_stack([votes, votes[:, 3], votes[:, 3], votes[:, 3]])
    start = np.where(votes[:, :3].sum(axis=1) > 0, 0.6, 0.1)
    post, rates, corr = X.label_model(copied, 0.2, np.ones(4000), start)
    assert np.abs(rates[1][:4] - rate[1][:4]).max() < 0.08 and np.abs(rates[0][:4] - rate[0][:4]).max() < 0.05
    assert corr[3, 5] > 0.9 and corr[0, 1] < 0.3
    assert ((post > 0.5) == y).mean() > 0.93
