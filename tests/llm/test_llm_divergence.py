import random
import re
import tracemalloc
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.ml.feature import CountVectorizer

from corpusmill.llm import divergence as D

DOCS = "doc_id long, text string, lang string, source string, term string, n int, p long, q long, item string, value int"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, "x", 1, 2, 3, "y", 4) for i, (t, lang, s) in enumerate(rows)], DOCS)


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)


def brute(rows, min_df=10, top=10):
    df, counts, groups = Counter(), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        bag = words(text)
        counts[lang, source].update(bag)
        df.update((lang, t) for t in set(bag))
    out = []
    for lang, source in groups:
        kept = [t for (name, t), n in df.items() if name == lang and n >= min_df]

        def shares(count):
            size = sum(count[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 10**9 * (count[t] + 2) // size for t in kept}

        p = shares(counts[lang, source])
        ranked = []
        for other in (s for name, s in groups if name == lang and s != source):
            q = shares(counts[lang, other])
            ranked.append((-sum((p[t] - q[t]) ** 2 // (p[t] + q[t]) for t in kept), other.encode()))
        out += [(lang, source, "pair", o.decode(), -v, r) for r, (v, o) in enumerate(sorted(ranked), 1)]
        q = shares(sum((counts[g] for g in groups if g[0] == lang), Counter()))
        over = sorted((-((p[t] - q[t]) ** 2 // (p[t] + q[t])), t.encode()) for t in kept if counts[lang, source][t] and p[t] > q[t])
        out += [(lang, source, "term", t.decode(), -v, r) for r, (v, t) in enumerate(over[:top], 1)]
    return sorted(out)


def sample_rows():
    rng = random.Random(5)
    vocab = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)] + ["É", "é", "日本", "𝒳y", "don't", "A_b"]
    rows = []
    for lang in ("en", "de", None, "a b"):
        for k, source in enumerate(("s1", "s2", "É", None, "z z")):
            for _ in range(rng.randint(3, 9)):
                rows.append((" ".join(rng.choice(vocab[k * 5 :]).title() for _ in range(rng.randint(0, 60))), lang, source))
    rows += [(None, "en", "only null"), ("", "en", "only null"), ("1 2 3 \x00\x7f", "xx", "digits"), ("x", "lone", "s")]
    return rows + [("q\u0085q " + "long " * 50_000, "en", "s1")] + [rows[0]] * 3


@pytest.mark.parametrize("size", [1 << 24, 100])
def test_divergence_matches_brute_force(spark, monkeypatch, size):
    monkeypatch.setattr(D, "SLICE", size)
    rows = sample_rows()
    got = sorted(map(tuple, D.divergence(docs(spark, rows).repartition(3)).collect()))
    assert got == brute(rows)


def test_counts_are_those_of_the_count_vectorizer(spark):
    rows = [(t, lang, s) for t, lang, s in sample_rows() if lang == "en"]
    bags = spark.createDataFrame([(words(t),) for t, _, _ in rows], "terms array<string>")
    model = CountVectorizer(inputCol="terms", outputCol="v", minDF=10.0, vocabSize=2**31 - 1).fit(bags)
    want = sum((r["v"].toArray() for r in model.transform(bags).collect()))
    got = {r["term"]: r["n"] for r in D.group_counts(D._texts(docs(spark, rows)), 10).groupBy("term").sum("n").withColumnRenamed("sum(n)", "n").collect()}
    assert got == {t: int(n) for t, n in zip(model.vocabulary, want)}


def test_vectors_of_texts():
    terms, row, at, n = D.vectors([t.encode() for t in ("", "Ab ab", "x", "1", "É-ab x", "")])
    got = sorted((int(r), terms[a].decode(), int(k)) for r, a, k in zip(row, at, n))
    assert got == [(1, "ab", 2), (2, "x", 1), (4, "ab", 1), (4, "x", 1), (4, "É", 1)]
    assert all(len(x) == 0 for x in D.vectors([b"", b""]))


def test_no_kept_terms(spark):
    rows = [("a b", "en", "s"), ("a", "en", "t"), (None, None, None)]
    got = sorted(map(tuple, D.divergence(docs(spark, rows)).collect()))
    assert got == [("en", "s", "pair", "t", 0, 1), ("en", "t", "pair", "s", 0, 1)]
    assert D.divergence(docs(spark, [])).count() == 0


def test_quotient_is_exact_for_large_counts(spark):
    cases = [(0, 2), (10**15 - 2, 10**15), (123456789012, 9 * 10**15), (7, 3 * 10**9 + 1), (999999998, 10**9 + 7)]
    df = spark.createDataFrame(cases, "n long, d long")
    assert [r[0] for r in df.select(D._p("n", "d")).collect()] == [1 + 10**9 * (n + 2) // d for n, d in cases]


def test_vectors_of_a_batch_take_little_memory():
    rng = random.Random(6)
    text = " ".join(rng.choice("abcdefgh") + rng.choice("ijklmnop") for _ in range(400))
    n = (20 << 20) // len(text)
    batch = pa.RecordBatch.from_pydict({"lang": ["en"] * n, "source": ["s"] * n, "text": [text] * n})
    tracemalloc.start()
    try:
        total = sum(sum(b.column("n").to_pylist()) for b in D._sums(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert total == 400 * n
    assert peak < 100 << 20
