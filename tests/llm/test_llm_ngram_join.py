import random

import numpy as np
import pytest

from corpusmill.llm import ngram_join as J

DOCS = "doc_id long, text string, id string, key int, n string, component int, digest string, row int"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, "n", 2, "d", 3) for i, t in rows], DOCS)


def gram_set(text):
    w = (text or "").encode().lower().split()
    return set() if not w else {tuple(w)} if len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def brute(rows):
    sets = [gram_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both, either = len(sets[i] & sets[j]), len(sets[i] | sets[j])
            if either and 100 * both >= 80 * either:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return sorted((str(d), len(s), str(low.get(find(i)))) for i, ((d, _), s) in enumerate(zip(rows, sets)))


def result(df):
    return sorted((str(r["id"]), r["n"], str(r["component"])) for r in df.collect())


def sample_rows():
    rng = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    passage = [rng.choice(words) for _ in range(40)]
    rows, i = [], 0
    for _ in range(12):
        base = [rng.choice(words) for _ in range(rng.randint(3, 90))]
        for _ in range(rng.randint(1, 6)):
            t = list(base)
            for _ in range(rng.randint(0, 3)):
                t[rng.randrange(len(t))] = rng.choice(words)
            rows.append((i, " ".join(t + (passage if i % 3 == 0 else []))))
            i += 1
    for k in range(30):  # one large group of near copies, a chain at its end
        t = list(passage * 2)
        t[k] = "changed"
        rows.append((1000 + k, " \t".join(t).upper()))
    for k in range(6):
        rows.append((1100 + k, " ".join(f"c{x}" for x in range(k * 5, k * 5 + 60))))
    rows += [(2000, None), (2001, ""), (2002, " \n"), (None, rows[0][1]), (2003, "a b"), (2004, "A  b"), (2005, "x " * 70_000), (2005, "x " * 70_000)]
    return rows + [(None, "only a null id here"), (7, "another text with id seven"), (3, rows[3][1])]


@pytest.mark.parametrize("stars, block, heavy", [(3, 1024, 1 << 20), (0, 4, 64)])
def test_components_match_brute_force(spark, monkeypatch, stars, block, heavy):
    monkeypatch.setattr(J, "CHUNK", 500)
    rows = sample_rows()
    assert result(J.jaccard_components(docs(spark, rows).repartition(3), stars=stars, block=block, max_heavy=heavy)) == brute(rows)


def test_empty_table(spark):
    assert J.jaccard_components(docs(spark, [])).count() == 0


def test_links_at_the_limit():
    a, b = np.arange(9, dtype=np.uint64), np.arange(1, 10, dtype=np.uint64)
    assert J.links(a, b)  # 8 of 10
    assert not J.links(a[:-1], b)  # 7 of 9 stays below
    assert not J.links(np.arange(2, dtype=np.uint64), np.arange(3, dtype=np.uint64))


def test_sets_of_few_words():
    assert len(J.shingle_set(None)) == len(J.shingle_set(" \n\t")) == 0
    assert len(J.shingle_set("a b")) == 1 and (J.shingle_set("A b") == J.shingle_set("a\x0bB")).all()
    assert len(J.shingle_set("a b a b a b a b")) == 2 and len(J.shingle_set("É a")) == 1
    assert J.shingle_set("É a") != J.shingle_set("é a")


def test_heavy_shingles_move_only_work(spark):
    d = spark.createDataFrame([("a b c d e f " * 2,)] * 40 + [("g h i j k",)], "text string")
    heavy = J.heavy_shingles(d, 5, 1 << 20, least=8)
    assert set(heavy) == set(J.shingle_set("a b c d e f " * 2))


def test_tables_are_broadcast_only_if_small(spark, monkeypatch):
    limits = []
    inner = J.lookup

    def seen(*args, small_bytes=0, **kw):
        limits.append(small_bytes)
        return inner(*args, small_bytes=small_bytes, **kw)

    monkeypatch.setattr(J, "lookup", seen)
    rows = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f"), (3, "x y")], "doc_id long, text string")
    assert sorted(map(tuple, J.jaccard_components(rows).collect())) == [(1, 2, 1), (2, 2, 1), (3, 1, 3)]
    assert len(limits) > 2 and max(limits) <= 16 << 20


def test_families_make_few_pairs(spark, monkeypatch):
    """Texts of one passage, most of which link with few others, are no pairs of the product."""
    rng = random.Random(9)
    base = [f"p{i}" for i in range(150)]
    rows = []
    for i in range(150):
        t = list(base)
        for k in range(rng.randint(0, 9)):
            t[rng.randrange(len(t))] = f"x{i}y{k}"
        rows.append((i, " ".join(t)))
    checked = []
    inner = J._check

    def seen(pairs, *args):
        checked.append(pairs.count())
        return inner(pairs, *args)

    monkeypatch.setattr(J, "_check", seen)
    assert result(J.jaccard_components(docs(spark, rows))) == brute(rows)
    assert sum(checked) <= len(rows)
