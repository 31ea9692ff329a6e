import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from corpusmill.llm import simhash as S
from corpusmill.llm.common import components, lookup, row_digest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, fp string, component int, row_key string"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "x", 1, "k") for i, t in rows], DOCS)


def brute(text):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    grams = [b" ".join(w)] if len(w) < 3 else [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)]
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def sample_rows():
    rng = random.Random(1)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(60):
        t = [rng.choice(words) for _ in range(rng.randint(1, 120))]
        rows.append((i * 3, " ".join(t)))
        if i % 4 == 0:
            rows.append((i * 3 + 1, " ".join(t)))
        if i % 5 == 0 and len(t) > 60:
            t[5] = "changed"
            rows.append((i * 3 + 2, "\t".join(t).upper()))
    return [*rows, (1000, None), (1001, ""), (1002, " \n"), (None, "only null id here"), (1003, "x " * 70_000), (1003, "x " * 70_000)]


def test_fingerprint_bits():
    for t in (None, "", "a", "A b", "a b c", "a  b\tc d\x0be", "Ünï A b c d e f", "x " * 9):
        assert S.fingerprint(t) == brute(t)


def test_components_match_brute_force(spark):
    rows = sample_rows()
    got = S.simhash_components(docs(spark, rows)).collect()
    fps = [brute(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    want = sorted((str(d), f, str(low.get(find(i)))) for i, ((d, _), f) in enumerate(zip(rows, fps)))
    assert sorted((str(r["id"]), r["fp"] % (1 << 64), str(r["component"])) for r in got) == want


def test_dense_keys_lose_no_link(spark):
    rng = np.random.default_rng(2)
    center = int(rng.integers(1 << 62))
    fps = sorted({center ^ (1 << int(a)) ^ (1 << int(b)) ^ (1 << int(c)) for a, b, c in rng.integers(0, 63, (300, 3))})
    nodes = spark.createDataFrame([(f,) for f in fps], "fp long")
    parts = []
    for dense in (2, 10_000):
        c = components(S.near_links(nodes, dense=dense)).collect()
        groups = {}
        for r in c:
            groups.setdefault(r["root"], set()).add(r["node"])
        parts.append(sorted(map(sorted, groups.values())))
    assert parts[0] == parts[1] and parts[0]


def test_one_row_of_each_group_stays(spark):
    rows = sample_rows()
    d = docs(spark, rows)
    kept = S.drop_near_duplicates(d)
    assert kept.columns == d.columns
    comp = S.simhash_components(d).select("component").distinct().count()
    out = kept.collect()
    assert len(out) == comp
    by_id = dict(rows)
    assert all(r["text"] == by_id[r["doc_id"]] for r in out)
    assert {1000} <= {r["doc_id"] for r in out} and 1001 not in {r["doc_id"] for r in out}


def test_empty_table(spark):
    d = docs(spark, [])
    assert S.simhash_components(d).count() == 0 and S.drop_near_duplicates(d).count() == 0


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}}


def test_lookup_joins_hot_and_cold_keys(spark):
    rows = spark.createDataFrame([(1, "a")] * 30 + [(2, "b"), (3, None)], "k long, x string")
    table = spark.createDataFrame([(1, 30, "one"), (2, 1, "two")], "k long, n long, v string")
    got = sorted((r["k"], r["x"] or "", r["v"] or "") for r in lookup(rows, table, "k", "n", hot=5).collect())
    assert got == [(1, "a", "one")] * 30 + [(2, "b", "two"), (3, "", "")]


def test_row_digest_tells_null_from_empty(spark):
    df = spark.createDataFrame([(1, None, [1]), (1, "", [1]), (1, "", [2]), (None, "", None)], "a long, b string, c array<int>")
    assert df.select(row_digest(df).alias("d")).where(F.col("d").isNotNull()).distinct().count() == 4
