import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from corpusmill.llm import prefix_trie as P

COLUMNS = "conv_id long, turn long, role string, text string, c int, k string, hi int, turns string, w int"


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "k", 2, "t", 3) for r in rows], COLUMNS)


def brute(rows):
    own = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        seq = tuple(own.get(base, [])[:h] + turns[h:])
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
        ends[seq].append(c)
    kids = defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    total = {}
    for p in sorted(members, key=len, reverse=True):
        leaves = sum(total[k][0] for k in kids[p]) if kids[p] else 1
        saved = sum(total[k][1] for k in kids[p]) + (len(members[p]) - 1) * (len(p[-1][1].encode()) if p else 0)
        total[p] = leaves, saved
    return sorted(
        (min(m), len(p), min(members[p[:-1]]) if p else -99, len(m), len(kids[p]), *total[p], hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest())
        for p, m in members.items()
    )


def result(df):
    return sorted((r[0], r[1], -99 if r[2] is None else r[2], *r[3:]) for r in map(tuple, df.collect()))


def sample_rows(seed):
    rng = random.Random(seed)
    heads = [[("user", rng.choice("ab")), ("assistant", rng.choice("cdé"))] for _ in range(3)]
    rows = []
    for c in [*range(0, 60), 61, 63, 7001, 7002, -3, -5, 12345678901]:
        if c in (10, 15):
            continue
        turns = list(rng.choice(heads)) + [("user", rng.choice("xyz") * rng.randint(0, 3)) for _ in range(rng.randint(0, 12))]
        rows += [(c, i, *t) for i, t in enumerate(turns)]
    rows += [(70, i, "user", f"t{i}") for i in range(150)] + [(71, i, "user", f"t{i}") for i in range(149)]
    rows += [(12, None, None, None), (12, 3, None, "z"), (12, 3, "user", None), (13, 1, "user", "é"), (13, 1, "user", "é"), (None, 1, "user", "lost"), (14, 0, "user", "x" * 100_000)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("block, chunk, part", [(4, 4096, 1024), (1, 7, 3), (5, 2, 2)])
def test_trie_matches_brute_force(spark, monkeypatch, block, chunk, part):
    monkeypatch.setattr(P, "CHUNK", chunk)
    monkeypatch.setattr(P, "PART", part)
    rows = sample_rows(block)
    assert result(P.prefix_trie(table(spark, rows).repartition(3), block)) == brute(rows)


def test_copies_and_a_turnless_conversation(spark):
    # 4 has h = 3: it takes nothing from the absent 0 and none of its single turn stays
    assert zlib.crc32(b"4") % 9 > 0
    rows = [(4, 0, "user", "gone")]
    assert result(P.prefix_trie(table(spark, rows))) == brute(rows)
    rows = [(c, t, "user", f"same {t}") for c in range(0, 200, 5) for t in range(6)]
    assert result(P.prefix_trie(table(spark, rows))) == brute(rows)


def test_empty_table(spark):
    assert P.prefix_trie(table(spark, [])).count() == 0


def test_block_must_be_positive(spark):
    with pytest.raises(ValueError):
        P.prefix_trie(table(spark, []), 0)
