"""Every registered query against its DuckDB oracle on the smallest table set
(the driver repeats this at sf0.01)."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E

SF = os.environ.get("CORPUSMILL_TEST_SF", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def canon(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(canon(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, canon(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return canon(v.asDict())
    return v


def _key(r):
    return tuple((x is None, str(type(x)), str(x)) for x in r)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_entry():
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    rows_only = {q for q in set(qs) - set(sql) if not q.startswith("op") and q != "pipeline"}
    assert not rows_only


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(canon(r[c]) for c in cols) for r in df.collect()), key=_key)
    cur = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(dcols) == cols
    want = sorted((tuple(canon(dict(zip(dcols, r))[c]) for c in cols) for r in cur.fetchall()), key=_key)
    assert got == want


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["record_id", "doc_id", "sent_pos", "split"]
