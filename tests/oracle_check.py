"""Run registered queries in Spark and their DuckDB oracles; compare rows.

Usage: python tests/oracle_check.py [sf_dir] [query ...]"""
import math
import sys
import time

sys.path.insert(0, "/root/repo")
import duckdb

import __spark_entry__ as E
from corpusmill.session import local_session

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def canon(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(canon(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, canon(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return canon(v.asDict())
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    return v


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    spark = local_session()
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf)
            cols = df.columns
            rows = [tuple(canon(r[c]) for c in sorted(cols)) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL  {name}: spark error {str(e)[:500]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in sqls:
            print(f"rows  {name}: {len(rows)} rows (no oracle) {ts:.1f}s")
            continue
        try:
            cur = con.execute(sqls[name])
            dcols = [d[0] for d in cur.description]
            drows = [tuple(canon(dict(zip(dcols, r))[c]) for c in sorted(dcols)) for r in cur.fetchall()]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL  {name}: duckdb error {str(e)[:500]}")
            bad += 1
            continue
        if sorted(cols) != sorted(dcols):
            print(f"FAIL  {name}: columns {sorted(cols)} vs {sorted(dcols)}")
            bad += 1
            continue
        key = lambda r: tuple((x is None, str(type(x)), str(x)) for x in r)
        a, b = sorted(rows, key=key), sorted(drows, key=key)
        if a != b:
            bad += 1
            diff_a = [r for r in a if r not in set(b)][:3]
            diff_b = [r for r in b if r not in set(a)][:3]
            print(f"FAIL  {name}: {len(a)} vs {len(b)} rows; spark-only {diff_a} duck-only {diff_b}"[:3000])
        else:
            print(f"OK    {name}: {len(a)} rows {ts:.1f}s")
    print("bad", bad)


if __name__ == "__main__":
    main()
