import hashlib
import json
import random
import zlib

import pytest

from corpusmill.llm import warc as R
from corpusmill.llm.common import lookup
from corpusmill.session import scratch_path


def pages(spark, rows):
    return spark.createDataFrame([(*r, "clash", 5) for r in rows], "page_id long, url string, html string, digest string, top int")


def sample():
    rng = random.Random(1)
    big = ["".join(rng.choice("abcdé\r\n ") for _ in range(1500)) for _ in range(4)]
    rows = [(i, f"http://h/{i}?a b\r\nX: é", big[i % 4] if i % 2 else f"own {i} " * 300) for i in range(30)]
    return [*rows, (100, None, None), (101, "u", ""), (102, "u", "short"), (103, "u", "short"), (104, "u", "x" * 999), (105, "u", "x" * 999), (106, "u", "y" * 1000), (107, "u", "y" * 1000), (107, "u", "y" * 1000), (None, "u", "y" * 1000), (None, "u", "z" * 2000), (None, "u", "z" * 2000), (108, "u", "WARC/1.1\r\n\r\n" * 200_000)]


def test_round_trip_through_the_files(spark):
    rows = sample()
    folder = scratch_path(spark, "test-warc")
    raw = R.write_archives(R.with_revisits(pages(spark, rows)).repartition(2), f"{folder}/raw", archive_bytes=20_000)
    names = [r["path"] for r in raw.collect()]
    assert len(names) > 3
    for n in names:  # one gzip stream each
        z = zlib.decompressobj(31)
        with open(n.removeprefix("file:"), "rb") as f:
            z.decompress(f.read())
        assert z.eof and not z.unused_data
    files = R.normalise(raw, f"{folder}/members")
    got = R.read_records(files).collect()
    top = {}
    for i, _, h in rows:
        p = (h or "").encode()
        if len(p) >= 1000 and i is not None:
            top[p] = max(top.get(p, -1), i)
    want = []
    for i, _, h in rows:
        p = (h or "").encode()
        again = p in top and top[p] != i
        want.append((str(i), len(p), hashlib.sha1(p).hexdigest(), "revisit" if again else "response", str(top[p] if again else None)))
    assert sorted((str(r["page_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], str(r["refers_to"])) for r in got) == sorted(want)
    n = 0
    for r in files.collect():
        with open(r["path"].removeprefix("file:"), "rb") as f, open(r["index_path"].removeprefix("file:"), "rb") as x:
            data, index = f.read(), [json.loads(line) for line in x]
        at = 0
        for e in index:  # members in a row, one record each
            assert e["offset"] == at
            rec = zlib.decompress(data[at : at + e["length"]], 31)
            assert rec.startswith(b"WARC/1.1\r\n") and len(list(R.records(iter([rec])))) == 1
            at += e["length"]
            n += 1
        assert at == len(data) == r["bytes"]
    assert n == len(rows)


def test_many_shared_payloads_are_joined_by_a_shuffle(spark, monkeypatch):
    p = pages(spark, sample())
    want = sorted(map(str, R.with_revisits(p).collect()))
    monkeypatch.setattr(R, "lookup", lambda rows, table, key, weight, **_: lookup(rows, table, key, weight, hot=3))
    assert sorted(map(str, R.with_revisits(p).collect())) == want


def test_streams_in_any_chunks():
    recs = [R.record(i, "u", b"x" * i, hashlib.sha1(b"x" * i).hexdigest(), "response", None) for i in (0, 1, 5000)]
    data = b"".join(recs)
    for step in (1, 7, 4096, len(data)):
        assert [r for _, r in R.records(iter(data[i : i + step] for i in range(0, len(data), step)))] == recs
    two = zlib.compress(recs[0], wbits=31) + zlib.compress(recs[1], wbits=31)
    for step in (1, 3, len(two)):
        assert b"".join(R.inflate(iter(two[i : i + step] for i in range(0, len(two), step)), 5)) == recs[0] + recs[1]


def test_damage_is_noticed():
    import pytest

    rec = R.record(1, "u", b"body", hashlib.sha1(b"other").hexdigest(), "response", None)
    with pytest.raises(ValueError):
        R.parse(zlib.compress(rec, wbits=31))
    with pytest.raises(ValueError):
        list(R.records(iter([rec[:-3]])))
    with pytest.raises(ValueError):
        list(R.inflate(iter([zlib.compress(rec, wbits=31)[:-9]])))


def test_no_pages(spark):
    folder = scratch_path(spark, "test-warc")
    raw = R.write_archives(R.with_revisits(pages(spark, [])), f"{folder}/raw")
    assert R.read_records(R.normalise(raw, f"{folder}/m")).count() == 0


def test_scheme_is_checked_before_any_task_runs(spark):
    with pytest.raises(ValueError, match="scheme 'dbfs'"):
        R.write_archives(R.with_revisits(pages(spark, [])), "dbfs:/x/raw")
