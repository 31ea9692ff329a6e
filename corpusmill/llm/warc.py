"""WARC archives: written as one gzip stream each, then normalised to a member a record.

``write_archives`` writes records in the partitions of the input, each archive as a
monolithic gzip stream (as many crawlers and repackers leave them), a new archive every
``archive_bytes`` of records.  ``normalise`` inflates each archive's stream once, front to
back, writes every record as a gzip member of its own, and writes a sidecar index (JSON
lines: offset, length, record id, type) beside it.  ``read_records`` reads records back
through the index, each from its own member.

Files go to a folder that all executors share, under a name that is unique to the task
attempt; a step returns the names of the archives that its successful tasks wrote, and
the next step opens only these, so files of lost attempts are never seen.  A task holds a
chunk of an archive, not the archive, and no content crosses an exchange.

A null payload is an empty one; a null url leaves out the target header, and characters
that a header can't hold are escaped.  An empty table gives no archives.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import checkpoint, lookup
from corpusmill.session import scratch_path
from corpusmill.sources.files import FileSystems, check_scheme

FILES = "path string, index_path string, records long, bytes long"
_FILES = ["path", "index_path", "records", "bytes"]
GZIP = 31  # window bits of a gzip wrapper
ID = "urn:page:"
SAME = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRLF = b"\r\n"


def record(page: int | None, url: str | None, payload: bytes, digest: str, kind: str, refers: int | None) -> bytes:
    """One record.  A revisit holds the HTTP header only, which gives the length of the
    payload that it stands for."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + (payload if kind == "response" else b"")
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{ID}{'' if page is None else page}>", "WARC-Date: 1970-01-01T00:00:00Z"]
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe="".join(map(chr, range(33, 127)))))
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if kind == "revisit":
        head += [f"WARC-Profile: {SAME}", f"WARC-Refers-To: <{ID}{refers}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return CRLF.join(h.encode("ascii", "backslashreplace") for h in head) + CRLF * 2 + block + CRLF * 2



def headers(head: bytes) -> dict[str, str]:
    lines = head.decode("ascii", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}


def records(stream: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, whole record) of every record of an inflated stream of byte chunks."""
    buf = bytearray()
    need = None
    for chunk in stream:
        buf += chunk
        while True:
            if need is None:
                end = buf.find(CRLF * 2)
                if end < 0:
                    break
                if not buf.startswith(b"WARC/"):
                    raise ValueError("not at the start of a WARC record")
                h = headers(bytes(buf[:end]))
                need = end + 4 + int(h["content-length"]) + 4
            if len(buf) < need:
                break
            yield h, bytes(buf[:need])
            del buf[:need]
            need = None
    if buf:
        raise ValueError("the archive ends within a record")


def chunks(f, step: int = 1 << 20) -> Iterator[bytes]:
    while data := f.read(step):
        yield data


def inflate(data: Iterator[bytes], most: int = 4 << 20) -> Iterator[bytes]:
    """The content of a gzip stream of any number of members, in chunks."""
    z = None
    for rest in data:
        while rest:
            z = z or zlib.decompressobj(GZIP)
            yield z.decompress(rest, most)
            if z.eof:
                rest, z = z.unused_data, None
            else:
                rest = z.unconsumed_tail
    if z is not None:
        yield z.flush()
        if not z.eof:
            raise ValueError("the gzip stream is cut short")


def _create(uri: str):
    where, path = FileSystems().open(uri)
    where.create_dir(path.rpartition("/")[0], recursive=True)
    return where.open_output_stream(path, compression=None)


def _open(uri: str):
    where, path = FileSystems().open(uri)
    return where.open_input_file(path)


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = 64 << 20, level: int = 3) -> DataFrame:
    """Write ``pages`` (page_id, url, html, digest, kind, refers) and return the archives'
    names, one row each.  A folder whose scheme tasks cannot open is an error here."""
    check_scheme(folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = z = None
        path, n, size = "", 0, 0

        def done():
            out.write(z.flush())
            out.close()
            return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([None], pa.string()), pa.array([n]), pa.array([size])], names=_FILES)

        for b in batches:
            for page, url, html, digest, kind, refers in zip(*(b.column(c).to_pylist() for c in ("page_id", "url", "html", "digest", "kind", "refers")), strict=True):
                if out is None:
                    path, n, size = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    out, z = _create(path), zlib.compressobj(level, zlib.DEFLATED, GZIP)
                rec = record(page, url, (html or "").encode("utf-8", "surrogatepass"), digest, kind, refers)
                out.write(z.compress(rec))
                n, size = n + 1, size + len(rec)
                if size >= archive_bytes:
                    yield done()
                    out = None
        if out is not None:
            yield done()

    return checkpoint(pages.mapInArrow(run, FILES))


def normalise(files: DataFrame, folder: str, level: int = 3) -> DataFrame:
    """Rewrite each archive with a member a record and a sidecar index."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for source in b.column("path").to_pylist():
                path = f"{folder}/{uuid.uuid4().hex}.warc.gz"
                n = at = 0
                with _open(source) as f, _create(path) as out, _create(f"{path}.idx") as index:
                    for h, rec in records(inflate(chunks(f))):
                        z = zlib.compressobj(level, zlib.DEFLATED, GZIP)
                        member = z.compress(rec) + z.flush()
                        out.write(member)
                        line = {"offset": at, "length": len(member), "id": h["warc-record-id"], "type": h["warc-type"]}
                        index.write(json.dumps(line).encode() + b"\n")
                        n, at = n + 1, at + len(member)
                yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([f"{path}.idx"]), pa.array([n]), pa.array([at])], names=_FILES)

    return checkpoint(files.mapInArrow(run, FILES))


def parse(member: bytes) -> tuple[int | None, int, str, str, int | None]:
    """(page, payload bytes, digest, type, page referred to) of a record's own member;
    checks the digest of a payload that is there."""
    rec = zlib.decompress(member, GZIP)
    cut = rec.index(CRLF * 2)
    h = headers(rec[:cut])
    block = rec[cut + 4 : cut + 4 + int(h["content-length"])]
    top = block.index(CRLF * 2)
    size = int(headers(block[:top])["content-length"])
    digest = h["warc-payload-digest"].removeprefix("sha1:")
    if h["warc-type"] == "response":
        body = block[top + 4 :]
        if len(body) != size or hashlib.sha1(body).hexdigest() != digest:
            raise ValueError(f"damaged payload in {h['warc-record-id']}")

    def page(x: str | None) -> int | None:
        m = re.fullmatch(rf"<{ID}(-?\d+)>", x or "")
        return int(m[1]) if m else None

    return page(h["warc-record-id"]), size, digest, h["warc-type"], page(h.get("warc-refers-to"))


def read_records(files: DataFrame) -> DataFrame:
    """A row per record of normalised archives, each read from its own member at the
    place that the index gives."""
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "offset", "length"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, index_path in zip(b.column("path").to_pylist(), b.column("index_path").to_pylist(), strict=True):
                rows = []
                with _open(path) as f, _open(index_path) as index:
                    for line in index.read().splitlines():
                        at = json.loads(line)
                        f.seek(at["offset"])
                        rows.append((*parse(f.read(at["length"])), at["offset"], at["length"]))
                cols = list(zip(*rows, strict=True)) or [()] * 7
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)

    return files.mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, offset long, length long")


def with_revisits(pages: DataFrame, least: int = 1000) -> DataFrame:
    """``pages`` (page_id, url, html) with digest, kind and refers: of equal payloads of
    ``least`` bytes or more the largest page id is the response (rows that repeat it,
    too) and the others, null ids among them, revisit it.  Null ids only: all responses."""
    body = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    rows = pages.select("page_id", "url", "html", F.sha1(body).alias("digest"), (F.octet_length(body) >= least).alias("large"))
    shared = rows.where("large").groupBy("digest").agg(F.max("page_id").alias("top"), F.count(F.lit(1)).alias("n")).where("n > 1 and top is not null")
    placed = lookup(rows, checkpoint(shared), "digest", "n", small_bytes=16 << 20)
    again = F.col("top").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("top"))
    return placed.select("page_id", "url", "html", "digest", F.when(again, "revisit").otherwise("response").alias("kind"), F.when(again, F.col("top")).alias("refers"))


def op10_warc(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select(F.col("page_id").cast("long"), "url", "html")
    folder = scratch_path(spark, "warc")
    raw = write_archives(with_revisits(pages), f"{folder}/raw")
    return read_records(normalise(raw, f"{folder}/members")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
