import base64
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from starpipe.llm import warc_chunks as wc
from starpipe.llm.queries import op6_chunked_warc
from tests.llm.conftest import SF


def b32(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def brute(rows, least=0):
    """(id, bytes, digest, type, refers_to) of each (id, payload)."""
    data = [(k, (t or "").encode()) for k, t in rows]
    owner = {}
    for k, d in data:
        if k is not None:
            owner[d] = max(k, owner.get(d, k))
    out = []
    for k, d in data:
        other = k is not None and len(d) >= least and owner[d] != k
        out.append((k, len(d), b32(d), "revisit" if other else "response", owner[d] if other else None))
    return sorted(out, key=str)


def got(rows):
    return sorted(((r["id"], r["n"], r["digest"], r["type"], r["refers_to"]) for r in rows.collect()), key=str)


@pytest.fixture()
def pages(spark):
    def make(rows):
        return spark.createDataFrame([(k, f"http://x.example/{k}?é=1\r\n", t, "clash", 1) for k, t in rows],
                                     "page_id long, url string, html string, payload string, n int")
    return make


def test_query_against_brute_force(spark):
    rows = [(r.page_id, r.html) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    found = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in op6_chunked_warc(spark, SF).collect()]
    assert sorted(found, key=str) == brute(rows)


def _rows():
    rng = random.Random(4)
    tricky = ["WARC/1.1\r\n", "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n", "x\r\n\r\nWARC/1.1", "\r\n", "\r\n\r\n", "\r", "WARC/1.1" * 40,
              "a\r\n\r\n\r\n\r\nWARC/1.1\r\n\r\n", "é" * 700, "\n" * 500, "Content-Length: 5\r\n\r\n", "no newline " * 300]
    tricky += ["".join(rng.choice(["\r", "\n", "\r\n", "WARC", "/1.1", "WARC/1.1\r\n", "z"]) for _ in range(200)) for _ in range(40)]
    rows = list(enumerate(tricky, 10))
    return rows + [(1, None), (2, ""), (3, None), (4, "same"), (5, "same"), (6, "same"), (6, "same"), (4, "same"), (None, "same"), (None, "zzz")]


@pytest.mark.parametrize(("chunk", "compression"), [(7, "none"), (1 << 18, "gzip"), (100, "none")])
def test_round_trip(spark, pages, chunk, compression):
    path = wc.archive_path(spark)
    wc.write(pages(_rows()), path, chunk_bytes=chunk, compression=compression)
    table = wc.read(spark, path)
    assert got(wc.records(table)) == brute(_rows())
    sizes = table.select(F.octet_length("bytes").alias("n")).collect()
    assert max(r.n for r in sizes) <= chunk
    # the chunks of every response put together are its payload
    whole = {}
    for r in table.orderBy("record", "chunk").collect():
        whole.setdefault((r.record, r.id, r.type if not r.chunk else "response"), []).append(bytes(r["bytes"]))
    stored = {(k, t) for k, _, _, t, _ in brute(_rows())}
    assert {(k, t) for _, k, t in whole} == stored
    payloads = {(k, (t or "").encode()) for k, t in _rows()}
    assert all((k, b"".join(c)) in payloads for (_, k, t), c in whole.items() if t == "response")


def test_small_payloads_are_not_revisits(spark, pages):
    rows = [(1, "same"), (2, "same"), (3, "long enough"), (4, "long enough"), (5, None), (6, "")]
    path = wc.archive_path(spark)
    wc.write(pages(rows), path, revisit_bytes=5)
    assert got(wc.records(wc.read(spark, path))) == brute(rows, least=5)


def test_files_are_warc(spark, pages):
    path = wc.archive_path(spark)
    wc.write(pages([(1, "<p>é</p>"), (2, "abcdef")]).coalesce(1), path, chunk_bytes=4, compression="none")
    raw = b"".join(bytes(r.content) for r in spark.read.format("binaryFile").load(path).select("content").collect())
    types, payload = [], []
    while raw:
        assert raw.startswith(b"WARC/1.1\r\n")
        head, _, rest = raw.partition(b"\r\n\r\n")
        fields = dict(x.split(": ", 1) for x in head.decode("ascii").split("\r\n")[1:])
        n = int(fields["Content-Length"])
        assert rest[n:n + 4] == b"\r\n\r\n"
        types.append((fields["WARC-Type"], int(fields["WARC-Segment-Number"])))
        payload.append(rest[:n])
        raw = rest[n + 4:]
    assert sorted(types) == [("continuation", 2)] * 2 + [("continuation", 3)] + [("response", 1)] * 2
    assert b"".join(payload) in ("<p>é</p>abcdef".encode(), "abcdef<p>é</p>".encode())


def test_damage_is_an_error(spark, pages):
    path = wc.archive_path(spark)
    wc.write(pages([(1, "0123456789")]), path, chunk_bytes=4)
    table = wc.read(spark, path)
    for broken in (table.where("chunk <> 1"), table.where("chunk <> 0"),
                   table.withColumn("bytes", F.when(F.col("chunk") == 2, F.lit(b"xx")).otherwise(F.col("bytes")))):
        with pytest.raises(Exception, match="declared|without those before it"):
            wc.records(broken).collect()


def test_no_pages(spark, pages):
    path = wc.archive_path(spark)
    wc.write(pages([(1, "a")]).limit(0), path)
    assert wc.records(wc.read(spark, path)).collect() == []
