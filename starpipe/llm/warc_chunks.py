"""WARC archives as a chunked record table.

A payload is a run of rows (record id, chunk number, bytes) of at most
``chunk_bytes`` each, and no chunk needs another one. In the archive a chunk is
a WARC record: the first is the ``response``, later ones are
``continuation`` records with segment numbers, as WARC 1.1 lays down for
segmented records. Spark's text writer writes them as plain ``.warc`` files
and its text reader reads them record by record: the separator is the end
of one record with the first line of the next, and the writer cuts a chunk
wherever a payload holds those bytes.

Reading back, a record of one chunk is digested where it lies. Chunks of longer
records are sorted by record and number and streamed: each chunk updates its
record's running SHA-1, so no task holds a whole payload.

Equal payloads (by SHA-1) of at least ``revisit_bytes`` are stored once,
under the largest page id; the others are ``revisit`` records.

Defined cases: a null payload is empty; pages equal in id and payload are
each stored as the type their id has; a null id never refers to or is
referred to; extra columns are ignored; no pages give no archive rows.
"""

from __future__ import annotations

import base64
import hashlib
import string
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starpipe.session import scratch_dir
from starpipe.sources.io import materialize

VERSION = b"WARC/1.1\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PRINTED = string.punctuation + "%"
#: Between two records. No chunk holds or can complete it, as none holds ``MARK``.
BETWEEN = b"\r\n\r\n" + VERSION
MARK = b"WARC/1.1"


def _header(pairs: list[tuple[str, object]]) -> bytes:
    return VERSION + "".join(f"{k}: {v}\r\n" for k, v in pairs if v is not None).encode() + b"\r\n"


def chunks(payload: bytes | pa.Buffer, chunk_bytes: int) -> Iterator[bytes]:
    """The payload in order, cut at every ``chunk_bytes`` and inside every ``MARK``;
    an empty payload is one empty chunk. Only one chunk at a time is copied."""
    view, at = memoryview(payload), 0
    while True:
        chunk = bytes(view[at:at + chunk_bytes])
        found = chunk.find(MARK)
        if found >= 0:
            chunk = chunk[:found + 4]
        yield chunk
        at += len(chunk)
        if at >= len(view):
            return


def typed(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
          revisit_bytes: int = 0) -> DataFrame:
    """(id, url, payload, n, sha1, refers_to): refers_to is null for responses; the
    payload is null for revisits, which store none."""
    payload = F.coalesce(F.col(payload_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"),
                        F.octet_length(payload).cast("long").alias("n"), F.sha1(payload).alias("sha1"))
    # Only payloads that occur under several ids need a look-up; the counts combine before the shuffle.
    # They are written, so their real size decides whether they are broadcast or the payloads shuffled.
    owners = materialize(rows.where(F.col("n") >= revisit_bytes).groupBy("sha1")
                         .agg(F.max("id").alias("owner"), F.min("id").alias("least")).where("owner <> least").select("sha1", "owner"),
                         "payload_owners")
    joined = rows.join(owners, "sha1", "left")
    refers = F.when((F.col("n") >= revisit_bytes) & (F.col("id") != F.col("owner")), F.col("owner"))
    return joined.withColumn("refers_to", refers).select(
        "id", "url", F.when(F.col("refers_to").isNull(), F.col("payload")).alias("payload"), "n", "sha1", "refers_to")


def to_records(rows: DataFrame, chunk_bytes: int = 1 << 18) -> DataFrame:
    """One row a WARC record (``value``, without its closing newline), in the order of
    ``rows``. Record ids name the page, then the task and place that wrote it; dates
    are fixed, so a rerun of a task writes the same bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, row, out, size = TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            payloads = batch.column("payload")
            for at in range(0, batch.num_rows, 64):
                cols = (batch.slice(at, 64).column(c).to_pylist() for c in ("id", "url", "n", "sha1", "refers_to"))
                for i, (page, url, n, sha1, refers) in enumerate(zip(*cols, strict=True), at):
                    record, row = f"urn:page:{_quoted(page)}:{part}.{row}", row + 1
                    digest = base64.b32encode(bytes.fromhex(sha1)).decode()
                    date = ("WARC-Date", "2000-01-01T00:00:00Z")
                    about = [("WARC-Record-ID", f"<{record}>"), date, ("WARC-Target-URI", None if url is None else quote(url, safe=PRINTED)),
                             ("WARC-Payload-Digest", f"sha1:{digest}"), ("X-Payload-Length", n)]
                    if refers is not None:
                        out.append(_header([("WARC-Type", "revisit"), *about, ("WARC-Profile", PROFILE),
                                            ("WARC-Refers-To", f"<urn:page:{_quoted(refers)}>"), ("Content-Length", 0)]) + b"\r\n\r")
                        continue
                    for number, chunk in enumerate(chunks(payloads[i].as_buffer(), chunk_bytes), 1):
                        own = [("WARC-Type", "response"), *about] if number == 1 else [
                            ("WARC-Type", "continuation"), ("WARC-Record-ID", f"<{record}#{number}>"), date,
                            ("WARC-Segment-Origin-ID", f"<{record}>")]
                        out.append(_header([*own, ("WARC-Segment-Number", number), ("Content-Length", len(chunk))])
                                   + chunk + b"\r\n\r")
                        size += len(chunk)
                        if size > 1 << 23:
                            yield _values(out)
                            out, size = [], 0
        yield _values(out)

    return rows.mapInArrow(run, "value binary")


def _quoted(page) -> str:
    return "" if page is None else quote(str(page), safe="")


def _values(out: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])


def write(pages: DataFrame, path: str, chunk_bytes: int = 1 << 18, compression: str = "gzip", **columns) -> None:
    """Write ``pages`` as WARC files into the new folder ``path``."""
    (to_records(typed(pages, **columns), chunk_bytes).select(F.col("value").cast("string"))
     .write.option("compression", compression).text(path))


def _field(head: Column, name: str) -> Column:
    return F.nullif(F.regexp_extract(head, rf"(?m)^{name}: ([^\r\n]*)", 1), F.lit(""))


def read(spark: SparkSession, path: str, id_type: str = "long") -> DataFrame:
    """The chunked record table of the archives at ``path``: record, type, id, refers_to,
    digest and n (both as declared by the record), chunk from 0, and its bytes."""
    rows = spark.read.option("lineSep", BETWEEN.decode()).text(path)
    # Headers are ASCII, so code points and bytes agree up to the payload.
    cut = F.locate("\r\n\r\n", F.col("value"))
    rows = rows.select(F.expr("CAST(value AS binary)").alias("raw"), cut.alias("cut"),
                       F.col("value").substr(F.lit(1), cut - 1).alias("head"))
    head, number = F.col("head"), F.coalesce(_field(F.col("head"), "WARC-Segment-Number").cast("long"), F.lit(1)) - 1
    record = F.coalesce(_field(head, "WARC-Segment-Origin-ID"), _field(head, "WARC-Record-ID"))

    def page(col: Column) -> Column:
        return F.nullif(F.url_decode(F.regexp_extract(col, r"^<urn:page:([^:>]*)", 1)), F.lit("")).cast(id_type)

    return rows.select(
        record.alias("record"), _field(head, "WARC-Type").alias("type"), page(record).alias("id"),
        page(_field(head, "WARC-Refers-To")).alias("refers_to"),
        F.regexp_extract(head, r"(?m)^WARC-Payload-Digest: sha1:(\w+)", 1).alias("digest"),
        _field(head, "X-Payload-Length").cast("long").alias("n"), number.alias("chunk"),
        F.substring(F.col("raw"), F.col("cut") + 4, _field(head, "Content-Length").cast("int")).alias("bytes"))


RECORD = "record string, type string, refers_to {id}, id {id}, n long, digest string"


def records(table: DataFrame) -> DataFrame:
    """One row a record of the chunk table: record, type, refers_to, id, and the full payload's n
    and digest; for responses both come from the bytes read, and a record that does
    not hold what it declares is an error."""
    id_type = table.schema["id"].dataType.simpleString()
    cols = table.select("record", "type", "refers_to", "id", "n", "digest", "chunk", "bytes")
    whole = (F.col("chunk") == 0) & ((F.col("type") == "revisit") | (F.octet_length("bytes") == F.col("n")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sha, size, done = None, None, 0, []
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(8)), strict=True):
                if row[6] == 0:
                    if now is not None:
                        done.append(_checked(now, sha, size))
                    now, sha, size = row[:6], hashlib.sha1(), 0
                elif now is None or row[0] != now[0]:
                    raise ValueError(f"{row[0]}: chunk {row[6]} without those before it")
                sha.update(row[7])
                size += len(row[7])
            yield _rows(done, out_schema)
            done = []
        if now is not None:
            yield _rows([_checked(now, sha, size)], out_schema)

    schema = RECORD.format(id=id_type)
    out_schema = table.sparkSession.createDataFrame([], schema).schema
    from pyspark.sql.pandas.types import to_arrow_schema
    out_schema = to_arrow_schema(out_schema)
    chunked = cols.where(~whole).repartition("record").sortWithinPartitions("record", "chunk")
    return cols.where(whole).mapInArrow(run, schema).union(chunked.mapInArrow(run, schema))


def _checked(row: tuple, sha, size: int) -> tuple:
    if row[1] == "revisit":
        return row
    digest = base64.b32encode(sha.digest()).decode()
    if (digest, size) != (row[5], row[4]):
        raise ValueError(f"{row[0]}: {size} bytes of digest {digest}, declared {row[4]} of {row[5]}")
    return (*row[:4], size, digest)


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


def archive_path(spark: SparkSession) -> str:
    """A new folder under the session's shared scratch folder."""
    return f"{scratch_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
