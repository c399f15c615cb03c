"""WARC archives as a chunked record table.

An archive is a table of rows (archive, number, record_id, chunk_no, last, header, data, digest): the chunks of a
record in order, its header first, are the record's bytes, and the records of an archive in order of their numbers are
a WARC/1.1 file. A payload
over ``chunk_bytes`` is streamed as several rows, each with the SHA-1 of the payload so far, so neither the writer's
output nor the reader ever holds a whole oversized record; the reader carries one digest from chunk to chunk.

Defined results: a null payload is empty; a repeated id is a record of its own, with the same record id; of records
with equal payloads of at least ``least`` bytes that with the largest id is the response, ties included (each of the
tied rows is one); a record with a null id is always a response; an empty table gives an empty archive; other columns
are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import dealt, table, written

CHUNK_BYTES = 1 << 20
LEAST_REVISIT = 1000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CHUNKS = "archive int, number long, record_id long, chunk_no int, last boolean, header string, data binary, digest string"
_ARROW = pa.schema([("archive", pa.int32()), ("number", pa.int64()), ("record_id", pa.int64()), ("chunk_no", pa.int32()), ("last", pa.bool_()), ("header", pa.string()), ("data", pa.binary()), ("digest", pa.string())])


def record_header(record_id: int, url: str | None, kind: str, digest: str, size: int, refers_to: int | None) -> str:
    """WARC and HTTP header of a record. A revisit's block has the HTTP header alone, with the full payload's length."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n"
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{record_id}>", "WARC-Date: 2024-01-01T00:00:00Z"]
    lines += [f"WARC-Target-URI: {''.join((url or '').split())}", f"WARC-Payload-Digest: sha1:{digest}"]
    if kind == "revisit":
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    block = len(http) + (size if kind == "response" else 0)
    return "\r\n".join([*lines, "Content-Type: application/http; msgtype=response", f"Content-Length: {block}"]) + "\r\n\r\n" + http


def parse_header(text: str) -> dict[str, str]:
    """Fields of a WARC header and, under ``http:``, of the HTTP header after it; names in lower case."""
    warc, _, http = text.partition("\r\n\r\n")
    fields = {"version": warc.split("\r\n", 1)[0]}
    for prefix, part in (("", warc), ("http:", http)):
        for line in part.split("\r\n")[1:]:
            name, colon, value = line.partition(":")
            if colon:
                fields[prefix + name.strip().lower()] = value.strip()
    return fields


def write_chunks(batches: Iterable[pa.RecordBatch], chunk_bytes: int) -> Iterator[pa.RecordBatch]:
    number = 0
    for batch in batches:
        rows: list[tuple] = []
        held = 0
        for archive, record_id, url, payload, digest, size, response in zip(*[batch.column(c) for c in ("archive", "record_id", "url", "payload", "digest", "size", "response")], strict=True):
            size, record_id = size.as_py(), record_id.as_py()
            revisit = response.as_py() is not None and response.as_py() != record_id
            header = record_header(record_id, url.as_py(), "revisit" if revisit else "response", digest.as_py(), size, response.as_py())
            body = memoryview(payload.as_buffer())[: 0 if revisit else size] if size else memoryview(b"")
            state = hashlib.sha1()
            for no, at in enumerate(range(0, max(len(body), 1), chunk_bytes)):
                piece = body[at : at + chunk_bytes]
                state.update(piece)
                rows.append((archive.as_py(), number, record_id, no, at + chunk_bytes >= len(body), None if no else header, bytes(piece), state.hexdigest()))
                held += len(piece)
                if held >= 8 * chunk_bytes:
                    yield pa.RecordBatch.from_pylist([dict(zip(_ARROW.names, r, strict=True)) for r in rows], _ARROW)
                    rows, held = [], 0
            number += 1
        if rows:
            yield pa.RecordBatch.from_pylist([dict(zip(_ARROW.names, r, strict=True)) for r in rows], _ARROW)


def write_archive(records: DataFrame, id_column: str = "page_id", url_column: str = "url", payload_column: str = "html", least: int = LEAST_REVISIT, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The chunk rows of an archive of all records. Only ids and digests are shuffled to find equal payloads; the
    payloads move once, by id, to meet their verdicts."""
    given = records.select(F.col(id_column).cast("long").alias("record_id"), F.col(url_column).alias("url"), F.coalesce(F.col(payload_column), F.lit("")).cast("binary").alias("payload"))
    marks = given.select("record_id", F.sha1("payload").alias("digest"), F.octet_length("payload").cast("long").alias("size"), F.xxhash64("payload").alias("check")).filter(F.col("size") >= least)
    groups = marks.groupBy("digest", "size", "check").agg(F.max("record_id").alias("response"), F.count("*").alias("copies")).filter("copies > 1").drop("copies")
    found = marks.distinct().join(dealt(groups), ["digest", "size", "check"]).select("record_id", "digest", "response")
    keyed = given.withColumn("digest", F.sha1("payload")).withColumn("size", F.octet_length("payload").cast("long"))
    paired = keyed.join(dealt(found.filter("response != record_id")), ["record_id", "digest"], "left")
    return paired.withColumn("archive", F.spark_partition_id()).mapInArrow(lambda it: write_chunks(it, chunk_bytes), CHUNKS)


def read_chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Walks chunks in order and closes a record at its last one. Raises if a digest or a length doesn't hold."""
    state, size, fields = hashlib.sha1(), 0, {}
    names = ["record_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    for batch in batches:
        out: list[tuple] = []
        for record_id, no, last, header, data, digest in zip(*[batch.column(c) for c in ("record_id", "chunk_no", "last", "header", "data", "digest")], strict=True):
            if no.as_py() == 0:
                state, size, fields = hashlib.sha1(), 0, parse_header(header.as_py())
            piece = data.as_buffer()
            state.update(piece)
            size += piece.size
            if state.hexdigest() != digest.as_py():
                raise ValueError(f"record {record_id}: chunk {no} doesn't have its digest")
            if last.as_py():
                told = fields["warc-payload-digest"].partition(":")[2]
                length = int(fields["http:content-length"])
                refers = fields.get("warc-refers-to")
                if refers is None and (told != state.hexdigest() or length != size):
                    raise ValueError(f"record {record_id}: the payload isn't what the header says")
                out.append((record_id.as_py(), length, told, fields["warc-type"], int(refers.strip("<>").rpartition(":")[2]) if refers else None))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)


def read_archive(chunks: DataFrame) -> DataFrame:
    """The records of an archive: record_id, payload_bytes, payload_digest (hex SHA-1 of the full payload),
    record_type, refers_to. Records of one chunk are read where they lie; only chunks of others are brought together,
    a record's to one task, which holds one of them at a time."""
    result = "record_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    whole = (F.col("chunk_no") == 0) & F.col("last")
    alone = chunks.filter(whole).mapInArrow(read_chunks, result)
    streamed = chunks.filter(~whole).repartition("archive", "number").sortWithinPartitions("archive", "number", "chunk_no").mapInArrow(read_chunks, result)
    return alone.unionByName(streamed)


def warc_bytes(chunks: DataFrame) -> Iterator[bytes]:
    """The archive as the bytes of a WARC file, streamed to the caller chunk by chunk."""
    for row in chunks.orderBy("archive", "number", "chunk_no").toLocalIterator():
        if row.header is not None:
            yield row.header.encode()
        yield bytes(row.data)
        if row.last:
            yield b"\r\n\r\n"


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_archive(written(write_archive(table(spark, sf_dir, "pages")), "warc")).withColumnRenamed("record_id", "page_id")


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, octet_length(encode(html)) AS payload_bytes, sha1(html) AS payload_digest FROM p),
g AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS top FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= 1000 AND top <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND top <> page_id THEN top END AS refers_to FROM g
"""
