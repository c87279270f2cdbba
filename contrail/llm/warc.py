"""WARC archives written and read as chunked record tables.

A payload travels as (record, chunk number) rows of at most ``CHUNK`` bytes.
The writer streams chunk rows into gzip members, one member per record; the
reader streams members back into chunk rows that carry the offset and the
SHA-1 of the payload up to and including the chunk. Neither holds a record.

Archives lie under the shared folder and are opened through Arrow's file
systems by URI. A writing task gives each archive a fresh name and lists it in
the manifest, a Spark-written table: archives of lost or repeated attempts are
in no manifest and so are never read.
"""

from __future__ import annotations

import base64
import hashlib
import os
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.llm.common import ROW, table, with_row
from contrail.session import materialize, scratch_path

CHUNK = 1 << 18
ARCHIVE_BYTES = 64 << 20
BATCH_BYTES = 8 << 20
DATE = "1970-01-01T00:00:00Z"
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # RFC 4122, URLs
CHUNK_ROWS = ("record_id string, record_type string, page_id long, url string, refers_record string, chunk_no long, "
              "chunk binary, offset long, digest string, last boolean")


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def record_id(page_id, row: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{page_id}/{row}')}>"


def place(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder given as a path or URI (also the one-slash form ``file:/x``)."""
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    return pafs.FileSystem.from_uri(uri)


def header(fields: list[tuple[str, object]]) -> bytes:
    lines = [f"{k}: {v}" for k, v in fields if v is not None]
    return ("WARC/1.1\r\n" + "\r\n".join(lines) + "\r\n\r\n").encode()


def plan_records(spark: SparkSession, pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``pages(page_id, url, html)`` with the record each becomes: the first of equal payloads is a response, others revisit it.

    First means smallest page id, null last, then scan order, so of rows with one id only one is the response.
    Groups are found by (SHA-256, length); the join carries groups of two and more only.
    """
    rows = with_row(pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                                 F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload")))
    rows = rows.withColumn("bytes", F.octet_length("payload")).withColumn("key", F.sha2("payload", 256))
    groups = (rows.where(F.col("bytes") >= min_bytes).groupBy("key", "bytes")
              .agg(F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", F.col(ROW).alias("row"))).alias("first"),
                   F.count("*").alias("rows")).where("rows > 1")
              .select(F.col("key").alias("group_key"), F.col("first.page_id").alias("first_page"), F.col("first.row").alias("first_row")))
    groups = materialize(spark, groups, "warc-groups")  # written: the planner knows its size before it chooses the join
    joined = rows.join(groups, rows["key"] == groups["group_key"], "left")
    revisit = (F.col("bytes") >= min_bytes) & F.col("first_row").isNotNull() & (F.col("first_row") != F.col(ROW))
    return joined.select(ROW, "page_id", "url", "payload", "bytes", F.sha1("payload").alias("sha1"),
                         F.coalesce(revisit, F.lit(False)).alias("revisit"), "first_page", "first_row")


def write_archives(spark: SparkSession, pages: DataFrame, folder: str | None = None, min_bytes: int = 0,
                   chunk: int = CHUNK, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record per row of ``pages`` under ``folder`` (default: fresh, in the shared folder); the manifest (archive, records, bytes).

    Null html is an empty payload, null url leaves out the target, null page id its field; line breaks in urls are percent-encoded.
    """
    folder = folder or scratch_path(spark, "warc")
    planned = plan_records(spark, pages, min_bytes)
    count = F.when(F.col("revisit"), 1).otherwise(F.greatest(F.lit(1), F.ceil(F.col("bytes") / chunk))).cast("int")
    rows = (planned.withColumn("chunks", count).withColumn("chunk_no", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
            .select(ROW, "page_id", "url", "bytes", "sha1", "revisit", "first_page", "first_row", "chunks", "chunk_no",
                    F.when(F.col("revisit"), F.lit(b"")).otherwise(
                        F.substring("payload", F.col("chunk_no") * chunk + 1, F.lit(chunk))).alias("chunk")))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = place(folder)
        store.create_dir(path, recursive=True)
        out, done, name, pack, records = None, [], "", None, 0

        def close() -> None:
            done.append((name, records, out.tell()))
            out.close()

        for batch in batches:
            for r in batch.to_pylist():
                if r["chunk_no"] == 0:
                    if out is None or out.tell() >= archive_bytes:
                        if out is not None:
                            close()
                        name, records = os.path.join(folder, f"part-{uuid.uuid4().hex}.warc.gz"), 0
                        out = store.open_output_stream(os.path.join(path, os.path.basename(name)), compression=None)
                    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
                    digest = base32(bytes.fromhex(r["sha1"]))
                    url = None if r["url"] is None else r["url"].replace("\r", "%0D").replace("\n", "%0A")
                    pack = zlib.compressobj(1, wbits=31)
                    out.write(pack.compress(header([
                        ("WARC-Type", "revisit" if r["revisit"] else "response"),
                        ("WARC-Record-ID", record_id(r["page_id"], r[ROW])), ("WARC-Date", DATE), ("WARC-Target-URI", url),
                        ("WARC-Payload-Digest", f"sha1:{digest}"),
                        ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" if r["revisit"] else None),
                        ("WARC-Refers-To", record_id(r["first_page"], r["first_row"]) if r["revisit"] else None),
                        ("X-Page-ID", r["page_id"]), ("Content-Type", "application/http; msgtype=response"),
                        ("Content-Length", len(http) + (0 if r["revisit"] else r["bytes"]))]) + http))
                out.write(pack.compress(r["chunk"]))
                if r["chunk_no"] + 1 == r["chunks"]:
                    out.write(pack.compress(b"\r\n\r\n") + pack.flush())
                    records += 1
        if out is not None:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int64()),
                                          pa.array([d[2] for d in done], pa.int64())], ["archive", "records", "bytes"])

    return materialize(spark, rows.mapInArrow(write, "archive string, records long, bytes long"), "warc-manifest")


class Archive:
    """Lines and bounded pieces of a gzip stream of many members."""

    def __init__(self, stream, step: int = 1 << 16):
        self.stream, self.step, self.raw, self.buffer, self.unpack = stream, step, b"", bytearray(), None

    def more(self) -> bool:
        raw = self.raw or self.stream.read(self.step)
        if not raw:
            return False
        self.unpack = self.unpack or zlib.decompressobj(wbits=31)
        self.buffer += self.unpack.decompress(raw, self.step * 4)
        self.raw = self.unpack.unconsumed_tail
        if self.unpack.eof:
            self.raw, self.unpack = self.unpack.unused_data, None
        return True

    def line(self) -> bytes | None:
        """The next line without its end; None at the end of the archive."""
        start = 0
        while (end := self.buffer.find(b"\r\n", start)) < 0:
            start = max(0, len(self.buffer) - 1)
            if not self.more():
                return None
        out = bytes(self.buffer[:end])
        del self.buffer[:end + 2]
        return out

    def piece(self, most: int) -> bytes:
        while len(self.buffer) < most and self.more():
            pass
        out = bytes(self.buffer[:most])
        del self.buffer[:most]
        return out


def read_records(archive: Archive, chunk: int) -> Iterator[dict]:
    """Chunk rows of an archive, in order."""
    while (line := archive.line()) is not None:
        if not line:
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:80]!r}")
        fields = {}
        while field := archive.line():
            k, _, v = field.decode().partition(": ")
            fields[k] = v
        left = int(fields["Content-Length"])
        while (field := archive.line()) is not None:  # the HTTP header of the block
            left -= len(field) + 2
            if not field:
                break
        sha, offset, number = hashlib.sha1(), 0, 0
        page = fields.get("X-Page-ID")
        while True:
            data = archive.piece(min(chunk, left))
            if len(data) < min(chunk, left):
                raise ValueError(f"record {fields['WARC-Record-ID']} ends early")
            left -= len(data)
            sha.update(data)
            offset += len(data)
            yield {"record_id": fields["WARC-Record-ID"], "record_type": fields["WARC-Type"], "page_id": None if page is None else int(page),
                   "url": fields.get("WARC-Target-URI"), "refers_record": fields.get("WARC-Refers-To"), "chunk_no": number,
                   "chunk": data, "offset": offset, "digest": base32(sha.copy().digest()), "last": left == 0}
            number += 1
            if not left:
                break


def read_archives(spark: SparkSession, manifest: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The chunked record table of the archives in ``manifest``: a row per record and chunk, one archive per task.

    ``offset`` and ``digest`` are of the payload up to and including the chunk; on the row marked
    ``last`` they are the record's. An empty payload has one empty chunk.
    """
    schema = pa.schema([("record_id", pa.string()), ("record_type", pa.string()), ("page_id", pa.int64()), ("url", pa.string()),
                        ("refers_record", pa.string()), ("chunk_no", pa.int64()), ("chunk", pa.binary()), ("offset", pa.int64()),
                        ("digest", pa.string()), ("last", pa.bool_())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                store, path = place(uri)
                rows, size = [], 0
                with store.open_input_stream(path, compression=None) as stream:
                    for r in read_records(Archive(stream), chunk):
                        rows.append(r)
                        size += len(r["chunk"]) + 500
                        if size >= BATCH_BYTES:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, size = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema)

    parts = max(1, manifest.count())
    return manifest.select("archive").repartitionByRange(parts, "archive").mapInArrow(read, CHUNK_ROWS)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write every page, read the archives back; digests and lengths come from the chunks read, a revisit's from its response."""
    manifest = write_archives(spark, table(spark, sf_dir, "pages"))
    ends = read_archives(spark, manifest).where("last").drop("chunk")
    ends = materialize(spark, ends, "warc-ends")
    source = ends.where("record_type = 'response'").select(F.col("record_id").alias("refers_record"), F.col("page_id").alias("source_page"),
                                                           F.col("offset").alias("source_bytes"), F.col("digest").alias("source_digest"))
    revisits = ends.where("record_type = 'revisit'").join(source, "refers_record").select(
        "page_id", F.col("source_bytes").alias("payload_bytes"), F.col("source_digest").alias("payload_digest"), "record_type",
        F.col("source_page").alias("refers_to"))
    responses = ends.where("record_type = 'response'").select("page_id", F.col("offset").alias("payload_bytes"),
                                                              F.col("digest").alias("payload_digest"), "record_type",
                                                              F.lit(None).cast("long").alias("refers_to"))
    return responses.unionByName(revisits)
