"""WARC archives as a chunked record table.

``write`` streams payloads as (page, chunk number) rows into gzip-per-record archives; ``read`` streams archives back as a
table with a row per chunk: record id, chunk number, the bytes, their place, and the digest of the payload up to and
with this chunk.  The last chunk's digest is that of the record, so no reader ever holds a record whole, on either side:
a task holds one chunk, a digest and a (de)compressor.

Payloads of at least ``least`` bytes that are equal are stored once, as the ``response`` of the smallest page_id; the
other pages have ``revisit`` records without a payload that name it.  Smaller ones are all responses.

An archive is named anew by every attempt of a task and counts only if the stored manifest names it, so lost or repeated
tasks leave no wrong records.

Archives of others are read as well: warcinfo, request and other records and records of any name are rows without a
page_id, and a revisit may name no record.

Defined results: a null html is an empty payload; rows of one page_id and one payload are all responses if that id is
the smallest; a page without an id is the response only where no page with the payload has an id.  An id that occurs with
several payloads has a record for each: the name of a record holds id and digest.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mortar.llm import columns, scratch

#: Bytes of a chunk; bytes after which a task begins another archive.
CHUNK, ARCHIVE = 1 << 16, 1 << 28
DATE = "2024-01-01T00:00:00Z"
CHUNKS = (
    "file string, page_id long, record_id string, record_type string, refers_to_record string, target string, "
    "chunk_no int, offset long, size int, payload_digest string, declared_digest string, last boolean, chunk binary"
)
SIZE = [c.split()[0] for c in CHUNKS.split(", ")].index("size")


def base32_sha1(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def record_id(page_id: int | None, digest: str, nth: int) -> str:
    """Name of a page's record; pages without an id are told apart by their place in the archive."""
    return f"<urn:page:{f'none-{nth}' if page_id is None else page_id}:{digest}>"


_OWN_ID = re.compile("<urn:page:(-?[0-9]+):[A-Z2-7]+>")


def page_of(record: str) -> int | None:
    """Page of a record name; none for pages without an id and records that ``write`` has not named."""
    own = _OWN_ID.fullmatch(record)
    return int(own[1]) if own else None


def decide(pages: DataFrame, least: int = 0) -> DataFrame:
    """Pages with payload, payload_bytes, sha1 (hex) and refers_to (null: a response)."""
    columns.need(pages, "page_id", "url", "html")
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload"))
    rows = rows.select("*", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("sha1"))
    # ids alone are grouped: one row for each payload and task goes through the shuffle, and those of single pages end here
    first = rows.filter(F.col("payload_bytes") >= least).groupBy("sha1").agg(
        F.min("page_id").alias("first"), F.count("*").alias("n")
    )
    first = first.filter("n > 1").drop("n")
    return rows.join(first, "sha1", "left").withColumn(
        "refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    ).drop("first")


def write(pages: DataFrame, folder: str, least: int = 0, chunk: int = CHUNK, archive: int = ARCHIVE) -> DataFrame:
    """Write one record per page; returns the stored manifest (file, records, bytes)."""
    rows = decide(pages, least)
    # a page becomes rows of one chunk each; revisits have an empty payload
    stored = F.when(F.col("refers_to").isNull(), F.col("payload_bytes")).otherwise(F.lit(0))
    numbers = F.sequence(F.lit(0), F.greatest(F.ceil(stored / chunk).cast("int") - 1, F.lit(0)))
    rows = rows.withColumn("chunk_no", F.explode(numbers))
    part = F.when(
        F.col("refers_to").isNull(), F.substring(F.col("payload"), F.col("chunk_no") * chunk + 1, F.lit(chunk))
    ).otherwise(F.lit(b""))
    rows = rows.select("page_id", "url", "payload_bytes", "sha1", "refers_to", "chunk_no", part.alias("chunk"))

    def archives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = scratch.file_system(folder)
        system.create_dir(base, recursive=True)
        out, name, records, done, left, press = None, "", 0, 0, 0, None
        finished = []
        try:
            for batch in batches:
                for page, url, size, sha1, refers, number, part in zip(*(c.to_pylist() for c in batch.columns)):
                    if number == 0:
                        if out is not None and done >= archive:
                            out.close()
                            finished.append((name, records, done))
                            out = None
                        if out is None:
                            name, records, done = scratch.attempt_name("pages", ".warc.gz"), 0, 0
                            out = system.open_output_stream(f"{base}/{name}", compression=None)
                        press = zlib.compressobj(6, zlib.DEFLATED, 31)
                        left = size if refers is None else 0
                        done += _put(out, press.compress(_head(page, url, size, sha1, refers, records)))
                        records += 1
                    left -= len(part)
                    done += _put(out, press.compress(part))
                    if left == 0:
                        done += _put(out, press.compress(b"\r\n\r\n") + press.flush())
                        left = -1
        finally:
            if out is not None:
                out.close()
        if out is not None:
            finished.append((name, records, done))
        if finished:
            names, counts, sizes = zip(*finished)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names), pa.array(counts, pa.int64()), pa.array(sizes, pa.int64())], names=["file", "records", "bytes"]
            )

    return scratch.stored(rows.mapInArrow(archives, "file string, records long, bytes long"), "manifest")


def _put(out, data: bytes) -> int:
    out.write(data)
    return len(data)


def _head(page: int | None, url: str | None, size: int, sha1: str, refers: int | None, nth: int) -> bytes:
    """WARC and HTTP header of a record."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    digest = base32_sha1(bytes.fromhex(sha1))
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page, digest, nth)}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(http) + (size if refers is None else 0)}",
    ]
    if url is not None:
        lines.append("WARC-Target-URI: " + "".join(c if c.isprintable() else f"%{ord(c):02X}" for c in url))
    if refers is not None:
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"WARC-Refers-To: {record_id(refers, digest, 0)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + http


class _Unpacked:
    """Bytes of a gzip file of many members, read on demand."""

    def __init__(self, stream, step: int):
        self.stream, self.step, self.press, self.buffer, self.ended = stream, step, None, bytearray(), False
        self.rest = b""

    def _more(self) -> bool:
        while True:
            if self.press is not None and self.press.eof:
                self.rest = self.press.unused_data
                self.press = None
            if not self.rest:
                self.rest = self.stream.read(self.step)
                if not self.rest:
                    if self.press is not None:
                        raise ValueError("archive cut short")
                    return False
            if self.press is None:
                self.press = zlib.decompressobj(31)
            data = self.press.decompress(self.rest, self.step)
            self.rest = self.press.unconsumed_tail
            if data:
                self.buffer += data
                return True

    def until(self, mark: bytes, most: int = 1 << 20) -> bytes | None:
        """Bytes up to and with a mark; None at the end of the archive."""
        while (at := self.buffer.find(mark)) < 0:
            if len(self.buffer) > most:
                raise ValueError("header too long")
            if not self._more():
                if self.buffer:
                    raise ValueError("archive cut short")
                return None
        return self.take(at + len(mark))

    def take(self, n: int) -> bytes:
        """The next n bytes, fewer only at the end of the archive."""
        while len(self.buffer) < n and self._more():
            pass
        out = bytes(self.buffer[:n])
        del self.buffer[:n]
        return out


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines) if k.strip()}


def chunk_rows(stream, name: str, chunk: int, with_bytes: bool) -> Iterator[tuple]:
    """Rows of the chunk table of one archive, in order."""
    source = _Unpacked(stream, chunk)
    while (head := source.until(b"\r\n\r\n")) is not None:
        if not head.startswith(b"WARC/"):
            raise ValueError(f"no record header in {name}")
        fields = _fields(head)
        http = source.until(b"\r\n\r\n") if fields.get("content-type", "").startswith("application/http") else b""
        left = int(fields["content-length"]) - len(http)
        rid, kind = fields["warc-record-id"], fields["warc-type"]
        known = (name, page_of(rid), rid, kind, fields.get("warc-refers-to"), fields.get("warc-target-uri"))
        declared = fields.get("warc-payload-digest", "")
        declared = declared.removeprefix("sha1:") if declared.startswith("sha1:") else None
        running, number, offset = hashlib.sha1(), 0, 0
        while True:
            part = source.take(min(chunk, left))
            if len(part) < min(chunk, left):
                raise ValueError("record cut short")
            running.update(part)
            left -= len(part)
            # a copy of the running state: the digest of all bytes so far
            digest = base32_sha1(running.copy().digest())
            yield (*known, number, offset, len(part), digest, declared, left == 0, part if with_bytes else None)
            number, offset = number + 1, offset + len(part)
            if left == 0:
                break
        # a payload that came in transfer chunks was digested without their marks
        plain = b"\r\ntransfer-encoding:" not in http.lower()
        if kind == "response" and plain and declared not in (None, digest):
            raise ValueError(f"payload of {rid} does not match its digest")
        if source.take(4) != b"\r\n\r\n":
            raise ValueError(f"record {rid} has no end")


def read(spark: SparkSession, folder: str, manifest: DataFrame, chunk: int = CHUNK, with_bytes: bool = True) -> DataFrame:
    """Chunk table of the archives that the manifest names."""
    names = [c.split()[0] for c in CHUNKS.split(", ")]
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary()}
    types = [kinds[c.split()[1]] for c in CHUNKS.split(", ")]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = scratch.file_system(folder)
        for files in batches:
            for name in files.column(0).to_pylist():
                held, size = [], 0
                with system.open_input_stream(f"{base}/{name}", compression=None, buffer_size=1 << 20) as stream:
                    for row in chunk_rows(stream, name, chunk, with_bytes):
                        held.append(row)
                        size += 256 + (row[SIZE] if with_bytes else 0)
                        if size >= 1 << 20:
                            yield batch(held)
                            held, size = [], 0
                if held:
                    yield batch(held)

    # one task an archive: the names alone say nothing of their size
    return manifest.select("file").repartition(max(1, manifest.count())).mapInArrow(rows, CHUNKS)


def records(chunks: DataFrame) -> DataFrame:
    """One row per record from its last chunk.

    Revisits take their size from the record they refer to, whose digest must be the one they declare.
    """
    ends = chunks.filter("last").select(
        "page_id", "record_id", "record_type", "refers_to_record", "target",
        (F.col("offset") + F.col("size")).cast("long").alias("n"), "payload_digest", "declared_digest",
    )
    ends = scratch.stored(ends, "records")
    columns_ = ["page_id", "n", "payload_digest", "record_type", "refers_to", "target"]
    whole = ends.filter("record_type = 'response'").select(
        F.col("record_id").alias("refers_to_record"), F.col("page_id").alias("refers_to"),
        F.col("n").alias("full_n"), F.col("payload_digest").alias("full_digest"),
    ).dropDuplicates(["refers_to_record"])
    # written, so that the join has a plain shuffle on both sides: Spark can then split a response of many revisits
    whole = scratch.stored(whole, "responses")
    alone = ends.filter("refers_to_record IS NULL").withColumn("refers_to", F.lit(None).cast("long"))
    revisits = ends.filter("refers_to_record IS NOT NULL").join(whole, "refers_to_record", "left")
    differs = F.col("full_digest") != F.col("declared_digest")
    wrong = F.concat(F.lit("payload of "), "record_id", F.lit(" is not that of the record it refers to"))
    revisits = revisits.withColumns({
        "n": F.coalesce("full_n", "n"),
        "payload_digest": F.when(differs, F.raise_error(wrong)).otherwise(F.coalesce("full_digest", "payload_digest")),
    })
    return alone.select(*columns_).unionByName(revisits.select(*columns_)).withColumnRenamed("n", "payload_bytes")


def round_trip(pages: DataFrame, least: int = 0) -> DataFrame:
    """Write the archives and read them back, one row per record."""
    folder = scratch.fresh_path(pages.sparkSession, "warc")
    manifest = write(pages, folder, least)
    return records(read(pages.sparkSession, folder, manifest, with_bytes=False))
