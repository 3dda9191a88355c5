"""Length-delimited binary records of token ids, with masked checksums and a separate offset index.

A shard file is a run of records.  A record is

    length of the payload   unsigned 64-bit, little-endian
    masked CRC-32C          of these 8 bytes, unsigned 32-bit
    payload                 ids as unsigned 16-bit (vocabularies up to 65,536 ids) or 32-bit integers, little-endian
    masked CRC-32C          of the payload, unsigned 32-bit

The mask is that of the common record format: the checksum turned right by 15 bits plus 0xa282ead8.  The index is a
table with a row per record: shard, file, place within the shard, document, byte offset, payload bytes, ids and the ids
of the shard before it.  It lets a reader seek to single records in any order.  A file is named anew by every attempt of a
task and counts only if the index names it, so lost or repeated tasks leave no wrong records.

Defined results: a null or empty text is a record with the end id alone; equal ids are records in the order of their
texts' hashes; documents without an id come first.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mortar.llm import bpe, columns, ranges, scratch

END_ID = 1
#: Bytes that run side by side in checksums.
SEGMENT = 1024
#: Characters of text that are framed together.
BLOCK = 1 << 20
_MASK = 0xA282EAD8
INDEX = "shard int, file string, place int, doc_id long, at long, bytes long, n_ids long, ids_before long"


@lru_cache(maxsize=None)
def _crc_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """CRC-32C steps over two bytes and one byte, and, by byte of the state, over ``SEGMENT`` zero bytes."""
    byte = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        byte = np.where(byte & 1, (byte >> 1) ^ np.uint32(0x82F63B78), byte >> 1).astype(np.uint32)
    step = lambda s: byte[s & 255] ^ (s >> np.uint32(8))
    two = step(step(np.arange(65536, dtype=np.uint32)))
    zeros = (np.arange(256, dtype=np.uint32)[None, :] << np.arange(0, 32, 8, dtype=np.uint32)[:, None]).ravel()
    for _ in range(SEGMENT):
        zeros = step(zeros)
    return two, byte, zeros.reshape(4, 256)


def crc32c(parts: list[bytes]) -> np.ndarray:
    """CRC-32C of many byte strings.

    All segments of all strings run side by side, two bytes a step, and are joined by the linearity of the checksum, so
    the steps do not grow with the longest string.  A string's short segment is its first one.
    """
    two, byte, zeros = _crc_tables()
    sizes = np.array([len(p) for p in parts], np.int64)
    starts = np.cumsum(sizes) - sizes
    data = np.frombuffer(b"".join(parts) + b"\x00", np.uint8)
    full, head = sizes // SEGMENT, sizes % SEGMENT

    order = np.argsort(-head, kind="stable")
    at, pairs = starts[order], head[order] // 2
    run = np.full(sizes.size, 0xFFFFFFFF, np.uint32)
    live = np.searchsorted(-pairs, -np.arange(1, int(pairs.max(initial=0)) + 1), side="right")
    for k, n in enumerate(live.tolist()):
        here = at[:n] + 2 * k
        word = data[here].astype(np.uint32) | (data[here + 1].astype(np.uint32) << np.uint32(8))
        run[:n] = two[(run[:n] ^ word) & np.uint32(0xFFFF)] ^ (run[:n] >> np.uint32(16))
    odd = np.flatnonzero(head[order] % 2)
    last = data[at[odd] + head[order][odd] - 1]
    run[odd] = byte[(run[odd] ^ last) & np.uint32(255)] ^ (run[odd] >> np.uint32(8))
    state = np.empty_like(run)
    state[order] = run

    first = np.cumsum(full) - full
    if full.any():
        owner = np.repeat(np.arange(sizes.size), full)
        begin = starts[owner] + head[owner] + (np.arange(owner.size) - first[owner]) * SEGMENT
        words = data[begin[:, None] + np.arange(SEGMENT)].view("<u2").T.astype(np.uint32)
        part = np.zeros(owner.size, np.uint32)
        for word in words:
            part = two[(part ^ word) & np.uint32(0xFFFF)] ^ (part >> np.uint32(16))
        for k in range(int(full.max())):
            on = np.flatnonzero(full > k)
            s = state[on]
            moved = zeros[0][s & 255] ^ zeros[1][(s >> 8) & 255] ^ zeros[2][(s >> 16) & 255] ^ zeros[3][s >> 24]
            state[on] = moved ^ part[first[on] + k]
    return ~state


def masked(crc: np.ndarray) -> np.ndarray:
    crc = crc.astype(np.uint32)
    return ((crc >> np.uint32(15)) | (crc << np.uint32(17))) + np.uint32(_MASK)


def frame(payloads: list[bytes]) -> list[bytes]:
    """The records of some payloads."""
    lengths = [len(p).to_bytes(8, "little") for p in payloads]
    heads, tails = masked(crc32c(lengths)).astype("<u4"), masked(crc32c(payloads)).astype("<u4")
    return [n + heads[i].tobytes() + p + tails[i].tobytes() for i, (n, p) in enumerate(zip(lengths, payloads))]


def read_records(stream, batch_bytes: int = 4 << 20) -> Iterator[list[bytes]]:
    """Payloads of a shard in batches, all checksums tested; raises ValueError on a broken or cut record."""
    while True:
        lengths, heads, payloads, tails, size = [], [], [], [], 0
        while size < batch_bytes:
            head = stream.read(12)
            if not head:
                break
            n = int.from_bytes(head[:8], "little")
            if len(head) < 12 or masked(crc32c([head[:8]]))[0] != int.from_bytes(head[8:], "little"):
                raise ValueError("broken record length")
            body = stream.read(n + 4)
            if len(body) < n + 4:
                raise ValueError("record cut short")
            payloads.append(body[:n])
            tails.append(int.from_bytes(body[n:], "little"))
            size += n + 16
        if not payloads:
            return
        if (masked(crc32c(payloads)) != np.array(tails, np.uint32)).any():
            raise ValueError("checksum differs")
        yield payloads


def write(docs: DataFrame, folder: str, vocabulary: str, end_id: int = END_ID) -> DataFrame:
    """Encode every whole text, append the end id, write shards in ascending order of doc_id; returns the stored index."""
    columns.need(docs, "doc_id", "text")
    spark = docs.sparkSession
    token, shared = bpe.share_vocabulary(spark, vocabulary)
    cuts = ranges.cut_points(docs, "doc_id")
    wide = max(max(bpe.Encoder(shared.value).strings), end_id) >= 1 << 16
    width = 4 if wide else 2

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = bpe.worker_encoder(token, shared)
        system, base = scratch.file_system(folder)
        system.create_dir(base, recursive=True)
        shard, out, name, at, place, before = None, None, "", 0, 0, 0
        try:
            for batch in batches:
                shard_of, ids, texts = (batch.column(i).to_pylist() for i in range(3))
                first = 0
                while first < len(texts):
                    last = first
                    size = 0
                    while last < len(texts) and shard_of[last] == shard_of[first] and size < BLOCK:
                        size += len(texts[last] or "")
                        last += 1
                    if shard_of[first] != shard:
                        if out is not None:
                            out.close()
                        shard, at, place, before = shard_of[first], 0, 0, 0
                        name = scratch.attempt_name(f"shard-{shard:05d}", ".rec")
                        out = system.open_output_stream(f"{base}/{name}", compression=None)
                    coded, bounds = encoder.encode_many(texts[first:last])
                    packed = np.insert(coded, bounds[1:], end_id).astype(f"<u{width}").tobytes()
                    bounds = ((bounds + np.arange(bounds.size)) * width).tolist()
                    payloads = [packed[a:b] for a, b in zip(bounds, bounds[1:])]
                    framed, rows = frame(payloads), []
                    out.write(b"".join(framed))
                    for doc, payload, record in zip(ids[first:last], payloads, framed):
                        n = len(payload) // width
                        rows.append((shard, name, place, doc, at, len(payload), n, before))
                        at, place, before = at + len(record), place + 1, before + n
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows), _INDEX_TYPES)], names=_INDEX_NAMES
                    )
                    first = last
        finally:
            if out is not None:
                out.close()

    dealt = docs.select(ranges.bucket(F.col("doc_id"), cuts).alias("shard"), "doc_id", "text")
    dealt = dealt.repartition("shard").sortWithinPartitions("shard", "doc_id", F.xxhash64("text"), "text")
    return scratch.stored(dealt.mapInArrow(shards, INDEX), "index")


_INDEX_NAMES = [c.split()[0] for c in INDEX.split(", ")]
_INDEX_TYPES = [{"int": pa.int32(), "string": pa.string(), "long": pa.int64()}[c.split()[1]] for c in INDEX.split(", ")]


def read(spark: SparkSession, folder: str, index: DataFrame, width: int = 2, with_ids: bool = True) -> DataFrame:
    """(file, place, n_ids, ids_before, ids_crc32, ids) of every record of the files that the index names.

    Without ``with_ids`` the ids themselves stay in the task, and their column is NULL.
    """

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = scratch.file_system(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                place = before = 0
                with system.open_input_stream(f"{base}/{name}", compression=None, buffer_size=1 << 20) as stream:
                    for payloads in read_records(stream):
                        ids = [np.frombuffer(p, f"<u{width}").astype("<u4") for p in payloads]
                        sizes = np.array([x.size for x in ids], np.int64)
                        offsets = np.concatenate([[0], np.cumsum(sizes)])
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([name] * len(ids)),
                                pa.array(np.arange(place, place + len(ids), dtype=np.int32)),
                                pa.array(sizes),
                                pa.array(before + offsets[:-1]),
                                pa.array([zlib.crc32(x) for x in ids], pa.int64()),
                                pa.ListArray.from_arrays(
                                    offsets.astype(np.int32), pa.array(np.concatenate(ids).view(np.int32))
                                )
                                if with_ids
                                else pa.nulls(len(ids), pa.list_(pa.int32())),
                            ],
                            names=["file", "place", "n_ids", "ids_before", "ids_crc32", "ids"],
                        )
                        place, before = place + len(ids), before + int(offsets[-1])

    # one task a file: their number is bounded, and their names alone say nothing of their size
    files = index.select("file").distinct()
    files = files.repartition(max(1, files.count()))
    return files.mapInArrow(records, "file string, place int, n_ids long, ids_before long, ids_crc32 long, ids array<int>")


def starts(index: DataFrame) -> DataFrame:
    """(file, start): ids of all shards before each shard; one row per shard, of which there are at most ``ranges.MOST_BUCKETS``."""
    sizes = index.groupBy("shard", "file").agg(F.sum("n_ids").alias("n")).orderBy("shard").collect()
    rows, total = [], 0
    for r in sizes:
        rows.append((r["file"], total))
        total += r["n"]
    return index.sparkSession.createDataFrame(rows, "file string, start long")


def round_trip(docs: DataFrame, vocabulary: str, end_id: int = END_ID) -> DataFrame:
    """Write the records, read the files back; per document: doc_id, start, n_tokens, ids_crc32."""
    spark = docs.sparkSession
    folder = scratch.fresh_path(spark, "records")
    index = write(docs, folder, vocabulary, end_id)
    found = read(spark, folder, index, with_ids=False).drop("ids")
    named = index.select("file", "place", "doc_id")
    return (
        found.hint("merge").join(named.hint("merge"), ["file", "place"])  # as many rows as documents on both sides
        .join(F.broadcast(starts(index)), "file")
        .select("doc_id", (F.col("start") + F.col("ids_before")).alias("start"), F.col("n_ids").alias("n_tokens"), "ids_crc32")
    )
