"""Substring dedup by content-defined chunks.

A gear hash rolls over a text's bytes: h = 2 * h + G[byte] modulo 2**32, so it depends on the last 32 bytes alone.  A chunk
ends where its top ``BITS`` bits are zero, moved to the end of the word if that is within 32 bytes and otherwise to the
end of the character.  Ends depend on what stands around them only: equal passages have equal chunks wherever they
stand, and an insertion changes the chunks it touches.  No length limits shift the ends.

Chunks are grouped by a 64-bit digest.  The document of the least id holds the first copy; the chunk in other documents
repeats it, as does every further copy in one text.  A run of repeated chunks of at least ``LEAST`` words is removed, so
short phrases that texts share by chance stay.

Defined results: null and empty texts have no chunks and stay as they are; rows of one id do not repeat each other;
documents without an id come after those with one and do not repeat each other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mortar.llm import bytescan, columns, scratch

BITS, LEAST = 5, 16
#: Of the query: the coarser cut leaves fewer than LEAST words in whole chunks of some 51-word passages.
FINE = 4
NO_ID = (1 << 63) - 1
_GEAR = np.random.default_rng(77).integers(0, 2**32, 256, dtype=np.uint32)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def chunk_ends(data: np.ndarray, offsets: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Ascending ends of the chunks of all texts; a text's last chunk ends with it."""
    if not data.size:
        return np.zeros(0, np.int64)
    h = _GEAR[data]
    into = np.arange(data.size) - np.repeat(offsets[:-1], np.diff(offsets))  # bytes of the text before this one
    for k in (1, 2, 4, 8, 16):  # sums over the last 2k bytes from sums over the last k
        before = np.zeros_like(h)
        before[k:] = h[:-k]
        before[into < k] = 0
        h = h + (before << np.uint32(k))
    hit = np.flatnonzero(h >> np.uint32(32 - bits) == 0) + 1
    stop = offsets[np.searchsorted(offsets, hit, side="left")]  # the end of the own text
    spaces = np.flatnonzero(_SPACE[data])
    place = np.searchsorted(spaces, hit - 1)
    nearest = np.append(spaces, data.size + 64)[place] + 1
    heads = np.flatnonzero((data & 0xC0) != 0x80)
    whole = np.append(heads, data.size)[np.searchsorted(heads, hit)]
    moved = np.where((nearest <= hit + 32) & (nearest <= stop), nearest, whole)
    ends = np.concatenate([np.minimum(moved, stop), offsets[1:][np.diff(offsets) > 0]])
    return np.unique(ends)


class Chunks:
    """Chunks of a block of texts: ends, digests, words, and the bounds of each text's chunks."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, bits: int = BITS):
        self.ends = chunk_ends(data, offsets, bits)
        self.starts = np.concatenate([[0], self.ends[:-1]]) if self.ends.size else self.ends
        self.digest = bytescan.byte_hashes(data, self.starts, self.ends).view(np.int64)
        first, _ = bytescan.spans(~_SPACE[data], offsets)
        self.words = np.searchsorted(first, self.ends) - np.searchsorted(first, self.starts)
        self.bounds = np.searchsorted(self.ends, offsets, side="right")


def digests(docs: DataFrame, bits: int = BITS) -> DataFrame:
    """(id, a, digests): the distinct chunk digests of every whole text; id and a identify the row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bytescan.sliced(batches, "text"):
            for first, data, offsets in bytescan.blocks(batch.column("text")):
                c = Chunks(data, offsets, bits)
                own = [np.unique(c.digest[i:j]) for i, j in zip(c.bounds[:-1], c.bounds[1:])]
                sizes = np.concatenate([[0], np.cumsum([x.size for x in own])]).astype(np.int32)
                flat = np.concatenate(own) if own else np.zeros(0, np.int64)
                part = batch.slice(first, offsets.size - 1).drop_columns(["text"])
                yield bytescan.with_columns(part, digests=pa.ListArray.from_arrays(sizes, pa.array(flat)))

    return docs.mapInArrow(run, "id long, a long, digests array<long>")


def _keys() -> list[Column]:
    """Order key (documents without an id last) and 16 bits of the text's hash.

    The bits keep the rows of one id apart, so that no list grows with them.  Rows that share id and bits share a list:
    that changes nothing, since a digest counts in a row only where its text has that chunk.
    """
    bits = F.shiftrightunsigned(F.xxhash64(F.col("text").isNull(), "text"), 48)
    return [F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), bits.alias("a")]


def repeated(docs: DataFrame, bits: int = BITS) -> DataFrame:
    """(id, a, repeats): for every document that shares chunks with an earlier one, these digests and the first owners."""
    rows = digests(docs.select(*_keys(), "text").filter("text <> ''"), bits)
    rows = rows.select("id", "a", F.explode("digests").alias("digest"))
    # counts and minima of fixed width: combined by hashing before the shuffle
    least = rows.groupBy("digest").agg(F.min("id").alias("owner"), F.max("id").alias("last"))
    # written, so that the join has a plain shuffle on both sides: Spark can then split a chunk that most documents have
    least = scratch.stored(least.filter("owner < last").drop("last"), "owners")
    shared = rows.join(least, "digest").filter("id > owner")
    return shared.groupBy("id", "a").agg(F.collect_list(F.struct("digest", "owner")).alias("repeats"))


def deduplicate(docs: DataFrame, least: int = LEAST, bits: int = BITS) -> tuple[DataFrame, dict[str, str]]:
    """Documents with the repeated runs cut out of ``text``, and the names of the added columns.

    ``n_chunks``; ``n_repeated`` chunks that repeat earlier ones; ``n_removed`` words cut; ``owners``: ids of the
    documents that hold the first copies of what was cut.
    """
    columns.need(docs, "doc_id", "text")
    names = {n: columns.free_name(docs, n) for n in ("n_chunks", "n_repeated", "n_removed", "owners")}
    rep, ida, ka = (columns.free_name(docs, n) for n in ("repeats", "order_key", "text_key"))
    found = repeated(docs, bits).select(F.col("id").alias(ida), F.col("a").alias(ka), F.col("repeats").alias(rep))
    id_, a = _keys()
    joined = docs.withColumns({ida: id_, ka: a}).join(found, [ida, ka], "left").drop(ka)
    kinds = {"n_chunks": "long", "n_repeated": "long", "n_removed": "long", "owners": "array<long>"}
    kept, plain = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema], docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bytescan.sliced(batches, "text"):
            texts, rows = [], []
            lists = batch.column(rep)
            nulls = batch.column("text").is_null().to_pylist()
            ids = batch.column(ida).to_pylist()
            for first, data, offsets in bytescan.blocks(batch.column("text")):
                c = Chunks(data, offsets, bits)
                raw = data.tobytes()
                for i in range(offsets.size - 1):
                    text, row = _cut(c, i, raw[offsets[i] : offsets[i + 1]], int(offsets[i]), lists[first + i], ids[first + i], least)
                    texts.append(None if nulls[first + i] else text)
                    rows.append(row)
            made = [list(x) for x in zip(*rows)]
            types = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
            added = {names[n]: pa.array(v, t) for n, v, t in zip(kinds, made, types)}
            out = bytescan.with_columns(batch.drop_columns([rep, ida]), **{"text": pa.array(texts, pa.string())}, **added)
            yield out.select([*plain, *added])

    schema = ", ".join([*kept, *(f"`{names[n]}` {k}" for n, k in kinds.items())])
    return joined.mapInArrow(run, schema), names


def _cut(c: Chunks, i: int, raw: bytes, at: int, repeats: pa.Scalar, own_id: int, least: int) -> tuple[str, tuple]:
    """Text i without its repeated runs, and the row (chunks, repeated, removed words, owners)."""
    lo, hi = int(c.bounds[i]), int(c.bounds[i + 1])
    digest, words = c.digest[lo:hi], c.words[lo:hi]
    owner, again = np.zeros(hi - lo, np.int64), np.zeros(hi - lo, bool)
    if hi - lo > 1:
        _, first, back = np.unique(digest, return_index=True, return_inverse=True)
        again = first[back] < np.arange(hi - lo)  # in the same text
        owner[again] = own_id
    if repeats.is_valid:
        known, of = (repeats.values.field(n).to_numpy() for n in ("digest", "owner"))
        order = np.argsort(known)
        known, of = known[order], of[order]
        place = np.minimum(np.searchsorted(known, digest), known.size - 1)
        hit = known[place] == digest
        owner[hit], again[hit] = of[place[hit]], True
    n_repeated = int(again.sum())
    if not n_repeated:
        return raw.decode(), (hi - lo, 0, 0, [])
    turn = np.flatnonzero(np.diff(np.concatenate([[False], again, [False]]).astype(np.int8)))
    pieces, start, removed, owners = [], 0, 0, set()
    for a, b in zip(turn[::2], turn[1::2]):
        n = int(words[a:b].sum())
        if n >= least:
            pieces.append(raw[start : int(c.starts[lo + a]) - at])
            start = int(c.ends[lo + b - 1]) - at
            removed += n
            owners.update(owner[a:b].tolist())
    text = (b"".join(pieces) + raw[start:]).decode()
    return text, (hi - lo, n_repeated, removed, sorted(x for x in owners if x != NO_ID))


def report(docs: DataFrame, bits: int = BITS) -> DataFrame:
    """Per document: doc_id, n_chunks, n_repeated, n_removed (words), repeated, owners, kept_sha256 (of the text left)."""
    found, names = deduplicate(docs.select("doc_id", "text"), bits=bits)
    return found.select(
        "doc_id",
        *[F.col(names[n]).alias(n) for n in ("n_chunks", "n_repeated", "n_removed")],
        (F.col(names["n_removed"]) > 0).alias("repeated"),
        F.col(names["owners"]).alias("owners"),
        F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"),
    )
