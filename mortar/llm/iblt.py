"""Document fingerprints: invertible Bloom lookup sketches of paragraphs.

A text is a set of paragraph digests.  A paragraph is a line; a long line is cut after words chosen by their own hash (one
in ``CUT``), so an insertion changes the pieces around it alone.  The k-th repeat of an equal paragraph has a digest of its
own.  A sketch adds every digest to one cell in each of three tables; a cell keeps the count, the sum of digests and the
sum of check values.  Sketches of two versions are subtracted cell by cell: what they share cancels.  Peeling then takes
a digest out of every cell that holds exactly one, until nothing is left; what it took are the differing paragraphs.  Where
it gets stuck both sketches are built anew, ``GROW`` times as large.

The fingerprint is the smallest sketch with the number of digests, in base64.  Likeness of two texts is
1 - differing / all paragraph digests of both (1 for two empty texts).

Defined results: a null text is an empty one, and equal texts have equal fingerprints.  In the order of descending ids
nulls come last and equal ids go by a hash of the text; a table of one row is its own next document.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mortar.llm import bytescan, columns, ranges
from mortar.llm.bytescan import mix

CUT, CELLS, GROW, TABLES = 4, 8, 4, 3
U64 = np.uint64
_WORD = np.ones(256, bool)
_WORD[[9, 10, 11, 12, 13, 32]] = False


def paragraphs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(digests, bounds): distinct 64-bit paragraph digests of every text, text i's at bounds[i]:bounds[i + 1]."""
    starts, ends = bytescan.spans(_WORD[data], offsets)
    if not starts.size:
        return np.zeros(0, U64), np.zeros(offsets.size, np.int64)
    words = bytescan.byte_hashes(data, starts, ends)
    lines = np.concatenate([[0], np.cumsum(data == 10)])
    last = np.ones(starts.size, bool)
    last[:-1] = (lines[starts[1:]] != lines[ends[:-1]]) | (words[:-1] % U64(CUT) == 0)
    text = np.searchsorted(offsets, starts, side="right") - 1
    last[:-1] |= text[1:] != text[:-1]
    stop = np.flatnonzero(last) + 1
    begin = np.concatenate([[0], stop[:-1]])
    digest, owner = bytescan.range_hashes(words, begin, stop), text[begin]
    order = np.lexsort((digest, owner))
    digest, owner = digest[order], owner[order]
    new = np.ones(digest.size, bool)
    new[1:] = (digest[1:] != digest[:-1]) | (owner[1:] != owner[:-1])
    heads = np.flatnonzero(new)
    nth = np.arange(digest.size) - heads[np.cumsum(new) - 1]
    digest = mix(digest + nth.astype(U64) * U64(0x9E3779B97F4A7C15))
    return digest, np.searchsorted(owner, np.arange(offsets.size))


def _check(digest: np.ndarray) -> np.ndarray:
    return mix(digest ^ U64(0x5851F42D4C957F2D)) & U64(0xFFFFFFFF)


def _cells(digest: np.ndarray, size: int) -> np.ndarray:
    """Cell of every digest in each table, (TABLES, n)."""
    return np.stack(
        [mix(digest + U64((j + 1) * 0x632BE59BD9B4E019 % 2**64)) % U64(size) + U64(j * size) for j in range(TABLES)]
    ).astype(np.int64)


def sketches(digest: np.ndarray, slot: np.ndarray, slots: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts, digest sums and check sums of ``slots`` sketches of TABLES * size cells."""
    at = (_cells(digest, size) + slot * (TABLES * size)).ravel()
    count = np.bincount(at, minlength=slots * TABLES * size)
    total, check = np.zeros(count.size, U64), np.zeros(count.size, U64)
    np.add.at(total, at, np.tile(digest, TABLES))
    np.add.at(check, at, np.tile(_check(digest), TABLES))
    return count, total, check


def peel(count: np.ndarray, total: np.ndarray, check: np.ndarray, slots: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Empty subtracted sketches: (solved per slot, and slot, digest and sign of what was taken out)."""
    cells = TABLES * size
    got_slot, got_digest, got_sign = [], [], []
    look = np.flatnonzero(np.abs(count) == 1)
    while look.size:
        sign = count[look]
        digest = np.where(sign == 1, total[look], U64(0) - total[look])
        value = np.where(sign == 1, check[look], U64(0) - check[look])
        pure = _check(digest) == value
        look, sign, digest = look[pure], sign[pure], digest[pure]
        if not look.size:
            break
        slot = look // cells
        order = np.lexsort((digest, slot))
        first = np.ones(order.size, bool)
        first[1:] = (digest[order][1:] != digest[order][:-1]) | (slot[order][1:] != slot[order][:-1])
        slot, digest, sign = (x[order][first] for x in (slot, digest, sign))
        at = (_cells(digest, size) + slot * cells).ravel()
        signs = np.tile(sign, TABLES)
        np.subtract.at(count, at, signs)
        np.subtract.at(total, at, np.where(signs == 1, np.tile(digest, TABLES), U64(0) - np.tile(digest, TABLES)))
        tags = np.tile(_check(digest), TABLES)
        np.subtract.at(check, at, np.where(signs == 1, tags, U64(0) - tags))
        got_slot.append(slot)
        got_digest.append(digest)
        got_sign.append(sign)
        look = np.unique(at)
        look = look[np.abs(count[look]) == 1]
    solved = ~((count != 0) | (total != 0) | (check != 0)).reshape(slots, cells).any(axis=1)
    none = np.zeros(0, np.int64)
    return (
        solved,
        np.concatenate(got_slot) if got_slot else none,
        np.concatenate(got_digest) if got_digest else none.astype(U64),
        np.concatenate(got_sign) if got_sign else none,
    )


def _gather(digest: np.ndarray, bounds: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Digests of some texts one after the other, and each one's place in ``which``."""
    sizes = np.diff(bounds)[which]
    slot = np.repeat(np.arange(which.size), sizes)
    at = np.arange(slot.size) - np.repeat(np.cumsum(sizes) - sizes, sizes) + bounds[which][slot]
    return digest[at], slot


def differing(a: tuple, b: tuple, left: np.ndarray, right: np.ndarray, size: int = CELLS) -> np.ndarray:
    """Number of differing digests between text left[i] of a and text right[i] of b, by subtraction and peeling."""
    out = np.zeros(left.size, np.int64)
    open_ = np.arange(left.size)
    while open_.size:
        stuck = []
        step = max(1, (1 << 20) // (TABLES * size))
        for at in range(0, open_.size, step):  # bounded cells at once
            part = open_[at : at + step]
            minus = sketches(*_gather(*b, right[part]), part.size, size)
            plus = sketches(*_gather(*a, left[part]), part.size, size)
            solved, slot, _, _ = peel(*(p - m for p, m in zip(plus, minus)), part.size, size)
            out[part] = np.bincount(slot, minlength=part.size)
            stuck.append(part[~solved])
        open_ = np.concatenate(stuck)
        size *= GROW
    return out


def likeness(a: tuple, b: tuple, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    both = np.diff(a[1])[left] + np.diff(b[1])[right]
    return np.where(both == 0, 1.0, 1.0 - differing(a, b, left, right) / np.maximum(both, 1))


def fingerprints(digest: np.ndarray, bounds: np.ndarray, size: int = CELLS) -> list[str]:
    """The smallest sketch of every text as a string."""
    n = bounds.size - 1
    count, total, check = sketches(*_gather(digest, bounds, np.arange(n)), n, size)
    sizes, cells = np.diff(bounds), TABLES * size
    packed = np.empty(count.size, np.dtype([("n", "<i4"), ("d", "<u8"), ("c", "<u4")]))
    packed["n"], packed["d"], packed["c"] = count, total, check & U64(0xFFFFFFFF)
    return [f"{sizes[i]}:{base64.b64encode(packed[i * cells : (i + 1) * cells].tobytes()).decode()}" for i in range(n)]


def sketch_texts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Paragraph digests of every text of a column."""
    found = [paragraphs(data, offsets) for _, data, offsets in bytescan.blocks(texts)]
    if not found:
        return np.zeros(0, U64), np.zeros(1, np.int64)
    sizes = np.concatenate([np.diff(bounds) for _, bounds in found])
    return np.concatenate([d for d, _ in found]), np.concatenate([[0], np.cumsum(sizes)])


def fingerprint(docs: DataFrame, column: str = "fingerprint") -> DataFrame:
    """Add the fingerprint of every whole text; a column of that name is replaced."""
    columns.need(docs, "text")
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != column]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bytescan.sliced(batches, "text"):
            marks = fingerprints(*sketch_texts(batch.column("text")))
            yield bytescan.with_columns(batch, **{column: pa.array(marks, pa.string())})

    return docs.mapInArrow(run, ", ".join([*kept, f"`{column}` string"]))


def followed(docs: DataFrame) -> DataFrame:
    """(bucket, extra, doc_id, text) in which every document is followed by the next one in the order of descending ids.

    Documents are dealt into buckets of descending ids and sorted; the first document of the next bucket is added to
    each as an extra last row, that of the first bucket to the last one.
    """
    cuts = ranges.cut_points(docs, "doc_id")
    dealt = docs.select(ranges.bucket(F.col("doc_id"), cuts).alias("own"), "doc_id", "text")
    # one row for each of a bounded number of buckets
    heads = {r["own"]: r["m"] for r in dealt.groupBy("own").agg(F.max("doc_id").alias("m")).collect()}
    order = sorted(heads, reverse=True)
    rows = [(heads[b], order[i - 1]) for i, b in enumerate(order)]
    goes = docs.sparkSession.createDataFrame(rows, "head long, goes int")
    spread = dealt.join(F.broadcast(goes), F.col("doc_id").eqNullSafe(F.col("head")), "left")
    own = F.struct(F.col("own").alias("bucket"), F.lit(False).alias("extra"))
    also = F.struct(F.col("goes").alias("bucket"), F.lit(True).alias("extra"))
    places = F.when(F.col("goes").isNull(), F.array(own)).otherwise(F.array(own, also))
    spread = spread.select(F.explode(places).alias("p"), "doc_id", "text").select("p.bucket", "p.extra", "doc_id", "text")
    return spread.repartition("bucket").sortWithinPartitions(
        "bucket", "extra", F.col("doc_id").desc_nulls_last(), F.xxhash64("text"), "text"
    )


def compare_versions(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness; see ``_versions`` for the edit."""
    columns.need(docs, "doc_id", "text")
    schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # rows that wait for the next one
        size = 0
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(4))):
                bucket, extra, doc_id, text = row
                if extra and held and held[-1][1]:
                    continue  # a second extra row of the bucket
                held.append((bucket, extra, doc_id, text or ""))
                size += len(text or "")
                if size >= bytescan.BLOCK and len(held) > 1:
                    yield _versions(held)
                    held, size = held[-1:], len(held[-1][3])
        if len(held) > 1:
            yield _versions(held)

    return followed(docs).mapInArrow(run, schema)


def _versions(rows: list[tuple]) -> pa.RecordBatch:
    """Results of all rows but the last and the extra ones.

    The edited text has its last third (rounded down, in code points) replaced by as many from the next text's start.
    """
    own = [i for i, (_, extra, _, _) in enumerate(rows[:-1]) if not extra]
    texts = [text for _, _, _, text in rows]
    edited = []
    for i in own:
        third = len(texts[i]) // 3
        edited.append(texts[i][: len(texts[i]) - third] + texts[i + 1][:third])
    a, b = sketch_texts(pa.array(texts, pa.string())), sketch_texts(pa.array(edited, pa.string()))
    marks, edited_marks = fingerprints(*a), fingerprints(*b)
    left = np.array(own, np.int64)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([rows[i][2] for i in own], pa.int64()),
            pa.array([len(texts[i]) for i in own], pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
            pa.array([marks[i] for i in own], pa.string()),
            pa.array(edited_marks, pa.string()),
            pa.array(likeness(a, b, left, np.arange(left.size))),
            pa.array(likeness(a, a, left, left + 1)),
        ],
        names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    )
