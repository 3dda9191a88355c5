"""Vectorised scans of the UTF-8 bytes of an Arrow text column."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes scanned together.  A longer text is a block of its own.
BLOCK = 1 << 20
U64 = np.uint64


def lowered(keep: bool = False) -> bytes:
    """Translation table that lower-cases A-Z and leaves every other byte."""
    table = bytearray(range(256))
    table[65:91] = bytes(range(97, 123))
    return bytes(table)


LOWER = np.frombuffer(lowered(), dtype=np.uint8)


def blocks(column: pa.Array, limit: int = BLOCK) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of whole texts; a null is an empty text."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if n == 0:
        return
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(off, off[first] + limit, side="right")) - 1
        last = min(n, max(last, first + 1))
        yield first, raw[off[first] : off[last]], off[first : last + 1] - off[first]
        first = last


def sliced(batches: Iterator[pa.RecordBatch], column: str, limit: int = BLOCK) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes of text: what a task holds does not depend on Spark's batches."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        text = batch.column(column)
        bounds = np.concatenate([[0], np.cumsum(pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False))])
        first = 0
        while first < n:
            last = int(np.searchsorted(bounds, bounds[first] + limit, side="right")) - 1
            last = min(n, max(last, first + 1), first + 2048)
            yield batch.slice(first, last - first)
            first = last


def with_columns(batch: pa.RecordBatch, **new: pa.Array) -> pa.RecordBatch:
    """A batch with columns added or replaced."""
    kept = [(n, batch.column(n)) for n in batch.schema.names if n not in new]
    return pa.RecordBatch.from_arrays([c for _, c in kept] + [*new.values()], names=[n for n, _ in kept] + [*new])


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true bytes; no run crosses a text's end."""
    if inside.size == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = np.zeros(inside.size + 1, bool)
    edge[offsets] = True
    before = np.empty(inside.size, bool)
    before[0] = False
    before[1:] = inside[:-1]
    after = np.empty(inside.size, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends


@lru_cache(maxsize=None)
def _constants() -> tuple[np.ndarray, int, int]:
    rng = np.random.default_rng(20240607)
    table = rng.integers(0, 2**64, 256, dtype=U64)
    base = int(rng.integers(0, 2**63)) | 5
    return table, base, pow(base, -1, 2**64)


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n, kept for the next block."""
    have = _POWERS.get(0)
    if have is None or have[0].size < n:
        _, base, inverse = _constants()
        out = []
        for factor in (base, inverse):
            p = np.empty(max(n, BLOCK + 1), U64)
            p[0] = 1
            size = 1
            while size < p.size:
                step = min(size, p.size - size)
                p[size : size + step] = p[:step] * U64(pow(factor, size, 2**64))
                size += step
            out.append(p)
        have = (out[0], out[1])
        if n <= 4 * BLOCK:
            _POWERS[0] = have
    return have


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit polynomial hash of values[start:end] for every range, equal for equal content at any place."""
    forward, back = _powers(values.size + 1)
    sums = np.zeros(values.size + 1, U64)
    np.cumsum(values * forward[: values.size], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(U64) * U64(0x9E3779B97F4A7C15))


def byte_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of every byte range."""
    return range_hashes(_constants()[0][data], starts, ends)


def per_text(positions: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many sorted positions precede each text's start: bounds of the texts within positions."""
    return np.searchsorted(positions, offsets)
