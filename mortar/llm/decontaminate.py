"""Benchmark decontamination: a broadcast hash set of normalised test n-grams, scanned over training token windows.

A-Z is lower-cased; a word is a run of digits, letters a-z and non-ASCII characters.  A window is ``width`` consecutive
words of a benchmark item; an item of fewer words (but not none) is one window.  Every window hash that a document's
token windows hit is verified on the words themselves, so hash collisions never count.

Defined results: a null or empty text has no words and is clean; repeated items count once (by item_id); an item without
an id marks words but is not counted or listed; an empty benchmark leaves all documents clean.  All columns of the
documents are kept; added columns get leading underscores where their name is taken.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mortar.llm import bytescan, columns, scratch, worker

WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
WIDTH = 10
#: Most windows broadcast at once (about 100 bytes each); a larger set is scanned in slices of this size.
MOST_WINDOWS = 500_000

_IS_WORD = np.zeros(256, bool)
_IS_WORD[0x30:0x3A] = True
_IS_WORD[0x61:0x7B] = True
_IS_WORD[0x80:] = True


def benchmark_windows(benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """(window, items): every distinct window of all items, words joined by a blank, with the ids of its items."""
    lower = F.translate(F.col("text"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = benchmark.select(F.col("item_id").cast("string").alias("item"), lower.alias("_t")).select(
        "item", F.regexp_extract_all("_t", F.lit(WORD), F.lit(0)).alias("words")
    )
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - width, F.lit(0)))
    window = F.array_join(F.slice("words", F.col("start") + 1, width), " ")
    return (
        words.filter(F.size("words") > 0)
        .select("item", "words", F.explode(starts).alias("start"))
        .select("item", window.alias("window"))
        .groupBy("window")
        .agg(F.collect_set("item").alias("items"))
    )


def _words(data: np.ndarray, offsets: np.ndarray):
    low = bytescan.LOWER[data]
    starts, ends = bytescan.spans(_IS_WORD[low], offsets)
    return low, starts, ends


class WindowSet:
    """Windows by hash; built once per worker from the broadcast list."""

    def __init__(self, windows: list[tuple[bytes, list[str]]]):
        self.by_length: dict[int, tuple[np.ndarray, dict[int, list[tuple[bytes, list[str]]]]]] = {}
        lengths: dict[int, list[tuple[bytes, list[str]]]] = {}
        for text, items in windows:
            lengths.setdefault(text.count(b" ") + 1, []).append((text, items))
        for length, entries in lengths.items():
            data = np.frombuffer(b"\x00".join(text for text, _ in entries), np.uint8)
            sizes = np.array([len(text) + 1 for text, _ in entries])
            offsets = np.concatenate([[0], np.cumsum(sizes)])
            offsets[-1] -= 1
            low, starts, ends = _words(data, offsets)
            hashes = rolling(bytescan.byte_hashes(low, starts, ends), length)[length][::length]
            table: dict[int, list[tuple[bytes, list[str]]]] = {}
            for h, entry in zip(hashes.tolist(), entries):
                table.setdefault(h, []).append(entry)
            sieve = np.zeros(1 << max(16, int(len(entries)).bit_length() + 4), bool)
            sieve[(hashes & np.uint64(sieve.size - 1)).astype(np.int64)] = True
            self.by_length[length] = (sieve, table)

    def scan(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int, list[str]]]]:
        """Word starts and ends, and the verified hits as (first word, words, items)."""
        low, starts, ends = _words(data, offsets)
        hits = []
        if starts.size and self.by_length:
            text_of = np.searchsorted(offsets, starts, side="right")
            hashed = rolling(bytescan.byte_hashes(low, starts, ends), max(self.by_length))
            raw = low.tobytes()
            for length, (sieve, table) in self.by_length.items():
                h = hashed[length]
                if not h.size:
                    continue
                found = np.flatnonzero(sieve[(h & np.uint64(sieve.size - 1)).astype(np.int64)])
                found = found[text_of[found] == text_of[found + length - 1]]
                for i, key in zip(found.tolist(), h[found].tolist()):
                    for window, items in table.get(key, ()):
                        if window == b" ".join(raw[a:b] for a, b in zip(starts[i : i + length], ends[i : i + length])):
                            hits.append((i, length, items))
        return starts, ends, hits


def rolling(words: np.ndarray, longest: int) -> dict[int, np.ndarray]:
    """Hashes of all windows of 1 to ``longest`` words."""
    factor = np.uint64(0x9E3779B97F4A7C15)
    out = {1: words}
    h = words
    for length in range(2, longest + 1):
        h = h[:-1] * factor + words[length - 1 :] if h.size else h
        out[length] = h
    return out


def _scan_pass(df: DataFrame, windows: list[tuple[bytes, list[str]]], names: dict[str, str], first: bool) -> DataFrame:
    shared, token = df.sparkSession.sparkContext.broadcast(windows), uuid.uuid4().hex
    added = f"`{names['n_words']}` long, `{names['spans']}` array<array<int>>, `{names['items']}` array<string>"
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name not in names.values())

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows_ = worker.held(token, lambda: WindowSet(shared.value))
        for batch in batches:
            n_words, spans, items = [], [], []
            for _, data, offsets in bytescan.blocks(batch.column("text")):
                starts, ends, hits = windows_.scan(data, offsets)
                bounds = bytescan.per_text(starts, offsets)
                n_words.extend(np.diff(bounds).tolist())
                own_spans: list[list[list[int]]] = [[] for _ in range(offsets.size - 1)]
                own_items: list[set[str]] = [set() for _ in range(offsets.size - 1)]
                for word, length, ids in hits:
                    row = int(np.searchsorted(bounds, word, side="right")) - 1
                    own_spans[row].append([word - int(bounds[row]), word - int(bounds[row]) + length])
                    own_items[row].update(ids)
                spans.extend(own_spans)
                items.extend(sorted(x) for x in own_items)
            if not first:
                spans = [a + b for a, b in zip(batch.column(names["spans"]).to_pylist(), spans)]
                items = [sorted({*a, *b}) for a, b in zip(batch.column(names["items"]).to_pylist(), items)]
            kept = [(n, batch.column(n)) for n in batch.schema.names if n not in names.values()]
            spans = [_merged(x) for x in spans]
            new = [
                (names["n_words"], pa.array(n_words, pa.int64())),
                (names["spans"], pa.array(spans, pa.list_(pa.list_(pa.int32())))),
                (names["items"], pa.array(items, pa.list_(pa.string()))),
            ]
            yield pa.RecordBatch.from_arrays([c for _, c in kept + new], names=[n for n, _ in kept + new])

    return df.mapInArrow(scan, f"{schema}, {added}")


def _merged(spans: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


def find_hits(
    docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, most_windows: int = MOST_WINDOWS
) -> tuple[DataFrame, dict[str, str]]:
    """Documents with their word count, hit word spans [start, end) and hit items; and the names of these columns.

    The windows are counted first.  Up to ``most_windows`` go out in one broadcast; a larger set is cut by hash into
    slices of that size, and each slice is one pass over the documents, written to the shared folder in between.
    """
    columns.need(docs, "text")
    columns.need(benchmark, "item_id", "text")
    names = {n: columns.free_name(docs, n) for n in ("n_words", "spans", "items")}
    windows = scratch.stored(benchmark_windows(benchmark, width), "windows")
    slices = -(-windows.count() // most_windows) or 1
    if slices > 1:
        slices += slices // 4 + 1  # hash slices differ in size
    out = docs
    for k in range(slices):
        part = windows.filter(F.pmod(F.xxhash64("window"), F.lit(slices)) == k)
        listed = [(r["window"].encode(), sorted(r["items"])) for r in part.toLocalIterator()]
        out = _scan_pass(out, listed, names, k == 0)
        if k + 1 < slices:
            out = scratch.stored(out, "scanned")
    return out, names


def report(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, most_windows: int = MOST_WINDOWS) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found, names = find_hits(docs.select("doc_id", "text"), benchmark, width, most_windows)
    spans, items = F.col(names["spans"]), F.col(names["items"])
    return found.select(
        "doc_id",
        F.col(names["n_words"]).alias("n_words"),
        F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0]).alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(items), ",").cast("binary"), 256).alias("items_sha256"),
        (F.size(spans) > 0).alias("contaminated"),
    )


def remove_documents(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """Documents without any benchmark window, columns as they came."""
    found, names = find_hits(docs, benchmark, width)
    return found.filter(F.size(names["spans"]) == 0).select(*[F.col(f"`{c}`") for c in docs.columns])


def remove_spans(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """All documents, the hit words cut out of their text together with what stands between them."""
    found, names = find_hits(docs, benchmark, width)

    @F.pandas_udf("string")
    def cut(text, spans):
        return text.combine(spans, _without)

    changed = F.when(F.size(names["spans"]) > 0, cut(F.col("text"), F.col(names["spans"]))).otherwise(F.col("text"))
    return found.withColumn("text", changed).select(*[F.col(f"`{c}`") for c in docs.columns])


def _without(text, spans):
    if text is None or spans is None or not len(spans):
        return text
    data = np.frombuffer(text.encode(), np.uint8)
    _, starts, ends = _words(data, np.array([0, data.size]))
    out, at = [], 0
    raw = data.tobytes()
    for first, last in spans:
        out.append(raw[at : starts[first]])
        at = int(ends[last - 1])
    return (b"".join(out) + raw[at:]).decode()
