"""SimHash near-duplicates by a self-join of binary tries.

A fingerprint has 64 bits: bit i is 1 if it is set in over half the hashes of a text's word shingles.  Documents link if
their fingerprints differ in at most ``budget`` bits, and a group is everything that links reach.

Two fingerprints within a budget of k agree on at least one of k + 1 blocks of bits.  So there is one binary trie per
block, its bits turned so that this block comes first.  The nodes below the block are the shuffle key, one subtrie each;
within it pairs of nodes are walked down together, from the pair of the root with itself.  A pair carries the number
of bits in which its nodes' prefixes differ, and is dropped as soon as that exceeds the budget.  A pair of leaves that
is left is a link.  A subtrie of more than ``MOST_LEAVES`` distinct fingerprints is cut into parts, and every pair of
parts is a task of its own, so no task grows with the data and no link is lost.  Of the links a task finds it returns
a spanning forest; components over all tasks give the groups.

Defined results: a null or empty text and one of white space alone has fingerprint zero and links like any other; equal
rows and repeated ids are rows of one group; a group whose ids are all null has a null component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mortar.llm import columns, scratch
from mortar.llm.bytescan import lowered
from mortar.llm.components import components

SHINGLE, BUDGET, SEED = 4, 4, 42
#: Most distinct fingerprints of one subtrie in a task, and most node pairs walked at once.
MOST_LEAVES, MOST_PAIRS = 8192, 1 << 20
_LOWER = lowered()
_LANES = np.uint64(0x0101010101010101)


def shingle_hashes(text: str | None, shingle: int = SHINGLE) -> list[int]:
    """XXH64 of every shingle of a text's words, repeats included."""
    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return []
    joined, hashed = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return [hashed(joined, SEED)]
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    return [hashed(joined[a:b], SEED) for a, b in zip(starts[: 1 - shingle].tolist(), ends[shingle - 1 :].tolist())]


def majority(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Fingerprint of each run of hashes: the bits that are set in over half of it; of an empty run zero."""
    out = np.zeros(sizes.size, np.uint64)
    full = np.flatnonzero(sizes)
    if not full.size:
        return out
    first = np.concatenate([[0], np.cumsum(sizes)])[full]
    # sums of 8 one-byte lanes hold up to 255 rows: cut longer runs
    pieces = -(-sizes[full] // 255)
    owner = np.repeat(np.arange(full.size), pieces)
    nth = np.arange(owner.size) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    cuts, heads = first[owner] + 255 * nth, np.cumsum(pieces) - pieces
    for bit in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(bit)) & _LANES, cuts)
        counts = lanes.view(np.uint8).reshape(-1, 8).astype(np.int64)
        counts = np.add.reduceat(counts, heads, axis=0)
        for byte in range(8):
            more = counts[:, byte] * 2 > sizes[full]
            out[full[more]] |= np.uint64(1 << (8 * byte + bit))
    return out


def _fingerprint_array(text: pa.Array) -> pa.Array:
    found, at = [], 0
    while at < len(text):  # bounded numbers of texts: the hashes of all are held at once
        part = text.slice(at, 256).to_pylist()
        hashes = [shingle_hashes(t) for t in part]
        sizes = np.array([len(h) for h in hashes], np.int64)
        flat = np.fromiter((x for h in hashes for x in h), np.uint64, int(sizes.sum()))
        found.append(majority(flat, sizes).view(np.int64))
        at += 256
    return pa.array(np.concatenate(found) if found else np.zeros(0, np.int64))


def _fingerprints(text: Column) -> Column:
    def run(text: pa.Array) -> pa.Array:
        return _fingerprint_array(text)

    return F.arrow_udf(run, "long")(text)


def fingerprints(docs: DataFrame, column: str = "fingerprint") -> DataFrame:
    """Add the fingerprint of every whole text as a signed 64-bit integer."""
    columns.need(docs, "text")
    return docs.withColumn(column, _fingerprints(F.col("text")))


def _blocks(budget: int) -> list[tuple[int, int]]:
    """(first bit from the top, bits) of budget + 1 blocks that make up 64 bits."""
    cuts = [64 * i // (budget + 1) for i in range(budget + 2)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _turned(bits: np.ndarray, first: int) -> np.ndarray:
    """Bits turned left, so that bit ``first`` from the top leads."""
    return bits if first == 0 else (bits << np.uint64(first)) | (bits >> np.uint64(64 - first))


class Forest:
    """Trees of linked leaves; keeps only links that join two of them."""

    def __init__(self, n: int):
        self.root, self.kept = np.arange(n), []

    def add(self, u: np.ndarray, v: np.ndarray) -> None:
        while u.size:
            a, b = self.root[u], self.root[v]
            apart = a != b
            u, v, a, b = u[apart], v[apart], a[apart], b[apart]
            if not u.size:
                return
            high, low = np.maximum(a, b), np.minimum(a, b)
            order = np.lexsort((low, high))
            lead = order[np.concatenate([[True], high[order][1:] != high[order][:-1]])]  # one link for each higher root
            self.kept.append((u[lead], v[lead]))
            self.root[high[lead]] = low[lead]
            while True:
                up = self.root[self.root]
                if (up == self.root).all():
                    break
                self.root = up


def trie_links(bits: np.ndarray, tops: np.ndarray, depth: np.ndarray | int, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (positions) spanning the near fingerprints of each subtrie.

    ``bits`` sorted within the subtries, which start at ``tops`` (with the end appended); all subtries begin at ``depth``.
    """
    forest = Forest(bits.size)
    lo, hi = tops[:-1], tops[1:]
    work = [(int(depth), lo, hi, lo, hi, np.zeros(lo.size, np.int64))]
    sums: dict[int, np.ndarray] = {}
    while work:
        level, alo, ahi, blo, bhi, err = work.pop()
        same = alo == blo
        single = (ahi - alo == 1) & (bhi - blo == 1)
        ready = single & ~same
        if ready.any():
            u, v = alo[ready], blo[ready]
            near = np.bitwise_count(bits[u] ^ bits[v]) <= budget
            forest.add(u[near], v[near])
        going = ~single
        alo, ahi, blo, bhi, err, same = (x[going] for x in (alo, ahi, blo, bhi, err, same))
        if not alo.size or level == 64:
            continue
        if level not in sums:
            ones = (bits >> np.uint64(63 - level)) & np.uint64(1)
            sums[level] = np.concatenate([[0], np.cumsum(ones.astype(np.int64))])
        c = sums[level]
        amid, bmid = ahi - (c[ahi] - c[alo]), bhi - (c[bhi] - c[blo])
        parts = [
            (alo, amid, blo, bmid, err, None), (amid, ahi, bmid, bhi, err, None),
            (alo, amid, bmid, bhi, err + 1, None), (amid, ahi, blo, bmid, err + 1, ~same),
        ]
        nxt = []
        for a0, a1, b0, b1, e, allowed in parts:
            keep = (a1 > a0) & (b1 > b0) & (e <= budget)
            if allowed is not None:
                keep &= allowed
            nxt.append(tuple(x[keep] for x in (a0, a1, b0, b1, e)))
        joined = [np.concatenate(x) for x in zip(*nxt)]
        for at in range(0, joined[0].size, MOST_PAIRS):
            work.append((level + 1, *(x[at : at + MOST_PAIRS] for x in joined)))
    if not forest.kept:
        none = np.zeros(0, np.int64)
        return none, none
    u, v = (np.concatenate(x) for x in zip(*forest.kept))
    return u, v


def _walk(budget: int):
    blocks = _blocks(budget)

    def links(tables: list[pa.Table]) -> pa.RecordBatch:
        table = pa.concat_tables(tables)
        block = table.column("block").to_numpy()
        group = table.column("subtrie").to_numpy().astype(np.uint64), table.column("p").to_numpy(), table.column("q").to_numpy()
        bits = table.column("fp").to_numpy().view(np.uint64)
        us, vs = [], []
        for k in np.unique(block):
            first, size = blocks[k]
            at = np.flatnonzero(block == k)
            turned = _turned(bits[at], first)
            keys = [g[at] for g in group]
            order = np.lexsort((turned, *keys))
            turned, keys = turned[order], [x[order] for x in keys]
            new = np.zeros(order.size, bool)
            new[0] = True
            for x in keys:
                new[1:] |= x[1:] != x[:-1]
            tops = np.concatenate([np.flatnonzero(new), [order.size]])
            u, v = trie_links(turned, tops, size, budget)
            original = bits[at][order]
            us.append(original[u].view(np.int64))
            vs.append(original[v].view(np.int64))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(us)), pa.array(np.concatenate(vs))], names=["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by subtrie: walk whole subtries, many small ones together."""
        held: list[pa.Table] = []
        rows = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            part = pa.Table.from_batches([batch])
            if rows >= 4 * MOST_LEAVES:
                # the last subtrie may go on: all that stands before it is whole
                key = [part.column(c).to_numpy() for c in ("block", "subtrie", "p", "q")]
                changed = np.zeros(batch.num_rows, bool)
                changed[0] = [x[0] for x in key] != last
                for x in key:
                    changed[1:] |= x[1:] != x[:-1]
                cut = np.flatnonzero(changed)
                if cut.size:
                    yield links([*held, part.slice(0, int(cut[-1]))])
                    held, rows, part = [], 0, part.slice(int(cut[-1]))
            held.append(part)
            rows += part.num_rows
            last = [part.column(c)[part.num_rows - 1].as_py() for c in ("block", "subtrie", "p", "q")]
        if held:
            yield links(held)

    return run


def near_links(distinct: DataFrame, budget: int = BUDGET) -> DataFrame:
    """Links (u, v) that span all distinct fingerprints ``fp`` within the budget of each other."""
    rows = distinct.select(
        "fp",
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(k).alias("block"),
                        F.expr(f"shiftrightunsigned(shiftleft(fp, {first}), {64 - size})").alias("subtrie"),
                    )
                    for k, (first, size) in enumerate(_blocks(budget))
                ]
            )
        ).alias("t"),
    ).select("t.block", "t.subtrie", "fp")
    large = rows.groupBy("block", "subtrie").count().filter(F.col("count") > MOST_LEAVES)
    parts = F.ceil(F.coalesce("count", F.lit(0)) / MOST_LEAVES).cast("int")
    rows = rows.join(large, ["block", "subtrie"], "left").withColumn("parts", F.greatest(parts, F.lit(1)))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    # parts i and j meet in task (i, j); a part meets itself wherever it goes
    rows = rows.filter((F.col("parts") == 1) | (F.col("own") != F.col("other")))
    rows = rows.select(
        "block", "subtrie", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), "fp"
    )
    keyed = rows.repartition("block", "subtrie", "p", "q").sortWithinPartitions("block", "subtrie", "p", "q")
    return keyed.mapInArrow(_walk(budget), "u long, v long")


def groups(marked: DataFrame, budget: int = BUDGET) -> DataFrame:
    """(fp, component): least doc_id of all that links reach, for every fingerprint of (doc_id, fp)."""
    least = scratch.stored(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprints")
    linked = components(near_links(least.select("fp"), budget))
    rooted = least.join(linked.withColumnRenamed("node", "fp"), "fp", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "fp"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component"))
    return rooted.join(named, "root").select("fp", "component")


def near_duplicates(docs: DataFrame, budget: int = BUDGET) -> DataFrame:
    """Per document: doc_id, fingerprint (16 hex digits), component_id (least doc_id of its group)."""
    columns.need(docs, "doc_id", "text")
    marked = docs.select("doc_id", "text").withColumn("fp", _fingerprints(F.col("text"))).select("doc_id", "fp")
    marked = scratch.stored(marked, "marked")
    return marked.join(groups(marked, budget), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id")
    )


def one_of_each_group(docs: DataFrame, budget: int = BUDGET) -> DataFrame:
    """The documents, one row of each group: that with the least id (ties: by a hash of the text); columns as they came."""
    columns.need(docs, "doc_id", "text")
    key, fp = columns.free_name(docs, "row_key"), columns.free_name(docs, "fp")
    marked = docs.select(
        "doc_id", columns.row_key("doc_id", "text").alias("key"), _fingerprints(F.col("text")).alias("fp")
    )
    marked = scratch.stored(marked, "marked")
    first = F.min_by("key", F.struct(F.col("doc_id").isNull(), "doc_id", "key"))
    least = marked.groupBy("fp").agg(F.min("doc_id").alias("least"))
    least = scratch.stored(least, "fingerprints")
    linked = components(near_links(least.select("fp"), budget)).withColumnRenamed("node", "fp")
    rooted = marked.join(linked, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    kept = rooted.groupBy("root").agg(first.alias(key)).select(key)
    keyed = docs.withColumn(key, columns.row_key("doc_id", "text"))
    return keyed.join(kept, key, "left_semi").dropDuplicates([key]).drop(key, fp)
