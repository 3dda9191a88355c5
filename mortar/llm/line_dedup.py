"""Line dedup by pairwise alignment.

Documents that share rare lines are found by hashes: a line's hash covers as many further lines as it takes to reach
``LEAST`` words, so short lines that texts share by chance find nobody, and every common block is found by the first
line of it.  Each hash links its documents to the first one that has it, so a line of n documents gives n - 1 links
and no line needs a frequency limit.  Linked documents are aligned by patience diff: lines that occur once in both, in
the longest common order, are anchors, and the gaps between them are aligned in the same way; a gap without such a line
is anchored at its rarest common one.  A run of aligned lines of at least ``LEAST`` words is a common block and is
deleted from the later document.  The first copy of a line is never deleted, since no earlier document has it.

One alignment cannot match what two documents hold in different orders, so with ``again``, as in the query and the
pipeline, the lines it leaves are looked up again: as long as a run of them is one that an earlier document has, they are
aligned with that document once more, the deleted lines standing as gaps that match nothing.  In the end no line hash of
what is left has an earlier owner.

Exact copies of a text are one aligned block with the first copy, and only first copies are linked and aligned.

Defined results: documents are ordered by id, those without an id last; rows of one id are not aligned with each other.
A null text stays null, an empty one empty; blank lines count as lines and have no words.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mortar.llm import bytescan, columns, scratch

LEAST = 5
NO_ID = (1 << 63) - 1
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _longest_rising(values: list[int]) -> list[int]:
    """Places of a longest rising subsequence."""
    tails: list[int] = []
    at: list[int] = []
    before = [-1] * len(values)
    for i, v in enumerate(values):
        k = bisect_left(tails, v)
        before[i] = at[k - 1] if k else -1
        if k == len(tails):
            tails.append(v)
            at.append(i)
        else:
            tails[k], at[k] = v, i
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Aligned places (i, j) with a[i] == b[j], rising in both."""
    matched: list[tuple[int, int]] = []
    work = [(0, len(a), 0, len(b))]
    while work:
        i0, i1, j0, j1 = work.pop()
        while i0 < i1 and j0 < j1 and a[i0] == b[j0]:
            matched.append((i0, j0))
            i0, j0 = i0 + 1, j0 + 1
        while i0 < i1 and j0 < j1 and a[i1 - 1] == b[j1 - 1]:
            i1, j1 = i1 - 1, j1 - 1
            matched.append((i1, j1))
        if i0 == i1 or j0 == j1:
            continue
        in_a: dict[int, list[int]] = {}
        in_b: dict[int, list[int]] = {}
        for i in range(i0, i1):
            in_a.setdefault(a[i], []).append(i)
        for j in range(j0, j1):
            in_b.setdefault(b[j], []).append(j)
        common = [x for x in in_a if x in in_b]  # in the order of a
        if not common:
            continue
        once = [(in_a[x][0], in_b[x][0]) for x in common if len(in_a[x]) == 1 and len(in_b[x]) == 1]
        if once:
            anchors = [once[k] for k in _longest_rising([j for _, j in once])]
        else:
            rarest = min(common, key=lambda x: (len(in_a[x]) + len(in_b[x]), in_a[x][0]))
            anchors = [(in_a[rarest][0], in_b[rarest][0])]
        matched += anchors
        edges = [(i0 - 1, j0 - 1), *anchors, (i1, j1)]
        work += [(p + 1, i, q + 1, j) for (p, q), (i, j) in zip(edges, edges[1:])]
    return sorted(matched)


def common_blocks(a: list[int], b: list[int], words: list[int], least: int = LEAST) -> list[int]:
    """Lines of b in blocks aligned with a that have at least ``least`` words."""
    out: list[int] = []
    block: list[int] = []
    last = (-2, -2)
    for i, j in [*patience(a, b), (-9, -9)]:
        if (i, j) != (last[0] + 1, last[1] + 1):
            if sum(words[k] for k in block) >= least:
                out += block
            block = []
        block.append(j)
        last = (i, j)
    return out


def _line_lists(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    for batch in bytescan.sliced(batches, "text"):
        for first, data, offsets in bytescan.blocks(batch.column("text")):
            full = np.flatnonzero(np.diff(offsets) > 0)
            breaks = np.flatnonzero(data == 10)
            starts = np.unique(np.concatenate([offsets[:-1][full], breaks + 1]))
            # a text's last line may be empty: it starts where the text ends
            closing = offsets[1:][full][data[offsets[1:][full] - 1] == 10]
            starts = np.sort(np.concatenate([starts[~np.isin(starts, np.setdiff1d(closing, offsets[:-1][full]))], closing]))
            text = np.searchsorted(offsets[:-1][full], starts, side="right") - 1
            twice = np.zeros(starts.size, bool)  # where a text ends with a line break and the next begins
            twice[:-1] = starts[:-1] == starts[1:]
            text[twice] -= 1
            ends = np.empty_like(starts)
            if starts.size:
                ends[:-1] = starts[1:] - 1
                ends[-1] = data.size
                change = np.flatnonzero(np.append(text[1:] != text[:-1], True))
                ends[change] = offsets[1:][full][text[change]]
            hashes = bytescan.byte_hashes(data, starts, ends)
            word_starts, _ = bytescan.spans(~_SPACE[data], offsets)
            words = np.searchsorted(word_starts, ends) - np.searchsorted(word_starts, starts)
            total = np.concatenate([[0], np.cumsum(words)])
            reach = np.searchsorted(total, total[:-1] + least)  # one past the last line of the unit
            bounds = np.searchsorted(text, np.arange(full.size + 1))
            fits = (words > 0) & (reach <= bounds[1:][text]) if starts.size else np.zeros(0, bool)
            unit = bytescan.range_hashes(hashes, np.flatnonzero(fits), reach[fits])
            unit_bounds = np.concatenate([[0], np.cumsum(fits)])[bounds]
            part = pa.RecordBatch.from_arrays(
                [batch.column(c).slice(first, offsets.size - 1).take(pa.array(full)) for c in ("id", "a", "b")],
                names=["id", "a", "b"],
            )
            lists = {"lines": (hashes.view(np.int64), bounds), "words": (words.astype(np.int32), bounds), "units": (unit.view(np.int64), unit_bounds)}
            yield bytescan.with_columns(
                part, **{n: pa.ListArray.from_arrays(x.astype(np.int32), pa.array(v)) for n, (v, x) in lists.items()}
            )


def left_units(words: list[int], gone: set[int], least: int = LEAST) -> list[tuple[int, int]]:
    """(first line, one past the last) of every unit that holds no deleted line."""
    out, end, total = [], 0, 0
    for i in range(len(words)):
        if end < i:
            end, total = i, 0
        while end < len(words) and total < least and end not in gone:
            total += words[end]
            end += 1
        if total >= least and words[i]:
            out.append((i, end))
        if end > i:
            total -= words[i]
    return out


def left_blocks(a: list[int], b: list[int], words: list[int], gone: set[int], least: int = LEAST) -> list[int]:
    """Lines of b, apart from the deleted ones, in blocks aligned with a; if none align, those of the first unit a has."""
    found = common_blocks(a, [(j,) if j in gone else x for j, x in enumerate(b)], words, least)
    if not found:
        places: dict[int, list[int]] = {}
        for i, x in enumerate(a):
            places.setdefault(x, []).append(i)
        for i, end in left_units(words, gone, least):
            if any(a[k : k + end - i] == b[i:end] for k in places.get(b[i], ())):
                return list(range(i, end))
    return found


def _keys() -> list[Column]:
    return [
        F.coalesce("doc_id", F.lit(NO_ID)).alias("id"),
        F.xxhash64("text").alias("a"),
        F.xxhash64(F.lit(7), "text").alias("b"),
    ]


def line_table(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """(id, a, b, lines, words, units) of every text that is not empty: keys, line hashes, words, and unit hashes."""
    keyed = docs.filter("text <> ''").select(*_keys(), "text")
    return keyed.mapInArrow(
        lambda batches: _line_lists(batches, least),
        "id long, a long, b long, lines array<long>, words array<int>, units array<long>",
    )


def _left_units(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """(id, a, unit) of the lines that are left."""
    for batch in batches:
        ids, texts, found = [], [], []
        for id_, a, lines, words, gone in zip(*(batch.column(c) for c in ("id", "a", "lines", "words", "gone"))):
            units = left_units(words.values.to_numpy().tolist(), set(gone.values.to_numpy().tolist()), least)
            if units:
                starts, ends = np.array(units).T
                own = np.unique(bytescan.range_hashes(lines.values.to_numpy().view(np.uint64), starts, ends))
                ids.append(np.full(own.size, id_.as_py()))
                texts.append(np.full(own.size, a.as_py()))
                found.append(own.view(np.int64))
        if ids:
            parts = [pa.array(np.concatenate(x), pa.int64()) for x in (ids, texts, found)]
            yield pa.RecordBatch.from_arrays(parts, names=["id", "a", "unit"])


def _align_left(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            lists = (part.column(c) for c in ("owner_lines", "lines", "words", "gone"))
            rows = ([x.values.to_numpy().tolist() for x in row] for row in zip(*lists))
            found = [left_blocks(a, b, w, set(g), least) for a, b, w, g in rows]
            out = bytescan.with_columns(part.select(["id", "a", "owner"]), gone=pa.array(found, pa.list_(pa.int32())))
            yield out.filter(pa.array([bool(g) for g in found]))


def deletions(docs: DataFrame, least: int = LEAST, again: bool = False) -> DataFrame:
    """(id, a, whole, deleted, owners): what the later documents lose, and the earlier documents that have it.

    ``again``: align the lines that are left until no earlier document has a unit of them; otherwise align once.
    """
    columns.need(docs, "doc_id", "text")
    rows = scratch.stored(line_table(docs, least), "lines")
    first = rows.groupBy("a", "b").agg(F.min("id").alias("first"))
    placed = rows.join(first, ["a", "b"])
    copies = placed.filter("id > first").select("id", "a", "first").distinct()
    own = scratch.stored(placed.filter("id = first").dropDuplicates(["id", "a"]).drop("first", "b"), "first-copies")

    units = own.select("id", F.explode(F.array_distinct("units")).alias("unit"))
    owners = units.groupBy("unit").agg(F.min("id").alias("owner"), F.max("id").alias("last")).filter("owner < last")
    # written, so that the join below has a plain shuffle on both sides: Spark can then split a unit of many documents
    owners = scratch.stored(owners.drop("last"), "owners")
    links = scratch.stored(units.join(owners, "unit").filter("id > owner").select("id", "owner").distinct(), "owner-links")

    pairs = (
        links.join(own.select("id", "a", "lines", "words"), "id")
        .join(own.select(F.col("id").alias("owner"), F.col("lines").alias("owner_lines")), "owner")
        .select("id", "a", "owner", "lines", "words", "owner_lines")
    )

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                lines, words, earlier = (part.column(c) for c in ("lines", "words", "owner_lines"))
                gone = [
                    common_blocks(a.values.to_numpy().tolist(), b.values.to_numpy().tolist(), w.values.to_numpy().tolist(), least)
                    for a, b, w in zip(earlier, lines, words)
                ]
                out = part.select(["id", "a", "owner"])
                out = bytescan.with_columns(out, gone=pa.array(gone, pa.list_(pa.int32())))
                yield out.filter(pa.array([bool(g) for g in gone]))

    found = scratch.stored(pairs.mapInArrow(align, "id long, a long, owner long, gone array<int>"), "aligned")
    table = own.select("id", "a", "lines", "words")
    open_ = table.join(links.select("id").distinct(), "id", "left_semi")
    while again:
        gone = found.groupBy("id", "a").agg(F.array_distinct(F.flatten(F.collect_list("gone"))).alias("gone"))
        state = open_.join(gone, ["id", "a"], "left").withColumn("gone", F.coalesce("gone", F.array().cast("array<int>")))
        left = state.mapInArrow(lambda batches: _left_units(batches, least), "id long, a long, unit long")
        links = left.join(owners, "unit").filter("id > owner").select("id", "a", "owner").distinct()
        links = scratch.stored(links, "links-left")
        if links.isEmpty():
            break
        pairs = links.join(state, ["id", "a"]).join(
            own.select(F.col("id").alias("owner"), F.col("lines").alias("owner_lines")), "owner"
        )
        pairs = pairs.select("id", "a", "owner", "lines", "words", "owner_lines", "gone")
        more = pairs.mapInArrow(lambda batches: _align_left(batches, least), "id long, a long, owner long, gone array<int>")
        more = scratch.stored(more, "aligned-left")
        found = found.unionByName(more)
        # what was not linked now has no owner left
        open_ = table.join(links.select("id", "a").distinct(), ["id", "a"], "left_semi")
    found = found.groupBy("id", "a").agg(
        F.array_distinct(F.flatten(F.collect_list("gone"))).alias("deleted"), F.array_sort(F.collect_set("owner")).alias("owners")
    )
    none = F.array().cast("array<int>")
    return found.select("id", "a", F.lit(False).alias("whole"), "deleted", "owners").unionByName(
        copies.select("id", "a", F.lit(True).alias("whole"), none.alias("deleted"), F.array("first").alias("owners"))
    )


def deduplicate(docs: DataFrame, least: int = LEAST, again: bool = False) -> tuple[DataFrame, dict[str, str]]:
    """Documents with the deleted lines cut out of ``text``, and the names of the added columns.

    ``n_lines`` before, ``n_deleted`` lines, ``owners``: ids of the earlier documents that hold what was deleted.
    """
    columns.need(docs, "doc_id", "text")
    names = {n: columns.free_name(docs, n) for n in ("n_lines", "n_deleted", "owners")}
    id_, a, whole, deleted, owners, lines = (
        columns.free_name(docs, n) for n in ("order_key", "text_key", "whole", "deleted_lines", "owner_ids", "line_list")
    )
    found = deletions(docs, least, again).select(
        F.col("id").alias(id_), F.col("a").alias(a), F.col("whole").alias(whole), F.col("deleted").alias(deleted),
        F.col("owners").alias(owners),
    )
    keys = _keys()
    joined = docs.withColumns({id_: keys[0], a: keys[1]}).join(found, [id_, a], "left")
    joined = joined.withColumn(lines, F.split(F.coalesce("text", F.lit("")), "\n"))
    n = F.when(F.coalesce("text", F.lit("")) == "", F.lit(0)).otherwise(F.size(lines))
    gone = F.when(F.col(whole), n).otherwise(F.coalesce(F.size(deleted), F.lit(0)))
    # places that stay, in order; looking them up keeps this linear in the lines
    places = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(deleted))
    kept = F.array_join(F.transform(places, lambda i: F.col(lines)[i]), "\n")
    text = F.when(F.col(whole).isNull(), F.col("text")).when(F.col(whole), F.lit("")).otherwise(kept)
    return joined.select(
        *[text.alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns],
        n.cast("long").alias(names["n_lines"]),
        F.coalesce(gone, F.lit(0)).cast("long").alias(names["n_deleted"]),
        F.coalesce(F.col(owners), F.array().cast("array<long>")).alias(names["owners"]),
    ), names


def report(docs: DataFrame, again: bool = False) -> DataFrame:
    """Per document: doc_id, n_lines, n_deleted, owners, kept_sha256 (of the text left; null for a null text)."""
    found, names = deduplicate(docs.select("doc_id", "text"), again=again)
    return found.select(
        "doc_id", *[F.col(names[n]).alias(n) for n in ("n_lines", "n_deleted", "owners")],
        F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"),
    )


def without_copied_lines(docs: DataFrame) -> DataFrame:
    """Documents with copied lines deleted and n_chars brought up to date, if there is such a column.

    A document that loses all its lines is a copy and goes; one that had no line stays as it is.
    """
    found, names = deduplicate(docs, again=True)
    left = found.filter((F.col(names["n_deleted"]) == 0) | (F.trim(F.col("text")) != ""))
    chars = F.when(F.col(names["n_deleted"]) > 0, F.length("text").cast("long"))
    return left.select(
        *[F.coalesce(chars, F.col(f"`{c}`")).alias(c) if c.lower() == "n_chars" else F.col(f"`{c}`") for c in docs.columns]
    )
