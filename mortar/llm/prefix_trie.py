"""Prefix trie of conversations by truncation peeling.

Every conversation becomes a chain of keys: the key of its first d turns hashes the key of the first d - 1 and turn d
(128 bits), so equal keys mean equal prefixes.  From the greatest depth downwards, the conversations that end at a depth
are merged with the nodes that are left of deeper ones; a node gets its members, children, leaves and saved tokens from
that one grouping.  Then its last turn is stripped and the shorter prefixes are regrouped, up to the textless root.

How it fits a cluster:

* Texts stay where they are read; a turn travels as 16 bytes and a word count.
* Chains are cut into segments of ``SEGMENT`` turns, stored by segment number, so a row's size does not follow the length
  of a conversation; nodes that reach the top of a segment fetch the one above by the conversation that stands for them.
* A depth is one native grouping, pre-aggregated before its shuffle: a first turn that a third of all conversations
  share is one row per task.  Successive depths that together hold at most ``FUSED`` prefixes are peeled in one round, dealt by
  their common prefix (399 turns in a few conversations need no 399 jobs).  The result does not depend on either number.
* Lists of members that end at a node are put together in pieces of 65,536 consecutive ids, and a digest reads the
  pieces one after the other.
* Each round is a written table; nothing but one row per depth and round reaches the driver.

Defined results: rows without a conv_id belong to no conversation; a null role or text is empty; turns are put in order
by turn, null first, and rows of equal turn by the SHA-256 of role and text (repeated rows stay, each a turn of its own);
``c % 20`` has the sign of c, as in SQL; a table without conversations has no node, not even a root.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mortar.llm import columns, scratch

WORDS = "[^\\x20\\x09-\\x0D]+"
ROOT = bytes(16)
#: Turns of a segment; prefixes that one round may peel depth after depth; ids of one piece of a list.
SEGMENT, FUSED, PIECE = 64, 20_000, 65_536
#: Bytes of one turn in a chain (key, words), and of the key before a segment's first turn.
STEP, ANCHOR = 20, 16

CHAINS = "conv_id bigint, block int, depth int, ends boolean, chain binary"
NODES = (
    "key binary, parent binary, depth int, conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
    "saved_tokens bigint, chain binary"
)

#: First turns that a conversation takes over: (conversation it takes them from, how many of them).
Heads = Callable[[int], tuple[int, int]]
FAMILY, MOST_HEADS = 20, 3


def heads_of_family(conv_id: int) -> int:
    """How many first turns conversation c takes from conversation c - c % 20."""
    return zlib.crc32(str(conv_id).encode()) % (MOST_HEADS + 1)


def no_heads(conv_id: int) -> int:
    """Conversations as they are."""
    return 0


def _chains(segment: int, heads: Callable[[int], int]):
    """Rows sorted by family, its first conversation first, then conversation and turn, to segments of key chains."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        family = conv = None
        first: list[tuple[bytes, int]] = []  # first turns of the family's first conversation
        own = taken = depth = 0
        key, chain = ROOT, bytearray()

        def add(turn: tuple[bytes, int]) -> None:
            nonlocal key, depth, chain
            if depth and depth % segment == 0:
                out.append((conv, depth // segment, depth, False, bytes(chain)))
                chain = bytearray(key)
            key = hashlib.blake2b(key + turn[0], digest_size=16).digest()
            chain += key + turn[1].to_bytes(4, "big")
            depth += 1

        def finish() -> None:
            if conv is not None:
                if taken and own <= taken:  # nothing of its own is left
                    for head in first[:taken]:
                        add(head)
                out.append((conv, -(-depth // segment), depth, True, bytes(chain)))

        for batch in batches:
            turns = zip(*(batch.column(c).to_pylist() for c in ("family", "conv_id", "digest", "words")))
            for family_, conv_, digest, words in turns:
                if conv_ != conv or conv is None:
                    finish()
                    if family_ != family:
                        family, first = family_, []
                    conv, own, depth, key, chain = conv_, 0, 0, ROOT, bytearray(ROOT)
                    taken = 0 if conv == family else heads(conv)
                turn = (digest, words)
                if conv == family and len(first) < MOST_HEADS:
                    first.append(turn)
                own += 1
                if own == taken + 1 and taken:  # its own turns begin: those taken over come first
                    for head in first[:taken]:
                        add(head)
                if own > taken:
                    add(turn)
            if len(out) >= 4096:
                yield _batch(out, CHAINS)
                out = []
        finish()
        if out:
            yield _batch(out, CHAINS)

    return build


TYPES = {"bigint": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    arrays = [pa.array(values, TYPES[t]) for values, (_, t) in zip(zip(*rows), fields)]
    return pa.RecordBatch.from_arrays(arrays, names=[n for n, _ in fields])


def chains(conversations: DataFrame, heads: Callable[[int], int] = heads_of_family, segment: int = SEGMENT) -> DataFrame:
    """Stored segments of all rebuilt conversations: conv_id, block (from 1; 0 without turns), depth of its end, ends, chain."""
    columns.need(conversations, "conv_id", "turn", "role", "text")
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    content = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turns = conversations.filter("conv_id IS NOT NULL").select(
        (F.col("conv_id") - F.col("conv_id") % FAMILY).cast("long").alias("family"),
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.substring(F.unhex(F.sha2(content.cast("binary"), 256)), 1, 16).alias("digest"),
        F.regexp_count(text, F.lit(WORDS)).alias("words"),
    )
    in_order = turns.repartition("family").sortWithinPartitions(
        "family", F.col("conv_id") != F.col("family"), "conv_id", F.asc_nulls_first("turn"), "digest"
    )
    built = in_order.select("family", "conv_id", "digest", "words").mapInArrow(_chains(segment, heads), CHAINS)
    path = scratch.fresh_path(conversations.sparkSession, "chains")
    built.write.partitionBy("block").parquet(path)
    schema = "conv_id bigint, depth int, ends boolean, chain binary, block int"
    return conversations.sparkSession.read.schema(schema).parquet(path)


def _key(chain: Column) -> Column:
    return F.substring(chain, F.length(chain) - STEP + 1, 16)


def _regroup(items: DataFrame, depth: int) -> DataFrame:
    """Nodes of one depth from the items that reach it: conversations that end there and nodes left of deeper ones."""
    merged = items.groupBy("chain").agg(
        F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
    )
    size = F.length("chain")
    words = F.conv(F.hex(F.substring("chain", size - 3, 4)), 16, 10).cast("long")
    # a segment's first turn stands right behind the key of the prefix before it
    parent = F.when(size == ANCHOR + STEP, F.substring("chain", 1, 16)).otherwise(F.substring("chain", size - 2 * STEP + 1, 16))
    return merged.select(
        _key(F.col("chain")).alias("key"),
        parent.alias("parent"),
        F.lit(depth).alias("depth"),
        "conv_id",
        "n_convs",
        "n_children",
        F.when(F.col("n_children") == 0, 1).otherwise(F.col("n_leaves")).alias("n_leaves"),
        (F.col("saved_tokens") + (F.col("n_convs") - 1) * words).alias("saved_tokens"),
        F.substring("chain", F.lit(1), size - STEP).alias("chain"),
    )


def _peel(top: int, low: int):
    """The same for depths ``top`` down to ``low`` of items that meet in one task if their prefixes of ``low`` turns agree."""

    def peel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels: list[dict[bytes, list[int]]] = [{} for _ in range(top - low + 1)]

        def merge(depth: int, chain: bytes, conv: int, *sums: int) -> None:
            state = levels[depth - low].get(chain)
            if state is None:
                levels[depth - low][chain] = [conv, *sums]
            else:
                state[0] = min(state[0], conv)
                for k, s in enumerate(sums, 1):
                    state[k] += s

        names = ("depth", "chain", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in names)):
                merge(*row)
        for depth in range(top, low - 1, -1):
            out = []
            for chain, (conv, n, children, leaves, saved) in levels[depth - low].items():
                left = chain[:-STEP]
                leaves = leaves if children else 1
                saved += (n - 1) * int.from_bytes(chain[-4:], "big")
                parent = left[-STEP:][:16] if len(left) > ANCHOR else left
                out.append((chain[-STEP:-4], parent, depth, conv, n, children, leaves, saved, left if depth == low else None))
                if depth > low:
                    merge(depth - 1, left, conv, n, 1, leaves, saved)
            levels[depth - low] = {}
            if out:
                yield _batch(out, NODES)

    return peel


def _rounds(ending: dict[int, int], segment: int, fused: int) -> list[tuple[int, int]]:
    """(top, low) depths of each round, from the deepest: none crosses a segment, few prefixes are peeled together."""
    alive, rounds = 0, []
    prefixes = 0
    for depth in range(max(ending, default=0), 0, -1):
        alive += ending.get(depth, 0)
        prefixes += alive
        if rounds and depth % segment and prefixes <= fused:
            rounds[-1] = (rounds[-1][0], depth)
        else:
            rounds.append((depth, depth))
            prefixes = alive
    return rounds


def trie(
    conversations: DataFrame, heads: Callable[[int], int] = heads_of_family, segment: int = SEGMENT, fused: int = FUSED
) -> tuple[DataFrame, DataFrame]:
    """Stored nodes (key, parent key, depth, conv_id, n_convs, n_children, n_leaves, saved_tokens) and stored chains."""
    spark = conversations.sparkSession
    cut = chains(conversations, heads, segment)
    ends = cut.filter("ends")
    ending = {r["depth"]: r["count"] for r in ends.groupBy("depth").count().collect()}
    path = scratch.fresh_path(spark, "nodes")
    fields = ["chain", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]

    def stored(nodes: DataFrame, number: int) -> DataFrame:
        nodes.write.parquet(f"{path}/round={number}")
        return spark.read.schema(NODES).parquet(f"{path}/round={number}")

    def left_of(nodes: DataFrame, depth: int) -> DataFrame:
        stripped = nodes.filter(F.col("depth") == depth)
        return stripped.select("chain", "conv_id", "n_convs", F.lit(1).cast("long").alias("n_children"), "n_leaves", "saved_tokens")

    zeros = [F.lit(0).cast("long").alias(c) for c in ("n_children", "n_leaves", "saved_tokens")]
    ended = ends.select("depth", "chain", "conv_id", F.lit(1).cast("long").alias("n_convs"), *zeros, "block")
    left, rounds = None, _rounds(ending, segment, fused)
    for number, (top, low) in enumerate(rounds):
        block = -(-top // segment)
        items = ended.filter((F.col("block") == block) & F.col("depth").between(low, top)).select("depth", *fields)
        if left is not None:
            if top % segment == 0:  # the segment above, of the conversation that stands for the node
                above = cut.filter((F.col("block") == block) & ~F.col("ends")).select("conv_id", "chain")
                left = left.drop("chain").join(above, "conv_id")
            items = items.unionByName(left.select(F.lit(top).alias("depth"), *fields))
        if top == low:
            nodes = _regroup(items, top)
        else:
            meeting = F.substring("chain", ANCHOR + (low - 1 - (block - 1) * segment) * STEP + 1, 16)
            nodes = items.repartition(meeting).mapInArrow(_peel(top, low), NODES)
        left = left_of(stored(nodes, number), low)
    root_of = ended.filter("depth = 0").select(*fields)
    if left is not None:
        root_of = root_of.unionByName(left.select(*fields))
    total = root_of.agg(
        F.min("conv_id").alias("conv_id"),
        *[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in fields[2:]],
    ).filter("n_convs > 0")
    root = total.select(
        F.lit(ROOT).alias("key"),
        F.lit(None).cast("binary").alias("parent"),
        F.lit(0).alias("depth"),
        "conv_id",
        "n_convs",
        "n_children",
        F.when(F.col("n_children") == 0, 1).otherwise(F.col("n_leaves")).cast("long").alias("n_leaves"),
        "saved_tokens",
        F.lit(None).cast("binary").alias("chain"),
    )
    stored(root, len(rounds))
    return spark.read.schema(f"{NODES}, round int").parquet(path).drop("chain", "round"), cut


def end_digests(cut: DataFrame) -> DataFrame:
    """(key, ends_sha256) of nodes at which conversations end: their ids ascending, joined by commas."""
    ends = cut.filter("ends").select(
        F.when(F.col("depth") == 0, F.lit(ROOT)).otherwise(_key(F.col("chain"))).alias("key"), "conv_id"
    )
    pieces = (
        ends.groupBy("key", F.floor(F.col("conv_id") / PIECE).alias("piece"))
        .agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
        .select("key", "piece", F.array_join("ids", ",").alias("ids"))
    )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            out = []
            for next_key, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist()):
                if next_key != key:
                    if key is not None:
                        out.append((key, state.digest()))
                    key, state = next_key, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if out:
                yield _batch(out, "key binary, digest binary")
        if key is not None:
            yield _batch([(key, state.digest())], "key binary, digest binary")

    in_order = pieces.repartition("key").sortWithinPartitions("key", "piece").select("key", "ids")
    return in_order.mapInArrow(digest, "key binary, digest binary").select("key", F.lower(F.hex("digest")).alias("ends_sha256"))


def report(
    conversations: DataFrame, heads: Callable[[int], int] = heads_of_family, segment: int = SEGMENT, fused: int = FUSED
) -> DataFrame:
    """Per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    nodes, cut = trie(conversations, heads, segment, fused)
    digests = scratch.stored(end_digests(cut), "digests")
    nodes = scratch.stored(nodes.join(digests, "key", "left"), "nodes")
    names = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    root = nodes.filter("depth = 0").select("conv_id").first()  # one row at most; the parent of all first turns
    of_root = F.when(F.col("depth") == 1, F.lit(root["conv_id"] if root else None)).cast("long")
    high, low = nodes.filter("depth <= 1"), nodes.filter("depth > 1")
    high = high.withColumn("parent_conv_id", of_root)
    low = low.join(names, "parent")
    return high.unionByName(low.select(*high.columns)).select(
        "conv_id",
        F.col("depth").cast("long").alias("depth"),
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
