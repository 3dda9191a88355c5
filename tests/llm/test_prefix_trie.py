import hashlib
import random
import re
import zlib

import pytest

from mortar.llm import prefix_trie

TABLE = "/root/testdata/sf0.001/conversations.parquet"
SCHEMA = "conv_id long, turn long, role string, text string"


def digest(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]


def expected(rows, heads=prefix_trie.heads_of_family):
    """Every prefix of every conversation, held in dictionaries."""
    by_conv = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            by_conv.setdefault(conv, []).append((turn is not None, turn or 0, digest(role or "", text or ""), role or "", text or ""))
    plain = {c: [t[3:] for t in sorted(turns, key=lambda t: t[:3])] for c, turns in by_conv.items()}
    built = {}
    for c, own in plain.items():
        family = c - (c % 20 if c >= 0 else -(-c % 20))
        built[c] = own if c == family else plain.get(family, [])[: heads(c)] + own[heads(c) :]
    members = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for prefix, convs in members.items():
        below = [p for p in members if p[: len(prefix)] == prefix]
        leaves = [p for p in below if not any(q[:-1] == p for q in members if q)]
        saved = sum((len(members[p]) - 1) * len(re.findall("[^ \t-\r]+", p[-1][1])) for p in below if p)
        ends = ",".join(str(c) for c in sorted(c for c in convs if len(built[c]) == len(prefix)))
        children = sum(1 for p in below if len(p) == len(prefix) + 1)
        parent = min(members[prefix[:-1]]) if prefix else None
        out.append((min(convs), len(prefix), parent, len(convs), children, len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def made_up(seed, conversations=60, longest=11):
    rng, rows = random.Random(seed), []
    for c in range(conversations):
        for turn in range(rng.randint(1, longest)):
            text = rng.choice(["a b", "a  b", "", None, "é 😀 x", "one two three\n four"][: rng.choice([1, 2, 6])])
            rows.append((c, turn, rng.choice(["user", "user", "assistant", None]), text))
    return rows


AWKWARD = [
    (None, 0, "user", "nobody's"), (100, None, "user", "first"), (100, 0, "user", "second"), (100, 0, "user", "second"),
    (101, 5, None, None), (102, 1, "", ""), (103, 1, "a", "bc"), (104, 1, "ab", "c"), (120, 1, "user", "x"), (-3, 0, "user", "neg ative"),
    (-23, 0, "user", "neg ative"), (-23, 1, "user", "more"), (105, 2, "user", "tie b"), (105, 2, "user", "tie a"), (2**40 + 3, 0, "u", "far"),
] + [(140 + c, turn, "user", f"same words {turn % 7}") for c in range(4) for turn in range(70 + c // 2)]


@pytest.mark.parametrize("segment,fused", [(64, 20_000), (4, 0), (3, 40), (1, 10**9), (64, 0)])
def test_report_equals_brute_force(spark, segment, fused):
    rows = made_up(segment) + [(c + 1000, *r) for c, *r in made_up(9, 25)] + ([] if 0 in (fused, segment - 1) else AWKWARD)
    table = spark.createDataFrame(rows, SCHEMA)
    got = sorted(map(tuple, prefix_trie.report(table, segment=segment, fused=fused).collect()), key=repr)
    assert got == expected(rows)


def test_given_table(spark):
    table = spark.read.parquet(TABLE)
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    got = sorted(map(tuple, prefix_trie.report(table.withColumnRenamed("turn", "turn")).collect()), key=repr)
    assert got == expected(rows)
    whole = prefix_trie.report(table, heads=prefix_trie.no_heads)
    assert sorted(map(tuple, whole.collect()), key=repr) == expected(rows, prefix_trie.no_heads)


def test_turnless_and_empty(spark):
    # conversations of one turn that give up more first turns than they have, while nobody lends any
    turnless = [c for c in range(1, 400) if c % 20 and zlib.crc32(str(c).encode()) % 4][:9]
    rows = [(c, 0, "user", "x") for c in turnless]
    table = spark.createDataFrame(rows, SCHEMA)
    got = sorted(map(tuple, prefix_trie.report(table).collect()), key=repr)
    assert got == expected(rows) and len(got) == 1 and got[0][3] == 9
    assert prefix_trie.report(spark.createDataFrame([], SCHEMA)).collect() == []


def test_long_lists_in_pieces(spark):
    old = prefix_trie.PIECE
    prefix_trie.PIECE = 8
    try:
        rows = [(c, 0, "user", "all the same") for c in [*range(0, 300), -5, -50]]
        table = spark.createDataFrame(rows, SCHEMA)
        got = sorted(map(tuple, prefix_trie.report(table, heads=prefix_trie.no_heads).collect()), key=repr)
    finally:
        prefix_trie.PIECE = old
    assert got == expected(rows, prefix_trie.no_heads)


def test_rounds():
    assert prefix_trie._rounds({}, 64, 100) == []
    assert prefix_trie._rounds({3: 5}, 64, 100) == [(3, 1)]
    assert prefix_trie._rounds({3: 5}, 64, 0) == [(3, 3), (2, 2), (1, 1)]
    assert prefix_trie._rounds({130: 1, 2: 200}, 64, 100) == [(130, 129), (128, 65), (64, 3), (2, 2), (1, 1)]
