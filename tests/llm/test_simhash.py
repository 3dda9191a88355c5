import re

import numpy as np
import pytest
import xxhash

from mortar.llm import simhash
from mortar.llm.components import components
from tests.llm.fixtures import documents, empty


def signed(x):
    return int(np.array([x], np.uint64).view(np.int64)[0])


def brute(fingerprints, budget=4):
    parent = list(range(len(fingerprints)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, x in enumerate(fingerprints):
        for j in range(i):
            if bin(x ^ fingerprints[j]).count("1") <= budget:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fingerprints))]


def fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0d]+", low)
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 4]).encode(), 42) for i in range(max(1, len(words) - 3))] if words else []
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


@pytest.mark.parametrize("leaves", [8192, 8])
def test_groups_equal_brute_force(spark, monkeypatch, leaves):
    monkeypatch.setattr(simhash, "MOST_LEAVES", leaves)
    rng = np.random.default_rng(leaves)
    found = set()
    for centre in rng.integers(0, 2**64, 12, dtype=np.uint64).tolist():
        found.add(centre)
        for _ in range(25):
            x = centre
            for bit in rng.integers(0, 64, rng.integers(1, 9)).tolist():
                x ^= 1 << bit
            found.add(x)
    prints = sorted(found)
    rows = spark.createDataFrame([(i, signed(x)) for i, x in enumerate(prints)], "doc_id long, fp long")
    got = {r["fp"]: r["component"] for r in simhash.groups(rows).collect()}
    assert [got[signed(x)] for x in prints] == brute(prints)


def test_pairs_in_pieces_give_the_same_links(monkeypatch):
    monkeypatch.setattr(simhash, "MOST_PAIRS", 3)
    bits = np.sort(np.array([0, 1, 3, 7, 15, 31, 1 << 63, 3 << 62], np.uint64))
    u, v = simhash.trie_links(bits, np.array([0, 8]), 0, 1)
    assert len(u) == 7  # a tree of all eight
    assert {tuple(sorted(x)) for x in zip(bits[u].tolist(), bits[v].tolist())} <= {
        (a, b) for a in bits.tolist() for b in bits.tolist() if a < b and bin(a ^ b).count("1") <= 1
    }


def test_near_duplicates(spark):
    docs = documents(spark)
    rows = docs.collect()
    prints = [fingerprint(r["text"]) for r in rows]
    group = brute(prints)
    least = {}
    for r, g in zip(rows, group):
        least[g] = min(least.get(g, 1 << 62), 1 << 62 if r["doc_id"] is None else r["doc_id"])
    want = sorted(((r["doc_id"], format(p, "016x"), least[g]) for r, p, g in zip(rows, prints, group)), key=repr)
    want = [(a, b, None if c == 1 << 62 else c) for a, b, c in want]
    assert sorted(map(tuple, simhash.near_duplicates(docs).collect()), key=repr) == want
    kept = simhash.one_of_each_group(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len(set(group))
    assert {r["doc_id"] for r in kept.collect()} == {c for _, _, c in want}


def test_components_of_paths_stars_and_bad_links(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(40)] + [(5, 5), (None, 3), (70, None), (200, 201), (201, 200)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{100 + i: 100 for i in range(40)}, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_empty_table(spark):
    assert simhash.near_duplicates(empty(spark)).count() == 0
    assert simhash.one_of_each_group(empty(spark)).count() == 0
