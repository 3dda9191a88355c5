import hashlib
import re

import pytest
from pyspark.sql import functions as F

from mortar.llm import decontaminate
from tests.llm.fixtures import documents, empty

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def expected(docs, items, width=10):
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - width + 1)) if w else ():
            windows.setdefault(tuple(w[i : i + width]), set()).add(item)
    out = []
    for doc_id, text in docs:
        w = words(text)
        hit, found = [False] * len(w), set()
        for window, ids in windows.items():
            for i in range(len(w) - len(window) + 1):
                if w[i] == window[0] and tuple(w[i : i + len(window)]) == window:
                    hit[i : i + len(window)] = [True] * len(window)
                    found |= ids
        ids = sorted(str(i) for i in found if i is not None)
        digest = hashlib.sha256(",".join(ids).encode()).hexdigest()
        out.append((doc_id, len(w), sum(hit), len(ids), digest, sum(hit) > 0))
    return sorted(out, key=repr)


ITEMS = [
    (1, "the same line of seven PLAIN words"),
    (2, "repeated"),
    (2, "is repeated"),
    (3, None),
    (4, ""),
    (None, "no id at"),
    (10, "lorem ipsum dolor sit amet consectetur lorem ipsum dolor sit amet"),
]


@pytest.mark.parametrize("most", [500_000, 3])
def test_report_equals_brute_force(spark, most):
    docs = documents(spark)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    real = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").limit(3)
    items = items.unionByName(real.select("item_id", "text").withColumn("item_id", F.col("item_id") + 100))
    got = sorted(map(tuple, decontaminate.report(docs, items, most_windows=most).collect()), key=repr)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert got == expected(rows, [tuple(r) for r in items.collect()])


def test_removal_of_documents_and_spans(spark):
    docs = documents(spark, real=False)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    left = decontaminate.remove_documents(docs, items)
    assert left.columns == docs.columns
    assert {r["doc_id"] for r in left.collect()} == {9001, 9002, 9003, 9004, 9009, 9010}
    cut = {(r["doc_id"], r["text"]) for r in decontaminate.remove_spans(docs, items).collect()}
    assert (9005, "\nand another line of some words") in cut
    assert (9008, "a second text of the same id, the id ") in cut
    assert (9001, None) in cut


def test_empty_tables(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontaminate.report(empty(spark), items).count() == 0
    none = decontaminate.report(documents(spark, real=False), items.limit(0))
    assert none.filter("contaminated").count() == 0
    assert none.count() == 13
