import hashlib

import numpy as np
import pyarrow as pa
import pytest

from mortar.llm import iblt, ranges
from tests.llm.fixtures import documents, empty


def test_peeling_recovers_the_difference():
    rng = np.random.default_rng(2)
    for shared, only_a, only_b in ((50, 3, 4), (500, 200, 90), (0, 1, 0), (10, 0, 0), (0, 0, 0)):
        keys = rng.integers(0, 2**64, shared + only_a + only_b, dtype=np.uint64)
        a, b = keys[: shared + only_a], np.concatenate([keys[:shared], keys[shared + only_a :]])
        left, right = (a, np.array([0, a.size])), (b, np.array([0, b.size]))
        assert iblt.differing(left, right, np.array([0]), np.array([0])).tolist() == [only_a + only_b]
        size = 4 * (only_a + only_b + 1)
        minus = [x - y for x, y in zip(iblt.sketches(a, np.zeros(a.size, int), 1, size), iblt.sketches(b, np.zeros(b.size, int), 1, size))]
        solved, _, digest, sign = iblt.peel(*minus, 1, size)
        assert solved.all()
        assert set(digest[sign == 1].tolist()) == set(a.tolist()) - set(b.tolist())
        assert set(digest[sign == -1].tolist()) == set(b.tolist()) - set(a.tolist())


def test_paragraphs_repeat_and_shift():
    lines = [f"line number {i} with words of its own {i * i}" for i in range(40)]
    texts = ["\n".join(lines), "\n".join(["new first line", *lines]), "\n".join(lines + lines), ""]
    digest, bounds = iblt.sketch_texts(pa.array(texts))
    part = [set(digest[bounds[i] : bounds[i + 1]].tolist()) for i in range(4)]
    assert len(part[0] - part[1]) == 0
    assert len(part[1] - part[0]) <= 3
    assert len(part[2]) == 2 * len(part[0])
    assert part[3] == set()


@pytest.mark.parametrize("rows", [4096, 25])
def test_versions(spark, monkeypatch, rows):
    monkeypatch.setattr(ranges.cut_points, "__defaults__", (rows, 2000))
    docs = documents(spark).filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    own = [(r["doc_id"], r["text"] or "") for r in docs.orderBy("doc_id", ascending=False).collect()]
    got = {r["doc_id"]: r for r in iblt.compare_versions(docs).collect()}
    assert len(got) == len(own)
    marks = {}
    for i, (doc_id, text) in enumerate(own):
        third = len(text) // 3
        edited = text[: len(text) - third] + own[(i + 1) % len(own)][1][:third]
        r = got[doc_id]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        assert marks.setdefault(text, r["fingerprint"]) == r["fingerprint"]
        if edited == text:
            assert r["near_edited"] == 1 and r["fingerprint"] == r["edited_fingerprint"]
    plain = {r["doc_id"]: r["fingerprint"] for r in iblt.fingerprint(docs).collect()}
    assert plain == {k: r["fingerprint"] for k, r in got.items()}
    long = [r for k, r in got.items() if r["n_chars"] > 500 and k < 9000]
    assert np.mean([r["near_edited"] for r in long]) > 0.5 > np.mean([r["near_next"] for r in long])


def test_nulls_ties_and_single_rows(spark):
    assert iblt.compare_versions(documents(spark, real=False)).count() == 13
    assert iblt.compare_versions(empty(spark)).count() == 0
    one = iblt.compare_versions(spark.createDataFrame([(1, "abc def ghi")], "doc_id long, text string")).collect()
    assert [r["near_next"] for r in one] == [1.0]
