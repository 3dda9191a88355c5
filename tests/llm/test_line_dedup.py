import hashlib
import random

from hypothesis import given
from hypothesis import strategies as st

from mortar.llm import line_dedup
from tests.llm.fixtures import documents, empty

LEAST = line_dedup.LEAST


def units(lines):
    for i, line in enumerate(lines):
        n = 0
        for j in range(i, len(lines)) if line.split() else ():
            n += len(lines[j].replace("\x1c", "x").replace("　", "x").replace("\xa0", "x").split())
            if n >= LEAST:
                yield tuple(lines[i : j + 1])
                break


def expected(rows):
    texts, first, own, out = {}, {}, {}, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        lines = text.split("\n") if text else []
        gone, owners = set(), []
        if text and texts.get(text, doc_id) != doc_id:
            gone, owners = set(range(len(lines))), [texts[text]]
        elif text:
            texts[text] = doc_id
            found = list(units(lines))
            for other in sorted({first[u] for u in found if first.get(u, doc_id) != doc_id}):
                for theirs in own[other]:
                    block = line_dedup.common_blocks(
                        [hash(x) for x in theirs], [hash(x) for x in lines], [len(x.split()) for x in lines]
                    )
                    gone |= set(block)
                    owners += [other] if block and other not in owners else []
            for u in found:
                first.setdefault(u, doc_id)
            own.setdefault(doc_id, []).append(lines)
        kept = None if text is None else "\n".join(x for i, x in enumerate(lines) if i not in gone)
        out.append((doc_id, len(lines), len(gone), owners, None if kept is None else hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


MORE = [
    (9101, "a b c d e f\n"), (9102, "x\na b c d e f\n\n"), (9103, "\n\n"), (9104, "a b c d e f\n"), (9105, "\na b c d e f"),
    (9106, "one two\n\nthree four\nfive six\nseven"), (9107, "zero\none two\n\nthree four\nfive six\neight"), (9108, "one two\nthree"),
]


def test_report_equals_brute_force(spark):
    docs = documents(spark).select("doc_id", "text").unionByName(spark.createDataFrame(MORE, "doc_id long, text string"))
    got = sorted((tuple(r) for r in line_dedup.report(docs).collect()), key=repr)
    assert got == expected([tuple(r) for r in docs.collect()])


def test_blocks_are_deleted_from_the_later_document(spark):
    rng = random.Random(1)
    line = lambda: " ".join(str(rng.random()) for _ in range(6))
    shared = [line() for _ in range(4)]
    rows = [(i, "\n".join([line(), *shared, line()])) for i in range(30)]
    got = {r["doc_id"]: r for r in line_dedup.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0]["n_deleted"] == 0
    assert all(got[i]["n_deleted"] == 4 and got[i]["owners"] == [0] for i in range(1, 30))


@given(st.lists(st.integers(0, 6), max_size=30), st.lists(st.integers(0, 6), max_size=30))
def test_alignment_rises_in_both(a, b):
    pairs = line_dedup.patience(a, b)
    assert all(a[i] == b[j] for i, j in pairs)
    assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
    if a == b:
        assert len(pairs) == len(a)


def test_unique_lines_anchor_the_alignment():
    assert line_dedup.patience([1, 9, 2, 9, 3], [9, 1, 9, 9, 3, 2]) == [(0, 1), (1, 2), (3, 3), (4, 4)]


def test_stage_and_empty_table(spark):
    docs = documents(spark, real=False)
    left = line_dedup.without_copied_lines(docs)
    assert left.columns == docs.columns
    got = {r["doc_id"]: r for r in left.collect()}
    assert 9006 not in got and got[9007]["text"] == "head\n" and got[9007]["n_chars"] == 5
    assert {9001, 9002, 9003, 9005} <= set(got)
    assert line_dedup.report(empty(spark)).count() == 0


def test_lines_in_another_order_go_as_well(spark):
    rng = random.Random(5)
    x, y, z = (" ".join(str(rng.random()) for _ in range(6)) for _ in range(3))
    rows = [(1, f"{x}\n{y}\n{z}"), (2, f"own\n{z}\n{y}\n{x}\nend"), (3, f"{y}\nthree\n{x}\n{z}"), (4, "\n".join(["four", z, y, x]))]
    got = {r["doc_id"]: r for r in line_dedup.report(spark.createDataFrame(rows, "doc_id long, text string"), again=True).collect()}
    assert [got[i]["n_deleted"] for i in range(1, 5)] == [0, 3, 3, 3]


def test_nothing_that_earlier_partners_have_is_left(spark):
    rng = random.Random(6)
    pool = [" ".join(str(rng.random()) for _ in range(6)) for _ in range(12)] + ["ok", "and so on"]
    rows = [(i, "\n".join(rng.sample(pool, rng.randint(3, 10)))) for i in range(25)]
    deleted = line_dedup.deletions(spark.createDataFrame(rows, "doc_id long, text string"), again=True).collect()
    gone = {r["id"]: set(r["deleted"]) for r in deleted if not r["whole"]}
    for i, text in rows:
        lines = text.split("\n")
        seen = {x for _, t in rows[:i] for x in t.split("\n")}
        left = [x for j, x in enumerate(lines) if j not in gone.get(i, set())]
        assert not any(x in seen for x in left if len(x.split()) >= LEAST)
        for _, other in rows[:i]:  # all earlier partners, not the first alone; short lines are no unit of their own
            block = line_dedup.common_blocks(
                [hash(x) for x in other.split("\n")], [hash(x) for x in lines], [len(x.split()) for x in lines]
            )
            assert {j for j in block if len(lines[j].split()) >= LEAST} <= gone.get(i, set())
