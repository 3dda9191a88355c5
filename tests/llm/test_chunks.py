import hashlib
import random

from mortar.llm import chunks
from tests.llm.fixtures import documents, empty

GEAR = chunks._GEAR.tolist()
SPACE = b"\t\n\x0b\x0c\r "


def cut(text):
    ends, h = set(), 0
    for i, x in enumerate(text):
        h = ((h << 1) + GEAR[x]) & 0xFFFFFFFF
        if h >> 27 == 0:
            end = i + 1
            space = next((k for k in range(end - 1, min(len(text), end + 32)) if text[k] in SPACE), None)
            if space is not None:
                end = space + 1
            else:
                while end < len(text) and text[end] & 0xC0 == 0x80:
                    end += 1
            ends.add(end)
    ends = sorted(ends | ({len(text)} if text else set()))
    return [text[a:b] for a, b in zip([0, *ends], ends)]


def expected(rows, least=chunks.LEAST):
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    first, out = {}, []
    for doc_id, text in order:
        for c in cut((text or "").encode()):
            first.setdefault(c, doc_id)
    for doc_id, text in order:
        parts, seen, again = cut((text or "").encode()), set(), []
        for c in parts:
            again.append(c in seen or first[c] != doc_id)
            seen.add(c)
        kept, removed, at, offset = b"", 0, 0, 0
        raw = b"".join(parts)
        while at < len(parts):
            end = at
            while end < len(parts) and again[end]:
                end += 1
            run = b"".join(parts[at:end])
            starts = sum(
                raw[k] not in SPACE and (k == 0 or raw[k - 1] in SPACE) for k in range(offset, offset + len(run))
            )
            if end > at and starts >= least:
                removed += starts
            elif end > at:
                kept += run
            if end == at:
                run, end = parts[at], at + 1
                kept += run
            offset, at = offset + len(run), end
        digest = None if text is None else hashlib.sha256(kept).hexdigest()
        out.append((doc_id, len(parts), sum(again), removed, removed > 0, digest))
    return sorted(out, key=repr)


def test_report_equals_brute_force(spark):
    docs = documents(spark)
    names = ["doc_id", "n_chunks", "n_repeated", "n_removed", "repeated", "kept_sha256"]
    got = sorted(map(tuple, chunks.report(docs).select(*names).collect()), key=repr)
    assert got == expected([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_insertions_leave_most_chunks_alone():
    rng = random.Random(3)
    text = " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9))) for _ in range(2000)).encode()
    before, after = set(cut(text)), set(cut(text[:3000] + b"INSERTED WORDS " + text[3000:]))
    assert len(before - after) <= 3 and len(before) > 200


def test_passages_are_removed_from_later_documents_only(spark):
    rng = random.Random(4)
    prose = lambda n: " ".join("".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 9))) for _ in range(n))
    passage = prose(60)
    rows = [(i, f"{prose(80)} {passage} {prose(80)}", "en", "s", 0) for i in range(5)] + [(i, prose(200), "en", "s", 0) for i in range(5, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r["doc_id"]: r for r in chunks.report(docs).collect()}
    assert [got[i]["repeated"] for i in range(9)] == [False] + [True] * 4 + [False] * 4
    assert all(got[i]["owners"][0] == 0 and 16 <= got[i]["n_removed"] <= 60 for i in range(1, 5))


def test_columns_stay_and_empty_table(spark):
    docs = documents(spark, real=False)
    found, names = chunks.deduplicate(docs)
    assert found.columns[: len(docs.columns)] == docs.columns and names["owners"] == "_owners"
    assert chunks.report(empty(spark)).count() == 0


def test_finer_cut_finds_passages_of_51_words():
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))

    def parts(text, bits):
        ends = chunks.chunk_ends(chunks.np.frombuffer(text, chunks.np.uint8), chunks.np.array([0, len(text)]), bits).tolist()
        return [text[a:b] for a, b in zip([0, *ends], ends)]

    missed = {chunks.BITS: 0, chunks.FINE: 0}
    for _ in range(300):
        passage = prose(51)
        first, second = (f"{prose(60)} {passage} {prose(60)}".encode() for _ in range(2))
        for bits in missed:
            own = set(parts(first, bits))
            missed[bits] += sum(len(x.split()) for x in parts(second, bits) if x in own) < chunks.LEAST
    assert missed[chunks.FINE] <= 2 < missed[chunks.BITS]
