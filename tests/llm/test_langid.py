import zlib

from mortar.llm import langid
from tests.llm.fixtures import DOCS, documents, empty


def substrings(text):
    return {tuple(text[i:j]) for i in range(len(text)) for j in range(i + 1, len(text) + 1)}


def test_automaton_reads_exactly_the_substrings():
    text = [1, 2, 1, 1, 2, 3, 1, 2, 1]
    steps = langid.suffix_automaton(text)
    found, work = set(), [((), 0)]
    while work:
        path, state = work.pop()
        for s, to in steps[state].items():
            found.add((*path, s))
            work.append(((*path, s), to))
    assert found == substrings(text)


def phrases(text, labelled):
    count, at = 0, 0
    while at < len(text):
        size = 1
        while at + size < len(text) and text[at : at + size + 1] in labelled:
            size += 1
        if text[at : at + size] not in labelled:
            size = 1
        count, at = count + 1, at + size
    return count


def test_costs_equal_greedy_parsing():
    import numpy as np

    samples = {"x": ["the cat sat on the mat and the dog"], "y": ["der hund und die katze sitzen"]}
    model = langid.Model(samples)
    texts = ["the dog sat", "die katze", "zzz qqq", "mat", ""]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    costs = model.costs(data, offsets)
    for i, name in enumerate(model.languages):
        labelled = samples[name][0].replace(" ", "\x00")
        for k, t in enumerate(texts):
            want = phrases(t.replace(" ", "\x00"), labelled) * np.log2(len(labelled)) / max(len(t), 1)
            assert abs(costs[i, k] - want) < 1e-9, (name, t)


def test_held_out_accuracy(spark):
    docs = documents(spark)
    found = langid.identify(docs).collect()
    assert len(found) == docs.count()
    for r in found:
        if r["doc_id"] is not None:
            assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1
    named = {r["doc_id"]: r["lang_pred"] for r in found}
    assert named[9001] == named[9002] == named[9003] == langid.UNDETERMINED
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(DOCS).collect()}
    held = [r for r in found if r["held_out"] and r["doc_id"] in truth]
    assert len(held) > 30
    assert sum(truth[r["doc_id"]] == r["lang_pred"] for r in held) / len(held) > 0.95


def test_without_labelled_text(spark):
    assert langid.identify(empty(spark)).count() == 0
    rows = spark.createDataFrame([(1, "some text", None), (2, "more", None)], "doc_id long, text string, lang string")
    assert {(r["lang_pred"], r["score"]) for r in langid.identify(rows).collect()} == {("und", 0.0)}
    one = spark.createDataFrame([(1, "some text", "en"), (2, "more", "en"), (4, "x", "en")], "doc_id long, text string, lang string")
    assert {r["lang_pred"] for r in langid.identify(one).collect()} == {"en"}
