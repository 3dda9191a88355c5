import numpy as np
import pytest

from mortar.llm import quality
from tests.llm.fixtures import documents, empty


def cast(real, share, n, seed=0):
    """Patterns and counts of ``n`` documents under labellers of given accuracies that vote on 70 %."""
    rng, real = np.random.default_rng(seed), np.array(real)
    truth = rng.random(n) < share
    right = rng.random((n, real.size)) < real
    good = np.where(right, truth[:, None], ~truth[:, None])
    votes = np.where(rng.random(right.shape) < 0.3, quality.NONE, np.where(good, quality.GOOD, quality.BAD))
    patterns, counts = np.unique(quality.pattern(votes.T), return_counts=True)
    return patterns, counts.astype(float)


@pytest.mark.parametrize("real", [[0.95, 0.9, 0.85, 0.8, 0.75, 0.7], [0.55, 0.9, 0.9, 0.9, 0.9, 0.55]])
@pytest.mark.parametrize("share", [0.7, 0.5, 0.85])
def test_expectation_maximisation_finds_accuracies_and_share(real, share):
    belief = quality.estimate(*cast(real, share, 400_000), np.array([quality.JUDGE] * len(real)))
    assert np.abs(belief.accuracy() - real).max() < 0.02
    assert abs(belief.share - share) < 0.02


def test_first_belief_holds_without_data_and_fades_with_it():
    first = np.array([quality.JUDGE] * 6)
    none = quality.estimate(np.zeros(0, int), np.zeros(0), first)
    assert np.allclose(none.chance, first) and none.share == quality.GOOD_SHARE
    real = [0.95, 0.95, 0.95, 0.95, 0.95, 0.95]
    gaps = [np.abs(quality.estimate(*cast(real, 0.7, n), first).accuracy() - real).max() for n in (100, 2_000, 100_000)]
    assert gaps[0] > gaps[1] > gaps[2] and gaps[2] < 0.01


def test_posterior_equals_bayes_by_hand():
    belief = quality.Belief(0.6, np.array([quality.DETECTOR, quality.JUDGE]))
    for d, j in ((quality.BAD, quality.GOOD), (quality.NONE, quality.BAD), (quality.NONE, quality.NONE)):
        chance = [0.6, 0.4]
        for k in (0, 1):
            chance[k] *= quality.DETECTOR[k][d] * (1 if j == quality.NONE else quality.JUDGE[k][j])
        assert abs(belief.good(np.array([[d, j]]))[0] - chance[0] / sum(chance)) < 1e-9


def test_votes_equal_counting_by_hand():
    texts = ["one two three " * 10, "one two. " * 20, "A | B| " * 10, "### ### $$$ a b c", "WORD! AGAIN! " * 8, "a a a a a a", "", "x"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    p = quality.profile(data, np.concatenate([[0], np.cumsum([len(t) for t in texts])]))
    for i, text in enumerate(texts):
        words = text.split()
        letters = [c for c in text if c.isalpha()]
        want = dict.fromkeys(quality.LABELLERS, quality.NONE)
        share = lambda test: sum(map(test, words)) / max(len(words), 1)
        if len(words) >= 5:
            signs = set("#$%&*+/<=>@\\^_`{|}~")
            want["symbols"] = quality.BAD if share(lambda w: w != "|" and bool(set(w) & signs)) >= 0.25 else quality.NONE
            want["table cells"] = quality.BAD if share(lambda w: w == "|") >= 0.15 else quality.NONE
            want["exclamations"] = quality.BAD if share(lambda w: "!" in w) >= 0.3 else quality.NONE
            want["repeated words"] = quality.BAD if sum(a == b for a, b in zip(words, words[1:])) >= 0.3 * len(words) else quality.NONE
        if len(letters) >= 20:
            want["capitals"] = quality.BAD if sum(c.isupper() for c in letters) >= 0.5 * len(letters) else quality.NONE
        if len(words) >= 20:
            stop = share(lambda w: w[-1] in ".,;:?")
            want["sentences"] = quality.BAD if stop < 0.02 else quality.GOOD if stop >= 0.06 else quality.NONE
        got = dict(zip(quality.LABELLERS, p.votes[:, i].tolist()))
        for name in ("symbols", "exclamations", "repeated words", "table cells", "capitals", "sentences"):
            assert got[name] == want[name], (text[:20], name)


def test_scorer_learns_soft_labels():
    rng = np.random.default_rng(1)
    x = rng.random((500, 20)).astype(np.float32)
    label = 1 / (1 + np.exp(-10 * (x[:, 3] - x[:, 5])))
    w = quality.train(x, label)
    p = 1 / (1 + np.exp(-(x @ w[:-1] + w[-1])))
    assert np.mean((p > 0.5) == (label > 0.5)) > 0.95


def test_agreement_with_given_labels(spark):
    docs = documents(spark)
    got = quality.classify(docs)
    assert got.columns == ["doc_id", "score", "weak_label", "keep"]
    rows = got.collect()
    assert len(rows) == docs.count()
    assert all(0 <= r["score"] <= 1 and r["keep"] == (r["score"] >= quality.KEEP) for r in rows)
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[9001]["score"] == by_id[9002]["score"] == by_id[9003]["score"] == 0
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet").collect()
    hits = [by_id[r["doc_id"]]["keep"] == (r["quality"] == 1) for r in labels]
    assert np.mean(hits) > 0.9
    clean = [by_id[r["doc_id"]]["keep"] for r in labels if r["quality"] == 1]
    assert np.mean(clean) > 0.97


def test_stage_and_empty_table(spark):
    docs = documents(spark)
    left = quality.keep_good(docs)
    assert left.columns == docs.columns and 0 < left.count() < docs.count()
    assert quality.classify(empty(spark)).count() == 0
    assert quality.classify(documents(spark, real=False)).count() == 13
