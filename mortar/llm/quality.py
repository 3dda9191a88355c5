"""Quality classifier from weak labels.

Heuristic labellers vote good, bad or nothing on every document.  Expectation-maximisation over the counts of all vote
patterns of all documents estimates, without any given label, the share of good documents and how often each labeller votes
what on good and on bad ones; a pattern's posterior is its documents' soft label.  A linear scorer over hashed word shapes and
pairs of shapes learns these labels and scores every whole text; a document is kept if its score is at least ``KEEP``.

A labeller that detects one kind of junk says something by its silence too; one that judges all texts says nothing on those
too short for it.  First beliefs are worth ``PSEUDO`` documents, whatever the size of the table, so data outweigh them as it grows.

Fit: vote patterns are counted over all documents (at most 3 ** labellers rows reach the driver).  The scorer is trained
on ``SAMPLE`` documents at most, the least text hash of each of ``SAMPLE`` hash classes, so copies count once.

Defined results: a null text, and one without a word, has score 0 and is not kept; equal texts have equal scores.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mortar.llm import bytescan, columns, scratch, worker

SAMPLE, WIDTH, KEEP = 4096, 2048, 0.35
#: First belief in the share of good documents, and the documents that each first belief is worth.
GOOD_SHARE, PSEUDO = 0.7, 100
#: No outcome is held rarer than this, so no labeller alone is beyond doubt.
RAREST = 1e-4
ROUNDS, STEPS, SHRINK = 500, 400, 1e-4
GOOD, NONE, BAD = 1, 0, 2


def _table(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars.encode())] = True
    return out


_SPACE = _table("\t\n\x0b\x0c\r ")
_UPPER = _table("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LOWER = _table("abcdefghijklmnopqrstuvwxyz")
_DIGIT = _table("0123456789")
_STOP = _table(".,;:?")
_BANG = _table("!")
_BAR = _table("|")
_SYMBOL = _table("#$%&*+/<=>@\\^_`{|}~")
_OTHER = np.arange(256) >= 128


def _distinct_pairs(words: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Distinct pairs of neighbouring words of every text (a text's last word makes a pair of its own)."""
    text = np.repeat(np.arange(bounds.size - 1), np.diff(bounds))
    pair = words * np.uint64(0x9E3779B97F4A7C15) + np.append(words[1:], words[:1])
    pair = np.sort(bytescan.mix(pair) >> np.uint64(24) | text.astype(np.uint64) << np.uint64(40))
    new = np.ones(pair.size, bool)
    new[1:] = pair[1:] != pair[:-1]
    return np.bincount((pair[new] >> np.uint64(40)).astype(np.int64), minlength=bounds.size - 1)


@dataclass
class Profile:
    """Words of a block of texts: shape, text and, per text, counts."""

    shape: np.ndarray
    bounds: np.ndarray
    votes: np.ndarray  # labeller x text


def profile(data: np.ndarray, offsets: np.ndarray) -> Profile:
    starts, ends = bytescan.spans(~_SPACE[data], offsets)
    bounds = np.searchsorted(starts, offsets)
    if not starts.size:
        return Profile(np.zeros(0, np.int64), bounds, np.zeros((len(LABELLERS), offsets.size - 1), np.int8))

    def inside(table: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(table[data], dtype=np.int32)])
        return total[ends] - total[starts]

    upper, lower, digit, bang, symbol, other = map(inside, (_UPPER, _LOWER, _DIGIT, _BANG, _SYMBOL, _OTHER))
    size = ends - starts
    hashes = bytescan.byte_hashes(data, starts, ends)
    again = np.zeros(size.size, bool)
    again[1:] = hashes[1:] == hashes[:-1]
    heads = bounds[:-1][np.diff(bounds) > 0]
    again[heads] = False
    stop = _STOP[data[ends - 1]]
    bar = _BAR[data[starts]] & (size == 1)
    shape = (
        (lower > 0) | (upper > 0) << 1 | _UPPER[data[starts]] << 2 | (symbol > 0) << 3 | (bang > 1) << 4 | stop << 5
        | bar << 6 | (digit > 0) << 7 | again << 8 | np.digitize(size, [4, 8, 13]) << 9 | (other > 0) << 11
    ).astype(np.int64)

    n = np.diff(bounds)

    def per_text(values: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
        return total[bounds[1:]] - total[bounds[:-1]]

    counts = {
        "words": n, "letters": per_text(upper + lower), "upper": per_text(upper),
        "symbol": per_text((symbol > 0) & ~bar), "bang": per_text(bang > 0),
        "bar": per_text(bar), "repeats": n - _distinct_pairs(hashes, bounds), "again": per_text(again), "stop": per_text(stop),
        "plain": per_text((lower > 0) & (upper == 0) & (symbol == 0) & (bang == 0) & (digit == 0)),
    }
    return Profile(shape, bounds, np.stack([f(counts) for f in LABELLERS.values()]).astype(np.int8))


def _detects(part: str, of: str, share: float, least: int = 5):
    """Votes bad at a share of at least ``share``, and nothing otherwise."""

    def vote(c: dict[str, np.ndarray]) -> np.ndarray:
        return np.where((c[of] >= least) & (c[part] >= share * c[of]), BAD, NONE)

    return vote


def _judges(part: str, of: str, bad: float, good: float, least: int = 10):
    """Votes bad at a share below ``bad``, good at one of at least ``good``, nothing between and on short texts."""

    def vote(c: dict[str, np.ndarray]) -> np.ndarray:
        share = c[part] / np.maximum(c[of], 1)
        out = np.where(share < bad, BAD, np.where(share >= good, GOOD, NONE))
        return np.where(c[of] < least, NONE, out)

    return vote


LABELLERS = {
    "symbols": _detects("symbol", "words", 0.25),
    "capitals": _detects("upper", "letters", 0.5, 20),
    "exclamations": _detects("bang", "words", 0.3),
    "repeated words": _detects("again", "words", 0.3),
    "table cells": _detects("bar", "words", 0.15),
    "few word pairs": _detects("repeats", "words", 0.8, 20),
    "sentences": _judges("stop", "words", 0.02, 0.06, 20),
    "plain words": _judges("plain", "words", 0.65, 0.75, 20),
}
#: Chances of (no vote, good, bad) on a good document and on a bad one.  A detector finds one kind of junk in five or so and is
#: rarely wrong; a judge is right in three votes of four, and where it does not vote (chance 0) nothing is concluded.
DETECTOR = [[0.995, 0, 0.005], [0.8, 0, 0.2]]
JUDGE = [[0, 0.75, 0.25], [0, 0.25, 0.75]]
FIRST = np.array([DETECTOR] * 6 + [JUDGE] * 2)


def features(p: Profile, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Hashed shapes and pairs of shapes: (bucket, text) of each."""
    text = np.repeat(np.arange(p.bounds.size - 1), np.diff(p.bounds))
    one = bytescan.mix(p.shape.astype(np.uint64) + np.uint64(1 << 40))
    same = text[1:] == text[:-1]
    two = bytescan.mix((p.shape[:-1] << 12 | p.shape[1:])[same].astype(np.uint64) + np.uint64(1 << 41))
    bucket = (np.concatenate([one, two]) % np.uint64(width)).astype(np.int64)
    return bucket, np.concatenate([text, text[1:][same]])


def shares(p: Profile, width: int = WIDTH) -> np.ndarray:
    """Feature vectors: text x bucket, each text's sum is 1."""
    bucket, text = features(p, width)
    n = p.bounds.size - 1
    out = np.bincount(text * width + bucket, minlength=n * width).reshape(n, width).astype(np.float32)
    return out / np.maximum(out.sum(axis=1, keepdims=True), 1)


def pattern(votes: np.ndarray) -> np.ndarray:
    """Vote patterns as numbers in base 3."""
    return (votes.astype(np.int64) * 3 ** np.arange(votes.shape[0])[:, None]).sum(axis=0)


@dataclass
class Belief:
    """Share of good documents and chances (labeller x good or bad document x no vote, good, bad)."""

    share: float
    chance: np.ndarray

    def good(self, votes: np.ndarray) -> np.ndarray:
        """P(good) of rows of votes."""
        sure = np.log(np.maximum(self.chance, RAREST))
        lean = sure[:, 0] - sure[:, 1]
        odds = np.log(self.share / (1 - self.share)) + lean[np.arange(lean.shape[0]), votes].sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(odds, -50, 50)))

    def accuracy(self) -> np.ndarray:
        """How often each labeller is right where it votes."""
        weight = np.array([self.share, 1 - self.share])
        right = (self.chance[:, [0, 1], [GOOD, BAD]] * weight).sum(axis=1)
        return right / ((self.chance[:, :, GOOD] + self.chance[:, :, BAD]) * weight).sum(axis=1)


def estimate(patterns: np.ndarray, counts: np.ndarray, first: np.ndarray = FIRST, rounds: int = ROUNDS) -> Belief:
    """Expectation-maximisation over counted vote patterns, from the first chances and ``GOOD_SHARE``.

    These count as ``PSEUDO`` documents.  A labeller whose first chance of no vote is 0 is not judged by its silence.
    """
    votes = patterns[:, None] // 3 ** np.arange(first.shape[0]) % 3
    outcome = np.stack([votes == k for k in (NONE, GOOD, BAD)], axis=2) & first.any(axis=1)  # pattern x labeller x vote
    belief = Belief(GOOD_SHARE, first)
    for _ in range(rounds):
        good = belief.good(votes)
        weight = np.stack([good, 1 - good]) * counts
        chance = np.einsum("cp,plk->lck", weight, outcome) + PSEUDO * first
        chance /= chance.sum(axis=2, keepdims=True)
        moved = np.abs(chance - belief.chance).max()
        belief = Belief((weight[0].sum() + PSEUDO * GOOD_SHARE) / (counts.sum() + PSEUDO), chance)
        if moved < 1e-6:
            break
    return belief


def train(x: np.ndarray, label: np.ndarray, steps: int = STEPS, shrink: float = SHRINK) -> np.ndarray:
    """Weights and bias of a logistic scorer for soft labels (full-batch, adaptive steps)."""
    w = np.zeros(x.shape[1] + 1)
    m, s = np.zeros_like(w), np.zeros_like(w)
    for k in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ w[:-1].astype(x.dtype) + w[-1], -50, 50)))
        gap = (p - label) / label.size
        g = np.append(x.T @ gap.astype(x.dtype) + shrink * w[:-1] / label.size, gap.sum())
        m, s = 0.9 * m + 0.1 * g, 0.999 * s + 0.001 * g * g
        w -= 0.3 * (m / (1 - 0.9**k)) / (np.sqrt(s / (1 - 0.999**k)) + 1e-9)
    return w


@dataclass
class Model:
    belief: Belief
    weights: np.ndarray


def _votes(docs: DataFrame) -> DataFrame:
    """(h, pattern) of every text with a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bytescan.sliced(batches, "text"):
            found = [profile(data, offsets) for _, data, offsets in bytescan.blocks(batch.column("text"))]
            code = np.concatenate([pattern(p.votes) for p in found])
            words = np.concatenate([np.diff(p.bounds) for p in found])
            out = pa.RecordBatch.from_arrays([batch.column("h"), pa.array(code)], names=["h", "pattern"])
            yield out.filter(pa.array(words > 0))

    return docs.select(F.xxhash64("text").alias("h"), "text").filter("text <> ''").mapInArrow(run, "h long, pattern long")


def fit(docs: DataFrame, sample: int = SAMPLE) -> Model | None:
    """Model from texts alone; None if no text has a word."""
    columns.need(docs, "text")
    voted = _votes(docs)
    # patterns and hash classes in one pass over the texts; stored, since both are then aggregated apart
    found = scratch.stored(
        voted.groupBy("pattern", F.pmod("h", F.lit(sample)).alias("c")).agg(F.count("*").alias("n"), F.min("h").alias("h")), "votes"
    )
    hashes = [(r["h"],) for r in found.groupBy("c").agg(F.min("h").alias("h")).collect()]
    if not hashes:
        return None
    counted = found.groupBy("pattern").agg(F.sum("n").alias("n")).orderBy("pattern").collect()
    belief = estimate(np.array([r["pattern"] for r in counted]), np.array([r["n"] for r in counted], float))

    chosen = docs.sparkSession.createDataFrame(hashes, "h long")  # ``sample`` rows at most
    texts = docs.select(F.xxhash64("text").alias("h"), "text").join(F.broadcast(chosen), "h").dropDuplicates(["h"])

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bytescan.sliced(batches, "text", bytescan.BLOCK // 2):
            for _, data, offsets in bytescan.blocks(batch.column("text")):
                p = profile(data, offsets)
                x = [v.tobytes() for v in shares(p)]
                yield pa.RecordBatch.from_arrays([pa.array(pattern(p.votes)), pa.array(x, pa.binary())], names=["pattern", "x"])

    rows = texts.mapInArrow(vectors, "pattern long, x binary").collect()
    x = np.stack([np.frombuffer(r["x"], np.float32) for r in rows])
    votes = np.array([r["pattern"] for r in rows])[:, None] // 3 ** np.arange(len(LABELLERS)) % 3
    return Model(belief, train(x, belief.good(votes)))


def score(docs: DataFrame, model: Model | None) -> tuple[DataFrame, dict[str, str]]:
    """Documents with score and weak_label (the posterior of their votes), and the names of these columns."""
    columns.need(docs, "text")
    names = {n: columns.free_name(docs, n) for n in ("score", "weak_label")}
    if model is None:
        return docs.withColumns({n: F.lit(0.0) for n in names.values()}), names
    shared, token = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = worker.held(token, lambda: shared.value)
        for batch in bytescan.sliced(batches, "text"):
            scores, weak = [], []
            for _, data, offsets in bytescan.blocks(batch.column("text")):
                p = profile(data, offsets)
                bucket, text = features(p)
                n = np.bincount(text, minlength=offsets.size - 1)
                total = np.bincount(text, weights=own.weights[bucket], minlength=offsets.size - 1)
                value = 1 / (1 + np.exp(-np.clip(total / np.maximum(n, 1) + own.weights[-1], -50, 50)))
                scores.append(np.where(n > 0, value, 0.0))
                weak.append(np.where(n > 0, own.belief.good(p.votes.T), 0.0))
            added = {names["score"]: pa.array(np.concatenate(scores)), names["weak_label"]: pa.array(np.concatenate(weak))}
            yield bytescan.with_columns(batch, **added)

    return docs.mapInArrow(run, ", ".join([*kept, *(f"`{n}` double" for n in names.values())])), names


def classify(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, score, weak_label, keep."""
    docs = docs.select("doc_id", "text")
    found, names = score(docs, fit(docs))
    return found.select("doc_id", names["score"], names["weak_label"], (F.col(names["score"]) >= KEEP).alias("keep"))


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that are kept, columns as they came."""
    found, names = score(docs, fit(docs))
    return found.filter(F.col(names["score"]) >= KEEP).select(*[F.col(f"`{c}`") for c in docs.columns])
