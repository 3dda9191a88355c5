"""Language by cross-parsing entropy.

Labelled text of each language is turned into a suffix automaton, which knows every substring of it.  A text is parsed
against each automaton into longest matches; the fewer phrases it takes, the closer it is to that language.  A phrase
costs about log2(n) bits against n bytes of labelled text, so the language with the least phrases * log2(n) a byte wins.

Fit: ``rows`` labelled documents a language at most (the least text hash of each of ``rows`` hash classes, so copies count
once), of each ``chars`` characters at a place chosen by the hash.  This sample, and so the automata that are broadcast,
is bounded by these two and ``MOST_LANGUAGES``; ``MOST_TABLE`` bytes bound the automata, else ``fit`` fails.

Parsing runs over all texts of a batch side by side, in blocks of ``BLOCK`` bytes that start a phrase anew.  Letters are
lower-cased, runs of ASCII characters that are no letters become one separator.

Defined results: ``und`` with score 0 for a null text, one without a letter, and all texts where no labelled text exists;
on a tie the first language in alphabetical order.  The score is the margin 1 - best / second (1 with one language alone).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mortar.llm import bytescan, columns, worker

ROWS, CHARS, BLOCK, MOST_TABLE, MOST_LANGUAGES = 128, 192, 1024, 256 << 20, 1000
UNDETERMINED = "und"
_LETTER = np.zeros(256, bool)
_LETTER[0x61:0x7B] = True
_LETTER[0x80:] = True


def _normal(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case bytes with every run of ASCII non-letters as one 0, and the offsets of the texts in them."""
    letter = _LETTER[data]
    keep = letter.copy()
    if keep.size:
        keep[1:] |= letter[:-1]
        heads = offsets[:-1][offsets[:-1] < data.size]
        keep[heads] = letter[heads]
    out = np.where(letter, data, 0)[keep]
    return out, np.concatenate([[0], np.cumsum(keep)])[offsets]


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the automaton that reads exactly the substrings of a sequence; state 0 is the start."""
    steps, link, length, last = [{}], [-1], [0], 0
    for s in symbols:
        new = len(steps)
        steps.append({})
        link.append(0)
        length.append(length[last] + 1)
        at = last
        while at >= 0 and s not in steps[at]:
            steps[at][s] = new
            at = link[at]
        if at >= 0:
            to = steps[at][s]
            if length[to] == length[at] + 1:
                link[new] = to
            else:  # the class splits: its shorter members get a state of their own
                copy = len(steps)
                steps.append(dict(steps[to]))
                link.append(link[to])
                length.append(length[at] + 1)
                link[to] = link[new] = copy
                while at >= 0 and steps[at].get(s) == to:
                    steps[at][s] = copy
                    at = link[at]
        last = new
    return steps


class Model:
    """Automata of all languages as one table: state * width + symbol -> next state * width * 4 + phrases that end."""

    def __init__(self, samples: dict[str, list[str]], most_table: int = MOST_TABLE):
        self.languages = sorted(samples)
        texts = {}
        for name in self.languages:
            joined = pc.utf8_lower(pa.scalar(" ".join(sorted(samples[name])))).as_py().encode()
            data = np.frombuffer(joined, np.uint8)
            texts[name] = _normal(data, np.array([0, data.size]))[0]
        seen = np.unique(np.concatenate([*texts.values(), np.zeros(1, np.uint8)]))
        self.symbol = np.full(256, seen.size, np.int32)  # the last symbol stands for bytes never seen
        self.symbol[seen] = np.arange(seen.size)
        self.width = seen.size + 1
        parts, self.starts, self.bits, states = [], [], [], 0
        for name in self.languages:
            steps = suffix_automaton(self.symbol[texts[name]].tolist())
            if (states + len(steps)) * self.width * 4 > most_table:
                raise ValueError("labelled sample too large: lower rows or chars")
            root = np.full(self.width, states * self.width * 4 + 2, np.int64)  # unseen: ends a phrase and is one
            for s, to in steps[0].items():
                root[s] = (states + to) * self.width * 4 + 1
            table = np.tile(root, (len(steps), 1))
            table[0] = np.where(root % 4 == 2, root - 1, root - 1)  # no phrase is open at the start
            for state, own in enumerate(steps[1:], 1):
                for s, to in own.items():
                    table[state, s] = (states + to) * self.width * 4
            parts.append(table.astype(np.int32))
            self.starts.append(states * self.width)
            self.bits.append(np.log2(max(2, texts[name].size)))
            states += len(steps)
        self.table = np.concatenate(parts).ravel()
        self.starts, self.bits = np.array(self.starts, np.int32), np.array(self.bits)

    def costs(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Bits a byte of every text (columns) under every language (rows)."""
        data, offsets = _normal(data, offsets)
        sizes = np.diff(offsets)
        blocks = -(-sizes // BLOCK)
        owner = np.repeat(np.arange(sizes.size), blocks)
        nth = np.arange(owner.size) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        first = offsets[:-1][owner] + nth * BLOCK
        length = np.minimum(BLOCK, offsets[1:][owner] - first)
        order = np.argsort(-length, kind="stable")
        owner, first, length = owner[order], first[order], length[order]
        count = np.zeros((len(self.languages), owner.size), np.int32)
        state = np.repeat(self.starts[:, None], owner.size, axis=1)
        symbols = self.symbol[data]
        live = np.searchsorted(-length, -np.arange(1, int(length.max(initial=0)) + 1), side="right")
        for k, n in enumerate(live.tolist()):
            step = self.table[state[:, :n] + symbols[first[:n] + k]]
            count[:, :n] += step & 3
            state[:, :n] = step >> 2
        count += state != self.starts[:, None]  # the phrase left open
        total = np.zeros((len(self.languages), sizes.size))
        for i in range(len(self.languages)):
            total[i] = np.bincount(owner, weights=count[i], minlength=sizes.size)
        return total * self.bits[:, None] / np.maximum(sizes, 1)

    def predict(self, data: np.ndarray, offsets: np.ndarray) -> tuple[list[str], np.ndarray]:
        costs = self.costs(data, offsets)
        best = np.argmin(costs, axis=0)
        if len(self.languages) == 1:
            return [self.languages[0]] * best.size, np.ones(best.size)
        two = np.sort(costs, axis=0)[:2]
        return [self.languages[i] for i in best], np.clip(1 - two[0] / np.maximum(two[1], 1e-12), 0, 1)


def held_out(doc_id: Column) -> Column:
    """Documents that the fit does not see: crc32 of the id's digits leaves 2 modulo 4 (a null id is not held out)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(labelled: DataFrame, rows: int = ROWS, chars: int = CHARS) -> Model | None:
    """Model from (text, lang); None if there is no labelled text with a letter."""
    columns.need(labelled, "text", "lang")
    usable = labelled.filter(F.col("lang").isNotNull() & F.col("text").rlike("\\p{L}"))
    if labelled.filter("lang IS NOT NULL").select("lang").distinct().limit(MOST_LANGUAGES + 1).count() > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    hashed = usable.select("lang", "text", F.xxhash64("text").alias("h"))
    least = hashed.groupBy("lang", F.pmod("h", F.lit(rows)).alias("c")).agg(F.min("h").alias("h")).drop("c")
    taken = hashed.join(F.broadcast(least), ["lang", "h"])
    place = F.pmod(F.xxhash64("h"), F.greatest(F.length("text") - chars, F.lit(0)) + 1).cast("int") + 1
    pieces = taken.select("lang", "h", F.substring("text", place, F.lit(chars)).alias("piece"))
    samples: dict[str, list[str]] = {}
    for r in pieces.groupBy("lang", "h").agg(F.min("piece").alias("piece")).collect():
        samples.setdefault(r["lang"], []).append(r["piece"])
    return Model(samples) if samples else None


def predict(docs: DataFrame, model: Model | None, lang: str = "lang_pred", score: str = "score") -> DataFrame:
    """Add the language and score of every whole text; columns of these names are replaced."""
    columns.need(docs, "text")
    if model is None:
        return docs.withColumns({lang: F.lit(UNDETERMINED), score: F.lit(0.0)})
    shared, token = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex
    flag = columns.free_name(docs, "has_letter")
    docs = docs.withColumn(flag, F.coalesce(F.col("text").rlike("\\p{L}"), F.lit(False)))
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name not in (lang, score)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = worker.held(token, lambda: shared.value)
        for batch in bytescan.sliced(batches, "text"):
            named, scores = [], []
            for _, data, offsets in bytescan.blocks(pc.utf8_lower(batch.column("text"))):
                found, value = own.predict(data, offsets)
                named += found
                scores.append(value)
            letters = batch.column(flag).to_pylist()
            named = [n if ok else UNDETERMINED for n, ok in zip(named, letters)]
            value = np.where(letters, np.concatenate(scores), 0.0)
            yield bytescan.with_columns(batch, **{lang: pa.array(named, pa.string()), score: pa.array(value)})

    return docs.mapInArrow(run, ", ".join([*kept, f"`{lang}` string", f"`{score}` double"])).drop(flag)


def identify(docs: DataFrame) -> DataFrame:
    """Fit on the documents that are not held out; per document: doc_id, held_out, lang_pred, score."""
    model = fit(docs.filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).select("text", "lang"))
    found = predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
