"""BPE encoding by dynamic programming over prefixes, and decoding.

The encoding of a word is unique, and so is its last token.  For every prefix of a word the operator stores that last
token: an automaton of the vocabulary with suffix links gives the tokens that end there, longest first, and the first
one that is compatible with the last token of what stands before it is the one.  Following these back-pointers from the
word's end gives the exact ids in time linear in the word.  Two tokens are compatible if the merge rules, run on their
joint symbols, never merge across the border; this follows from the merge ranks along the facing edges of their merge trees.

Texts are cut into words, and words are looked up by a 64-bit hash, for a batch of texts at a time; the words that a worker
does not know are encoded side by side, one prefix length after the other.

The vocabulary is a JSON file of the tokenizers library (BPE with byte-level symbols and an end-of-word suffix); its path
is a parameter, and its bytes, whose size is that of the file, are broadcast.

Defined results: a null or empty text has no ids; strings of special tokens in a text give their ids, as in the library;
truncation and padding settings are not applied.
"""

from __future__ import annotations

import json
import re
import unicodedata
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mortar.llm import bytescan, columns, worker

# fixed values: the pattern of words in the vocabulary file, its contractions, and Unicode white space
PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")
SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
#: Most words and token pairs remembered by a worker; what is forgotten is computed again.
MOST_WORDS, MOST_PAIRS, MOST_STEPS = 400_000, 1 << 20, 200_000
#: Words of more bytes are encoded one by one, all others side by side.
LONG_WORD = 64
_END, _SYMBOLS = 256, 512


class _State(dict):
    """State of the automaton: symbol -> next state.

    ``link`` is the state of the longest proper suffix, ``tokens`` the vocabulary's tokens that end here, longest first,
    each with its length and what is known of the tokens it can follow.  A step that the vocabulary does not have goes
    along the links; what it finds is remembered, up to ``MOST_STEPS`` of all states.
    """

    __slots__ = ("link", "tokens")
    remembered = 0

    def __init__(self, link: _State | None):
        super().__init__()
        self.link, self.tokens = link, ()

    def grow(self, symbol: int) -> _State:
        self[symbol] = new = _State(None)
        return new

    def after(self, symbol: int) -> _State:
        """Next state by the vocabulary's own steps, without remembering; the start where there is none."""
        state = self
        while True:
            found = state.get(symbol)
            if found is not None:
                return found
            if state.link is None:
                return state
            state = state.link

    def __missing__(self, symbol: int) -> _State:
        found = self.after(symbol)
        if _State.remembered < MOST_STEPS:
            _State.remembered += 1
            self[symbol] = found
        return found


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """Kind of every code point: 0 white space, 1 letter, 2 number, 3 other."""
    first = "".join(unicodedata.category(chr(c))[0] for c in range(0x110000))
    kinds = np.full(0x110000, 3, np.uint8)
    letters = np.frombuffer(first.encode(), np.uint8)
    kinds[letters == ord("L")], kinds[letters == ord("N")] = 1, 2
    kinds[[ord(c) for c in SPACE]] = 0
    return kinds


def word_bounds(points: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of texts given as code points: runs of letters, single numbers, runs of others.

    An apostrophe on its own takes the letters of a contraction with it.
    """
    kinds = _kinds()[points]
    edge = np.zeros(points.size + 1, bool)
    edge[offsets] = True
    begins = edge[:-1] | (kinds == 2)
    begins[1:] |= kinds[1:] != kinds[:-1]
    quotes = np.flatnonzero((points[:-1] == ord("'")) & begins[:-1] & (kinds[1:] == 1) & ~edge[1:-1])
    if quotes.size:
        padded = np.append(points, [0, 0, 0])
        for short in CONTRACTIONS:
            here = quotes[padded[quotes + 1] == ord(short[0])]
            if len(short) == 2:
                here = here[(padded[here + 2] == ord(short[1])) & ~edge[here + 2]]
            begins[here + 1] = False
            after = here + 1 + len(short)
            after = after[after < points.size]
            begins[after] = True  # what is left of the letters; a break of any other kind stood there anyway
    breaks = np.flatnonzero(begins)
    ends = np.append(breaks[1:], points.size)
    words = kinds[breaks] != 0
    return breaks[words], ends[words]


class _Table:
    """Fixed-size hash table of 64-bit keys and small values, used for many keys at once (linear probing)."""

    def __init__(self, entries: int):
        bits = max(4, (2 * entries).bit_length())
        self.shift, self.mask, self.room = np.uint64(64 - bits), (1 << bits) - 1, entries
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int32)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Enter distinct keys that are not there yet, as long as there is room."""
        keys, values = keys[: self.room], values[: self.room]
        self.room -= len(keys)
        at = self._home(keys)
        while keys.size:
            free = self.keys[at] == -1
            self.keys[at[free]] = keys[free]  # of those that meet in a slot one stays
            here = self.keys[at] == keys
            self.values[at[here]] = values[here]
            keys, values, at = keys[~here], values[~here], (at[~here] + 1) & self.mask

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Values of the keys; -1 for those that are not there."""
        at = self._home(keys)
        seen = self.keys[at]
        out = np.where(seen == keys, self.values[at], -1)
        open_ = np.flatnonzero((seen != keys) & (seen != -1))
        while open_.size:
            at[open_] = (at[open_] + 1) & self.mask
            seen = self.keys[at[open_]]
            same = seen == keys[open_]
            out[open_[same]] = self.values[at[open_[same]]]
            open_ = open_[~same & (seen != -1)]
        return out


class Encoder:
    """Encoder and decoder of one vocabulary file, given as bytes."""

    def __init__(self, content: bytes):
        spec = json.loads(content)
        self._content, self._library = content, None
        model = spec["model"]
        steps = [n["type"] for n in spec["normalizer"]["normalizers"]]
        split, level = spec["pre_tokenizer"]["pretokenizers"]
        suffix = model["end_of_word_suffix"]
        if (
            steps != ["NFC", "Replace", "Lowercase"] or split["type"] != "Split" or level["type"] != "ByteLevel"
            or not split["invert"] or level["use_regex"] or level["add_prefix_space"] or not suffix
            or model["continuing_subword_prefix"] or spec["post_processor"] or spec["decoder"] or split["pattern"]["Regex"] != PATTERN
        ):
            raise ValueError("unsupported kind of vocabulary file")
        self._special_ids = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self._special = re.compile("|".join(map(re.escape, sorted(self._special_ids, key=len, reverse=True))) or "(?!)")
        self.strings = {i: t for t, i in model["vocab"].items()} | {i: t for t, i in self._special_ids.items()}

        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in set(printable)]
        self._byte_of = {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}

        self._symbols = {t: self._to_symbols(t, suffix) for t in model["vocab"]}
        self._rank: dict[tuple[int, int], int] = {}
        self._left: dict[int, int] = {}
        self._right: dict[int, int] = {}
        self._made: dict[int, int] = {}
        ids = model["vocab"]
        for rank, (a, b) in enumerate(model["merges"]):
            a, b, t = ids[a], ids[b], ids[a + b]
            self._rank[a, b] = rank
            if t not in self._made:
                self._made[t], self._left[t], self._right[t] = rank, a, b
        self._build_automaton()
        self._build_tables()
        self._pairs = 0
        self._forget()

    def _forget(self) -> None:
        """Begin with no words remembered: hash of a word -> its number; number -> place and count of its ids."""
        self._known = _Table(MOST_WORDS)
        self._ids, self._at, self._count = np.zeros(0, "<u4"), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _to_symbols(self, token: str, suffix: str) -> tuple[int, ...]:
        """A token as symbols: bytes, the last one of a word raised by 256."""
        ends = token.endswith(suffix) and len(token) > len(suffix)
        body = [self._byte_of[c] for c in (token[: -len(suffix)] if ends else token)]
        if ends:
            body[-1] += _END
        return tuple(body)

    def _build_automaton(self) -> None:
        _State.remembered = 0
        vocab = {t: i for i, t in self.strings.items() if t in self._symbols}
        root = _State(None)
        token_at: dict[int, tuple[int, int]] = {}
        for token, symbols in self._symbols.items():
            state = root
            for s in symbols:
                following = state.get(s)
                state = state.grow(s) if following is None else following
            token_at[id(state)] = vocab[token], len(symbols)
        self._length = [0] * (max(self.strings) + 1)
        known: dict[int, tuple[int, int, dict[int, bool]]] = {}
        queue = []
        for child in root.values():
            child.link = root
            queue.append(child)
        for state in queue:  # breadth first: suffix links of shallower states are known
            shorter = state.link.tokens
            if id(state) in token_at:
                token, length = token_at[id(state)]
                self._length[token] = length
                shorter = ((token, length, known.setdefault(token, (token, length, {}))[2]), *shorter)
            state.tokens = shorter
            for s, child in list(state.items()):
                child.link = state.link.after(s)
                queue.append(child)
        self._root = root

    def _build_tables(self) -> None:
        """The automaton as arrays, for many words side by side: states are numbered breadth first from the start, 0."""
        states, number, edges = [self._root], {id(self._root): 0}, []
        for state in states:
            for symbol, child in state.items():
                if child.link is not None and id(child) not in number:
                    number[id(child)] = len(states)
                    states.append(child)
                    edges.append((number[id(state)] * _SYMBOLS + symbol, number[id(child)]))
        keys, values = np.array(edges, np.int64).reshape(-1, 2).T
        self._steps = _Table(len(edges))
        self._steps.add(keys, values)
        self._link = np.array([0 if s.link is None else number[id(s.link)] for s in states])
        own = np.array([bool(s.tokens) and (s.link is None or len(s.tokens) > len(s.link.tokens)) for s in states])
        self._token_of = np.array([s.tokens[0][0] if s.tokens else 0 for s in states], np.int64)
        #: The state itself or the nearest one along its links at which a token of its own ends; 0: none.
        self._hit = np.zeros(len(states), np.int64)
        for k in range(1, len(states)):  # links lead to lower numbers
            self._hit[k] = k if own[k] else self._hit[self._link[k]]
        self._lengths = np.array(self._length, np.int64)
        self._fits = _Table(MOST_PAIRS)

    def _fitting(self, left: np.ndarray, token: np.ndarray) -> np.ndarray:
        """Whether each token can follow the one on its left."""
        keys = left << 32 | token
        found = self._fits.find(keys)
        new = np.unique(keys[found < 0])
        if new.size:
            known = np.array([self._compatible(k >> 32, k & 0xFFFFFFFF) for k in new.tolist()], np.int32)
            self._fits.add(new, known)
            unknown = np.flatnonzero(found < 0)
            found[unknown] = known[np.searchsorted(new, keys[unknown])]
        return found > 0

    def _encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words one after the other and their counts, all prefixes of a length side by side; as ``_encode_word``."""
        sizes = np.array([len(w) for w in words])
        order = np.argsort(-sizes, kind="stable")
        size = sizes[order]
        start = (np.cumsum(sizes) - sizes)[order]
        symbols = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        symbols[np.cumsum(sizes) - 1] += _END
        longest = int(size[0])
        live = np.searchsorted(-size, -np.arange(longest), side="left")  # words of more than i symbols come first
        state = np.zeros(size.size, np.int64)
        last = np.zeros((longest, size.size), np.int64)
        for i, n in enumerate(live.tolist()):
            symbol, at = symbols[start[:n] + i], state[:n]
            found = self._steps.find(at * _SYMBOLS + symbol)
            lost = np.flatnonzero(found < 0)
            while lost.size:
                top = at[lost] == 0
                found[lost[top]] = 0
                lost = lost[~top]
                at[lost] = self._link[at[lost]]
                found[lost] = self._steps.find(at[lost] * _SYMBOLS + symbol[lost])
                lost = lost[found[lost] < 0]
            state[:n] = found
            place, place_state = np.arange(n), self._hit[found]
            while place.size:
                token = self._token_of[place_state]
                last[i, place] = token
                before = i - self._lengths[token]
                inner = np.flatnonzero(before >= 0)
                fits = self._fitting(last[before[inner], place[inner]], token[inner])
                again = inner[~fits]
                shorter = self._hit[self._link[place_state[again]]]
                place, place_state = place[again][shorter > 0], shorter[shorter > 0]
        place, at, steps = np.arange(size.size), size - 1, []
        while place.size:
            token = last[at, place]
            steps.append((place, token))
            at = at - self._lengths[token]
            place, at = place[at >= 0], at[at >= 0]
        counts = np.zeros(size.size, np.int64)
        for place, _ in steps:
            counts[place] += 1
        own = np.empty(size.size, np.int64)
        own[order] = counts
        ends = np.cumsum(own)[order]
        ids = np.empty(int(counts.sum()), "<u4")
        for k, (place, token) in enumerate(steps):
            ids[ends[place] - 1 - k] = token
        return ids, own

    def _compatible(self, a: int, b: int) -> bool:
        """Whether the merge rules leave token a followed by token b as they are.

        While merges run in the order of their ranks, the piece left of the border climbs the right edge of a's merge
        tree, and the piece right of it climbs the left edge of b's.  Two facing pieces are there together from the
        later of their own merges to the earlier of their parents'.  A rule for them fires across the border if its
        rank falls before both parents' merges; at an equal rank the leftmost pair is merged first.
        """
        made, rank = self._made, self._rank
        never = len(rank)
        left, parent = [], never
        while True:
            left.append((a, parent))
            if a not in self._right:
                break
            parent, a = made[a], self._right[a]
        right, parent = [], never
        while True:
            right.append((b, parent))
            if b not in self._left:
                break
            parent, b = made[b], self._left[b]
        for x, x_parent in left:
            for y, y_parent in right:
                r = rank.get((x, y))
                if r is not None and r < x_parent and r <= y_parent:
                    return False
        return True

    def _encode_word(self, word: str) -> list[int]:
        symbols = list(word.encode())
        symbols[-1] += _END
        last: list[int] = []
        state, i = self._root, 0
        for s in symbols:
            state = state[s]
            for token, length, known in state.tokens:
                before = i - length
                if before < 0:
                    break
                left = last[before]
                try:
                    fits = known[left]
                except KeyError:
                    fits = self._compatible(left, token)
                    if self._pairs < MOST_PAIRS:
                        self._pairs += 1
                        known[left] = fits
                if fits:
                    break
            last.append(token)
            i += 1
        length = self._length
        out, i = [], i - 1
        while i >= 0:
            token = last[i]
            out.append(token)
            i -= length[token]
        out.reverse()
        return out

    def _coded(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words, one after the other, and their counts."""
        packed = [w.encode() for w in words]
        if not packed or max(map(len, packed)) <= LONG_WORD:
            return self._encode_words(packed) if packed else (np.zeros(0, "<u4"), np.zeros(0, np.int64))
        short = [w for w in packed if len(w) <= LONG_WORD]
        ids, counts = self._encode_words(short) if short else (np.zeros(0, "<u4"), np.zeros(0, np.int64))
        cut = iter(np.split(ids, np.cumsum(counts)[:-1]) if short else [])
        parts = [next(cut) if len(b) <= LONG_WORD else np.array(self._encode_word(w), "<u4") for w, b in zip(words, packed)]
        return np.concatenate(parts), np.array([p.size for p in parts])

    def _numbers(self, text: str, hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Numbers of the words of a text; new ones are encoded together and remembered."""
        found = self._known.find(hashes)
        if (found >= 0).all():
            return found
        new, first = np.unique(hashes[found < 0], return_index=True)
        if new.size > self._known.room and self._known.room < MOST_WORDS:
            self._forget()
            return self._numbers(text, hashes, starts, ends)
        if new.size > self._known.room:  # more different words than are remembered
            self._known = _Table(new.size)
        first = np.flatnonzero(found < 0)[first]
        ids, counts = self._coded([text[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist())])
        self._known.add(new, np.arange(new.size, dtype=np.int32) + self._at.size)
        self._at = np.concatenate([self._at, self._ids.size + np.cumsum(counts) - counts])
        self._ids, self._count = np.concatenate([self._ids, ids]), np.concatenate([self._count, counts])
        return self._known.find(hashes)

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a text."""
        return self.encode_many([text])[0]

    def encode_many(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, as unsigned 32-bit integers, and how many are before each and the end."""
        odd: dict[int, np.ndarray] = {}
        plain = []
        for i, text in enumerate(texts):
            text = text or ""
            if "<" in text and self._special.search(text):
                odd[i] = self._with_special(text)
                text = ""
            elif not text.isascii():
                if "Cn" in map(unicodedata.category, set(text)):
                    odd[i] = self._coded(self._split_by_library(text))[0]
                    text = ""
                else:
                    # str.lower() has a special rule for a sigma at a word's end, which the library has not
                    text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
            plain.append(text.lower())
        joined = "".join(plain)
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in plain])]).astype(np.int64)
        ascii_ = joined.isascii()
        points = np.frombuffer(joined.encode("ascii" if ascii_ else "utf-32-le"), np.uint8 if ascii_ else "<u4")
        if not points.size:
            ids, bounds = np.zeros(0, "<u4"), np.zeros(len(texts) + 1, np.int64)
        else:
            starts, ends = word_bounds(points, offsets)
            hashes = bytescan.range_hashes(bytescan.mix(points.astype(np.uint64)), starts, ends).view(np.int64)
            word = self._numbers(joined, hashes, starts, ends)
            counts = self._count[word]
            before = np.concatenate([[0], np.cumsum(counts)])
            ids = self._ids[np.repeat(self._at[word] - before[:-1], counts) + np.arange(before[-1])]
            bounds = before[np.searchsorted(starts, offsets)]
        if odd:
            parts = np.split(ids, bounds[1:-1])
            parts = [odd.get(i, part) for i, part in enumerate(parts)]
            ids, bounds = np.concatenate(parts), np.concatenate([[0], np.cumsum([p.size for p in parts])])
        return ids, bounds

    def _with_special(self, text: str) -> np.ndarray:
        """Ids of a text that holds strings of special tokens."""
        marks = list(self._special.finditer(text))
        cuts = [0, *(x for m in marks for x in m.span()), len(text)]
        ids, bounds = self.encode_many([text[a:b] for a, b in zip(cuts[::2], cuts[1::2])])
        return np.insert(ids, bounds[1:-1], [self._special_ids[m[0]] for m in marks])

    def _split_by_library(self, text: str) -> list[str]:
        """Words of a text with characters younger than Python's tables: the library knows which are letters."""
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_str(self._content.decode())
        cut = self._library.pre_tokenizer.pre_tokenize_str(self._library.normalizer.normalize_str(text))
        return [bytes(self._byte_of[c] for c in word).decode() for word, _ in cut]

    def decode(self, ids) -> str:
        """Token strings joined by blanks: the library's decoding where a vocabulary file names no decoder."""
        return " ".join([self.strings[i] for i in ids if i in self.strings])


def worker_encoder(token: str, shared) -> Encoder:
    """The encoder of a broadcast vocabulary, built once per worker."""
    return worker.held(token, lambda: Encoder(shared.value))


def share_vocabulary(spark: SparkSession, path: str):
    """(token, broadcast) of a vocabulary file; its size is that of the file."""
    with open(path, "rb") as f:
        return uuid.uuid4().hex, spark.sparkContext.broadcast(f.read())


def _mapped(df: DataFrame, path: str, column: str, added: dict[str, tuple[str, object]]) -> DataFrame:
    """Rows in small batches with columns added; ``added``: name -> (type, function of encoder and the input column)."""
    token, shared = share_vocabulary(df.sparkSession, path)
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name not in added]
    schema = ", ".join([*kept, *(f"`{n}` {kind}" for n, (kind, _) in added.items())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(token, shared)
        for batch in bytescan.sliced(batches, column) if column == "text" else _few(batches):
            made: dict[str, pa.Array] = {}
            for name, (_, make) in added.items():
                made[name] = make(encoder, batch.column(column), made)
            yield bytescan.with_columns(batch, **made)

    return df.mapInArrow(run, schema)


def _few(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _encoded(encoder: Encoder, text: pa.Array, _) -> pa.Array:
    ids, bounds = encoder.encode_many(text.to_pylist())
    return pa.ListArray.from_arrays(bounds.astype(np.int32), pa.array(ids.view(np.int32)))


def _decoded(encoder: Encoder, ids: pa.Array, _=None) -> pa.Array:
    strings = encoder.strings.get
    rows = (None if not x.is_valid else x.values.to_numpy(zero_copy_only=False).tolist() for x in ids)
    return pa.array([None if x is None else " ".join([t for t in map(strings, x) if t is not None]) for x in rows], pa.string())


def encode(docs: DataFrame, path: str, column: str = "ids") -> DataFrame:
    """Add the ids of every whole text; a column of that name is replaced."""
    columns.need(docs, "text")
    return _mapped(docs, path, "text", {column: ("array<int>", _encoded)})


def decode(coded: DataFrame, path: str, ids: str = "ids", column: str = "decoded") -> DataFrame:
    """Add the text decoded from a column of ids."""
    columns.need(coded, ids)
    return _mapped(coded, path, ids, {column: ("string", _decoded)})


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """Add ``ids`` and the text ``decoded`` from them in one pass."""
    columns.need(docs, "text")
    return _mapped(
        docs, path, "text", {"ids": ("array<int>", _encoded), "decoded": ("string", lambda e, _, made: _decoded(e, made["ids"]))}
    )


def digest_columns() -> list:
    """SHA-256 of the decimal ids joined by a blank and of the decoded text, from columns ids and decoded."""
    joined = F.array_join(F.col("ids").cast("array<string>"), " ")
    return [
        F.sha2(joined.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    ]


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Per document: doc_id, n_tokens, and digests of its ids and of the text decoded from them."""
    coded = round_trip(docs.select("doc_id", "text"), path)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), *digest_columns())
