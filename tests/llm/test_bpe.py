import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from mortar.llm import bpe
from tests.llm.fixtures import documents, empty

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    with open(PATH, "rb") as f:
        return bpe.Encoder(f.read())


def ids(encoder, text):
    return np.frombuffer(encoder.encode(text), "<u4").tolist()


def test_random_texts(encoder, library):
    rng = random.Random(5)
    vocabulary = [t.replace("</w>", "") for t in library.get_vocab()]
    for _ in range(3000):
        parts = ["".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 5))), rng.choice("abcé!0日") * rng.randint(1, 50)]
        text = " ".join(rng.sample(parts, 2)) + rng.choice(["", "'s", "<|endoftext|>", "<|endof", "\x1c\x1d a", "ΣΑΣ", "֌"])
        want = library.encode(text, add_special_tokens=False).ids
        assert ids(encoder, text) == want
        assert encoder.decode(want) == library.decode(want, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(encoder, library, text):
    assert ids(encoder, text) == library.encode(text, add_special_tokens=False).ids


def test_every_prefix_has_a_compatible_last_token(encoder):
    for word in ("internationalisation", "aaaaaaaaaaaaaaa", "xyzzy"):
        coded = encoder._encode_word(word)
        assert all(encoder._compatible(a, b) for a, b in zip(coded, coded[1:]))


def test_small_caches_change_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "MOST_WORDS", 3)
    monkeypatch.setattr(bpe, "MOST_PAIRS", 3)
    monkeypatch.setattr(bpe, "MOST_STEPS", 3)
    monkeypatch.setattr(bpe, "LONG_WORD", 4)
    with open(PATH, "rb") as f:
        small = bpe.Encoder(f.read())
    for text in ("one two", "one two three four five, one two three four five six seven eight " * 3, "it's 'tis ''s 12 é's we'll'd 're"):
        assert ids(small, text) == library.encode(text, add_special_tokens=False).ids


def test_texts_encoded_together(encoder, library):
    texts = ["it'", "s", None, "", "a'l", "l 'r", "e<|endoftext|>'s", "<|endoftext|>", "12", "3\u0378x", "\x1c'd", "x" * 500 + " it's"] * 3
    flat, bounds = encoder.encode_many(texts)
    got = [flat[a:b].tolist() for a, b in zip(bounds, bounds[1:])]
    assert got == [library.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_digests_equal_the_library(spark, library):
    docs = documents(spark)
    want = []
    for r in docs.collect():
        coded = library.encode(r["text"] or "", add_special_tokens=False).ids
        text = library.decode(coded, skip_special_tokens=False)
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        want.append((r["doc_id"], len(coded), sha(" ".join(map(str, coded))), sha(text)))
    assert sorted(map(tuple, bpe.digests(docs, PATH).collect()), key=repr) == sorted(want, key=repr)


def test_separate_steps_and_empty_table(spark, library):
    docs = documents(spark, real=False)
    both = {(r["doc_id"], r["decoded"]) for r in bpe.decode(bpe.encode(docs, PATH), PATH).collect()}
    assert both == {(r["doc_id"], r["decoded"]) for r in bpe.round_trip(docs, PATH).collect()}
    assert bpe.digests(empty(spark), PATH).count() == 0
