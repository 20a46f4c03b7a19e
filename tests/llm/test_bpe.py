"""Segment-tree BPE against the tokenizers library."""

import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from test_tokens import HARD, LIBRARY, ROWS, VOCABULARY, frame, library

from wireloom.llm import bpe

CODEC = bpe.Codec(VOCABULARY)


@pytest.mark.parametrize("text", [*HARD, "word" * 40, "".join(random.Random(1).choices("etaoin", k=3000)), "é" * 500])
def test_hard_texts(text):
    ids = library(text)
    assert CODEC.encode(text) == ids
    assert CODEC.decode(ids) == LIBRARY.decode(ids, skip_special_tokens=False)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("aBetion'.,<|> \n\t\x1cİΣ́ ²e"), st.characters(exclude_categories=["Cs", "Cn"])), max_size=90))
def test_any_text(text):
    assert CODEC.encode(text) == library(text)


def test_rows_and_single_words_agree():
    rng = random.Random(3)
    pieces = ["".join(rng.choices("thionaer", k=rng.randint(1, 64))).encode() for _ in range(500)]
    CODEC.merge(pieces)
    for piece in pieces:
        symbols = [*(int(CODEC.inner[b]) for b in piece[:-1]), int(CODEC.last[piece[-1]])]
        assert CODEC.pieces[piece] == bpe.merge_one(symbols, CODEC.merges)


def test_parts_and_small_caches(monkeypatch):
    monkeypatch.setattr("wireloom.llm.tokens.PART_BYTES", 64)
    monkeypatch.setattr(bpe, "parts", lambda text: __import__("wireloom.llm.tokens", fromlist=["parts"]).parts(text, 64))
    texts = [" ".join(f"Word{i % 37}," for i in range(500)), "", "  ", "x", "end <|endoftext|>"]
    got = list(bpe.text_digests((t.encode() for t in texts), bpe.Codec(VOCABULARY, most=10), together=200))
    assert got == [digest(t) for t in texts]


def digest(text):
    ids = library(text or "")
    decoded = LIBRARY.decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


def test_table(spark):
    got = sorted(map(tuple, bpe.bpe_digests(frame(spark, ROWS)).collect()), key=repr)
    assert got == sorted(((i, *digest(t)) for i, t in ROWS), key=repr)
    assert bpe.bpe_digests(frame(spark, [])).collect() == []
