"""Operator 11 against the sentencepiece library."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from plain import HARD_ROWS
from sentencepiece import SentencePieceProcessor

from adspend.llm import op11_sentencepiece as op11
from adspend.llm import registry

MODEL = public_tokenizers.path("piece_bpe_32k.model")
SMALL = "/root/testdata/sf0.001"
TEXTS = st.text(st.one_of(st.sampled_from("aeiou thsnrdlTHE'\n\t  ▁.,!01$%ñéß日"), st.characters(codec="utf-8")), max_size=80)


@pytest.fixture(scope="module")
def coders():
    return op11.Pieces(MODEL), SentencePieceProcessor(model_file=MODEL)


def same(coders, texts):
    mine, library = coders
    flat, ends = mine.encode(texts)
    for text, ids in zip(texts, np.split(flat, ends[:-1])):
        want = library.encode(text or "")
        assert ids.tolist() == want
        assert mine.decode(ids) == library.decode(want)


@settings(max_examples=300, deadline=None)
@given(st.lists(TEXTS, max_size=4))
def test_pieces_equal_the_library(coders, texts):
    same(coders, texts)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 31_999) | st.integers(0, 400), max_size=8))
def test_any_ids_decode_as_in_the_library(coders, ids):
    assert coders[0].decode(np.array(ids, np.int64)) == coders[1].decode(ids)


def test_rounds_over_long_words_are_the_same(coders, monkeypatch):
    rng = random.Random(1)
    monkeypatch.setattr(op11, "LONG", 2)
    coders[0].forget()
    for letters in ("aeiou thsnrdl", "the io nab", "ab", "é日a"):
        same(coders, ["".join(rng.choices(letters, k=rng.randrange(300))) for _ in range(40)])
    monkeypatch.undo()
    coders[0].forget()
    same(coders, ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=200_000)), "ab" * 50_000, " " * 100_001, "x" * 99_999, "日" * 20_000, None, ""])


def test_two_million_letters_take_little_memory(coders):
    import tracemalloc

    word = "".join(random.Random(2).choices("abcdefghijklmnopqrstuvwxyz", k=2_000_000))
    tracemalloc.start()
    ids, _ = coders[0].encode([word])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    coders[0].forget()
    assert peak < 800 << 20
    assert coders[0].decode(ids) == word


def digests(text, library):
    ids = library.encode(text or "")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))


def test_pieces_query(spark, small_rows, coders, hard, empty):
    got = {r.doc_id: tuple(r)[1:] for r in registry.QUERIES["op11_sentencepiece"](spark, SMALL).collect()}
    assert got == {i: digests(t, coders[1]) for i, t in small_rows}
    rows = sorted((tuple(r) for r in op11.round_trip(hard, MODEL).collect()), key=str)
    assert rows == sorted(((r[0], *digests(r[1], coders[1])) for r in HARD_ROWS), key=str)
    assert op11.round_trip(empty, MODEL).count() == 0


def test_pieces_round_trip_of_the_operator(hard, empty, coders):
    encoded = op11.encode(hard, MODEL)
    got = sorted(((r.doc_id, r.text) for r in op11.decode(encoded, MODEL).collect()), key=str)
    assert got == sorted(((r[0], coders[1].decode(coders[1].encode(r[1] or ""))) for r in HARD_ROWS), key=str)
    assert op11.encode(empty, MODEL).count() == 0
