"""Piece encoding against the library, on texts that break naive encoders."""

from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from seatplan.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    "", " ", "  ", "a", " a  b", "▁", "▁▁x", "\n\n\t x", "日本語テキスト🎉é\x00", " " * 40 + "x", "x" * 3000, "ab " * 10, "<s> </s> <unk> <0x0A>",
    "Ünïcödé wörds ßind hier — ö", "l'été, ça va?", "🏳️‍🌈 ​﻿", "1234567890" * 30, "....,,,;;;", "word." * 400,
]


@pytest.fixture(scope="module")
def model():
    return pieces.model(PATH, pieces.Settings())


def agrees(model, text):
    parts = list(model.encode(text)) if text else []
    ids = [i for p in parts for i in p]
    assert ids == model.library.encode(text), repr(text)
    assert "".join(model.decode(parts)) == model.library.decode(ids), repr(text)


@pytest.mark.parametrize("k", range(len(ODD)))
def test_odd_texts(model, k):
    agrees(model, ODD[k])


def test_runs_of_spaces_and_pieces(model):
    rng = random.Random(4)
    names = sorted(model.id_of)
    for n in range(60):
        agrees(model, " " * n + "end" + " " * n)
    for _ in range(1500):
        agrees(model, "".join(rng.choice(names) for _ in range(rng.randint(1, 10))))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abcdeorst   ▁\n.,éñß日本🎉0123THE-'", max_size=80))
def test_drawn_texts(text):
    agrees(pieces.model(PATH, pieces.Settings()), text)


def test_failed_places_step_back(model):
    # merging never joins these as the longest matches would
    tried = [a + b for a in ("in", "er", "he", "on", "re", "th", "ing") for b in ("ing", "ere", "hen", "ther", "one", "ent")]
    for a in tried:
        for b in tried:
            assert model.pieces(a + b) == model.merged(a + b)


def test_long_texts_in_parts():
    rng = random.Random(9)
    text = "".join(rng.choice(["the ", "cat's ", "  ", "日本 ", "🎉 ", "naïve ", "x" * 40, "\n"]) for _ in range(20_000))
    small = pieces.Model(PATH, pieces.Settings(part=1000, remember=50, unit=10))
    assert len(list(small.parts(small.library.normalize(text)))) > 20
    agrees(small, text)


def test_rows(spark):
    rows = [(1, "Hello  wörld 🎉"), (2, None), (3, ""), (1, "Hello  wörld 🎉"), (None, " x"), (4, "long " * 30_000)]
    frame = spark.createDataFrame([(k, t, 1, 2, "z") for k, t in rows], "doc_id long, text string, n_tokens int, ids int, _text string")
    library = pieces.model(PATH, pieces.Settings()).library

    def row(key, text):
        ids = library.encode(text or "")
        return key, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()

    assert sorted(map(str, map(tuple, pieces.digests(frame, PATH).collect()))) == sorted(str(row(k, t)) for k, t in rows)
    full = pieces.encode(frame, PATH).collect()
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["ids"], r["decoded"]) for r in full) == sorted((str(k), len(i := library.encode(t or "")), i, library.decode(i)) for k, t in rows)
    assert pieces.digests(frame.limit(0), PATH).collect() == []
