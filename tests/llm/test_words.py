"""Word hashes, shingles and token ids against plain Python and the tokenizers library."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from awkward_tables import words_of
from scrubline.llm import textscan
from scrubline.llm.tokenizing import units

PATTERNS = ((textscan.SPACES, r"[^\x20\x09-\x0D]+"), (textscan.SIGNS, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"))


@pytest.mark.parametrize("separator, pattern", PATTERNS)
def test_words_are_told_apart(separator, pattern):
    rng = random.Random(1)
    texts = [None, "", "a", "A b c", "ab " * 700_000, "q" * 2_500_000]
    texts += ["".join(rng.choice("aAbB  \n\t.,é中9-") for _ in range(rng.randint(0, 200))) for _ in range(800)]
    got, known = [], {}
    for _, _, hashes, counts in textscan.words(pa.array(texts), separator):
        got += np.split(hashes, np.cumsum(counts)[:-1])
    assert len(got) == len(texts)
    for text, hashes in zip(texts, got):
        expected = words_of(text, pattern)
        assert len(expected) == len(hashes)
        for word, hashed in zip(expected, hashes):
            assert known.setdefault(word, hashed) == hashed
    assert len(set(map(int, known.values()))) == len(known)


def test_shingles():
    texts = ["a b c d e f", "A B C D E", "a b", "a b c", "", "b a"]
    (_, _, hashes, counts), = textscan.words(pa.array(texts), textscan.SPACES)
    value, per_text = textscan.shingles(hashes, counts)
    assert per_text.tolist() == [2, 1, 1, 1, 0, 1]
    assert value[0] == value[2]
    assert len(set(value.tolist())) == 5


ODD = ["a", "B", "é", "É", " ", "  ", "\n", "\t", ".", ",", "'s", "'", "<|endoftext|>", "<|startoftext|>", "1", "２", "中"]
ODD += ["́", "\x1c", "\x85", " ", "﻿", "ß", "İ", "Σ", "​", "\U0001f600", "ﬁ", "`", "|", "**", "\xa0", "×"]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_are_the_librarys(name, documents):
    path = public_tokenizers.path(name)
    table, library = units(path), Tokenizer.from_file(path)

    def check(text):
        assert np.frombuffer(table.ids(text), "<u2").tolist() == library.encode(text, add_special_tokens=False).ids

    @settings(max_examples=400, deadline=None)
    @given(st.lists(st.sampled_from(ODD), max_size=30).map("".join) | st.text(max_size=40))
    def odd(text):
        check(text)

    odd()
    for row in documents[:60]:
        check(row.text or "")


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_of_a_batch_are_those_of_its_texts(name, documents):
    path = public_tokenizers.path(name)
    table, library = units(path), Tokenizer.from_file(path)
    rng = random.Random(3)
    batch = ["", " ", "a", " a  b\n", *("".join(rng.choice(ODD) for _ in range(rng.randint(0, 25))) for _ in range(400)), *((r.text or "") for r in documents[:80])]
    got = table.ids_of(pa.array(["skipped", *batch]).slice(1))
    for text, ids in zip(batch, got):
        assert np.frombuffer(ids, "<u2").tolist() == library.encode(text, add_special_tokens=False).ids
    assert table.ids_of(pa.array([], pa.string())) == []


def test_bounded_table_gives_the_same(monkeypatch):
    import scrubline.llm.tokenizing as tokenizing

    monkeypatch.setattr(tokenizing, "REMEMBERED", 3)
    path = public_tokenizers.path("byte_bpe_50k.json")
    table, library = tokenizing.Units(path), Tokenizer.from_file(path)
    text = "one two three four five six two one seven one"
    assert np.frombuffer(table.ids(text), "<u2").tolist() == library.encode(text).ids
    assert len(table.young) <= 3 and len(table.old) <= 3
