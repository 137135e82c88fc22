"""Tree concatenation of split text against the tokenizer's own library."""

from __future__ import annotations

import random

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tillroll.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture
def codec(monkeypatch):
    monkeypatch.setattr(bpe, "BRANCH", 40)
    return bpe.Codec(bpe.load(PATH))


def equal(codec, library, text):
    assert codec.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


def texts():
    rng = random.Random(5)
    parts = ["the", "don't", "it's", " ", "  ", "\n", "\n\n ", "\t", "x" * 70, "12345", "é", "日本語。", "字", "，", "😀", "　", "\x1f", "\xa0",
             "...", "!?", "'s", "'", "<|endoftext|>", "<|endof", "text|>", "a.b", "A,", ";", "end of line\r\n", "ﬁ", "́", "ー", "٣"]
    for size in (41, 80, 200, 1500):
        for _ in range(60):
            chosen = rng.sample(parts, rng.randrange(2, len(parts)))
            yield "".join(rng.choice(chosen) for _ in range(size))
    yield from ("a" * 5000, " " * 5000, "字" * 3000, "。" * 500, "word " * 2000, "\n" * 300 + "x", "a " * 41, ("b" * 3000 + " ") * 3)


def test_joined_halves_equal_the_library(codec, library):
    for text in texts():
        equal(codec, library, text)


def test_cuts_at_every_place_of_a_text(codec, library):
    text = "It's a “test”, isn't it?  Yes:\n\n 日本語のテキスト。次の文、です<|endoftext|> don't 3.14 stop " * 2
    for place in range(1, len(text)):
        left, right = text[:place], text[place:]
        found = codec.concatenate(left, codec.encode(left), right, codec.encode(right))
        assert found.tolist() == library.encode(text, add_special_tokens=False).ids


def test_a_tenth_of_the_given_texts_are_joined_by_windows(library, monkeypatch):
    """With the registered parameters: many texts go through joins, and few windows have to grow to both halves."""
    codec = bpe.Codec(bpe.load(PATH))
    joins, wholes = 0, 0
    concatenate, piece = bpe.Codec.concatenate, bpe.Codec._encode_piece
    given = [text for (text,) in duckdb.sql("SELECT text FROM '/root/testdata/sf0.01/documents.parquet' WHERE text IS NOT NULL").fetchall()]
    joined = set()
    for number, text in enumerate(given):
        def watched(self, left, left_ids, right, right_ids, number=number):
            nonlocal joins
            joins += 1
            joined.add(number)
            return concatenate(self, left, left_ids, right, right_ids)

        def counted(self, part):
            nonlocal wholes
            wholes += len(part) > bpe.BRANCH
            return piece(self, part)

        monkeypatch.setattr(bpe.Codec, "concatenate", watched)
        monkeypatch.setattr(bpe.Codec, "_encode_piece", counted)
        equal(codec, library, text)
    assert len(joined) > len(given) / 10 and joins > len(joined)
    assert wholes < joins / 100


def test_no_tokens_on_a_side(codec):
    some = codec.encode("some text")
    none = np.empty(0, np.uint32)
    assert codec.concatenate("", none, "some text", some).tolist() == some.tolist()
    assert codec.concatenate("some text", some, "", none).tolist() == some.tolist()
