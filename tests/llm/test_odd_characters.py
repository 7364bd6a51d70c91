"""Texts in any script: ids and counts as the library gives them, by runs and not by texts."""

import random
from array import array

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from turnloom.llm import byte_bpe, packing, token_counts

BPE = public_tokenizers.path("byte_bpe_50k.json")
# disputed blanks and controls, an unassigned character, letters of late scripts, marks
ODD = "\x00\x1c\x1f\x85\xa0 ᠎    　﻿͸\U0001e900́\U00020000"
WORDS = ["the", "Ünïcode", "don't", "日本語", "テスト", "Привет", "שלום", "नमस्ते", "한국어", "😀👍🏽", "42", "٣٤", "'s", "…", ";"]
BLANKS = [" ", " ", " ", "\n", "  ", "\t", " \n", "\r\n", "\n\n "]


def texts():
    rng = random.Random(5)
    for n in (0, 1, 2, 5, 30, 200):
        for share in (0, 0.02, 0.3):
            for _ in range(12):
                out = []
                for _ in range(n):
                    out += [rng.choice(WORDS), rng.choice(BLANKS) if rng.random() < 0.9 else ""]
                    if rng.random() < share:
                        out.append(rng.choice(ODD) * rng.randint(1, 2))
                yield "".join(out)
    yield "x" * 300_000 + "　" + " y" * 400_000 + "\x85z"
    yield "日本" * 50_000
    yield "a <|endoftext|>　b"
    yield None


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(BPE)
    return [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts()]


def test_counts(library):
    assert token_counts.count_tokens(BPE, list(texts())) == list(map(len, library))


def test_ids(library):
    got = [b"".join(v) for v in packing.encoder(BPE).values(list(texts()))]
    assert got == [array("I", ids).tobytes() for ids in library]


def test_only_runs_around_odd_characters_go_whole():
    text = "plain words before\n" * 100 + "one odd　sign here" + " and after it" * 100
    parts = list(byte_bpe.runs(text))
    assert "".join(p for _, p in parts) == text
    assert [p for odd, p in parts if odd] == [" odd　sign"]
    for other in ("Привет, мир", "日本語のテキスト", "fine 😀👍🏽 thanks"):
        assert not byte_bpe.is_odd(other)


def test_long_pieces_are_not_remembered():
    words = token_counts.Counts(BPE)
    words.values(["語" * 1_000 + " word", "　" * 1_000])
    assert " word" in words.memory and max(map(len, words.memory)) <= byte_bpe.REMEMBERED
