"""Ids of words by table against the tokenizer itself."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from millrace.llm import pieces, token_files

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", "don't", "a.b", "...", "x!!", "É\u0130x", "ß÷", "日本", "\u00d7", "Ǝɐ", "naïve,", "</w>", "<unk>", "é" * 70, "a1", "\u0301a", "."]


@pytest.fixture(scope="module")
def texts():
    r = random.Random(3)
    letters = "abcxyzABÉéßıİſǅɏɐ.,;:!?'-0 \t\n\u00a0\u2003"
    return [None, "", "  ", *["".join(r.choice(letters) for _ in range(r.randrange(60))) for _ in range(400)], " ".join(ODD), "word " * 5000]


def expected(texts):
    known = Tokenizer.from_file(PATH)
    return [[*known.encode(t or "", add_special_tokens=False).ids, 2] for t in texts]


@pytest.mark.parametrize("bits", [64, 6, 0])
def test_words_of_equal_hash_are_told_apart(texts, monkeypatch, bits):
    true = pieces.word_hashes
    monkeypatch.setattr(pieces, "word_hashes", lambda *x: true(*x) & np.uint64((1 << bits) - 1))
    words = pieces.WordIds(PATH)
    coder = token_files.WordCoder.__new__(token_files.WordCoder)
    coder.pieces = words
    want = expected(texts)
    for first in (0, 200, 0):  # the last time with all words known
        ids, at = coder.encode(pa.array(texts[first:], pa.string()), 2)
        assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == want[first:]


def test_a_full_table_starts_anew(texts):
    coder = token_files.WordCoder.__new__(token_files.WordCoder)
    coder.pieces = pieces.WordIds(PATH, kept=20)
    want = expected(texts)
    for k in range(0, len(texts), 50):
        ids, at = coder.encode(pa.array(texts[k : k + 50], pa.string()), 2)
        assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == want[k : k + 50]
