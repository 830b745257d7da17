"""Byte-level BPE against tiktoken."""

from __future__ import annotations

import base64
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from mailsift.llm import bpe
from tests.llm.helpers import clashing, docs

PATH = public_tokenizers.path(bpe.RANKS)


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    rng = random.Random(5)
    odd = ["", " ", "a" * 3000, "日本語" * 300, " \n\t  x", "é" * 1000 + "z", "<|endoftext|>", "ab" * 700, "1234567 don't"]
    return odd + ["".join(rng.choice("abcdeé 1!\n") for _ in range(rng.randint(0, 500))) for _ in range(200)]


def test_ids_are_those_of_tiktoken(reference):
    given = texts()
    ids, counts = bpe._Coder(PATH, public_tokenizers.PATTERN).encode(given)
    ends = np.concatenate([[0], np.cumsum(counts)])
    for n, text in enumerate(given):
        assert ids[ends[n] : ends[n + 1]].tolist() == reference.encode_ordinary(text)


def test_heap_and_matrix_agree():
    vocabulary = bpe._vocabulary(PATH)
    for text in texts():
        word = text.encode()[:200]
        if word:
            assert vocabulary._matrix([word], len(word))[0].tolist() == vocabulary._by_heap(word).tolist()


def test_round_trip_keeps_rows_and_columns(spark, reference):
    given = [(n, text) for n, text in enumerate(texts())] + [(3, None), (None, "x y"), (None, "x y")]
    df = clashing(docs(spark, given))
    coded = bpe.encode_decode(df)
    rows = coded.collect()
    assert len(rows) == len(given) and set(df.columns) <= set(coded.columns)
    for row in rows:
        assert row.ids == reference.encode_ordinary(row.text or "")
        assert bytes(row.decoded) == (row.text or "").encode() and row.key == "own key"
    again = bpe.decode(coded.drop("decoded")).collect()
    assert sorted(bytes(r.decoded) for r in again) == sorted(bytes(r.decoded) for r in rows)
    assert bpe.encode(df.limit(0)).count() == 0
