"""Prefix counts against the library, which encodes every prefix anew."""

from __future__ import annotations

import random

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from mailsift.llm import queries as catalog
from mailsift.llm import token_counts
from mailsift.llm.common import table
from tests.llm.helpers import clashing, docs

PATH = public_tokenizers.path(token_counts.MODEL)
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
BITS = ["a", "e", "t", " ", "   ", "\n", "the", "ing", "\u2581", "é", "日", "本", "\U0001f600", "\u0300", "<s>", "</s>", "<unk>",
        "<0x0A>", "\t", "\r", "xxxxx", "1", "0", "==", "--", "\ufdfa", "\x00", "\xa0", "\u2028", ".", ",", "'"]


def count(text):
    return len(LIBRARY.encode(text))


def counts(text):
    return token_counts.running(token_counts.counter(PATH).changes(text)).tolist()


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(BITS), st.characters(exclude_categories=["Cs"])), max_size=14).map("".join))
def test_every_prefix_counts_as_the_library_does(text):
    assert counts(text) == [count(text[:k]) for k in range(len(text) + 1)]


def test_prefixes_of_real_texts(spark):
    rng = random.Random(1)
    for row in table(spark, "/root/testdata/sf0.001", "documents").limit(60).collect():
        text = row.text or ""
        got = counts(text)
        for k in [len(text), *rng.sample(range(len(text) + 1), min(20, len(text)))]:
            assert got[k] == count(text[:k])


def test_query_counts_as_the_library_does(spark):
    folder = "/root/testdata/sf0.001"
    rows = {r.doc_id: r for r in catalog.op12_token_counts(spark, folder).collect()}
    texts = table(spark, folder, "documents").select("doc_id", "text").collect()
    assert len(rows) == len(texts)
    for doc_id, text in texts:
        n = count(text or "")
        assert tuple(rows[doc_id]) == (doc_id, len((text or "").encode()), n, n > 4096)


ROWS = [
    (1, "one two three, four. one two"), (2, None), (3, ""), (4, "x" * 3000 + " " * 3000 + "日本語" * 1000),
    (1, "one two three, four. one two"), (None, "null id"), (6, "word\n" * 20_000), (7, "\ufdfa" * 50),
]


def test_answers_are_read_off_the_stored_counts(spark):
    df = token_counts.prefix_counts(clashing(docs(spark, ROWS)).withColumn("n_tokens", F.lit("old")))
    texts = [r.text or "" for r in df.select("text").collect()]
    got = df.collect()
    assert [r.n_tokens for r in got] == [count(t) for t in texts] and {r.row for r in got} == {"own row"}
    budgets = [0, 1, 2, 7, 100, 5000, 10**6]
    for budget in budgets:
        for r, text in zip(token_counts.truncate(df, budget).collect(), texts):
            assert r.kept_tokens == count(text[: r.kept_chars]) <= budget
            longer = counts(text)[r.kept_chars + 1 :]
            assert not longer or min(longer) > budget
    for n in (0, 1, 5, 10**7):
        for r, text in zip(token_counts.count_at(df, n).collect(), texts):
            assert r.n_tokens_at == count(text[:n])
    assert {r.n_tokens_at for r in token_counts.count_at(df, F.lit(None)).collect()} == {None}
    assert {r.kept_chars for r in token_counts.truncate(df, F.lit(None)).collect()} == {None}


def test_windows_cover_the_text_and_keep_to_the_budget(spark):
    df = token_counts.prefix_counts(docs(spark, ROWS))
    for budget in (1, 10, 300):
        for r in token_counts.windows(df, budget).collect():
            upto = counts(r.text or "")
            ends = [0, *r.ends]
            assert ends[-1] == len(r.text or "") and all(a < b for a, b in zip(ends, ends[1:]))
            for a, b in zip(ends, ends[1:]):
                assert upto[b] - upto[a] <= budget or b == a + 1
                assert b == len(upto) - 1 or min(upto[b + 1 :]) > upto[a] + budget or b == a + 1
    with pytest.raises(ValueError):
        token_counts.windows(df, 0)


def test_empty_table_and_unfit_model(spark, tmp_path):
    empty = docs(spark, ROWS).limit(0)
    assert token_counts.prefix_counts(empty).count() == 0
    assert token_counts.truncate(token_counts.prefix_counts(empty), 5).count() == 0
    with pytest.raises(Exception):
        token_counts.Pieces(str(tmp_path / "missing.model"))
