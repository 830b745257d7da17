"""Repeated passages against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest

from mailsift.llm import induced, suffix_dedup
from tests.llm.helpers import clashing, docs

LAST = 2**63 - 1


def brute(rows):
    """Of each row (by place): removed bytes as a mask."""
    first = {}
    data = [(LAST if i is None else i, (t or "").encode()) for i, t in rows]
    for i, x in data:
        for p in range(len(x) - 49):
            w = x[p : p + 50]
            first[w] = min(first.get(w, LAST + 1), i)
    masks = []
    for i, x in data:
        mask = np.zeros(len(x), bool)
        for p in range(len(x) - 49):
            if first[x[p : p + 50]] < i:
                mask[p : p + 50] = True
        masks.append(mask)
    return masks


def sample():
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefé") for _ in range(rng.randint(1, 7)))
    text = lambda n: " ".join(word() for _ in range(n))
    passage, long = text(30), text(900)
    rows = [(n, text(rng.randint(0, 60))) for n in range(20)]
    rows += [(100 + n, text(5) + passage + text(5)) for n in range(40)]  # one passage in very many
    rows += [(200, long), (201, long), (202, long[:700] + "X" + long[700:])]
    rows += [(300, "a" * 500), (301, "a" * 300 + "b" * 60), (302, "ab" * 200), (303, "b" + "ab" * 150)]
    rows += [(400, None), (401, ""), (None, passage + "!"), (None, long), (200, long), (5, long[:200])]
    return rows


@pytest.mark.parametrize("many", [suffix_dedup.MANY, 3])
def test_equals_brute_force(spark, many):
    rows = sample()
    found = suffix_dedup.Repeats(docs(spark, rows).repartition(5), many=many).result().collect()
    want = []
    for (i, t), mask in zip(rows, brute(rows)):
        x = np.frombuffer((t or "").encode(), np.uint8)
        spans = int((mask & ~np.concatenate([[False], mask[:-1]])).sum()) if len(mask) else 0
        want.append((str(i), len(x), int(mask.sum()), spans, x[~mask].tobytes()))
    got = [(str(r.id), r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in found]
    assert sorted(got) == sorted(want)


def test_shards_stay_small_as_the_table_grows(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", 500, raising=False)
    monkeypatch.setattr(suffix_dedup, "OPEN_BYTES", 300, raising=False)
    rows = sample()
    repeats = suffix_dedup.Repeats(docs(spark, rows).repartition(5))
    total = sum(len((t or "").encode()) for _, t in rows)
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert repeats.count == -(-total // 500) > least and repeats.open_count > least
    want = sorted((str(i), int(mask.sum())) for (i, _), mask in zip(rows, brute(rows)))
    assert sorted((str(r.id), r.n_removed) for r in repeats.result().collect()) == want


def test_texts_stay_texts_and_columns_stay(spark):
    df = clashing(docs(spark, [(1, "é" * 60), (2, "x" + "é" * 60), (3, None), (4, "")]))
    out = suffix_dedup.remove_repeats(df)
    assert out.columns == df.columns and out.dtypes == df.dtypes
    rows = {r.doc_id: r for r in out.collect()}
    assert rows[1].text == "é" * 60 and rows[2].text == "x" and rows[2].n_chars == 1
    assert rows[3].text is None and rows[4].text == "" and rows[2].chunk == "own chunk"
    assert suffix_dedup.remove_repeats(df.limit(0)).count() == 0


def test_suffixes_of_small_strings_are_in_order(monkeypatch):
    rng = random.Random(3)
    for few in (2048, 0):  # by blocks, one by one
        monkeypatch.setattr(induced, "_FEW", few)
        for _ in range(150):
            symbols = [rng.randint(1, rng.choice([1, 2, 3, 9])) for _ in range(rng.randint(0, 60))] + [0]
            got = induced.suffix_array(np.array(symbols)).tolist()
            assert got == sorted(range(len(symbols)), key=lambda i: symbols[i:])


def test_arrays_on_disk_give_the_same_order(monkeypatch, tmp_path):
    rng = np.random.default_rng(2)
    text = np.append(rng.integers(1, 4, 5000), 0)
    want = induced.suffix_array(text)
    monkeypatch.setattr(induced, "MEMORY", 100)
    assert (induced.suffix_array(text, str(tmp_path)) == want).all()
