"""What the operators of the pipeline hold in a Python worker, and leave there."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pyarrow as pa

from mailsift.llm import suffix_dedup
from mailsift.llm.common import giving_back


def _open_shard(size: int):
    """Contexts of a shard as chunks send them, each there twice, and how many strings start in a smaller document."""
    numbers = np.random.default_rng(3)
    once = numbers.integers(97, 123, (size // 126, 63)).astype(np.uint8)
    n = 2 * len(once)
    drawers = np.tile(numbers.integers(0, suffix_dedup.DRAWERS, len(once)).astype(np.uint8), 2)
    columns = {
        "entries": np.arange(n, dtype=np.uint32), "sizes": np.full(n, 63, np.uint8), "docs": np.arange(n, dtype=np.int64),
        "drawers": drawers, "data": np.concatenate([once, once]),
    }
    table = {name: pa.array([x.tobytes()], pa.binary()) for name, x in columns.items()}
    return pa.table({"shard": pa.array([0], pa.int64()), "chunk": pa.array([7], pa.int64()), **table}), len(once)


def test_a_shard_of_open_contexts_takes_little_beside_its_bytes():
    table, repeated = _open_shard(2 << 20)
    answer = suffix_dedup._answer_open(1)
    tracemalloc.start()
    out = answer(table)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    entries = np.frombuffer(out.column("entries")[0].as_py(), np.uint32)
    assert len(entries) == repeated * 14 and entries.min() == repeated  # 14 strings of 50 bytes in 63
    assert peak < 40 * (2 << 20)


def test_a_step_gives_back_once_its_rows_are_out(monkeypatch):
    given = []
    monkeypatch.setattr("mailsift.llm.common.give_back", lambda: given.append(1))
    step = giving_back(lambda batches: (x + 1 for x in batches))
    rows = step(iter([1, 2]))
    assert next(rows) == 2 and not given
    assert list(rows) == [3] and given == [1]
