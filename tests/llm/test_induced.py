"""The order of suffixes where the queue is emptied one suffix at a time."""

from __future__ import annotations

import time

import numpy as np
import pytest

from mailsift.llm import induced


@pytest.mark.parametrize("memory", [induced.MEMORY, 0])
def test_one_by_one_is_the_exact_order(monkeypatch, tmp_path, memory):
    monkeypatch.setattr(induced, "_FEW", 0)
    monkeypatch.setattr(induced, "MEMORY", memory)  # 0: the queue lies in a file
    numbers = np.random.default_rng(11)
    for _ in range(150):
        n, symbols = int(numbers.integers(1, 200)), int(numbers.integers(1, 120))
        text = np.concatenate([numbers.integers(1, symbols + 1, n), [0]])
        expected = sorted(range(n + 1), key=lambda i: text[i:].tolist())
        assert induced.suffix_array(text, str(tmp_path)).tolist() == expected


def _plain(text, small, symbols, sampled) -> np.ndarray:
    """The induction as it is told, suffix by suffix."""
    bounds = induced._bounds(text, symbols)
    q, t, s = [-1] * len(text), text.tolist(), small.tolist()
    tail = (bounds[1:] - 1).tolist()
    for i in sampled[::-1].tolist():
        q[tail[t[i]]] = i
        tail[t[i]] -= 1
    head = bounds[:-1].tolist()
    for k in range(len(text)):
        i = q[k] - 1
        if i >= 0 and not s[i]:
            q[head[t[i]]] = i
            head[t[i]] += 1
    tail = (bounds[1:] - 1).tolist()
    for k in range(len(text) - 1, -1, -1):
        i = q[k] - 1
        if i >= 0 and s[i]:
            q[tail[t[i]]] = i
            tail[t[i]] -= 1
    q[0] = len(text) - 1
    return np.array(q)


def test_one_by_one_takes_less_time_than_the_plain_loop():
    numbers = np.random.default_rng(5)
    text = np.concatenate([numbers.integers(1, 50_000, 400_000), [0]])
    small = induced._types(text)
    sampled = np.flatnonzero(small[1:] & ~small[:-1]) + 1

    def best(run):
        took = []
        for _ in range(3):
            start = time.process_time()
            order = run()
            took.append(time.process_time() - start)
        return min(took), order

    plain, expected = best(lambda: _plain(text, small, 50_000, sampled))
    quick, order = best(lambda: induced._induce_each(text, small, 50_000, sampled, None))
    assert (order == expected).all()
    assert quick < 0.85 * plain
