"""Sorting the suffixes of one shard by induced sorting.

Suffixes are of type S (smaller than the next suffix) or L. Only the leftmost S
suffixes of each run are sorted outright: the substrings between them are
brought into order by one induction, named, and the string of names, at most
half as long, is sorted by the same method; recursion ends when all names
differ. From these sorted suffixes the L suffixes are induced in ascending and
the S suffixes in descending order: each suffix that leaves the queue puts its
predecessor in.

The queue is keyed by the predecessor's first symbol. It is monotone, so one
first-in-first-out region per symbol serves it, all regions lying in one array
of 8 bytes a suffix. Above ``MEMORY`` bytes this array lies in a file in the task's
scratch folder and is mapped. The text and the arrays beside it stay in memory, some
100 bytes a byte of the shard, so the caller bounds its shards. Neighbours get their
common-prefix length, up to a limit, from the text once the order is finished.
"""

from __future__ import annotations

import tempfile
import numpy as np

MEMORY = 256 << 20
_FEW = 2048  # up to so many symbols a queue is emptied symbol by symbol, in blocks


def _array(n: int, folder: str | None) -> np.ndarray:
    if folder and n * 8 > MEMORY:
        with tempfile.NamedTemporaryFile(dir=folder) as file:  # the mapping outlives the name
            return np.memmap(file.name, np.int64, "w+", shape=(n,))
    return np.empty(n, np.int64)


def _types(text: np.ndarray) -> np.ndarray:
    """True where the suffix is of type S. The last symbol is the only smallest one."""
    n = len(text)
    rise = np.zeros(n, np.int8)
    rise[:-1] = np.sign(text[1:].astype(np.int64) - text[:-1])
    rise[-1] = 1
    at = np.where(rise != 0, np.arange(n), n)
    return rise[np.minimum.accumulate(at[::-1])[::-1]] > 0


def suffix_array(text: np.ndarray, folder: str | None = None) -> np.ndarray:
    """Start positions of all suffixes in order. ``text`` holds symbols above 0 and ends with the only 0."""
    n, symbols = len(text), int(text.max()) + 1
    if n == 1:
        return np.zeros(1, np.int64)
    small = _types(text)
    sampled = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    induce = _induce_blocks if symbols <= _FEW else _induce_each
    # One induction from the sampled positions in any order sorts their substrings.
    order = induce(text, small, symbols, sampled, folder)
    is_sampled = np.zeros(n, bool)
    is_sampled[sampled] = True
    sub = order[is_sampled[order]]
    names = _names(text, sampled, sub)
    if names[-1] + 1 < len(sampled):
        by_place = np.empty(n, np.int64)
        by_place[sub] = names
        ranks = suffix_array(by_place[sampled], folder)
        sub = sampled[ranks]
    return induce(text, small, symbols, sub, folder)


def _names(text: np.ndarray, sampled: np.ndarray, sub: np.ndarray) -> np.ndarray:
    """Numbers of the sorted sampled substrings, equal for equal ones."""
    nexts = np.empty(len(text), np.int64)
    nexts[sampled] = np.concatenate([sampled[1:], [len(text) - 1]])
    length = nexts[sub] - sub + 1
    same = length[1:] == length[:-1]
    live = np.flatnonzero(same)
    offset = 0
    while len(live):  # symbol by symbol, as long as both go on and agree
        a, b = sub[live] + offset, sub[live + 1] + offset
        equal = text[a] == text[b]
        same[live[~equal]] = False
        live = live[equal & (offset + 1 < length[live])]
        offset += 1
    return np.concatenate([[0], np.cumsum(~same)])


def _bounds(text: np.ndarray, symbols: int) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols))])


def _put(queue, head, text, from_left: bool, positions: np.ndarray) -> None:
    """Append positions to the regions of their symbols, keeping their order."""
    symbols = text[positions]
    order = np.argsort(symbols, kind="stable")
    s = symbols[order]
    new = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
    count = np.diff(np.concatenate([new, [len(s)]]))
    place = np.arange(len(s)) - np.repeat(new, count)
    if from_left:
        queue[head[s] + place] = positions[order]
        head[s[new]] += count
    else:
        queue[head[s] - place] = positions[order]
        head[s[new]] -= count


def _induce_blocks(text, small, symbols, sampled, folder) -> np.ndarray:
    n = len(text)
    bounds = _bounds(text, symbols)
    queue = _array(n, folder)
    firsts = text[sampled]
    ends = np.searchsorted(firsts, np.arange(symbols + 1)) if (np.diff(firsts) >= 0).all() else None
    if ends is None:
        sampled = sampled[np.argsort(firsts, kind="stable")]
        ends = np.searchsorted(text[sampled], np.arange(symbols + 1))
    head = bounds[:-1].copy()
    for c in range(symbols):
        done = bounds[c]
        while done < head[c]:  # what this symbol's own suffixes put in comes in the next turn
            block = np.array(queue[done : head[c]])
            done = head[c]
            before = block[block > 0] - 1
            before = before[~small[before]]
            if len(before):
                _put(queue, head, text, True, before)
        block = sampled[ends[c] : ends[c + 1]]
        before = block[block > 0] - 1
        before = before[~small[before]]
        if len(before):
            _put(queue, head, text, True, before)
    left = head  # each symbol's L suffixes end here
    head = bounds[1:] - 1
    for c in range(symbols - 1, -1, -1):
        done = bounds[c + 1] - 1
        while done > head[c]:
            block = np.array(queue[head[c] + 1 : done + 1])[::-1]
            done = head[c]
            before = block[block > 0] - 1
            before = before[small[before]]
            if len(before):
                _put(queue, head, text, False, before)
        block = np.array(queue[bounds[c] : left[c]])[::-1]
        before = block[block > 0] - 1
        before = before[small[before]]
        if len(before):
            _put(queue, head, text, False, before)
    queue[0] = n - 1
    return queue


def _induce_each(text, small, symbols, sampled, folder) -> np.ndarray:
    """The same with many symbols (names): one suffix at a time."""
    n = len(text)
    bounds = _bounds(text, symbols)
    queue = _array(n, folder)
    queue[:] = -1
    # Each symbol's sampled suffixes at the end of its region, in their order.
    firsts = text[sampled]
    by_symbol = np.argsort(firsts, kind="stable")
    count = np.bincount(firsts, minlength=symbols)
    place = np.arange(len(sampled)) + np.repeat(bounds[1:] - np.cumsum(count), count)
    queue[place] = sampled[by_symbol]
    q = queue if isinstance(queue, np.memmap) else queue.tolist()
    # Symbol before each place where the suffix there is to be put in by the pass, else -1;
    # the last is for places of the queue that are still empty. What a pass puts in it also meets.
    before = np.full(n + 1, -1, np.int64)
    before[1:n] = np.where(small[: n - 1], -1, text[: n - 1])
    goes, head = before.tolist(), bounds[:-1].tolist()
    for i in q:
        c = goes[i]
        if c >= 0:
            k = head[c]
            q[k] = i - 1
            head[c] = k + 1
    before[1:n] = np.where(small[: n - 1], text[: n - 1], -1)
    goes, tail = before.tolist(), (bounds[1:] - 1).tolist()
    for i in reversed(q):
        c = goes[i]
        if c >= 0:
            k = tail[c]
            q[k] = i - 1
            tail[c] = k - 1
    q[0] = n - 1
    return q if isinstance(q, np.memmap) else np.array(q, np.int64)


def common_prefixes(text: np.ndarray, order: np.ndarray, limit: int) -> np.ndarray:
    """Length of the common prefix of each suffix and the one before it, at most ``limit``."""
    out = np.zeros(len(order), np.int64)
    padded = np.concatenate([text, np.zeros(limit + 8, text.dtype)])
    live = np.arange(1, len(order))
    for depth in range(limit):
        equal = padded[order[live] + depth] == padded[order[live - 1] + depth]
        live = live[equal]
        if not len(live):
            break
        out[live] = depth + 1
    return out


def equal_prefixes(pieces: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Strings of ``length`` bytes in the order of their suffixes: the piece and the place of each,
    and where in this order a new string begins. Strings do not cross from one piece to the next.
    """
    sizes = np.array([len(p) for p in pieces], np.int64)
    if not len(sizes):
        return (np.zeros(0, np.int64),) * 3
    # Symbols: 0 ends the shard, 1 ends a piece, bytes follow.
    text = np.ones(int(sizes.sum()) + len(sizes) + 1, np.int16)
    text[-1] = 0
    starts = np.cumsum(sizes + 1) - (sizes + 1)
    flat = np.frombuffer(b"".join(pieces), np.uint8)
    text[np.arange(len(flat)) + np.repeat(np.arange(len(sizes)), sizes)] = flat.astype(np.int16) + 2
    room = np.maximum(sizes - length + 1, 0)  # strings of that length in each piece
    piece = np.full(len(text), -1)
    at = np.repeat(starts, room) + np.arange(room.sum()) - np.repeat(np.cumsum(room) - room, room)
    piece[at] = np.repeat(np.arange(len(sizes)), room)
    with tempfile.TemporaryDirectory(prefix="suffixes-") as folder:
        order = suffix_array(text, folder)
        order = np.asarray(order[piece[order] >= 0])
    common = common_prefixes(text, order, length)
    piece = piece[order]
    return piece, order - starts[piece], np.flatnonzero(common < length)
