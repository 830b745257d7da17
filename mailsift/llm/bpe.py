"""Byte-level BPE, many words at a time.

Texts are cut by the tokenizer's pattern. The words that a task has not met
before go into padded matrices, one per length bucket, a row per word. In each
round every row looks its neighbouring pairs up in a hash table, merges its
leftmost pair of minimum rank, and closes the gap; rows without a pair left
leave the matrix. The ids are those tiktoken gives.

A word longer than ``LONG`` bytes takes a heap over its pairs instead, as a
matrix would cost the square of its length; same merges, same ids.

Defined cases: null and empty texts give no ids and decode to nothing; texts
of any length are encoded whole; rows and columns of the input stay as they are.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructType

from mailsift import session
from mailsift.llm.common import give_back, mix64, steps, text_bytes

RANKS = "byte_bpe_50k.tiktoken"
LONG = 256  # bytes; longer words go by heap
KEEP_WORDS = 300_000  # words a task remembers before it starts anew
_NONE = np.int32(2**31 - 1)
_FREE = np.uint64(2**64 - 1)


class Vocabulary:
    """Ranks, and a hash table from pairs of ids to the rank of their merge."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.bytes = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        pairs, merged = [], []
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                left, right = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs.append(left << 32 | right)
                    merged.append(rank)
        self._fill(np.array(pairs, np.uint64), np.array(merged, np.int32))
        self.pairs = dict(zip(pairs, merged))

    def _fill(self, pairs: np.ndarray, merged: np.ndarray) -> None:
        size = 1 << int(np.ceil(np.log2(4 * len(pairs) + 1)))
        self.mask = np.uint64(size - 1)
        self.keys = np.full(size, _FREE, np.uint64)
        self.values = np.full(size, _NONE, np.int32)
        slot = mix64(pairs) & self.mask
        while len(pairs):  # of those that want one free slot, the first gets it
            free = np.flatnonzero(self.keys[slot] == _FREE)
            _, first = np.unique(slot[free], return_index=True)
            won = free[first]
            self.keys[slot[won]], self.values[slot[won]] = pairs[won], merged[won]
            lost = np.ones(len(pairs), bool)
            lost[won] = False
            pairs, merged, slot = pairs[lost], merged[lost], (slot[lost] + np.uint64(1)) & self.mask

    def lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair; ``_NONE`` where there is none."""
        pairs = left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint32)
        slot = mix64(pairs) & self.mask
        keys = self.keys[slot]
        out = np.where(keys == pairs, self.values[slot], _NONE)
        todo = np.flatnonzero((keys != pairs) & (keys != _FREE))
        slot = slot[todo]
        while len(todo):
            slot = slot + np.uint64(1) & self.mask
            keys = self.keys[slot]
            hit = keys == pairs[todo]
            out[todo[hit]] = self.values[slot[hit]]
            on = ~hit & (keys != _FREE)
            todo, slot = todo[on], slot[on]
        return out

    def encode(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of each word."""
        out: list = [None] * len(words)
        buckets: dict[int, list[int]] = {}
        for i, word in enumerate(words):
            n = len(word)
            if n > LONG:
                out[i] = self._by_heap(word)
            else:
                buckets.setdefault(n if n <= 16 else 1 << (n - 1).bit_length(), []).append(i)
        for width, rows in buckets.items():
            most = max(1, (1 << 22) // max(width, 1))  # cells of one matrix
            for k in range(0, len(rows), most):
                part = rows[k : k + most]
                for i, ids in zip(part, self._matrix([words[i] for i in part], width)):
                    out[i] = ids
        return out

    def _matrix(self, words: list[bytes], width: int) -> list[np.ndarray]:
        flat = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8)
        ids = self.bytes[flat].reshape(len(words), width)
        length = np.array([len(w) for w in words])
        ids[np.arange(width) >= length[:, None]] = -1
        out: list = [None] * len(words)
        row = np.arange(len(words))
        while len(row):
            if ids.shape[1] > 1:
                rank = self.lookup(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(row), -1)
                at = rank.argmin(1)  # the leftmost, where several are least
                least = rank[np.arange(len(row)), at]
                done = least == _NONE
            else:
                done = np.ones(len(row), bool)
            if done.any():
                for r, line in zip(row[done], ids[done]):
                    out[r] = line[line >= 0]
                go = ~done
                row, ids = row[go], ids[go]
                if not len(row):
                    break
                at, least = at[go], least[go]
            n = np.arange(len(row))
            ids[n, at] = least
            keep = np.ones(ids.shape, bool)
            keep[n, at + 1] = False
            ids = ids[keep].reshape(len(row), -1)
            used = int((ids >= 0).any(0).sum())  # drop columns that are padding everywhere
            ids = ids[:, : max(used, 1)]
        return out

    def _by_heap(self, word: bytes) -> np.ndarray:
        ids = self.bytes[np.frombuffer(word, np.uint8)].tolist()
        after, ahead = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        pairs = self.pairs
        heap = [
            (pairs[key], i, ids[i], ids[i + 1])
            for i in range(len(ids) - 1)
            if (key := ids[i] << 32 | ids[i + 1]) in pairs
        ]
        heapq.heapify(heap)
        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j >= len(ids) or ids[j] != right:
                continue  # one of the two has been merged since
            ids[i], ids[j] = rank, -1
            after[i] = after[j]
            if after[i] < len(ids):
                ahead[after[i]] = i
            for a, b in ((ahead[i], i), (i, after[i])):
                if a >= 0 and b < len(ids) and (key := ids[a] << 32 | ids[b]) in pairs:
                    heapq.heappush(heap, (pairs[key], a, ids[a], ids[b]))
        return np.array([x for x in ids if x >= 0], np.int32)


@cache
def _vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class _Coder:
    """Encodes and decodes texts, with a memory of words; kept while the worker lives, the words while a task does."""

    def __init__(self, path: str, pattern: str):
        self.vocabulary = _vocabulary(path)
        self.cut = regex.compile(pattern).findall
        self.known: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and how many each has."""
        cut = [self.cut(text) for text in texts]
        new = list({w for words in cut for w in words if w not in self.known})
        if len(self.known) + len(new) > KEEP_WORDS:
            self.known.clear()
            new = list({w for words in cut for w in words})
        self.known.update(zip(new, (ids.tobytes() for ids in self.vocabulary.encode([w.encode() for w in new]))))
        get = self.known.__getitem__
        rows = [b"".join(map(get, words)) for words in cut]
        return np.frombuffer(b"".join(rows), np.int32), np.array([len(r) // 4 for r in rows], np.int64)


@cache
def _coder(path: str, pattern: str) -> _Coder:
    return _Coder(path, pattern)


@cache
def _token_bytes(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all tokens end to end, where each begins, how long it is."""
    tokens = _vocabulary(path).tokens
    words = [tokens.get(i, b"") for i in range(max(tokens) + 1)]
    length = np.array([len(w) for w in words], np.int64)
    return np.frombuffer(b"".join(words), np.uint8), np.cumsum(length) - length, length


def _decode(path: str, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all rows end to end, and where each row ends."""
    flat, start, length = _token_bytes(path)
    n = length[ids]
    ends = np.cumsum(n)
    data = flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(start[ids] - (ends - n), n)]
    return data, np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]


def _offsets(counts: np.ndarray) -> pa.Buffer:
    return pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32), pa.int32())


def encode(df: DataFrame, text_col: str = "text", ids_col: str = "ids", ranks: str | None = None,
           pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """``df`` with a column of ids (array of int)."""
    return _coded(df, text_col, ids_col, None, ranks, pattern)


def encode_decode(df: DataFrame, text_col: str = "text", ids_col: str = "ids", bytes_col: str = "decoded",
                  ranks: str | None = None, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """``df`` with the ids of its texts and the bytes these ids decode to."""
    return _coded(df, text_col, ids_col, bytes_col, ranks, pattern)


def _coded(df, text_col, ids_col, bytes_col, ranks, pattern) -> DataFrame:
    session.tune(df.sparkSession)
    path = ranks or public_tokenizers.path(RANKS)
    taken = {ids_col.lower(), (bytes_col or ids_col).lower()}
    rest = [F.col(f"`{c}`") for c in df.columns if c.lower() not in taken]
    source = df.select(F.struct(*rest, F.lit(True).alias("_row_there")).alias("row"), text_bytes(text_col).alias("text"))
    fields = StructType().add("row", source.schema["row"].dataType).add("ids", ArrayType(IntegerType()))
    if bytes_col:
        fields = fields.add("bytes", BinaryType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(path, pattern)
        for batch in steps(batches, "text"):
            ids, counts = coder.encode(batch.column("text").to_pylist())
            columns = [batch.column("row"), pa.ListArray.from_arrays(_offsets(counts), pa.array(ids, pa.int32()))]
            if bytes_col:
                data, ends = _decode(path, ids, counts)
                columns.append(pa.Array.from_buffers(
                    pa.binary(), len(counts), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data)]))
            yield pa.RecordBatch.from_arrays(columns, ["row", "ids", "bytes"][: len(columns)])

    def lean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            _coder(path, pattern).known = {}
            give_back()

    out = source.mapInArrow(lean, fields)
    names = [F.col(f"row.`{c}`") for c in df.columns if c.lower() not in taken]
    extra = [F.col("bytes").alias(bytes_col)] if bytes_col else []
    return out.select(*names, F.col("ids").alias(ids_col), *extra)


def decode(df: DataFrame, ids_col: str = "ids", bytes_col: str = "decoded", ranks: str | None = None) -> DataFrame:
    """``df`` with the bytes that a column of ids stands for (null ids: no bytes)."""
    session.tune(df.sparkSession)
    path = ranks or public_tokenizers.path(RANKS)
    rest = [c for c in df.columns if c.lower() != bytes_col.lower()]
    source = df.select(
        F.struct(*[F.col(f"`{c}`") for c in rest], F.lit(True).alias("_row_there")).alias("row"),
        F.coalesce(F.col(ids_col), F.array().cast("array<int>")).alias("ids"),
    )
    fields = StructType().add("row", source.schema["row"].dataType).add("bytes", BinaryType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("ids")
            counts = np.asarray(pc.list_value_length(column))
            data, ends = _decode(path, np.asarray(column.flatten()), counts)
            bytes_ = pa.Array.from_buffers(
                pa.binary(), len(counts), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data)])
            yield pa.RecordBatch.from_arrays([batch.column("row"), bytes_], ["row", "bytes"])

    return source.mapInArrow(run, fields).select(*[F.col(f"row.`{c}`") for c in rest], F.col("bytes").alias(bytes_col))
