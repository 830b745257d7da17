"""Removing repeated passages: every byte covered by a string of 50 bytes that
also starts in a document with a smaller id.

1. **Chunks.** Whole documents are packed into chunks of some MB and written
   down, bucketed by chunk, so that later steps join to them without moving text.
2. **Samples.** In each string of 50 bytes the 24 bytes of least hash are its
   anchor. Equal strings have equal anchors, and one anchor serves a run of
   strings, its context. Chunks send each distinct (anchor, context) once, as
   packed hashes, to the shard of the anchor's hash. There a context that a
   smaller document has too is settled; an anchor met in one document only is
   settled; an anchor with several contexts is not.
3. **Suffixes.** The open contexts go, as bytes, to their shards, where their
   suffixes are sorted by external induced sorting (module ``induced``), a part of
   the anchors at a time, as this takes some 100 bytes a byte; runs of
   suffixes with 50 common bytes tell which strings start in a smaller document.
   An anchor with very many contexts (a phrase in a third of all documents) is
   not one shard's burden: its strings go one by one to shards of their own hash.
4. **Removal.** The answers return to the chunks, which cut their texts.

There are as many shards as the bytes of the table ask for, and for the open
contexts as many as those do, so that what a task holds of a shard does not grow
with the table. The contexts of one anchor, and the places of one string of a
dealt-out anchor, stay together.

Anchor hashes carry 32 bits beside the shard's number; a chance agreement only
makes a context open. Contexts are told apart by 48 bits more.

Defined cases: null and empty texts have nothing to remove; a null id is larger
than any other, and equal ids (repeated rows) are not smaller than one another,
so they take nothing from each other; a text of any length is treated whole.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyspark
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructType

from mailsift.llm.common import Work, flat_text, give_back, giving_back, mix64, text_bytes
from mailsift.llm.induced import equal_prefixes
from mailsift.llm.minhash import _INVERSE, _PRIME, _power

LENGTH, GRAM = 50, 24
_WIDTH = LENGTH - GRAM + 1  # anchors to choose from in a string
CHUNK_BYTES = 2 << 20
SHARD_BYTES = 16 << 20  # of text whose contexts go to one shard
OPEN_BYTES = 4 << 20  # of open contexts that go to one shard
DRAWERS = 8  # parts of a shard of open contexts, sorted one after the other
BLOCK_BYTES = 256 << 10  # of text in one vectorised step
MANY = 500  # contexts of one anchor; above, its strings are dealt out one by one
_LAST = 2**63 - 1  # stands for a null id

SETTLED, REMOVED, OPEN, SPREAD = 0, 1, 2, 3


def _anchors(flat: np.ndarray, offsets: np.ndarray):
    """Of each context: first and last string start, anchor hash, context hash, document."""
    found = [_anchors_of(flat, offsets, b, min(b + BLOCK_BYTES, len(flat))) for b in range(0, max(len(flat), 1), BLOCK_BYTES)]
    return tuple(np.concatenate(x) for x in zip(*found))


def _anchors_of(flat, offsets, begin, end):
    part = flat[begin : end + LENGTH - 1]  # strings that start from begin to end
    n = len(part)
    none = np.zeros(0, np.int64)
    if n < LENGTH:
        return none, none, none.astype(np.uint64), none.astype(np.uint64), none
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    np.cumsum((part.astype(np.uint64) + np.uint64(1)) * _power(_PRIME, n), out=sums[1:])
    back = _power(_INVERSE, n)
    least = mix64((sums[GRAM:] - sums[:-GRAM]) * back[: n - GRAM + 1])
    grams = least
    which = np.arange(len(least), dtype=np.int32)
    span = 1
    while span < _WIDTH:  # minimum over 2, 4, 8, 16, 27 neighbours, the leftmost of equals
        by = min(span, _WIDTH - span)
        right = least[by:] < least[:-by]
        which = np.where(right, which[by:], which[:-by])
        least = np.minimum(least[by:], least[:-by])
        span += by
    strings = n - LENGTH + 1
    edge = np.zeros(strings + 1, np.int32)  # strings that would cross the end of a document
    ends = offsets[1:-1] - begin
    ends = np.unique(ends[(ends > 0) & (ends < n)])
    np.add.at(edge, np.clip(ends - LENGTH + 1, 0, strings), 1)
    np.add.at(edge, np.clip(ends, 0, strings), -1)
    good = np.cumsum(edge[:-1]) == 0
    new = good.copy()
    new[1:] &= ~good[:-1] | (which[1:] != which[:-1])
    low = np.flatnonzero(new)
    stop = good.copy()
    stop[:-1] &= ~good[1:] | (which[1:] != which[:-1])
    high = np.flatnonzero(stop)
    context = mix64((sums[high + LENGTH] - sums[low]) * back[low] ^ np.uint64(0x5851F42D4C957F2D))
    doc = np.searchsorted(offsets, low + begin, side="right") - 1
    return low + begin, high + begin, grams[which[low]], context, doc


def _distinct(anchor: np.ndarray, context: np.ndarray):
    """The first of each (anchor, context), and of each occurrence which one it is."""
    both = mix64(anchor * np.uint64(_PRIME) + context)
    _, first, inverse = np.unique(both, return_index=True, return_inverse=True)
    order = np.argsort(first, kind="stable")  # in the order of the text
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return first[order], rank[inverse]


class _Chunk:
    """The documents of a chunk and their contexts."""

    def __init__(self, ids: pa.Array, sizes: pa.Array, data: memoryview):
        self.ids = ids.fill_null(_LAST).to_numpy(zero_copy_only=False)
        self.flat = np.frombuffer(data, np.uint8)
        self.offsets = np.concatenate([[0], np.cumsum(sizes.to_numpy(zero_copy_only=False))]).astype(np.int64)
        self.low, self.high, self.anchor, self.context, self.doc = _anchors(self.flat, self.offsets)
        self.first, self.which = _distinct(self.anchor, self.context)

    def shards(self, count: int) -> list[tuple[int, np.ndarray]]:
        """The distinct contexts of each shard."""
        return _split(self.anchor[self.first] % np.uint64(count))


def _split(number: np.ndarray) -> list[tuple[int, np.ndarray]]:
    order = np.argsort(number, kind="stable")
    at = np.flatnonzero(np.concatenate([[True], number[order][1:] != number[order][:-1]])) if len(order) else []
    return [(int(number[part[0]]), part) for part in np.split(order, at[1:])] if len(order) else []


def _rows(batch: pa.RecordBatch) -> Iterator[tuple[dict, _Chunk]]:
    for i in range(batch.num_rows):
        row = {name: batch.column(name)[i] for name in batch.schema.names}
        yield row, _Chunk(row["ids"].values, row["sizes"].values, memoryview(row["data"].as_buffer()))


def _frame(columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(columns)


# -- chunks ------------------------------------------------------------------


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = pyspark.TaskContext.get().partitionId() << 32
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        start = 0
        lengths = np.diff(flat_text(batch.column("text"))[1])
        for i in range(batch.num_rows):
            size += int(lengths[i])
            if size >= CHUNK_BYTES:
                held.append(batch.slice(start, i + 1 - start))
                yield _chunk_row(number, held)
                number, held, size, start = number + 1, [], 0, i + 1
        if start < batch.num_rows:
            held.append(batch.slice(start))
    if held:
        yield _chunk_row(number, held)


def _chunk_row(number: int, parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    table = pa.Table.from_batches(parts).combine_chunks()
    ids = table.column("id").combine_chunks()
    order = np.argsort(ids.fill_null(_LAST).to_numpy(zero_copy_only=False), kind="stable")
    table = table.take(order)
    flat, offsets = flat_text(table.column("text").combine_chunks())

    def one(values: pa.Array) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

    return pa.RecordBatch.from_arrays(
        [pa.array([number]), one(table.column("id").combine_chunks()), one(pa.array(np.diff(offsets))),
         one(table.column("row").combine_chunks()), pa.array([flat.tobytes()], pa.binary())],
        ["chunk", "ids", "sizes", "rows", "data"],
    )


# -- what chunks send and shards answer ---------------------------------------


def _send_contexts(count: int):
    def run(batches):
        for batch in batches:
            for row, chunk in _rows(batch):
                out = {"shard": [], "chunk": [], "anchors": [], "contexts": [], "docs": []}
                for shard, part in chunk.shards(count):
                    at = chunk.first[part]
                    anchor, context = chunk.anchor[at], chunk.context[at]
                    out["shard"].append(shard)
                    out["chunk"].append(row["chunk"].as_py())
                    out["anchors"].append((anchor >> np.uint64(32)).astype(np.uint32).tobytes())
                    six = context.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
                    out["contexts"].append(np.ascontiguousarray(six).tobytes())
                    out["docs"].append(chunk.ids[chunk.doc[at]].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out["shard"], pa.int64()), pa.array(out["chunk"], pa.int64()),
                     *[pa.array(out[k], pa.binary()) for k in ("anchors", "contexts", "docs")]], list(out))

    return run


def _joined(table: pa.Table, name: str, kind) -> np.ndarray:
    return np.frombuffer(b"".join(table.column(name).to_pylist()), kind)


def _answer_contexts(many: int):
    return lambda table: _codes_of(table, many)


def _codes_of(table: pa.Table, many: int) -> pa.Table:
    """A code for each context that came in."""
    anchor = _joined(table, "anchors", np.uint32).astype(np.uint64)
    six = np.zeros((len(anchor), 8), np.uint8)
    six[:, :6] = _joined(table, "contexts", np.uint8).reshape(-1, 6)
    context = six.view(np.uint64).ravel()
    doc = _joined(table, "docs", np.int64)
    order = np.lexsort((doc, context, anchor))
    a, c, d = anchor[order], context[order], doc[order]
    new_anchor = np.concatenate([[True], a[1:] != a[:-1]])
    new_context = new_anchor | np.concatenate([[True], c[1:] != c[:-1]])
    at_anchor, at_context = np.flatnonzero(new_anchor), np.flatnonzero(new_context)
    sizes = np.diff(np.concatenate([at_anchor, [len(a)]]))
    alone = np.repeat(np.minimum.reduceat(d, at_anchor) == np.maximum.reduceat(d, at_anchor), sizes)
    kinds = np.repeat(np.add.reduceat(new_context.astype(np.int64), at_anchor), sizes)
    least = np.repeat(d[at_context], np.diff(np.concatenate([at_context, [len(a)]])))
    code = np.where(least < d, REMOVED, np.where(alone | (kinds == 1), SETTLED, np.where(kinds > many, SPREAD, OPEN)))
    codes = np.empty(len(a), np.uint8)
    codes[order] = code
    lengths = np.array([len(x) // 4 for x in table.column("anchors").to_pylist()])
    ends = np.cumsum(lengths)
    parts = [codes[e - n : e] for e, n in zip(ends, lengths)]
    # An open context has 76 bytes at most; a dealt-out one at most 27 strings, of 29 bytes as sent.
    asks = [int((LENGTH + _WIDTH - 1) * (x == OPEN).sum() + 29 * _WIDTH * (x == SPREAD).sum()) for x in parts]
    return pa.table({
        "chunk": table.column("chunk"), "shard": table.column("shard"),
        "codes": pa.array([x.tobytes() for x in parts], pa.binary()), "asks": pa.array(asks, pa.int64()),
    })


def _codes(chunk: _Chunk, answers: list | None, count: int) -> np.ndarray:
    """The code of each distinct context of a chunk."""
    code = np.zeros(len(chunk.first), np.uint8)
    got = {a["shard"]: a["codes"] for a in answers or []}
    for shard, part in chunk.shards(count):
        code[part] = np.frombuffer(got[shard], np.uint8)
    return code


def _send_open(sent: int, count: int):
    """Open contexts as bytes; strings of anchors with very many contexts by their hash."""

    def run(batches):
        for batch in batches:
            for row, chunk in _rows(batch):
                code = _codes(chunk, row["answers"].as_py(), sent)
                number = row["chunk"].as_py()
                out = []
                open_ = np.flatnonzero(code == OPEN)
                mixed = mix64(chunk.anchor[chunk.first[open_]])
                shard = (mixed % np.uint64(count)).astype(np.int64)
                drawer = (mixed // np.uint64(count) % np.uint64(DRAWERS)).astype(np.uint8)
                for s, part in _split(shard):
                    entries = open_[part]
                    at = chunk.first[entries]
                    low, high = chunk.low[at], chunk.high[at]
                    data = b"".join(chunk.flat[a : b + LENGTH].tobytes() for a, b in zip(low, high))
                    out.append((s, number, entries.astype(np.uint32).tobytes(), (high - low + LENGTH).astype(np.uint8).tobytes(),
                                chunk.ids[chunk.doc[at]].tobytes(), drawer[part].tobytes(), data))
                entries = np.flatnonzero(code == SPREAD)
                if len(entries):
                    at = chunk.first[entries]
                    n = chunk.high[at] - chunk.low[at] + 1
                    place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    start = np.repeat(chunk.low[at], n) + place
                    owner, doc = np.repeat(entries, n), chunk.ids[np.repeat(chunk.doc[at], n)]
                    strings = np.lib.stride_tricks.sliding_window_view(chunk.flat, LENGTH)[start].astype(np.uint64)
                    keys = [mix64((strings * _power(base, LENGTH)).sum(1, dtype=np.uint64)) for base in (_PRIME, _INVERSE)]
                    for s, part in _split((keys[0] % np.uint64(count)).astype(np.int64)):
                        out.append((count + s, number, owner[part].astype(np.uint32).tobytes(), place[part].astype(np.uint8).tobytes(),
                                    doc[part].tobytes(), b"", np.stack([k[part] for k in keys], 1).tobytes()))
                columns = list(zip(*out)) if out else [[]] * 7
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
                     *[pa.array(c, pa.binary()) for c in columns[2:]]],
                    ["shard", "chunk", "entries", "sizes", "docs", "drawers", "data"])

    return run


def _later(doc: np.ndarray, new: np.ndarray) -> np.ndarray:
    """Which of the strings, in their order, start in a smaller document too; ``new``: where another string begins."""
    least = np.minimum.reduceat(doc, new) if len(new) else doc
    return np.repeat(least, np.diff(np.concatenate([new, [len(doc)]]))) < doc


def _emptied(answer):
    """An answer to a shard, after which the memory it took is given back."""

    def run(table: pa.Table) -> pa.Table:
        try:
            return answer(table)
        finally:
            give_back()

    return run


def _answer_open(count: int):
    def run(table: pa.Table) -> pa.Table:
        entries = _joined(table, "entries", np.uint32)
        doc = _joined(table, "docs", np.int64)
        lengths = np.array([len(x) // 4 for x in table.column("entries").to_pylist()])
        origin = np.repeat(np.arange(len(lengths)), lengths)
        sizes = _joined(table, "sizes", np.uint8)
        if table.column("shard")[0].as_py() < count:
            data = b"".join(table.column("data").to_pylist())
            drawers = _joined(table, "drawers", np.uint8)
            ends = np.cumsum(sizes.astype(np.int64))
            found = []
            for _, part in _split(drawers):  # equal strings have one anchor, so they lie in one drawer
                pieces = [data[e - n : e] for e, n in zip(ends[part].tolist(), sizes[part].tolist())]
                piece, place, new = equal_prefixes(pieces, LENGTH)
                piece = part[piece]
                hit = _later(doc[piece], new)
                found.append((piece[hit], place[hit]))
            piece, place = (np.concatenate(x) for x in zip(*found))
        else:
            keys = _joined(table, "data", np.uint64).reshape(-1, 2)
            piece = np.lexsort((keys[:, 1], keys[:, 0]))
            place = sizes[piece].astype(np.int64)
            sorted_ = keys[piece]
            new = np.flatnonzero(np.concatenate([[True], (sorted_[1:] != sorted_[:-1]).any(1)]))
            hit = _later(doc[piece], new)
            piece, place = piece[hit], place[hit]
        out = []
        for i, part in _split(origin[piece]):
            out.append((table.column("chunk")[i].as_py(), entries[piece[part]].tobytes(), place[part].astype(np.uint8).tobytes()))
        columns = list(zip(*out)) if out else [[]] * 3
        return pa.table({"chunk": pa.array(columns[0], pa.int64()), "entries": pa.array(columns[1], pa.binary()),
                         "places": pa.array(columns[2], pa.binary())})

    return run


# -- removal -------------------------------------------------------------------


def _as_text(bytes_: pa.Array, removed: np.ndarray) -> pa.Array:
    """Strings; bytes of a character that was cut through are left out."""
    if not removed.any():
        return bytes_.cast(pa.string())
    return pa.array([x.decode(errors="ignore") for x in bytes_.to_pylist()], pa.string())


def _cut(count: int, as_text: bool):
    def run(batches):
        for batch in batches:
            for row, chunk in _rows(batch):
                covered = _covered(chunk, row, count)
                keep = ~covered
                kept = np.concatenate([[0], np.cumsum(keep)])[chunk.offsets]
                begins = covered.copy()
                begins[1:] &= ~covered[:-1]
                inside = chunk.offsets[:-1][np.diff(chunk.offsets) > 0]
                begins[inside] = covered[inside]
                spans = np.concatenate([[0], np.cumsum(begins)])[chunk.offsets]
                data = chunk.flat[keep]
                n = len(chunk.ids)
                bytes_ = pa.Array.from_buffers(
                    pa.large_binary(), n, [None, pa.py_buffer(kept.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])
                size = np.diff(chunk.offsets)
                removed = size - np.diff(kept)
                bytes_ = _as_text(bytes_, removed) if as_text else bytes_.cast(pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [row["rows"].values, row["ids"].values, pa.array(size), pa.array(removed),
                     pa.array(np.diff(spans)), bytes_],
                    ["row", "id", "n_bytes", "n_removed", "n_spans", "kept"])

    return run


def _covered(chunk: _Chunk, row: dict, count: int) -> np.ndarray:
    """Which bytes go."""
    code = _codes(chunk, row["answers"].as_py(), count)
    # A context that an earlier document of the chunk has: all its strings go.
    later = chunk.ids[chunk.doc] > chunk.ids[chunk.doc[chunk.first[chunk.which]]]
    whole = later | (code[chunk.which] == REMOVED)
    depth = np.zeros(len(chunk.flat) + 1, np.int32)
    np.add.at(depth, chunk.low[whole], 1)
    np.add.at(depth, chunk.high[whole] + LENGTH, -1)
    masks = np.zeros(len(chunk.first), np.uint32)
    for part in row["parts"].as_py() or []:
        entries, places = np.frombuffer(part["entries"], np.uint32), np.frombuffer(part["places"], np.uint8)
        np.bitwise_or.at(masks, entries, np.uint32(1) << places.astype(np.uint32))
    some = np.flatnonzero(~whole & (masks[chunk.which] > 0))
    for place in range(_WIDTH):
        at = chunk.low[some[(masks[chunk.which[some]] >> np.uint32(place)) & 1 == 1]] + place
        np.add.at(depth, at, 1)
        np.add.at(depth, at + LENGTH, -1)
    return np.cumsum(depth[:-1]) > 0


def _shards(least: int, bytes_: DataFrame, size: int) -> int:
    """As many as the sum of the one column asks for."""
    return max(least, -(-(bytes_.agg(F.sum(bytes_.columns[0])).first()[0] or 0) // size))


class Repeats:
    """The removal of repeated passages from one table."""

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", many: int = MANY):
        self.spark = spark = docs.sparkSession
        self.work = work = Work(spark)
        self.columns, self.id_col, self.text_col = docs.columns, id_col, text_col
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        others = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
        source = docs.select(
            F.col(id_col).cast("long").alias("id"),
            F.struct(*others, F.lit(True).alias("_row_there"), F.col(text_col).isNull().alias("_no_text")).alias("row"),
            text_bytes(text_col).alias("text"),
        )
        fields = (
            StructType().add("chunk", LongType()).add("ids", ArrayType(LongType())).add("sizes", ArrayType(LongType()))
            .add("rows", ArrayType(source.schema["row"].dataType)).add("data", BinaryType())
        )
        name = f"mailsift_chunks_{uuid.uuid4().hex}"
        (source.mapInArrow(giving_back(_pack), fields).write.bucketBy(buckets, "chunk").format("parquet")
         .option("path", f"{work.root}/chunks").saveAsTable(name))
        self.chunks = spark.table(name)
        total = self.chunks.select(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x))
        self.count = count = _shards(buckets, total, SHARD_BYTES)
        read = self.chunks.select("chunk", "ids", "sizes", "data")
        sent = read.mapInArrow(giving_back(_send_contexts(count)), "shard long, chunk long, anchors binary, contexts binary, docs binary")
        codes = sent.groupBy("shard").applyInArrow(_emptied(_answer_contexts(many)), "chunk long, shard long, codes binary, asks long")
        # One row per chunk: as many bytes as the chunk has contexts.
        self.answers = work.keep(
            codes.groupBy("chunk").agg(F.collect_list(F.struct("shard", "codes")).alias("answers"), F.sum("asks").alias("asks"))
        )
        self.open_count = _shards(buckets, self.answers.select("asks"), OPEN_BYTES)
        self.answers = self.answers.drop("asks")
        open_ = read.join(self.answers, "chunk", "left").mapInArrow(
            giving_back(_send_open(count, self.open_count)), "shard long, chunk long, entries binary, sizes binary, docs binary, drawers binary, data binary")
        hits = open_.groupBy("shard").applyInArrow(_emptied(_answer_open(self.open_count)), "chunk long, entries binary, places binary")
        self.parts = work.keep(hits.groupBy("chunk").agg(F.collect_list(F.struct("entries", "places")).alias("parts")))
        self.rows_type = source.schema["row"].dataType
        spark.sql(f"DROP TABLE {name}")  # the name; the files stay

    def result(self, as_text: bool = False) -> DataFrame:
        """Per document: row (its other columns), id, n_bytes, n_removed, n_spans, kept (bytes or text)."""
        fields = (
            StructType().add("row", self.rows_type).add("id", LongType()).add("n_bytes", LongType())
            .add("n_removed", LongType()).add("n_spans", LongType()).add("kept", StringType() if as_text else BinaryType())
        )
        joined = self.chunks.join(self.answers, "chunk", "left").join(self.parts, "chunk", "left")
        return joined.mapInArrow(giving_back(_cut(self.count, as_text)), fields)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with their repeated passages cut out, same columns.

    Bytes of a character that was cut through go with the passage. ``n_chars``,
    where there is such a column, is the new length; a null text stays null.
    """
    text = F.when(~F.col("row._no_text"), F.col("kept"))
    kinds = dict(docs.dtypes)

    def column(name: str):
        if name == text_col:
            return text.alias(name)
        if name == "n_chars":
            return F.length("kept").cast(kinds[name]).alias(name)
        return F.col(f"row.`{name}`").alias(name)

    return Repeats(docs, id_col, text_col).result(as_text=True).select(*[column(c) for c in docs.columns])
