"""Near-duplicate documents by DartMinHash.

A document is a weighted set: its shingles of five words, each with the number
of times it occurs. Every unit of weight of a shingle is a region into which
hashed darts fall, at ranks that depend on the shingle alone. Darts up to a
rank that leaves about ``k (ln k + 2)`` of them per document are thrown; each
belongs to one of ``k`` coordinates, and the earliest of a coordinate is the
document's signature there (documents with an empty coordinate get twice the
darts). Two signatures agree at a coordinate with the probability of their
weighted Jaccard similarity. Six coordinates make a band; documents that agree
in one of 24 bands are candidates: a pair of similarity 0.8 is missed with
probability 0.0007.

Candidates are compared exactly on their whole weighted sets. Within a bucket
every text is first compared with one other, then, where this leaves it in
another component, with the text that has been found alike to others most
often, and last with all of the bucket from which it is still apart. So a group
of near copies costs its size, not its square, and no link that joins two
groups is lost.

Copies are one node: texts are grouped by their md5 before any bucket forms.

Defined cases: words are runs of anything but the six ASCII white space
characters; fewer than five words make one shingle; texts without words (null
and empty ones too) are near duplicates only of the very same text; rows with
one id and several texts are several documents; null ids are kept and come last.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, LongType, StructType

from mailsift.llm.common import Work, flat_text, giving_back, mix64, steps, text_bytes
from mailsift.llm.components import components

WORDS = 5
SIMILAR = 0.8
BANDS, ROWS = 24, 6
BLOCK = 256  # texts of a bucket that meet others at once

_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
_PRIME = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
_INVERSE = pow(_PRIME, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    known = _powers.get(base)
    if known is None or len(known) < n:
        factors = np.full(max(n, 1 << 16), base, np.uint64)
        factors[0] = 1
        known = _powers[base] = np.cumprod(factors)
    return known[:n]


def word_hashes(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of all texts, and how many words each text has."""
    n = len(flat)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(offsets) - 1, np.int64)
    word = ~_WHITE[flat]
    edge = np.zeros(n + 1, bool)  # a text begins here
    edge[offsets] = True
    before = np.concatenate([[False], word])
    after = np.concatenate([word, [False]])
    starts = np.flatnonzero(after & (~before | edge))
    ends = np.flatnonzero(before & (~after | edge))
    sums = np.concatenate([[np.uint64(0)], np.cumsum((flat.astype(np.uint64) + np.uint64(1)) * _power(_PRIME, n))])
    hashes = mix64((sums[ends] - sums[starts]) * _power(_INVERSE, n)[starts])
    return hashes, np.diff(np.searchsorted(starts, offsets))


def shingles(flat: np.ndarray, offsets: np.ndarray, width: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each shingle of all texts, and how many each text has."""
    words, counts = word_hashes(flat, offsets)
    total = len(words)
    padded = np.concatenate([words, np.zeros(width, np.uint64)])
    doc = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)
    left = counts[doc] - place  # words from here to the end of the text
    hashes = np.zeros(total, np.uint64)
    for j in range(width):
        part = mix64(padded[j : j + total] + np.uint64(j * 0x632BE59BD9B4E019 % (1 << 64)))
        hashes += np.where(left > j, part, np.uint64(0))
    keep = (left >= width) | (place == 0)
    return mix64(hashes[keep]), np.bincount(doc[keep], minlength=len(counts))


def regions(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """One hash for each unit of weight: the m-th copy of a shingle in a text is its own region."""
    doc = np.repeat(np.arange(len(counts)), counts)
    order = np.lexsort((hashes, doc))
    h, d = hashes[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    at = np.flatnonzero(new)
    copy = np.arange(len(h)) - np.repeat(at, np.diff(np.concatenate([at, [len(h)]])))
    return mix64(h + copy.astype(np.uint64) * np.uint64(0xD1342543DE82EF95))


def dart_signatures(cells: np.ndarray, counts: np.ndarray, k: int, part: np.ndarray | None = None) -> np.ndarray:
    """Signatures (texts x k). ``cells`` are the regions of all texts end to end;
    ``part`` is the share of each region that belongs to the text (1 if not given)."""
    out = np.zeros((len(counts), k), np.uint64)
    doc = np.repeat(np.arange(len(counts)), counts)
    weight = np.bincount(doc, part, len(counts)) if part is not None else counts.astype(float)
    todo = np.flatnonzero(weight > 0)
    darts = k * (np.log(k) + 2)
    while len(todo):
        chosen = np.zeros(len(counts), bool)
        chosen[todo] = True
        use = chosen[doc]
        reach = np.zeros(len(counts))
        reach[todo] = darts / weight[todo]
        filled = _throw(cells[use], doc[use], None if part is None else part[use], reach, k, out, todo)
        todo = todo[~filled]
        darts *= 2
    return out


def _throw(cell, doc, part, reach, k, out, todo) -> np.ndarray:
    rank = np.zeros(len(cell))
    slots, ranks, darts = [], [], []
    number = 0
    while len(cell):
        number += 1
        dart = mix64(cell + np.uint64(number * _PRIME % (1 << 64)))
        rank = rank - np.log(((dart >> np.uint64(11)).astype(float) + 0.5) * 2.0**-53)
        near = rank <= reach[doc]
        cell, doc, rank, dart = cell[near], doc[near], rank[near], dart[near]
        where = mix64(dart ^ np.uint64(0xA0761D6478BD642F))
        slot = doc * k + ((where >> np.uint64(32)) * np.uint64(k) >> np.uint64(32)).astype(np.int64)
        if part is not None:
            part = part[near]
            inside = (where & np.uint64(0xFFFFFFFF)).astype(float) * 2.0**-32 < part
            slots.append(slot[inside]), ranks.append(rank[inside]), darts.append(dart[inside])
        else:
            slots.append(slot), ranks.append(rank), darts.append(dart)
    slot, rank, dart = np.concatenate(slots), np.concatenate(ranks), np.concatenate(darts)
    first = np.full(out.size, np.inf)
    np.minimum.at(first, slot, rank)
    won = rank == first[slot]
    out.reshape(-1)[slot[won]] = dart[won]
    return np.isfinite(first.reshape(out.shape)[todo]).all(1)


def band_hashes(signatures: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    parts = signatures.reshape(len(signatures), bands, rows)
    mixed = np.zeros(parts.shape[:2], np.uint64) + np.arange(bands, dtype=np.uint64)
    for j in range(rows):
        mixed = mix64(mixed * np.uint64(_PRIME) + parts[:, :, j])
    return mixed


def _list_array(values: pa.Array, counts: np.ndarray) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in steps(batches, "text"):
        hashes, counts = shingles(*flat_text(batch.column("text")))
        found = band_hashes(dart_signatures(regions(hashes, counts), counts, BANDS * ROWS))
        per_text = np.where(counts > 0, BANDS, 0)
        values = pa.array(found[counts > 0].ravel().view(np.int64))
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("key"), _list_array(values, per_text)], ["id", "key", "bands"]
        )


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text's regions as sorted 32-bit hashes: sets whose Jaccard similarity is the weighted one."""
    for batch in steps(batches, "text"):
        hashes, counts = shingles(*flat_text(batch.column("text")))
        cells = (regions(hashes, counts) >> np.uint64(32)).astype(np.uint32)
        ends = np.cumsum(counts)
        blobs = [np.sort(cells[e - c : e]).tobytes() for c, e in zip(counts, ends)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("key"), batch.column("bands"), pa.array(blobs, pa.binary())], ["key", "bands", "cells"])


def _similarity(x: np.ndarray, y: np.ndarray) -> float:
    both = np.sort(np.concatenate([x, y]), kind="stable")
    shared = int((both[1:] == both[:-1]).sum())
    return shared / (len(both) - shared) if len(both) else 0.0


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        similar = [
            _similarity(np.frombuffer(left.as_buffer(), np.uint32), np.frombuffer(right.as_buffer(), np.uint32))
            for left, right in zip(batch.column("left_cells"), batch.column("right_cells"))
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column("a"), batch.column("b"), pa.array(similar, pa.float64())], ["a", "b", "similarity"]
        )


def _pack(table: pa.Table) -> pa.Table:
    """The texts of a bucket's block in one row."""
    out = {name: table.column(name).slice(0, 1) for name in ("bucket", "block")}
    for name in ("key", "root", "cells"):
        values = table.column(name).combine_chunks()
        out[f"{name}s"] = pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
    bands = np.asarray(table.column("bands").combine_chunks().flatten(), np.int64)
    return pa.table(out | {"bands": pa.array([bands.tobytes()], pa.binary())})


def _meet(similar: float):
    """Compare the texts of two blocks of a bucket; give a forest of their links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple[bytes, bytes]] = []
            for i in range(batch.num_rows):
                found += _tile({name: batch.column(name)[i].as_py() for name in batch.schema.names}, similar)
            a, b = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])

    return run


def _tile(tile: dict, similar: float) -> list[tuple[bytes, bytes]]:
    x, y = (np.frombuffer(tile[f"{side}_bands"], np.int64).reshape(-1, BANDS) for side in ("left", "right"))
    band = int((x[0] == tile["bucket"]).argmax())
    # Each pair is met in the first band that its texts share.
    met = np.zeros((len(x), len(y)), bool)
    for n in range(band):
        met |= x[:, n][:, None] == y[:, n]
    sets = [[np.frombuffer(c, np.uint32) for c in tile[f"{side}_cells"]] for side in ("left", "right")]
    size_x, size_y = (np.array([len(s) for s in side], float) for side in sets)
    low, high = np.minimum(size_x[:, None], size_y), np.maximum(size_x[:, None], size_y)
    open_ = ~met & (low >= similar * high)
    if tile["same"]:
        open_ &= np.arange(len(x))[:, None] < np.arange(len(y))
    home: dict[bytes, bytes] = {}

    def top(root: bytes) -> bytes:
        while (up := home.get(root, root)) != root:
            root = up
        return root

    links = []
    for i, j in zip(*np.nonzero(open_)):
        a, b = top(tile["left_roots"][i]), top(tile["right_roots"][j])
        if a != b and _similarity(sets[0][i], sets[1][j]) >= similar:
            home[max(a, b)] = min(a, b)
            links.append((tile["left_keys"][i], tile["right_keys"][j]))
    return links


def _pair(x: str, y: str) -> list:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _spokes(entries: DataFrame, other: str = "key") -> DataFrame:
    """Pairs of each bucket's text of highest rank and its others (of another component)."""
    hub = F.max_by(F.struct(F.col("key").alias("hub"), F.col(other).alias("hub_other")), "rank").alias("at")
    hubs = entries.groupBy("bucket").agg(hub).select("bucket", "at.hub", "at.hub_other")
    joined = entries.join(hubs, "bucket").where(F.col(other) != F.col("hub_other"))
    return joined.select(*_pair("key", "hub")).distinct()


def _standing(checked: DataFrame, similar: float) -> DataFrame:
    """How often a text was found similar to those it was compared with."""
    hit = (F.col("similarity") >= similar).cast("double").alias("hit")
    both = checked.select(F.col("a").alias("key"), hit).unionByName(checked.select(F.col("b").alias("key"), hit))
    return both.groupBy("key").agg(((F.sum("hit") + 1) / (F.count("*") + 2)).alias("standing"))


class NearDuplicates:
    """One search over a table of documents; its tables stay in the work folder."""

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similar: float = SIMILAR):
        self.work = Work(docs.sparkSession)
        self.similar = similar
        # The key is the text's md5; 16 bytes.
        self.texts = docs.select(
            F.col(id_col).cast("long").alias("id"), text_bytes(text_col).alias("text")
        ).withColumn("key", F.unhex(F.md5("text")))
        fields = StructType().add("id", LongType()).add("key", BinaryType()).add("bands", ArrayType(LongType()))
        self.signed = self.work.keep(self.texts.mapInArrow(giving_back(_sign), fields))
        self.links = self._links()

    def _links(self) -> DataFrame:
        keep = self.work.keep
        nodes = self.signed.groupBy("key").agg(F.first("bands").alias("bands"), F.min("id").alias("first"))
        entries = keep(nodes.select("key", F.explode("bands").alias("bucket")))
        several = (
            entries.groupBy("bucket").agg(F.min("key").alias("first"), F.max("key").alias("last"))
            .where(F.col("first") != F.col("last")).select("bucket")
        )
        shared = keep(entries.join(several, "bucket"))  # buckets of several texts
        fields = StructType().add("key", BinaryType()).add("bands", ArrayType(LongType())).add("cells", BinaryType())
        wanted = shared.select("key").distinct()
        # One row of each text that is a candidate; copies have gone by then.
        firsts = nodes.join(wanted, "key", "left_semi").select(F.col("key").alias("own_key"), "first", "bands")
        same = (F.col("key") == F.col("own_key")) & F.col("id").eqNullSafe(F.col("first"))
        self.cells = keep(
            self.texts.join(firsts, same).dropDuplicates(["key"]).select("key", "bands", "text").mapInArrow(giving_back(_cells), fields)
        )
        # First every text with a random one of each of its buckets, then with the
        # one that has proved most alike to others, then with all that are still apart.
        checked = keep(self._verify(_spokes(shared.withColumn("rank", F.xxhash64("bucket", "key")))))
        links = self._similar(checked)
        labelled = self._labelled(shared, links)
        if labelled.isEmpty():
            return links
        rank = F.struct(F.coalesce("standing", F.lit(0.0)), F.xxhash64("bucket", "key"))
        standing = labelled.join(_standing(checked, self.similar), "key", "left").withColumn("rank", rank)
        more = _spokes(standing, "root").join(checked.select("a", "b"), ["a", "b"], "left_anti")
        links = keep(links.unionByName(self._similar(self._verify(more))))
        labelled = self._labelled(labelled.select("bucket", "key"), links)
        return links if labelled.isEmpty() else links.unionByName(keep(self._rest(labelled)))

    def _similar(self, checked: DataFrame) -> DataFrame:
        return checked.where(F.col("similarity") >= self.similar).select("a", "b")

    def _rest(self, labelled: DataFrame) -> DataFrame:
        """Links between components within buckets: blocks of texts meet inside a task, pairs are not listed."""
        sizes = labelled.groupBy("bucket").agg(F.count("*").alias("rows"))
        block = F.pmod(F.xxhash64("key"), F.ceil(F.col("rows") / F.lit(BLOCK))).cast("int")
        rows = labelled.join(sizes, "bucket").withColumn("block", block).join(self.cells, "key")
        blocks = self.work.keep(rows.select("bucket", "block", "key", "root", "bands", "cells").groupBy("bucket", "block").applyInArrow(
            _pack, "bucket long, block int, keys array<binary>, roots array<binary>, cellss array<binary>, bands binary"))

        def side(name: str) -> DataFrame:
            parts = {"keys": "keys", "roots": "roots", "cellss": "cells", "bands": "bands"}
            return blocks.select("bucket", F.col("block").alias(f"{name}_block"), *[F.col(c).alias(f"{name}_{n}") for c, n in parts.items()])

        pairs = side("left").join(side("right"), "bucket").where("left_block <= right_block")
        return pairs.withColumn("same", F.expr("left_block = right_block")).mapInArrow(giving_back(_meet(self.similar)), "a binary, b binary")

    def _labelled(self, shared: DataFrame, links: DataFrame) -> DataFrame:
        """Entries with the component of their text, of buckets that still hold several components."""
        roots = components(links, self.work).withColumnRenamed("node", "key")
        rows = self.work.keep(
            shared.join(roots, "key", "left").select("bucket", "key", F.coalesce("root", "key").alias("root"))
        )
        apart = (
            rows.groupBy("bucket").agg(F.min("root").alias("first"), F.max("root").alias("last"))
            .where(F.col("first") != F.col("last")).select("bucket")
        )
        return self.work.keep(rows.join(apart, "bucket", "left_semi"))

    def _verify(self, pairs: DataFrame) -> DataFrame:
        left = self.cells.select(F.col("key").alias("a"), F.col("cells").alias("left_cells"))
        right = self.cells.select(F.col("key").alias("b"), F.col("cells").alias("right_cells"))
        fields = StructType().add("a", BinaryType()).add("b", BinaryType()).add("similarity", DoubleType())
        return pairs.join(left, "a").join(right, "b").mapInArrow(giving_back(_compare), fields)

    def classes(self) -> DataFrame:
        """One row per document: id, key, class_id (smallest id of its class), class_size, kept."""
        roots = components(self.links, self.work)
        keys = self.signed.groupBy("key").agg(F.min("id").alias("first"), F.count("*").alias("rows"))
        labelled = self.work.keep(
            keys.join(roots.withColumnRenamed("node", "key"), "key", "left")
            .select("key", "first", "rows", F.coalesce("root", "key").alias("root"))
        )
        order = F.struct(F.col("first").isNull(), F.col("first"), F.col("key"))
        least = labelled.groupBy("root").agg(F.min(order).alias("least"), F.sum("rows").alias("class_size"))
        by_key = labelled.join(least, "root").select(
            "key", F.col("least.first").alias("class_id"), F.col("least.key").alias("class_key"), "class_size"
        )
        rows = self.signed.select("id", "key").join(by_key, "key")
        kept = F.col("id").eqNullSafe(F.col("class_id")) & (F.col("key") == F.col("class_key"))
        return rows.select("id", "key", "class_id", "class_size", kept.alias("kept"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similar: float = SIMILAR) -> DataFrame:
    """One row per document: its id, class_id, class_size and whether it stays."""
    found = NearDuplicates(docs, id_col, text_col, similar).classes()
    return found.select(F.col("id").alias(id_col), "class_id", "class_size", "kept")


def without_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                            similar: float = SIMILAR) -> DataFrame:
    """The documents that stay, one of each class, with all their columns."""
    search = NearDuplicates(docs, id_col, text_col, similar)
    stay = search.work.keep(
        search.classes().where("kept").groupBy("id", "key").agg(F.count("*").alias("rows"))
        .select(F.col("id").alias("stay_id"), F.col("key").alias("stay_key"), "rows")
    )
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(id_col).cast("long").alias("own_id"),
        F.unhex(F.md5(text_bytes(text_col))).alias("own_key"),
    )
    joined = rows.join(stay, (F.col("own_key") == F.col("stay_key")) & F.col("own_id").eqNullSafe(F.col("stay_id")), "left_semi")
    if not stay.where("rows > 1").isEmpty():  # the same row several times
        joined = joined.dropDuplicates(["own_key", "own_id"])
    return joined.select("row.*")
