"""Near-duplicate vectors by PCA-ordered tiled comparison.

Unit vectors are turned onto the principal axes of the corpus, the largest
first. A grid over the leading axes deals them out; within a cell, blocks of about a
megabyte. Blocks that follow each other in the grid make a group of some megabytes,
and each pair of groups whose bounding boxes are near enough goes to one task, so a
vector travels once for each group near its own. In the task, tiles are the pairs of
blocks whose boxes are near. In a tile, products accumulate over the leading
dimensions first, in single precision; what the rest can add is bounded by the
product of the suffix norms, and pairs that cannot reach the threshold any more are
dropped from stage to stage. Survivors are decided by the cosine of the original
vectors in double precision.

A pair of groups gives counts of links by vector, and each one's root among what its
links connect; links themselves are never listed. So a cluster that holds a third of
all vectors makes many tiles of equal size, and no large row.

Each pair of vectors in groups that are near is met once, so the time grows with the
square of the table where the boxes tell nothing apart; memory does not grow, and
what is shuffled is the table times the number of groups.

Defined cases: see ``vectors.usable``; vectors left out have no link and are
their own component (null ids: null component, not kept); rows with one id count
as one vector; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mailsift.llm.common import Work, give_back
from mailsift.llm.components import components
from mailsift.llm.vectors import LARGE_ROWS, matrix, usable

SIMILAR = 0.95
GROUP_BYTES = 16 << 20  # of the vectors of a group
BLOCK_BYTES = 1 << 20  # of those of a block
_LEAST_ROWS = 1024  # of a group, so that little data is not cut to pieces
_AXES, _CELL = 3, 0.25  # of the grid: at most 9 ** 3 cells
_STAGES = (16, 32)  # leading dimensions after which pairs are dropped
_ROWS = 512  # rows of a tile compared at once
_SLACK = 1e-5  # for the rounding of the turned vectors, which are single
_FEW_GROUPS = 500  # whose pairs are broadcast


def _axes(vectors: DataFrame, width: int) -> np.ndarray:
    """Principal axes of the unit vectors, the largest first; sums of products by task."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            x = _unit(matrix(batch.column("vector"), width))
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width * width)), pa.array(total.ravel())], ["place", "value"])

    rows = vectors.select("vector").mapInArrow(sums, "place long, value double").groupBy("place").agg(F.sum("value").alias("value")).collect()
    moment = np.zeros(width * width)
    for row in rows:
        moment[row.place] = row.value
    moment = moment.reshape(width, width)
    return np.linalg.eigh((moment + moment.T) / 2)[1][:, ::-1]


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def links(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", similar: float = SIMILAR):
    """Tables (id, links) and (a, b) of a forest of the links."""
    work = Work(rows.sparkSession)
    vectors, width = usable(rows, id_col, vector_col, work)
    if not width:
        empty = vectors.select("id")
        return work, empty.select("id", F.lit(0).cast("long").alias("links")), empty.select(F.col("id").alias("a"), F.col("id").alias("b"))
    turn = _axes(vectors, width)
    reach = float(np.sqrt(max(2 - 2 * similar, 0)) + 1e-6)
    axes = min(_AXES, width)
    single = isinstance(getattr(rows.schema[vector_col].dataType, "elementType", None), T.FloatType)
    kind = np.dtype(np.float32 if single else np.float64)  # as they came, so nothing is lost

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("vector"), width)
            side = np.clip(np.floor((_unit(x) @ turn[:, :axes]) / _CELL) + 4, 0, 8).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(side @ (9 ** np.arange(axes, dtype=np.int32))[::-1], pa.int32()),
                 pa.array([r.tobytes() for r in x.astype(kind)], pa.binary())], ["id", "cell", "vector"])

    placed = work.keep(vectors.mapInArrow(place, "id long, cell int, vector binary"))
    cores = rows.sparkSession.sparkContext.defaultParallelism
    total = placed.count()
    fair = -(-total // int(np.ceil(np.sqrt(8 * cores))))  # pairs enough for all cores
    most = max(1, GROUP_BYTES // (kind.itemsize * width))
    group_rows = min(most, max(fair, _LEAST_ROWS))
    block_rows = min(group_rows, max(1, BLOCK_BYTES // (kind.itemsize * width)))
    groups = -(-total // group_rows)
    blocks_here = F.ceil(F.col("rows") / F.lit(block_rows))
    before = F.sum("rows").over(Window.orderBy("cell")) - F.col("rows")  # of a few hundred cells
    cells = placed.groupBy("cell").agg(F.count("*").alias("rows")).withColumn("before", before)
    dealt = placed.join(F.broadcast(cells), "cell").withColumn("block", F.pmod(F.xxhash64("id"), blocks_here).cast("int"))
    first = F.col("before") + F.floor(F.col("block") * F.col("rows") / blocks_here)
    dealt = dealt.withColumn("group", F.floor(first / F.lit(group_rows)).cast("int"))

    def pack(table: pa.Table) -> pa.Table:
        raw = b"".join(table.column("vector").to_pylist())
        y = _unit(_doubles(raw, kind, width)) @ turn
        return pa.table({
            "group": table.column("group").slice(0, 1),
            "low": pa.array([y.min(0).tolist()], pa.list_(pa.float64())), "high": pa.array([y.max(0).tolist()], pa.list_(pa.float64())),
            "ids": pa.array([table.column("id").to_numpy().tobytes()], pa.binary()), "vectors": pa.array([raw], pa.binary())})

    blocks = work.keep(
        dealt.groupBy("cell", "block", "group").applyInArrow(
            pack, "group int, low array<double>, high array<double>, ids binary, vectors binary"),
        **LARGE_ROWS)
    pairs = work.keep(_near_groups(blocks, reach))
    # Blocks are small on disk where vectors repeat, which must not make Spark send them to the driver.
    pairs = F.broadcast(pairs) if groups <= _FEW_GROUPS else pairs.hint("merge")
    sent = blocks.select("group", "ids", "vectors").join(pairs, "group").repartition(max(cores, min(groups * groups, 4096)), "a", "b")

    def compare(key: tuple, table: pa.Table) -> pa.Table:
        a, b = (k.as_py() for k in key)
        try:
            return _compared(table, a, b, turn, kind, similar, reach)
        finally:
            give_back()

    found = work.keep(sent.groupBy("a", "b").applyInArrow(compare, "id long, links long, root long"))
    counts = found.groupBy("id").agg(F.sum("links").alias("links"))
    return work, counts, found.select(F.col("id").alias("a"), F.col("root").alias("b"))


def _near_groups(blocks: DataFrame, reach: float) -> DataFrame:
    """Pairs (a, b) of groups whose boxes lie within reach, a <= b, once for each ``group`` of the two."""
    sides = blocks.select("group", F.posexplode(F.arrays_zip("low", "high")).alias("axis", "side"))
    sides = sides.groupBy("group", "axis").agg(F.min("side.low").alias("low"), F.max("side.high").alias("high"))
    boxes = sides.groupBy("group").agg(F.array_sort(F.collect_list(F.struct("axis", "low", "high"))).alias("box"))
    a = boxes.select(F.col("group").alias("a"), F.col("box").alias("box_a"))
    b = boxes.select(F.col("group").alias("b"), F.col("box").alias("box_b"))
    gap = F.zip_with("box_a", "box_b", lambda x, y: F.greatest(x["low"] - y["high"], y["low"] - x["high"], F.lit(0.0)))
    apart = F.aggregate(gap, F.lit(0.0), lambda total, x: total + x * x)
    near = a.join(b, (F.col("a") <= F.col("b")) & (apart <= reach * reach)).select("a", "b")
    return near.select("a", "b", F.explode(F.array_distinct(F.array("a", "b"))).alias("group"))


def _doubles(raw: bytes, kind: np.dtype, width: int) -> np.ndarray:
    return np.frombuffer(raw, kind).reshape(-1, width).astype(float)


class _Block:
    """Some vectors: as they came, and turned, with the norms of what follows each stage."""

    def __init__(self, ids: bytes, raw: bytes, turn: np.ndarray, kind: np.dtype, nodes: np.ndarray):
        width = len(turn)
        self.raw = np.frombuffer(raw, kind).reshape(-1, width)
        self.nodes = np.searchsorted(nodes, np.frombuffer(ids, np.int64))
        x = _doubles(raw, kind, width)
        self.most = np.abs(x).max(1, keepdims=True)
        x /= self.most
        self.norm = np.linalg.norm(x, axis=1, keepdims=True)
        y = (x / self.norm) @ turn
        self.low, self.high = y.min(0), y.max(0)
        stages = [s for s in _STAGES if s < width] or [width]
        self.parts = [y[:, s:t].astype(np.float32) for s, t in zip([0, *stages], stages)]
        self.rests = [np.linalg.norm(y[:, s:], axis=1).astype(np.float32) for s in stages]
        # The bound of the first stage is one product: the suffix norm stands as one more dimension.
        self.lead = np.column_stack([self.parts[0], self.rests[0]])

    def units(self, rows) -> np.ndarray:
        return self.raw[rows].astype(float) / self.most[rows] / self.norm[rows]


def _compared(table: pa.Table, a: int, b: int, turn: np.ndarray, kind: np.dtype, similar: float, reach: float) -> pa.Table:
    """Links of each vector of two groups (or one), and its root among what these connect."""
    group = table.column("group").to_numpy()
    ids = [np.frombuffer(x.as_py(), np.int64) for x in table.column("ids")]
    nodes = np.sort(np.concatenate(ids))
    made = [_Block(i, v.as_py(), turn, kind, nodes) for i, v in zip(ids, table.column("vectors"))]
    left, right = ([n for n in range(len(made)) if group[n] == side] for side in (a, b))
    count, root = np.zeros(len(nodes), np.int64), np.arange(len(nodes))
    for m in left:
        for n in right:
            if a == b and n < m:
                continue
            x, y = made[m], made[n]
            gap = np.maximum(np.maximum(x.low - y.high, y.low - x.high), 0)
            if gap @ gap > reach * reach:
                continue
            for start in range(0, len(x.raw), _ROWS):
                i, j = _linked(x, y, slice(start, min(start + _ROWS, len(x.raw))), m == n, similar)
                if len(i):
                    u, v = x.nodes[i], y.nodes[j]
                    count += np.bincount(u, minlength=len(nodes)) + np.bincount(v, minlength=len(nodes))
                    root = _joined(root, u, v)
    some = count > 0
    return pa.table({"id": pa.array(nodes[some]), "links": pa.array(count[some]), "root": pa.array(nodes[root[some]])})


def _linked(x: _Block, y: _Block, part: slice, same: bool, similar: float):
    """Places in two blocks of the pairs that reach the threshold, of some rows of the first."""
    least = np.float32(similar - _SLACK)
    i, j = np.divmod(np.flatnonzero(x.lead[part] @ y.lead.T >= least), len(y.raw))
    i += part.start
    if same:
        i, j = i[i < j], j[i < j]
    if len(x.parts) > 1 and 4 * len(i) < (part.stop - part.start) * len(y.raw):
        for k in range(1, len(x.parts)):
            so_far = sum(_products(lambda r, n=n: x.parts[n][r], lambda r, n=n: y.parts[n][r], i, j) for n in range(k + 1))
            on = so_far + x.rests[k][i] * y.rests[k][j] >= least
            i, j = i[on], j[on]
    if 4 * len(i) > (part.stop - part.start) * len(y.raw):  # most are left: all at once
        products = (x.units(part) @ y.units(slice(None)).T)[i - part.start, j]
    else:
        products = _products(x.units, y.units, i, j)
    linked = products >= similar
    return i[linked], j[linked]


def _products(x, y, i, j) -> np.ndarray:
    """Inner products of chosen pairs."""
    out = np.empty(len(i))
    for k in range(0, len(i), 1 << 14):
        p = slice(k, k + (1 << 14))
        out[p] = np.einsum("nd,nd->n", x(i[p]), y(j[p]))
    return out


def _joined(root: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Roots (the least node of what hangs together) when these links come in."""
    while True:
        apart = root[u] != root[v]
        u, v = u[apart], v[apart]
        if not len(u):
            return root
        least = np.minimum(root[u], root[v])
        np.minimum.at(root, root[u], least)
        np.minimum.at(root, root[v], least)
        while (root[root] != root).any():
            root = root[root]


def near_duplicates(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", similar: float = SIMILAR) -> DataFrame:
    """One row per vector: id, n_links, component_id (least id reachable by links), kept."""
    work, counts, forest = links(rows, id_col, vector_col, similar)
    roots = components(forest, work)
    ids = rows.select(F.col(id_col).cast("long").alias("id"))
    out = ids.join(counts, "id", "left").join(roots.withColumnRenamed("node", "id"), "id", "left")
    component = F.coalesce("root", "id")
    return out.select(
        F.col("id").alias(id_col), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))
