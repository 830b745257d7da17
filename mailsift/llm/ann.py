"""Nearest neighbours by a hierarchical k-means tree with best-bin-first search.

The tree is fitted on a bounded sample (``SAMPLE`` rows, by the hash of their
id) and every row is filed under a leaf. A query descends best bin first: a
priority queue holds the branches passed by, nearest centre first, and leaf after
leaf is opened until the number of visits is reached that calibration has set:
for a bounded set of queries the exact neighbours are found by brute force over
all rows, and visits are widened until the wanted share of them lies in the
leaves visited, or all leaves are.

Rows of a leaf lie in blocks of about a megabyte, and blocks of leaves that follow each
other make a shard. A query travels once to each shard that holds one of its leaves, with
their numbers, and meets every block of its leaves there. Blocks give each query's nearest,
exactly measured in double precision. Only tables bounded by the sample are broadcast.

Defined cases: see ``vectors.usable``; with fewer candidates than wanted all are
returned; ties go to the smaller id; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mailsift.llm.common import Work, give_back
from mailsift.llm.vectors import LARGE_ROWS, blob_matrix, matrix, usable

SAMPLE = 20_000  # rows the tree is fitted on
BRANCHES, LEAF = 8, 64  # branches of a node; sample rows below which a node is a leaf
PROBES = 64  # queries that calibrate the visits
RECALL = 0.97  # of their neighbours
QUERY_BLOCK = 512  # queries that meet a block at once
SHARD_BYTES = 32 << 20  # of rows one task holds
QUERY_BYTES = 4 << 20  # of queries that go to a shard together
_LEAST_ROWS = 1024  # of a shard, so that little data is not cut to pieces
BLOCK_BYTES = 1 << 20  # of rows that lie in one block
_HELD = 200_000  # neighbours a task holds before it narrows them down

_FOUND = "query_id long, vec_id long, score double"


@dataclass
class Tree:
    centres: np.ndarray  # of all nodes but the root
    children: list[list[int]]  # by node; node 0 is the root, node n has centre n - 1
    leaves: dict[int, int]  # node: number of the leaf

    def file(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row: nearest centre on the way down."""
        out = np.zeros(len(x), np.int64)
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if node in self.leaves:
                out[rows] = self.leaves[node]
                continue
            kids = self.children[node]
            nearest = _distances(x[rows], self.centres[[k - 1 for k in kids]]).argmin(1)
            for n, kid in enumerate(kids):
                part = rows[nearest == n]
                if len(part):
                    todo.append((kid, part))
        return out

    def visit(self, query: np.ndarray, most: int) -> list[int]:
        """Leaves, best bin first."""
        queue, out = [(0.0, 0)], []
        while queue and len(out) < most:
            _, node = heapq.heappop(queue)
            while node not in self.leaves:  # down to a leaf; branches passed by wait in the queue
                kids = self.children[node]
                far = ((self.centres[[k - 1 for k in kids]] - query) ** 2).sum(1)
                best = int(far.argmin())
                for n, kid in enumerate(kids):
                    if n != best:
                        heapq.heappush(queue, (float(far[n]), kid))
                node = kids[best]
            out.append(self.leaves[node])
        return out


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return (x * x).sum(1)[:, None] - 2 * x @ y.T + (y * y).sum(1)


def fit(sample: np.ndarray, seed: int = 7) -> Tree:
    rng = np.random.default_rng(seed)
    centres, children, leaves = [], [[]], {}
    todo = [(0, np.arange(len(sample)))]
    while todo:
        node, rows = todo.pop()
        parts = _split(sample[rows], rng) if len(rows) > LEAF else None
        if parts is None:
            leaves[node] = len(leaves)
            continue
        for centre, member in parts:
            centres.append(centre)
            children.append([])
            children[node].append(len(centres))
            todo.append((len(centres), rows[member]))
    width = sample.shape[1]
    return Tree(np.array(centres).reshape(-1, width), children, leaves)


def _split(x: np.ndarray, rng) -> list | None:
    """k-means; nothing if the rows are all alike."""
    centres = x[rng.choice(len(x), BRANCHES, replace=False)]
    for _ in range(12):
        owner = _distances(x, centres).argmin(1)
        used = np.unique(owner)
        centres = np.array([x[owner == k].mean(0) for k in used])
    owner = _distances(x, centres).argmin(1)
    used = np.unique(owner)
    return [(centres[k], np.flatnonzero(owner == k)) for k in used] if len(used) > 1 else None


class _Nearest:
    """Nearest candidates of many queries, narrowed down whenever too many are held."""

    def __init__(self, count: int):
        self.count, self.held, self.parts = count, 0, []

    def add(self, query_ids, queries, ids, x) -> None:
        """All rows ``x`` are candidates of all ``queries``."""
        far = np.maximum(_distances(queries, x), 0)
        n = min(self.count + 1, len(ids))  # one may be the query itself
        border = np.partition(far, n - 1, axis=1)[:, n - 1]
        rows, columns = np.nonzero(far <= (border * (1 + 1e-9) + 1e-9)[:, None])
        scores = np.sqrt(((queries[rows] - x[columns]) ** 2).sum(1))
        found = np.stack([query_ids[rows], ids[columns]], 1)
        other = found[:, 0] != found[:, 1]
        self.parts.append((found[other], scores[other]))
        self.held += len(scores)
        if self.held > _HELD:
            self.parts = [self.narrow()]
            self.held = len(self.parts[0][1])

    def narrow(self):
        found = np.concatenate([p[0] for p in self.parts]) if self.parts else np.zeros((0, 2), np.int64)
        scores = np.concatenate([p[1] for p in self.parts]) if self.parts else np.zeros(0)
        order = np.lexsort((found[:, 1], scores, found[:, 0]))
        found, scores = found[order], scores[order]
        first = np.flatnonzero(np.concatenate([[True], found[1:, 0] != found[:-1, 0]])) if len(found) else np.zeros(0, np.int64)
        place = np.arange(len(found)) - np.repeat(first, np.diff(np.concatenate([first, [len(found)]])))
        keep = place < self.count
        return found[keep], scores[keep]

    def batch(self) -> pa.RecordBatch:
        found, scores = self.narrow()
        return pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1]), pa.array(scores)], ["query_id", "vec_id", "score"])


def _merge(found: DataFrame, count: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)


def _probe(vectors: DataFrame, probes: np.ndarray, ids: np.ndarray, width: int, count: int) -> DataFrame:
    """Exact neighbours of a bounded number of queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Nearest(count)
        for batch in batches:
            best.add(ids, probes, batch.column("id").to_numpy(), matrix(batch.column("vector"), width))
        yield best.batch()

    return _merge(vectors.mapInArrow(run, _FOUND), count)


class Index:
    """The rows of a table, filed under the leaves of a tree."""

    def __init__(self, rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding"):
        self.work = work = Work(rows.sparkSession)
        self.vectors, self.width = usable(rows, id_col, vector_col, work)
        if not self.width:
            return
        width = self.width
        sample = self.vectors.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("vector").toArrow()
        self.tree = tree = fit(matrix(sample.column("vector").combine_chunks(), width))

        def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = matrix(batch.column("vector"), width)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), pa.array(tree.file(x)), pa.array([r.tobytes() for r in x], pa.binary())], ["id", "leaf", "vector"])

        self.filed = work.keep(self.vectors.mapInArrow(file, "id long, leaf long, vector binary"))
        sizes = self.filed.groupBy("leaf").agg(F.count("*").alias("rows"))  # as many as the tree has leaves
        cores = rows.sparkSession.sparkContext.defaultParallelism
        total = self.filed.count()
        shard_rows = min(max(1, SHARD_BYTES // (8 * width)), max(-(-total // (4 * cores)), _LEAST_ROWS))
        self.shards = -(-total // shard_rows)
        block_rows = min(shard_rows, max(1, BLOCK_BYTES // (8 * width)))
        sizes = sizes.withColumn("blocks", F.ceil(F.col("rows") / F.lit(block_rows)))
        sizes = sizes.withColumn("before", F.sum("rows").over(Window.orderBy("leaf")) - F.col("rows"))

        def shard(block) -> "F.Column":
            return F.floor((F.col("before") + F.floor(block * F.col("rows") / F.col("blocks"))) / F.lit(shard_rows)).cast("int")

        # Where the blocks of each leaf lie: the first and the last shard.
        self.places = work.keep(sizes.select("*", shard(F.lit(0)).alias("first"), shard(F.col("blocks") - 1).alias("last")))

        def pack(table: pa.Table) -> pa.Table:
            return pa.table({
                "leaf": table.column("leaf").slice(0, 1), "shard": table.column("shard").slice(0, 1),
                "ids": pa.array([table.column("id").to_numpy().tobytes()], pa.binary()),
                "rows": pa.array([b"".join(table.column("vector").to_pylist())], pa.binary())})

        dealt = self.filed.join(F.broadcast(self.places), "leaf")
        dealt = dealt.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")).withColumn("shard", shard(F.col("block")))
        self.blocks = work.keep(
            dealt.select("leaf", "block", "shard", "id", "vector").groupBy("leaf", "block", "shard").applyInArrow(
                pack, "leaf long, shard int, ids binary, rows binary"),
            **LARGE_ROWS)

    def calibrate(self, queries: DataFrame, count: int, recall: float = RECALL) -> int:
        """Leaves to visit, from the exact neighbours of some queries."""
        probes = queries.orderBy(F.xxhash64("id"), "id").limit(PROBES).toArrow()
        if not probes.num_rows:
            return 1
        ids, x = probes.column("id").to_numpy(), matrix(probes.column("vector").combine_chunks(), self.width)
        exact = _probe(self.vectors, x, ids, self.width, count)
        homes = self.filed.select(F.col("id").alias("vec_id"), "leaf").join(F.broadcast(exact), "vec_id").select("query_id", "leaf").collect()
        place = {int(q): {leaf: n for n, leaf in enumerate(self.tree.visit(v, len(self.tree.leaves)))} for q, v in zip(ids, x)}
        needed = np.sort([place[row.query_id][row.leaf] + 1 for row in homes])
        if not len(needed):
            return 1
        return int(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))))])

    def search(self, wanted, count: int = 10, recall: float = RECALL) -> DataFrame:
        """(query_id, rank, vec_id, score) of the rows whose id meets ``wanted``, a condition on ``id``."""
        if not self.width:
            return self.vectors.select(F.col("id").alias("query_id"), F.lit(0).alias("rank"), F.col("id").alias("vec_id"), F.lit(0.0).alias("score"))
        queries = self.vectors.where(wanted)
        visits, tree, width = self.calibrate(queries, count, recall), self.tree, self.width

        spans = {row.leaf: range(row.first, row.last + 1) for row in self.places.select("leaf", "first", "last").collect()}

        def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = matrix(batch.column("vector"), width)
                for n, query in enumerate(x):
                    here: dict[int, list[int]] = {}
                    for leaf in tree.visit(query, visits):
                        for shard in spans.get(leaf, ()):
                            here.setdefault(shard, []).append(leaf)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("id").take(pa.array([n] * len(here), pa.int32())), pa.array(list(here), pa.int32()),
                         pa.array([np.array(leaves, np.int32).tobytes() for leaves in here.values()], pa.binary()),
                         pa.array([query.tobytes()] * len(here), pa.binary())], ["id", "shard", "leaves", "vector"])

        sent = queries.mapInArrow(visit, "id long, shard int, leaves binary, vector binary")
        parts = max(1, -(-queries.count() * 8 * width // QUERY_BYTES))
        sent = sent.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int"))
        rows = self.blocks.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
        tasks = min(max(4 * self.shards * parts, 1), 4096)
        sent, rows = (side.repartition(tasks, "shard", "part").groupBy("shard", "part") for side in (sent, rows))

        def meet(asked: pa.Table, held: pa.Table) -> pa.Table:
            try:
                return _met(asked, held, width, count)
            finally:
                give_back()

        met = sent.cogroup(rows).applyInArrow(meet, _FOUND)
        return _merge(met, count).select("query_id", "rank", "vec_id", "score")


def _met(asked: pa.Table, held: pa.Table, width: int, count: int) -> pa.Table:
    """The nearest of each query among the blocks of its leaves."""
    best = _Nearest(count)
    ids, x = asked.column("id").to_numpy(), blob_matrix(b"".join(asked.column("vector").to_pylist()), width)
    leaves = [np.frombuffer(n.as_py(), np.int32) for n in asked.column("leaves")]
    owner = np.repeat(np.arange(len(ids)), [len(n) for n in leaves])
    leaves = np.concatenate([*leaves, np.zeros(0, np.int32)])
    order = np.argsort(leaves, kind="stable")
    leaves, owner = leaves[order], owner[order]
    for leaf, row_ids, rows in zip(*(held.column(n) for n in ("leaf", "ids", "rows"))):
        low, high = np.searchsorted(leaves, [leaf.as_py(), leaf.as_py() + 1])
        row_ids, rows = np.frombuffer(row_ids.as_py(), np.int64), blob_matrix(rows.as_py(), width)
        for start in range(low, high, QUERY_BLOCK):
            some = owner[start : min(start + QUERY_BLOCK, high)]
            best.add(ids[some], x[some], row_ids, rows)
    return pa.Table.from_batches([best.batch()])
