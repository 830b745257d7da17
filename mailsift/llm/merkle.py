"""A hash tree over a table: a manifest that proves every row's place in one root.

Rows are leaves, hashed over length-prefixed fields. Within a group (say, a source)
leaves stand in the order of their key; every ``fanout`` neighbours become one parent
until a single node is left, the group's subroot. Subroots in the order of their groups
build the top tree in the same way.

1. **Places.** Rows are dealt out by ranges of (group, key, leaf); where each group begins in
   each range comes from counts by range, one row each, so no group is numbered in one task.
2. **Slot pivot.** A parent is one row: conditional aggregates spread its children into
   ``fanout`` columns by slot. All columns concatenated are hashed to the parent; all but a
   child's own are its siblings, those left and those right of it.
3. **Proofs** go down from the root. Each level's parents meet the proofs they have themselves,
   and hand them, with the siblings put in front, to their children. The levels' sizes fall
   geometrically, so all joins together move about half as many rows again as there are leaves.
4. **Verification** folds a leaf and its proof upwards again, as a column expression.

Every level is a written table, so a lost executor costs tasks of one level.

Defined cases: a null field is ``-``, an empty one ``0:``; null groups come first and stand apart
from empty ones; null keys come first in their group; rows with one key stand in the order of their
leaves, so repeated rows, which are alike, get one place each; texts of any length are
hashed whole; an empty table has no rows and no root (null). Other columns, whatever
they are called, take no part and pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from mailsift import session
from mailsift.llm.common import Work

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FANOUT = 3
_STEP = "struct<left:string,right:string>"


def field(column: Column) -> Column:
    """A value as hashed: its UTF-8 length, a colon, the value; null is a dash."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(columns: list[Column]) -> Column:
    return F.sha2(F.concat(*[field(c) for c in columns]), 256)


def fold(leaf_col: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(proof, leaf_col, lambda node, step: F.sha2(F.concat(step["left"], node, step["right"]), 256))


def proof_text(proof: Column) -> Column:
    """All siblings of a proof, level by level from the leaf, each level left to right."""
    return F.array_join(F.transform(proof, lambda step: F.concat(step["left"], step["right"])), "")


def _placed(work: Work, rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``pos``, their place in their ``tree`` by ``order``, and ``n``, the rows of the tree."""
    # Rows alike in all of `order` may fill a range; the row number breaks them up, and any order of them is right.
    near = rows.withColumn("_tie", F.monotonically_increasing_id())
    by = [F.col(c).asc_nulls_first() for c in [*order, "_tie"]]
    dealt = near.repartitionByRange(*by).sortWithinPartitions(*by).drop("_tie")
    at = F.monotonically_increasing_id()
    dealt = work.keep(dealt.withColumn("_at", at).withColumn("_range", F.shiftright("_at", 33)))
    parts = dealt.groupBy("tree", "_range").agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    tree = Window.partitionBy("tree")
    before = F.sum("_rows").over(tree.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select(
        "tree", "_range", (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_shift"), F.sum("_rows").over(tree).alias("n")
    )
    return (
        dealt.join(parts, ["tree", "_range"]).withColumn("pos", F.col("_at") + F.col("_shift"))
        .drop("_at", "_range", "_shift")
    )


class _Trees:
    """Trees over nodes (tree, n, pos, hash, ...): the pivoted levels and the roots."""

    def __init__(self, work: Work, nodes: DataFrame, fanout: int, payload: list[str]):
        self.work, self.fanout = work, fanout
        self.levels: list[DataFrame] = []
        self.payload = payload
        self.nodes = work.keep(nodes)
        roots = [self._roots(self.nodes)]
        most = self.nodes.agg(F.max("n")).first()[0] or 0
        nodes = self.nodes
        while most > 1:
            level = work.keep(self._pivot(nodes.where("n > 1"), payload if not self.levels else []))
            self.levels.append(level)
            nodes = level.select("tree", "n", "pos", "hash")
            roots.append(self._roots(nodes))
            most = -(-most // fanout)
        self.roots = roots  # by level: the trees that end there

    @staticmethod
    def _roots(nodes: DataFrame) -> DataFrame:
        return nodes.where("n = 1").select("tree", "hash")

    def all_roots(self) -> DataFrame:
        found = self.roots[0]
        for more in self.roots[1:]:
            found = found.unionByName(more)
        return found

    def _pivot(self, nodes: DataFrame, payload: list[str]) -> DataFrame:
        """One row per parent, its children in slot columns."""
        fanout = self.fanout
        slots = [
            F.max(F.when(F.col("pos") % fanout == i, F.struct("hash", *payload))).alias(f"slot{i}") for i in range(fanout)
        ]
        parent = F.floor(F.col("pos") / fanout).cast("long")
        grouped = nodes.groupBy("tree", F.ceil(F.col("n") / fanout).cast("long").alias("n"), parent.alias("pos")).agg(*slots)
        return grouped.withColumn("hash", F.sha2(self._beside(range(fanout)), 256))

    @staticmethod
    def _beside(slots) -> Column:
        return F.concat(F.lit(""), *[F.coalesce(F.col(f"slot{i}.hash"), F.lit("")) for i in slots])

    def proofs(self, ends: DataFrame) -> DataFrame:
        """Nodes of the lowest level with their proofs; ``ends`` has (tree, root, proof) of every tree's root."""
        fanout, below = self.fanout, None
        for number in range(len(self.levels), -1, -1):
            # Proofs of the nodes at this level: of trees that end here, and handed down from above.
            mine = self.roots[number].join(ends, "tree").select("tree", F.lit(0).cast("long").alias("pos"), "root", "proof")
            above = mine if below is None else mine.unionByName(below)
            if number == 0:
                lone = self.nodes.where("n = 1").join(ends, "tree")
                lone = lone.select("tree", "hash", *self.payload, "root", "proof")
                return lone if self._children is None else lone.unionByName(self._children)
            payload = self.payload if number == 1 else []
            child = F.explode(F.array(*[
                F.struct(
                    F.lit(i).alias("slot"), F.col(f"slot{i}").alias("node"),
                    F.struct(self._beside(range(i)).alias("left"), self._beside(range(i + 1, fanout)).alias("right")).alias("step"),
                ) for i in range(fanout)
            ])).alias("child")
            down = (
                self.levels[number - 1].join(above, ["tree", "pos"]).select("tree", "pos", "root", "proof", child)
                .where("child.node is not null")
                .select(
                    "tree", (F.col("pos") * fanout + F.col("child.slot")).alias("pos"), "child.node", "root",
                    F.concat(F.array("child.step"), "proof").alias("proof"),
                )
            )
            if number == 1:
                self._children = down.select("tree", "node.hash", *[f"node.{c}" for c in payload], "root", "proof")
                below = None
            else:
                below = self.work.keep(down.drop("node"))

    _children: DataFrame | None = None


class Manifest:
    """The tree over ``docs``: ``root``, ``subroots()``, and ``proofs()`` of all rows.

    ``columns`` are the hashed fields in order, ``group`` and ``key`` the columns that
    place a row. Other columns named in ``carry`` come along with the proofs.
    """

    def __init__(self, docs: DataFrame, columns=FIELDS, group: str = "source", key: str = "doc_id", fanout: int = FANOUT,
                 carry: dict[str, Column] | None = None):
        if fanout < 2:
            raise ValueError("fanout must be 2 at least")
        session.tune(docs.sparkSession)
        self.work = Work(docs.sparkSession)
        carry = carry or {}
        named = docs.select(
            F.col(f"`{group}`").alias("grp"), F.col(f"`{key}`").alias("key"),
            leaf([F.col(f"`{c}`") for c in columns]).alias("hash"),
            F.struct(F.lit(True).alias("_row_there"), *[c.alias(n) for n, c in carry.items()]).alias("carried"),
        ).withColumn("tree", field(F.col("grp")))
        nodes = _placed(self.work, named, ["grp", "key", "hash"])
        self.carry = list(carry)
        self._trees = _Trees(self.work, nodes.select("tree", "n", "pos", "hash", "grp", "key", "carried"), fanout, ["grp", "key", "carried"])
        groups = self._trees.nodes.where("pos = 0").select("tree", "grp")
        ends = self._trees.all_roots().join(groups, "tree")
        top = _placed(self.work, ends.select(F.lit("").alias("tree"), F.col("tree").alias("group_tree"), "grp", "hash"), ["grp"])
        self._top = _Trees(self.work, top.select("tree", "n", "pos", "hash", "grp", "group_tree"), fanout, ["grp", "group_tree"])
        found = self._top.all_roots().first()  # one row
        self.root: str | None = found["hash"] if found else None

    def subroots(self) -> DataFrame:
        """One row per group: grp, subroot, and its proof up to the root."""
        start = self._top.all_roots().select("tree", F.col("hash").alias("root"), F.expr(f"cast(array() as array<{_STEP}>)").alias("proof"))
        return self._top.proofs(start).select("grp", "group_tree", F.col("hash").alias("subroot"), "proof")

    def proofs(self) -> DataFrame:
        """One row per row of the table: grp, key, leaf, subroot, root, proof, and the carried columns.

        ``proof`` holds, from the leaf up to the root, the siblings left and right of the way.
        """
        subroots = self.work.keep(self.subroots())
        ends = subroots.select(F.col("group_tree").alias("tree"), F.col("subroot").alias("root"), "proof")
        return self._trees.proofs(ends).select(
            "grp", "key", F.col("hash").alias("leaf"), F.col("root").alias("subroot"),
            F.lit(self.root).cast("string").alias("root"), "proof", *[F.col(f"carried.`{c}`") for c in self.carry],
        )

    def verify(self, proofs: DataFrame, leaf_col: str = "leaf") -> DataFrame:
        """``proofs`` with the root each leaf folds to, and whether it is this manifest's."""
        folded = proofs.withColumn("folded_root", fold(F.col(leaf_col), F.col("proof")))
        return folded.withColumn("verified", F.col("folded_root") == F.lit(self.root))
