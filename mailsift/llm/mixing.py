"""Mixing sources to target weights by hash-threshold histograms.

A document's key has a fixed 60-bit hash. A source that shall give ``target``
words of its ``size`` gives every document ``floor(target / size)`` times, and
those whose hash lies below a threshold once more. The threshold is found from
histograms: words by source and hash bucket, the bucket in which the budget
ends, then that bucket alone by the next bits, and so on. Nothing is sorted,
and a larger budget keeps all that a smaller one took (thresholds are nested).

Defined cases: a null or empty text has size 0 and is never taken; a null
source is a source, the last one; rows that repeat an id share its hash and go
together; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mailsift.llm.common import Work, text_bytes, unit_hash

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
CAP = 3
_BITS, _STEP = 60, 12


def targets(sizes: dict, weights=WEIGHTS, cap: int = CAP) -> dict:
    """Words each source shall give: shares of all words by weight, none above
    ``cap`` times its size, the excess shared by weight among the others.

    ``sizes`` has one entry per source. Sources take the weights in order of
    their names by code point, null last.
    """
    names = sorted(sizes, key=lambda name: (name is None, name or ""))
    weight = {name: weights[i % len(weights)] for i, name in enumerate(names)}
    words, parts = sum(sizes.values()), sum(weight.values())
    result = {}
    for name in sorted(names, key=lambda n: cap * sizes[n] / weight[n]):
        if words * weight[name] <= cap * sizes[name] * parts:
            break
        result[name] = float(cap * sizes[name])
        words -= cap * sizes[name]
        parts -= weight[name]
    return {name: result.get(name, words * weight[name] / parts if parts else 0.0) for name in names}


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """Four numbers of each document, written down: texts are read once."""
    return Work(docs.sparkSession).keep(
        docs.select(
            F.col(id_col).alias("id"),
            F.col(source_col).cast("string").alias("source"),
            F.regexp_count(text_bytes(text_col), F.lit(WORD)).cast("long").alias("size"),
            unit_hash(F.col(id_col)).alias("hash"),
        )
    )


def _shares(sized: DataFrame, weights, cap: int) -> DataFrame:
    """One row per source: its size, target, whole copies, and the threshold for one more."""
    sizes = {r.source: r.size for r in sized.groupBy("source").agg(F.sum("size").alias("size")).collect()}
    wanted = targets(sizes, weights, cap)
    plan = {}
    for name, size in sizes.items():
        whole = int(wanted[name] // size) if size else 0
        plan[name] = {"whole": whole, "below": 0, "rest": wanted[name] - whole * size}
    _thresholds(sized, plan)
    return sized.sparkSession.createDataFrame(
        [(name, sizes[name], wanted[name], row["whole"], row["below"]) for name, row in plan.items()],
        "mix_source string, source_size long, target double, mix_whole long, mix_below long",
    )


def _copies(hash_: Column) -> Column:
    return F.col("mix_whole") + (hash_ < F.col("mix_below")).cast("long")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=WEIGHTS, cap: int = CAP) -> DataFrame:
    """One row per row of ``docs``: id, size, source, source_size, target, copies, taken.

    ``copies`` is how often the mix holds the document, ``taken`` the words it
    takes from it. One row per source travels to the driver and back; all other
    work is on rows of four numbers, in a written table.
    """
    sized = _sized(docs, id_col, text_col, source_col)
    shares = F.broadcast(_shares(sized, weights, cap))
    copies = _copies(F.col("hash"))
    return sized.join(shares, F.col("source").eqNullSafe(F.col("mix_source"))).select(
        "id", "size", "source", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken")
    )


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          weights=WEIGHTS, cap: int = CAP) -> DataFrame:
    """The rows of ``docs``, each as often as the mix holds it, same columns.

    What a row gives follows from its source and the hash of its id, so texts
    meet only the broadcast row of their source and are never shuffled.
    """
    shares = _shares(_sized(docs, id_col, text_col, source_col), weights, cap)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.col(source_col).cast("string").alias("own_source"), unit_hash(F.col(id_col)).alias("own_hash"))
    joined = rows.join(F.broadcast(shares), F.col("own_source").eqNullSafe(F.col("mix_source")))
    copies = _copies(F.col("own_hash")).cast("int")
    return joined.select("row", F.explode(F.array_repeat(F.lit(True), copies))).select("row.*")


def _thresholds(sized: DataFrame, plan: dict) -> None:
    """Set each source's ``below``: documents with a smaller hash are taken once more."""
    spark = sized.sparkSession
    open_, before = {name: 0 for name in plan}, dict.fromkeys(plan, 0)
    for shift in range(_BITS - _STEP, -1, -_STEP):
        if not open_:
            return
        rows = [(name, prefix, plan[name]["rest"] - before[name]) for name, prefix in open_.items()]
        edge = F.broadcast(spark.createDataFrame(rows, "edge_source string, prefix long, budget double"))
        upper = F.shiftright("hash", shift + _STEP)
        sums = (
            sized.join(edge, F.col("source").eqNullSafe(F.col("edge_source")) & (upper == F.col("prefix")))
            .groupBy("source", F.shiftright("hash", shift).alias("bucket"), "budget")
            .agg(F.sum("size").alias("words"))
        )
        upto = F.sum("words").over(Window.partitionBy("source").orderBy("bucket"))
        found = (
            sums.withColumn("upto", upto)
            .where(F.col("upto") > F.col("budget"))
            .groupBy("source", "budget")
            .agg(F.min_by(F.struct("bucket", "upto", "words"), "bucket").alias("at"))
            .collect()
        )
        still = {}
        for row in found:
            name, at = row["source"], row["at"]
            less = at["upto"] - at["words"]
            if shift:
                still[name] = at["bucket"]
                before[name] += less
            else:  # one hash value: with it or without, whichever is nearer
                nearer = at["upto"] - row["budget"] < row["budget"] - less
                plan[name]["below"] = at["bucket"] + int(nearer)
        for name in open_.keys() - {row["source"] for row in found}:
            # Only at the first level: the budget is never reached, all go.
            plan[name]["below"] = 1 << _BITS
        open_ = still
