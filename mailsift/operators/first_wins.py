"""Global deduplication: the first copy in corpus order is the mail."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Namespace, date, file, then place inside the file: the order of a depth-first
# walk over the sorted bucket. Arrays of numbers compare element by element.
CORPUS_ORDER = ("namespace", "date_partition", "source_file", "entry_ord")


def first_wins(
    rows: DataFrame, key: str = "uid", order: tuple[str, ...] = CORPUS_ORDER
) -> DataFrame:
    """The first row of every key.

    A minimum over a struct is combined before the shuffle, so a key that
    holds a third of all rows leaves each task as one row. Rows should not
    carry bytes: only keys and references move.
    """
    rest = [c for c in rows.columns if c != key and c not in order]
    best = F.min(F.struct(*order, *rest)).alias("first")
    return rows.groupBy(key).agg(best).select(key, "first.*").select(*rows.columns)


def without_known(
    rows: DataFrame, ledger: DataFrame, keys: list[str] | str, small: bool = False
) -> DataFrame:
    """Rows whose keys the ledger does not hold.

    ``small`` says that ``rows`` has been counted and fits a broadcast. Then
    the long ledger is only scanned, not shuffled: the few keys at hand go to
    it, and what it knows of them comes back.
    """
    keys = [keys] if isinstance(keys, str) else keys
    known = ledger.select(*keys)
    if small:
        at_hand = F.broadcast(rows.select(*keys).distinct())
        known = known.join(at_hand, keys, "left_semi").distinct()
    return rows.join(known, keys, "left_anti")


def dedup_counts(leaves: DataFrame, winners: DataFrame, by: list[str]) -> DataFrame:
    """Leaves, kept and dropped per group; groups without a winner stay."""
    return (
        leaves.groupBy(*by)
        .agg(F.count(F.lit(1)).alias("leaves"))
        .join(winners.groupBy(*by).agg(F.count(F.lit(1)).alias("kept")), by, "left")
        .select(
            *by,
            "leaves",
            F.coalesce("kept", F.lit(0)).alias("processed"),
            (F.col("leaves") - F.coalesce("kept", F.lit(0))).alias("deduplicated"),
        )
    )


def hit_rate(deduplicated: Column, leaves: Column) -> Column:
    return F.when(leaves > 0, deduplicated / leaves).otherwise(F.lit(0.0))
