"""Change capture: which files of the bucket are new."""

from __future__ import annotations

from pyspark.sql import DataFrame

from mailsift.operators.first_wins import without_known

BACKFILL, INCREMENTAL = "backfill", "incremental"
SOURCE_KEY = ["content_hash", "path"]


def changed(
    sources: DataFrame, discovered: DataFrame, mode: str = INCREMENTAL, small: bool = False
) -> DataFrame:
    """Files to process. A backfill takes all; an incremental run only those
    whose bytes have not been seen under this path."""
    if mode not in (BACKFILL, INCREMENTAL):
        raise ValueError(f"mode must be {BACKFILL} or {INCREMENTAL}, not {mode}")
    if mode == BACKFILL:
        return sources
    return without_known(sources, discovered, SOURCE_KEY, small)


def newly_discovered(sources: DataFrame, discovered: DataFrame, small: bool = False) -> DataFrame:
    """Rows to append to the discovered ledger: its key stays unique."""
    return without_known(sources, discovered, SOURCE_KEY, small).dropDuplicates(SOURCE_KEY)
