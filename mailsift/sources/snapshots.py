"""Snapshots of a bucket's listing, and what is different between two of them.

Files count as unchanged where place, size and time are the same. Most folders do not
change between two looks at a bucket, so folders are compared first, by a digest of
their files that is combined before the shuffle; only the files of folders that differ meet
each other. A file that was written about when it was listed may change again within the
resolution of its time; its time is not kept, so it differs at the next look.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STAT = ["location", "size", "modified_at"]
_FOLDER = ["root", "namespace", "date_partition"]


def _rooted(rows: DataFrame) -> DataFrame:
    """With the root, so that equal folders of two buckets are not taken for one."""
    return rows.withColumn("root", F.expr("substring(location, 1, length(location) - length(path))"))


def folder_digests(rows: DataFrame) -> DataFrame:
    """One row per folder: its files, and two hashes over their names, sizes and times."""
    own = F.struct("path", "size", "modified_at")
    return rows.groupBy(*_FOLDER).agg(
        F.count(F.lit(1)).alias("files"),
        F.bit_xor(F.xxhash64(own)).alias("one_hash"),
        F.bit_xor(F.xxhash64(F.lit("other"), own)).alias("other_hash"),
        F.bool_or(F.col("modified_at").isNull()).alias("open"),
    )


def unlike(now: DataFrame, before: DataFrame) -> DataFrame:
    """Files of ``now`` that ``before`` lacks, or has with another size or time."""
    columns = now.columns
    now, before = _rooted(now), _rooted(before)
    same = folder_digests(before).where(~F.col("open")).drop("open")
    changed = folder_digests(now).drop("open").join(same, [*_FOLDER, "files", "one_hash", "other_hash"], "left_anti")
    changed = changed.select(*_FOLDER)
    mine = now.join(changed, _FOLDER, "left_semi")
    other = before.join(changed, _FOLDER, "left_semi").select(*STAT)
    return mine.join(other, STAT, "left_anti").select(*columns)


def settled(listing: DataFrame, seconds: float) -> DataFrame:
    """The listing as kept: times too close to now are left out."""
    limit = F.current_timestamp() - F.make_dt_interval(secs=F.lit(seconds))
    return listing.withColumn("modified_at", F.when(F.col("modified_at") < limit, F.col("modified_at")))


def merged(before: DataFrame, now: DataFrame, covered: Column) -> DataFrame:
    """The next snapshot, one row per file: what was listed now, and of before what was out of its sight."""
    rest = before.where(~covered).select(*now.columns).join(now.select("location"), "location", "left_anti")
    return rest.select(*now.columns).unionByName(now)
