"""Counters of a run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailsift.operators.first_wins import hit_rate


def namespace_metrics(
    sources: DataFrame, leaves: DataFrame, winners: DataFrame, skips: DataFrame
) -> DataFrame:
    """Discovered, processed, skipped, deduplicated and hit rate by namespace.

    Each input is counted on its own first, so the four small results are all
    that is put together.
    """

    def counted(rows: DataFrame, name: str) -> DataFrame:
        return rows.groupBy("namespace").agg(F.count(F.lit(1)).alias("n")).select(
            "namespace", F.lit(name).alias("what"), "n"
        )

    counts = (
        counted(sources, "discovered")
        .unionByName(counted(leaves, "leaves"))
        .unionByName(counted(winners, "processed"))
        .unionByName(counted(skips, "skipped"))
    )

    def of(name: str):
        return F.coalesce(F.sum(F.when(F.col("what") == name, F.col("n"))), F.lit(0))

    return (
        counts.groupBy("namespace")
        .agg(
            of("discovered").alias("discovered"),
            of("processed").alias("processed"),
            of("skipped").alias("skipped"),
            of("leaves").alias("leaves"),
        )
        .withColumn("deduplicated", F.col("leaves") - F.col("processed"))
        .select(
            "namespace",
            "discovered",
            "processed",
            "skipped",
            "deduplicated",
            hit_rate(F.col("deduplicated"), F.col("leaves")).alias("dedup_hit_rate"),
        )
    )
