"""What has been ingested so far."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailsift.operators.metrics import namespace_metrics
from mailsift.plans.ledger import Ledger, last_completed


def status(spark: SparkSession, output_root: str) -> DataFrame:
    """The last completed run beside the totals. One row, also before any run."""
    ledger = Ledger(spark, output_root)
    totals = (
        ledger.processed()
        .select(F.lit("p").alias("what"))
        .unionByName(ledger.skipped().select(F.lit("s").alias("what")))
        .agg(
            F.count(F.when(F.col("what") == "p", 1)).alias("total_processed"),
            F.count(F.when(F.col("what") == "s", 1)).alias("total_skipped"),
        )
        .withColumn("one", F.lit(1))
    )
    last = last_completed(ledger.runs()).withColumn("one", F.lit(1))
    return totals.join(last, "one", "left").drop("one")


def run_metrics(spark: SparkSession, output_root: str) -> DataFrame:
    """New files, mails and skips by run and namespace, from the ledgers."""
    ledger = Ledger(spark, output_root)
    parts = [
        rows.select("run_id", "namespace", F.lit(name).alias("what"))
        for rows, name in (
            (ledger.discovered(), "discovered"),
            (ledger.processed(), "processed"),
            (ledger.skipped(), "skipped"),
        )
    ]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])

    def of(name: str):
        return F.count(F.when(F.col("what") == name, 1)).alias(name)

    return rows.groupBy("run_id", "namespace").agg(of("discovered"), of("processed"), of("skipped"))


__all__ = ["namespace_metrics", "run_metrics", "status"]
