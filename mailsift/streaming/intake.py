"""Files as a stream: every micro-batch is one incremental run.

The stream carries locations; the bytes are read by the tasks that unpack them,
as in a run over the bucket, so files of any size pass.

The set of known mails is exact and never ends, so it lives in the ledgers and
not in streaming state, and there is no watermark: a file may land in a folder
of any date at any time.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from mailsift import session
from mailsift.operators.capture import INCREMENTAL
from mailsift.plans.ingest import Options, ingest_frame, ingest_listing
from mailsift.sources.polls import NAME, BucketSource


def watch_bucket(
    spark: SparkSession, root: str, options: Options = Options(), pause_seconds: float = 1.0
) -> DataFrame:
    """Stream of the bucket's listings: in every micro-batch all its files, where they are, their
    size and time, as the tasks list them. Names starting with ``_``, empty, old and
    replaced files are among them. Two listings are ``pause_seconds`` apart at least.
    """
    session.ship(spark)
    spark.dataSource.register(BucketSource)
    files = (
        spark.readStream.format(NAME)
        .option("root", root)
        .option("tasks", str(spark.sparkContext.defaultParallelism * 2))
        .option("pause_seconds", str(pause_seconds))
        .load()
    )
    return files.withColumn("format", options.formats.detect(F.col("source_file")))


def ingest_stream(
    files: DataFrame,
    output_root: str,
    checkpoint: str,
    *,
    options: Options = Options(),
    name: str = "intake",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Ingest a stream of files: path, namespace, date_partition, source_file, and
    either ``location`` and ``size`` or ``content``.

    A run is named by the identity that the checkpoint keeps and the batch number:
    a batch that is delivered again after a restart is either known as completed or
    overwrites its own first try, and another checkpoint's batches are other runs.

    Of a stream of listings only files that look other than at the last run
    (``Options.by_stat``) are opened; a listing without such files leaves no run.
    """
    by_stat = replace(options, by_stat=True)

    def one_batch(batch: DataFrame, number: int) -> None:
        context = batch.sparkSession.sparkContext
        run_id = f"{name}-{context.getLocalProperty('sql.streaming.queryId')}-{number}"
        if "location" not in batch.columns:
            ingest_frame(batch, output_root, INCREMENTAL, options=options, run_id=run_id)
            return
        ingest_listing(batch, output_root, INCREMENTAL, options=by_stat, run_id=run_id)

    return (
        files.writeStream.foreachBatch(one_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
