"""Mails and attachments as loose files, written by the executors."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailsift.functions import naming
from mailsift.sources import storage


def write_files(rows: DataFrame, root: str) -> DataFrame:
    """Write ``content`` to ``root/path`` for every row; gives path and size.

    Names come from content hashes, so a repeated task writes the same file.
    Nothing is written until the result is used.
    """
    base = root.rstrip("/")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = batch.column("path").to_pylist()
            sizes = [
                storage.write_all(f"{base}/{path}", iter([batch.column("content")[n].as_py()]))
                for n, path in enumerate(paths)
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(paths), pa.array(sizes, pa.int64())], names=["path", "size"]
            )

    return rows.select("path", "content").mapInArrow(run, "path string, size bigint")


def mail_files(emails: DataFrame) -> DataFrame:
    """Path and bytes of every staged mail."""
    return emails.select(
        naming.output_path(
            F.col("namespace"), F.col("date_partition"), F.col("uid"), F.col("ext")
        ).alias("path"),
        "content",
    )


def attachment_files(attachments: DataFrame) -> DataFrame:
    """Path and bytes of every attachment, in its mail's folder."""
    folder = naming.attachment_dir(F.col("namespace"), F.col("date_partition"), F.col("uid"), F.lit(1))
    return attachments.select(_below(folder, F.col("safe_name")).alias("path"), "content")


def _below(folder: Column, name: Column) -> Column:
    return F.concat(folder, F.lit("/"), name)
