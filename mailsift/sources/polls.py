"""The bucket as a streaming source: every micro-batch is a listing of it, made by the tasks.

The offset is the time of a listing and nothing else, so there is no map of seen
files on the driver, however long the stream runs. What is new in a listing is found by
comparing it with the snapshot that the last run has left in its ledger.
"""

from __future__ import annotations

import time
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from mailsift.schemas import LISTING
from mailsift.sources import bucket, storage

NAME = "mailsift_bucket"


@dataclass
class Share(InputPartition):
    """The date folders of a namespace that fall to one task."""

    root: str
    namespace: str
    number: int
    shares: int


class Polls(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.root = options["root"].rstrip("/")
        self.tasks = max(1, int(options.get("tasks", "8")))
        self.pause = float(options.get("pause_seconds", "1"))
        self.listed_at = 0

    def initialOffset(self) -> dict:
        return {"listed_at": 0}

    def latestOffset(self) -> dict:
        """A time later than any before, a pause apart at least."""
        now = int(time.time() * 1000)
        if now >= self.listed_at + 1000 * self.pause:
            self.listed_at = max(now, self.listed_at + 1)
        return {"listed_at": self.listed_at}

    def partitions(self, start: dict, end: dict) -> list[Share]:
        """Only the root is listed here; dates and files are the tasks' work."""
        names = sorted(e.name for e in storage.list_dir(self.root) if e.is_dir and not e.name.startswith("."))
        shares = -(-self.tasks // max(len(names), 1))
        return [Share(self.root, name, i, shares) for name in names for i in range(shares)]

    def read(self, partition: Share) -> Iterator[pa.RecordBatch]:
        where = pa.RecordBatch.from_pydict({"root": [partition.root], "namespace": [partition.namespace]})
        for dates in bucket._dates_below(iter([where])):
            mine = [
                zlib.crc32(date.encode()) % partition.shares == partition.number
                for date in dates.column("date_partition").to_pylist()
            ]
            yield from bucket._files_below(iter([dates.filter(pa.array(mine, pa.bool_()))]))


class BucketSource(DataSource):
    """``spark.readStream.format("mailsift_bucket").option("root", ...)``"""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self):
        return LISTING

    def streamReader(self, schema) -> Polls:
        return Polls(self.options)
