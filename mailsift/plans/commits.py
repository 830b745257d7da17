"""Commits of a ledger: one numbered file each, which only one writer can create.

A run is completed by the file that carries its row of the run log. Two runs that end at
once want the same number; one gets it, the other looks at what the first has written
before it tries the next one. A compaction is a commit too: its file names the
folders that from now on stand for all runs committed up to a number, in one step.
"""

from __future__ import annotations

import json
from datetime import UTC, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mailsift import schemas
from mailsift.session import no_rows
from mailsift.sources import storage

RUN, COMPACT = "run", "compact"
_STAMP = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


class Commits:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.folder = spark, f"{root.rstrip('/')}/ledger/commits"

    def _path(self, number: int) -> str:
        return f"{self.folder}/{number:012d}.json"

    def last(self) -> int:
        """The highest number taken; 0 before the first commit."""
        names = (e.name for e in storage.list_dir(self.folder) if not e.is_dir)
        return max((int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()), default=0)

    def take(self, number: int, kind: str, entry: dict) -> bool:
        """Write a commit under a number; false if another one has it."""
        said = {k: v.astimezone(UTC).isoformat(timespec="microseconds") if isinstance(v, datetime) else v for k, v in entry.items()}
        return storage.create_new(self._path(number), json.dumps({"kind": kind, **said}).encode())

    def all(self) -> DataFrame:
        """All commits that are left, by number."""
        try:
            reader = self.spark.read.schema(schemas.COMMIT).option("timestampFormat", _STAMP)
            rows = reader.option("pathGlobFilter", "*.json").json(self.folder)
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in (error.getCondition() or ""):
                raise
            return no_rows(self.spark, T.StructType([*schemas.COMMIT.fields, schemas.COMMIT_NO]))
        number = F.regexp_extract("_metadata.file_name", r"^(\d+)[.]json$", 1).cast("long")
        return rows.withColumn("commit_no", number)

    def compaction(self) -> tuple[int, str | None]:
        """The last compaction: up to which commit, and where; (-1, None) before the first."""
        if not any(True for _ in storage.list_dir(f"{self.folder.removesuffix('commits')}compacted")):
            return -1, None  # the usual case, without a job
        found = (
            self.all().where(F.col("kind") == COMPACT)
            .orderBy(F.desc("commit_no")).limit(1).select("upto", "place").collect()
        )
        return (found[0].upto, found[0].place) if found else (-1, None)

    def remove(self, upto: int) -> None:
        """Remove the files of commits up to a number, but for the last compaction's."""
        kept = self.all().where(F.col("kind") == COMPACT).agg(F.max("commit_no")).first()[0]
        for entry in list(storage.list_dir(self.folder)):
            if entry.name.endswith(".json") and int(entry.name[:-5]) <= upto and int(entry.name[:-5]) != kept:
                storage.remove_file(f"{self.folder}/{entry.name}")
