"""State between runs: Parquet tables, one folder per run, one commit file.

Every table is written under ``run_id=...``. A run counts once its commit file is
there; until then nobody sees its rows, and a rerun under the
same id overwrites them. ``compact`` puts the rows of many runs into a few files, sorted by key;
readers take these for the runs they stand for and the folders of later runs beside them. Whoever
asks for a few keys (``may_hold``) reads only the files whose filter lets one of them pass.
"""

from __future__ import annotations

import uuid
from datetime import UTC, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mailsift import schemas
from mailsift.plans import known
from mailsift.plans.commits import COMPACT, RUN, Commits
from mailsift.session import PACKED, no_rows
from mailsift.sources import storage

RUNNING, COMPLETED, FAILED = "running", "completed", "failed"

# Table name: where it lies below the output root, its schema, its partition columns.
TABLES: dict[str, tuple[str, T.StructType, tuple[str, ...]]] = {
    "discovered": ("ledger/discovered", schemas.DISCOVERED, ()),
    "processed": ("ledger/processed", schemas.PROCESSED, ()),
    "skipped": ("ledger/skipped", schemas.SKIPPED, ()),
    "listing": ("ledger/listing", schemas.SNAPSHOT, ()),
    "manifest": ("manifest", schemas.MANIFEST, ()),
    "emails": ("emails", schemas.EMAILS, ("namespace", "date_partition")),
    "attachments": ("attachments", schemas.ATTACHMENTS, ()),
}


# Tables that a compaction rewrites, and the key it sorts each by. Tables with bytes stay as they are.
COMPACTED = {"discovered": "content_hash", "processed": "content_hash", "skipped": "path", "manifest": "uid"}
# Those of them that runs ask for keys. A mail's uid is its content hash.
ASKED = ("discovered", "processed")


def latest_state(events: DataFrame, order: Column | str = "event_no") -> DataFrame:
    """Current row of every run: its latest event."""
    fields = [c for c in events.columns if c != "run_id"]
    last = F.max_by(F.struct(*fields), F.col(order) if isinstance(order, str) else order)
    return (
        events.groupBy("run_id")
        .agg(last.alias("last"))
        .select("run_id", *[F.col(f"last.{f}").alias(f) for f in fields])
    )


def _last_try() -> Column:
    """A run that failed may be tried again under its id; completion is final."""
    return F.struct(F.col("status") == COMPLETED, F.col("started_at"), F.col("event_no"))


def last_completed(runs: DataFrame) -> DataFrame:
    """The completed run that ended last."""
    return (
        runs.filter(F.col("status") == COMPLETED)
        .orderBy(F.desc("completed_at"), F.desc("run_id"))
        .limit(1)
    )


def committed_only(rows: DataFrame, runs: DataFrame) -> DataFrame:
    """Rows of completed runs. The run id is the partition column, so folders
    of other runs are pruned at run time."""
    done = runs.filter(F.col("status") == COMPLETED).select("run_id")
    return rows.join(done, "run_id", "left_semi")


class Ledger:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.commits = Commits(spark, self.root)

    def path(self, table: str) -> str:
        return f"{self.root}/{TABLES[table][0]}"

    def _read(self, path: str, schema: T.StructType) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(path)
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in (error.getCondition() or ""):
                raise
            return no_rows(self.spark, schema)

    # -- run log -----------------------------------------------------------

    def run_events(self) -> DataFrame:
        """Starts and failures, and completions with the number of their commit."""
        try:
            reader = self.spark.read.schema(schemas.RUN_EVENTS).option("recursiveFileLookup", "true")
            logged = reader.parquet(f"{self.root}/ledger/runs")
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in (error.getCondition() or ""):
                raise
            logged = no_rows(self.spark, schemas.RUN_EVENTS)
        events = logged.withColumn("commit_no", F.lit(None).cast("long"))
        committed = self.commits.all().where(F.col("kind") == RUN)
        events = events.unionByName(committed.select(*events.columns))
        _, place = self.commits.compaction()
        if place:
            events = events.unionByName(self.spark.read.schema(events.schema).parquet(f"{place}/runs"))
        return events

    def _states(self) -> DataFrame:
        return latest_state(self.run_events(), _last_try())

    def runs(self) -> DataFrame:
        return self._states().drop("event_no", "commit_no")

    def _log(self, **event) -> None:
        row = [F.lit(event.get(f.name)).cast(f.dataType).alias(f.name) for f in schemas.RUN_EVENTS]
        self.spark.range(0, 1, 1, 1).select(*row).write.mode("append").parquet(
            f"{self.root}/ledger/runs/{event['run_id']}"
        )

    def start_run(self, run_id: str, mode: str) -> datetime:
        started = datetime.now(UTC)
        self._log(
            run_id=run_id,
            mode=mode,
            started_at=started,
            status=RUNNING,
            files_discovered=0,
            files_processed=0,
            files_skipped=0,
            files_deduplicated=0,
            event_no=0,
        )
        return started

    def complete_run(self, run_id: str, mode: str, started: datetime, counts: dict, number: int | None = None) -> bool:
        """The commit, after everything else is written; false if the number is another commit's.

        Without a number the next free one is taken.
        """
        entry = dict(
            run_id=run_id,
            mode=mode,
            started_at=started,
            completed_at=datetime.now(UTC),
            status=COMPLETED,
            files_discovered=counts["discovered"],
            files_processed=counts["processed"],
            files_skipped=counts["skipped"],
            files_deduplicated=counts["deduplicated"],
            event_no=1,
        )
        if number is not None:
            return self.commits.take(number, RUN, entry)
        while not self.commits.take(self.commits.last() + 1, RUN, entry):
            pass
        return True

    def committed_after(self, number: int) -> list[str]:
        """Runs whose commits have a higher number: those that ended while another run was at work."""
        found = self.commits.all().where((F.col("kind") == RUN) & (F.col("commit_no") > number))
        return [row.run_id for row in found.select("run_id").collect()]

    def fail_run(self, run_id: str, mode: str, started: datetime) -> None:
        self._log(run_id=run_id, mode=mode, started_at=started, status=FAILED, event_no=1)

    def is_completed(self, run_id: str) -> bool:
        events = self.run_events()
        return not events.filter(
            (F.col("run_id") == run_id) & (F.col("status") == COMPLETED)
        ).isEmpty()

    # -- tables ------------------------------------------------------------

    def read(self, table: str, run_id: str | None = None) -> DataFrame:
        """Committed rows of a table, of all runs or of one."""
        schema = TABLES[table][1]
        upto, place = self.commits.compaction() if table in COMPACTED else (-1, None)
        rows = self._read(self.path(table), schema)
        compacted = self.spark.read.schema(schema).parquet(f"{place}/{table}") if place else None
        if run_id is not None:
            rows = rows.filter(F.col("run_id") == run_id)
            compacted = compacted and compacted.filter(F.col("run_id") == run_id)
        rows = committed_only(rows, self._states().where(F.col("commit_no") > upto))
        return rows.unionByName(compacted) if compacted else rows

    def may_hold(self, table: str, keys: DataFrame) -> DataFrame:
        """Committed rows of a table of ``ASKED`` among which are all with one of the keys.

        ``keys`` is one column of content hashes, few enough to be broadcast. Of what has been
        compacted only files are read that can hold one of them, by their Bloom filter; runs since
        then are read whole. Compactions without a filter, from before there was one, are too.
        """
        schema = TABLES[table][1]
        upto, place = self.commits.compaction()
        if place is None or not known.has_filter(f"{place}/known/{table}"):
            return self.read(table)
        since = self._states().where(F.col("commit_no") > upto)
        rows = committed_only(self._read(self.path(table), schema), since)
        files = known.files_with(self.spark, f"{place}/known/{table}", keys)
        if not files:
            return rows
        paths = [f"{place}/{table}/{name}" for name in files]
        return rows.unionByName(self.spark.read.schema(schema).parquet(*paths))

    def compact(self, files: int | None = None) -> bool:
        """Rewrite the ledgers of all runs committed so far into a few files each, sorted by key.

        Nobody sees the new files before their commit, and everybody after it; a compaction that
        breaks off leaves files that nobody reads. False if another commit came first:
        the compaction stands for less than all and is not made.
        """
        upto = self.commits.last()
        place = f"{self.root}/ledger/compacted/{uuid.uuid4().hex}"
        for table, key in COMPACTED.items():
            rows = self.read(table)
            spread = rows.repartitionByRange(files, key, "run_id") if files else rows.repartitionByRange(key, "run_id")
            spread.sortWithinPartitions(key, "run_id").write.options(**PACKED).parquet(f"{place}/{table}")
            if table in ASKED:
                written = self.spark.read.schema(rows.schema).parquet(f"{place}/{table}")
                known.write_filter(written, key, f"{place}/known/{table}")
        done = self._states().where(F.col("status") == COMPLETED)
        done.select(*schemas.RUN_EVENTS.names, "commit_no").repartition(1).write.parquet(f"{place}/runs")
        done = self.commits.take(upto + 1, COMPACT, {"upto": upto, "place": place})
        if not done:
            storage.remove_tree(place)
        return done

    def vacuum(self) -> None:
        """Remove what the last compaction stands for. Only while no reader is at work that began before it."""
        upto, place = self.commits.compaction()
        if place is None:
            return
        covered = self.spark.read.schema(schemas.RUN_EVENTS).parquet(f"{place}/runs").select("run_id")
        run_ids = {row.run_id for row in covered.collect()}
        for table in COMPACTED:
            for entry in list(storage.list_dir(self.path(table))):
                if entry.name.removeprefix("run_id=") in run_ids:
                    storage.remove_tree(f"{self.path(table)}/{entry.name}")
        for run_id in run_ids:  # their starts, and failures of earlier tries
            storage.remove_tree(f"{self.root}/ledger/runs/{run_id}")
        # Earlier compactions; a folder without a commit may be one at work, so it stays.
        before = self.commits.all().where((F.col("kind") == COMPACT) & (F.col("place") != place)).select("place")
        for row in before.collect():
            storage.remove_tree(row.place)
        self.commits.remove(upto)

    def write(self, table: str, run_id: str, rows: DataFrame) -> None:
        """Write a run's rows of a table, in place of an earlier try's."""
        _, schema, parts = TABLES[table]
        columns = [c for c in schema.names if c != "run_id"]
        # A whole folder is replaced, whatever the session says about partitions.
        writer = rows.select(*columns).write.mode("overwrite").option("partitionOverwriteMode", "static")
        writer = writer.options(**PACKED)
        if parts:
            writer = writer.partitionBy(*parts)
        writer.parquet(f"{self.path(table)}/run_id={run_id}")

    def read_own(self, table: str, run_id: str) -> DataFrame:
        """Rows this run has written, before its commit."""
        _, schema, _ = TABLES[table]
        fields = T.StructType([f for f in schema if f.name != "run_id"])
        return self.spark.read.schema(fields).parquet(f"{self.path(table)}/run_id={run_id}")

    def snapshots(self) -> list[str]:
        """Completed runs that have left a listing, the latest first."""
        kept = self._read(self.path("listing"), TABLES["listing"][1]).select("run_id").distinct()
        done = self.runs().filter(F.col("status") == COMPLETED).select("run_id", "completed_at")
        # One row per kept snapshot, of which there are few: older ones are removed.
        rows = kept.join(done, "run_id").orderBy(F.desc("completed_at"), F.desc("run_id")).collect()
        return [row.run_id for row in rows]

    def snapshot(self) -> DataFrame:
        """The listing that the last run left; empty if none did."""
        found = self.snapshots()
        if not found:
            return no_rows(self.spark, schemas.LISTING)
        return self.read_own("listing", found[0])

    def drop_snapshots(self, keep: int) -> None:
        """Remove all listings but the latest; a reader may still be at the one before."""
        for run_id in self.snapshots()[keep:]:
            storage.remove_tree(f"{self.path('listing')}/run_id={run_id}")

    def last_run(self) -> DataFrame:
        return last_completed(self.runs())

    def processed(self) -> DataFrame:
        return self.read("processed")

    def skipped(self) -> DataFrame:
        return self.read("skipped")

    def discovered(self) -> DataFrame:
        return self.read("discovered")

    def emails(self) -> DataFrame:
        return self.read("emails")

    def attachments(self) -> DataFrame:
        return self.read("attachments").where("fault IS NULL").drop("fault")

    def attachment_faults(self) -> DataFrame:
        """Mails whose MIME broke off while their attachments were read: what came before is kept."""
        rows = self.read("attachments").where("fault IS NOT NULL")
        return rows.select("uid", "namespace", "date_partition", "fault", "run_id")

    def manifest(self) -> DataFrame:
        return self.read("manifest")
