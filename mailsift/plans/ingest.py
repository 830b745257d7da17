"""Ingestion: bucket in, deduplicated mails with lineage out.

    list -> [hash, drop known] -> open and unpack, level by level -> keys of
    all mails -> first wins -> drop known -> fetch winners' bytes -> attachments
    -> ledgers -> commit row

A file's bytes are read once in a backfill (in an incremental run, once to hash
all and once more for the new ones, which are the only ones unpacked). With
``by_stat`` an incremental run does not open files whose size and time are those of
the listing that the last run left in the ledger. No join
or aggregate moves bytes: they go from the bucket to the staged level and from
there to the mail table, with one rebalance by folder where the staged files are
not laid out so, or are too few for the cores; see ``_write_mails``.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mailsift.functions import naming
from mailsift.functions.formats import CONTAINER, DEFAULT, Formats
from mailsift.functions.records import content_hash, json_lines, now
from mailsift.operators.attachments import BY_TEXT, attachment_counts, extract_attachments
from mailsift.operators.capture import (
    BACKFILL,
    INCREMENTAL,
    SOURCE_KEY,
    changed,
    newly_discovered,
)
from mailsift.operators.entries import Limits, hash_in_storage
from mailsift.operators.fetch import fetch_rows
from mailsift.operators.first_wins import first_wins, without_known
from mailsift.operators.unpack import (
    MAX_TASKS,
    Found,
    _placed,
    open_inline,
    open_parts,
    open_stored,
    stage_writer,
    survey_large,
    unpack_all,
)
from mailsift.plans.ledger import Ledger
from mailsift.schemas import FOUND, LISTING
from mailsift.session import PACKED, new_work_dir
from mailsift.sources import storage
from mailsift.sources.bucket import list_files
from mailsift.sources.snapshots import merged, settled, unlike
from mailsift.sources.storage import list_dir, remove_tree


_FOLDER = ("namespace", "date_partition")
_FILE_COLUMNS = ["path", "namespace", "date_partition", "source_file", "content"]


@dataclass(frozen=True)
class Options:
    formats: Formats = DEFAULT
    task_bytes: int = 128 << 20  # bytes one task reads
    task_files: int = 20_000  # files one task reads
    inline_bytes: int = 64 << 20  # larger containers are read in parts
    raw_mbox: bool = False
    attachment_test: str = BY_TEXT
    # Keys up to this many are sent to the ledger; beyond it both are shuffled.
    broadcast_keys: int = 200_000
    write_json: bool = True
    # Leave out files that look as they did at the last run with this option: same place, size and time.
    by_stat: bool = False
    settle_seconds: float = 5.0  # files written that shortly before a listing are looked at again
    keep_work: bool = False


def _limits(options: Options, work: str) -> Limits:
    return Limits(
        inline=options.inline_bytes,
        part=options.inline_bytes,
        spill_dir=f"{work}/spill",
        raw_mbox=options.raw_mbox,
    )


def _spread(files: DataFrame, options: Options) -> DataFrame:
    """Give every task about the same bytes, from as few folders as it can be.

    A folder is cut into as many slots as its bytes ask for, so one that holds
    a third of the bucket goes to a third of the tasks, and small ones stay
    whole. What a task stages is then already laid out by folder.
    """
    spark = files.sparkSession
    sizes = files.groupBy("namespace", "date_partition").agg(
        F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("files")
    )
    total = sizes.agg(
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
        F.coalesce(F.sum("files"), F.lit(0)).alias("files"),
        F.count(F.lit(1)).alias("folders"),
    ).first()
    # On little data, smaller tasks keep all cores at work.
    cores = spark.sparkContext.defaultParallelism
    task_bytes = max(1, min(options.task_bytes, max(total["bytes"] // cores, 1 << 20)))
    task_files = max(1, min(options.task_files, max(total["files"] // cores, 100)))
    tasks = max(1, -(-total["bytes"] // task_bytes), -(-total["files"] // task_files))
    slots = F.greatest(
        F.ceil(F.col("bytes") / F.lit(task_bytes)), F.ceil(F.col("files") / F.lit(task_files))
    )
    sizes = sizes.select("namespace", "date_partition", slots.alias("slots"))
    if total["folders"] <= options.broadcast_keys:
        sizes = F.broadcast(sizes)
    slotted = files.join(sizes, ["namespace", "date_partition"]).withColumn(
        "slot", F.pmod(F.xxhash64("path"), F.col("slots"))
    )
    tasks = min(tasks, MAX_TASKS)
    return slotted.repartition(tasks, "namespace", "date_partition", "slot").drop("slot", "slots")


def _with_stored_hash(files: DataFrame) -> DataFrame:
    """Hash of every listed file, read in the task that has its path."""
    import pyarrow as pa

    schema = T.StructType([*files.schema.fields, T.StructField("content_hash", T.StringType())])

    def run(batches):
        for batch in batches:
            digests = [hash_in_storage(w)[0] for w in batch.column("location").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(digests, pa.string())], names=schema.names
            )

    return files.mapInArrow(run, schema)


class _Run:
    """One run: its tables, its work folder, its counters."""

    def __init__(
        self, spark: SparkSession, output_root: str, mode: str, options: Options, run_id: str | None
    ):
        if mode not in (BACKFILL, INCREMENTAL):
            raise ValueError(f"mode must be {BACKFILL} or {INCREMENTAL}, not {mode}")
        self.spark, self.mode, self.options = spark, mode, options
        self.ledger = Ledger(spark, output_root)
        self.named, self.run_id = run_id is not None, run_id or str(uuid.uuid4())
        self.base = self.ledger.commits.last()  # commits that the ledgers read in this run hold
        self.work = new_work_dir(spark, f"{self.ledger.root}/_work")
        self.limits = _limits(options, self.work)
        self.found = Found(spark, f"{self.work}/found")
        self.snapshot: DataFrame | None = None  # the listing to keep, for the next run by stat

    def row(self) -> DataFrame:
        return self.ledger.runs().filter(F.col("run_id") == self.run_id)

    def staged(self, rows: DataFrame, name: str) -> DataFrame:
        path = f"{self.work}/{name}"
        rows.write.mode("overwrite").options(**PACKED).parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Remove staged tables that nothing reads any more, so that they do not lie beside what follows."""
        for name in () if self.options.keep_work else names:
            remove_tree(f"{self.work}/{name}")

    def known(self, table: str, rows: DataFrame, key: str = "content_hash") -> tuple[DataFrame, bool]:
        """Ledger rows to compare with, and whether the rows at hand are few. For few keys, what
        cannot hold one of them is not read."""
        if rows.count() > self.options.broadcast_keys:
            return self.ledger.read(table), False
        return self.ledger.may_hold(table, rows.select(key)), True

    # -- front ends --------------------------------------------------------

    def open_bucket(
        self, root: str, namespaces: Iterable[str] | None, dates: Iterable[str] | None
    ) -> None:
        files = list_files(self.spark, root, namespaces, dates, self.options.formats)
        covered = F.startswith("location", F.lit(f"{root.rstrip('/')}/"))
        for column, values in (("namespace", namespaces), ("date_partition", dates)):
            if values is not None:
                covered = covered & F.col(column).isin([str(v) for v in values])
        self.open_listing(self.looked_at(self.staged(files, "listing"), covered))

    def looked_at(self, listing: DataFrame, covered: Column) -> DataFrame:
        """The files of a listing to look into. By stat, the listing is kept for the next run,
        and an incremental run leaves out files that look as they did in the last one."""
        options = self.options
        if not options.by_stat:
            return listing
        before = self.ledger.snapshot()
        now = settled(listing.select(*LISTING.names), options.settle_seconds)
        self.snapshot = self.staged(merged(before, now, covered), "snapshot")
        if self.mode != INCREMENTAL:
            return listing
        return self.staged(unlike(listing, before), "unlike")

    def open_listing(self, listing: DataFrame) -> None:
        """Files by their location, already staged."""
        options, formats = self.options, self.options.formats
        boxes = F.col("format").isin(formats.names_of(CONTAINER))
        by_parts = boxes & F.col("format").isin("zip", "mbox") & (
            F.col("size") > options.inline_bytes
        )
        ordinary, large = listing.filter(~by_parts), listing.filter(by_parts)
        surveyed = None
        if not large.isEmpty():
            wide = large.repartition(self.spark.sparkContext.defaultParallelism * 4, "path")
            surveyed = self.staged(survey_large(wide, self.limits.part), "survey")
        sized = _spread(ordinary, options)

        if self.mode == INCREMENTAL:
            hashed = self.staged(_with_stored_hash(sized), "hashed")
            known, few = self.known("discovered", hashed)
            fresh = self.staged(changed(hashed, known, self.mode, few), "fresh").select(*listing.columns)
            sized = _spread(fresh, options)
            if surveyed is not None:
                known, few = self.known("discovered", surveyed)
                surveyed = self.staged(changed(surveyed, known, self.mode, few), "survey-fresh")

        rows = open_stored(sized, formats, self.limits)
        if surveyed is not None:
            parts = open_parts(_placed(surveyed), formats, self.limits)
            rows = rows.unionByName(parts).unionByName(_source_rows(surveyed, formats))
        self.found.add_level(rows)

    def open_frame(self, files: DataFrame) -> None:
        """Files that come with their bytes: path, namespace, date_partition,
        source_file, content."""
        files = files.select(*_FILE_COLUMNS)
        if self.mode == INCREMENTAL:
            files = self._drop_known(files)
        self.found.add_level(open_inline(files, self.options.formats, self.limits))

    def _drop_known(self, files: DataFrame) -> DataFrame:
        """Change capture for rows with bytes. They are read, hashed and staged once;
        keys are compared alone, and the new rows come out of the staged files by position."""
        schema = T.StructType([*files.schema.fields, T.StructField("content_hash", T.StringType())])
        folder = f"{self.work}/arrived"
        hashed = files.withColumn("content_hash", content_hash(F.col("content")))
        stage_writer(hashed).parquet(folder)
        keys = self.spark.read.schema(schema).parquet(folder).select(
            *SOURCE_KEY,
            F.regexp_extract("_metadata.file_path", "([^/]+)$", 1).alias("stage_file"),
            F.col("_metadata.row_index").alias("stage_row"),
            F.length("content").alias("size"),
        )
        keys = self.staged(keys, "keys")
        known, few = self.known("discovered", keys)
        fresh = self.staged(changed(keys, known, self.mode, few), "fresh")
        total = fresh.agg(
            F.count_distinct("stage_file").alias("files"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes")
        ).first()
        tasks = max(1, total["files"], -(-total["bytes"] // self.options.task_bytes))
        return fetch_rows(fresh, folder, schema, _FILE_COLUMNS, min(tasks, MAX_TASKS))

    # -- the common rest ---------------------------------------------------

    def finish(self) -> dict:
        options, ledger = self.options, self.ledger
        unpack_all(self.found, options.formats, self.limits)
        found = self.found.counts()
        if not options.keep_work:
            _remove_spilled(self)
        self.drop("survey", "survey-fresh", "hashed", "fresh", "listing", "unlike")

        best = self.staged(first_wins(self.found.leaves()), "best")
        known, few = self.known("processed", best, "uid")
        winners = self.staged(without_known(best, known, "uid", few), "winners")
        self.drop("best")
        # Two chains of jobs that do not need each other.
        with ThreadPoolExecutor(2) as chains:
            records = chains.submit(self._write_records, found["source"])
            mails = chains.submit(self._write_bytes, winners)
            processed, few = mails.result()
            records.result()
        self.drop("found", "arrived", "keys")
        self._write_manifest(winners, few)
        self.drop("winners")
        if options.write_json:
            self._write_json("manifest")
        return {
            "discovered": found["source"],
            "processed": processed,
            "skipped": found["skip"],
            "deduplicated": found["leaf"] - processed,
        }

    def _write_records(self, n_sources: int) -> None:
        """Skips and sources. A source counts as discovered with the run's commit,
        so what a broken run has seen is seen again."""
        ledger, run_id = self.ledger, self.run_id
        ledger.write("skipped", run_id, self.found.skips().withColumn("discovered_at", now()))
        if self.options.write_json:
            self._write_json("skipped")
        sources = self.found.sources()
        if self.mode == INCREMENTAL:  # the known ones were dropped at the start
            fresh = sources.dropDuplicates(SOURCE_KEY)
        else:
            few = n_sources <= self.options.broadcast_keys
            known = ledger.may_hold("discovered", sources.select("content_hash")) if few else ledger.discovered()
            fresh = newly_discovered(sources, known, few)
        ledger.write("discovered", run_id, fresh.withColumn("discovered_at", now()))
        if self.snapshot is not None:
            ledger.write("listing", run_id, self.snapshot)

    def _write_bytes(self, winners: DataFrame) -> tuple[int, bool]:
        """Mails and attachments; how many mails, and whether few can have attachments."""
        count = self._write_mails(winners)
        return count, self._write_attachments(winners) <= self.options.broadcast_keys

    def _write_mails(self, winners: DataFrame) -> int:
        """Winners' bytes, laid out by folder.

        A bucket's files were opened folder by folder, so the staged files are
        laid out already and their rows are written as they come. Where each
        staged file holds many folders (files that came as rows in any order),
        writing like that would leave a file per task and folder; only then are
        the bytes shuffled, once, into evenly sized pieces per folder. So is a
        result too small to keep all cores at work.
        """
        pieces = winners.groupBy("stage_file", "namespace", "date_partition").agg(
            F.count(F.lit(1)).alias("mails"), F.sum("size").alias("bytes")
        )
        total = pieces.agg(
            F.coalesce(F.sum("mails"), F.lit(0)).alias("mails"),
            F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
            F.count(F.lit(1)).alias("pieces"),
            F.count_distinct("stage_file").alias("files"),
            F.count_distinct("namespace", "date_partition").alias("folders"),
        ).first()
        task_bytes = self.options.task_bytes
        tasks = max(1, total["files"], -(-total["bytes"] // task_bytes))
        columns = ["uid", "namespace", "date_partition", "name", "format", "mail"]
        fetched = fetch_rows(
            winners, self.found.folder, FOUND, columns, min(tasks, MAX_TASKS)
        )
        few = total["bytes"] < self.spark.sparkContext.defaultParallelism * task_bytes
        even_pieces = total["folders"] + total["bytes"] // task_bytes
        if few or total["pieces"] > 2 * even_pieces:
            fetched = fetched.hint("rebalance", "namespace", "date_partition")
        self.ledger.write(
            "emails",
            self.run_id,
            fetched.select(
                "uid",
                naming.suffix_of(F.col("name")).alias("ext"),
                "format",
                F.col("mail").alias("content"),
                "namespace",
                "date_partition",
            ),
        )
        return total["mails"]

    def _write_attachments(self, winners: DataFrame) -> int:
        """Only mails marked while unpacking can have any; only those are read. Returns how many these are."""
        likely = winners.filter("may_attach")
        total = likely.agg(
            F.count(F.lit(1)).alias("mails"),
            F.count_distinct("stage_file").alias("files"),
            F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"),
        ).first()
        tasks = max(1, total["files"], -(-total["bytes"] // self.options.task_bytes))
        mails = fetch_rows(
            likely, self.found.folder, FOUND, ["uid", "mail", *_FOLDER], min(tasks, MAX_TASKS)
        )
        self.ledger.write(
            "attachments",
            self.run_id,
            extract_attachments(
                mails, "mail", test=self.options.attachment_test, searched=True, keep=_FOLDER, faults=True
            ),
        )
        return total["mails"]

    def _write_manifest(self, winners: DataFrame, few: bool) -> None:
        """``few`` says that counts of attachments by mail fit a broadcast; then the winners are not shuffled."""
        ledger, run_id = self.ledger, self.run_id
        whole = ledger.read_own("attachments", run_id).where("fault IS NULL")
        counts = attachment_counts(whole.select("uid"))
        counts = F.broadcast(counts) if few else counts
        ledger.write("manifest", run_id, manifest_rows(winners, counts))
        ledger.write(
            "processed",
            run_id,
            ledger.read_own("manifest", run_id).select(
                "content_hash",
                "uid",
                F.col("source_lineage.source_file").alias("source_path"),
                "source_lineage.namespace",
                "source_lineage.date_partition",
                "output_path",
                F.col("source_lineage").alias("lineage"),
                "processed_at",
            ),
        )

    def commit(self, started, counts: dict) -> None:
        """Complete the run. Runs that were completed while this one was at work come first: what
        they hold too is taken out of this run before it tries for the next number."""
        ledger = self.ledger
        while True:
            last = ledger.commits.last()
            if last > self.base:
                counts = self._give_way(ledger.committed_after(self.base), counts)
                self.base = last
            if ledger.complete_run(self.run_id, self.mode, started, counts, last + 1):
                return

    def _give_way(self, others: list[str], counts: dict) -> dict:
        others = [run_id for run_id in others if run_id != self.run_id]
        if not others:
            return counts
        mails = self._take_out(others, "processed", ["uid"], ["emails", "attachments", "manifest", "processed"])
        if mails and self.options.write_json:
            self._write_json("manifest")
        self._take_out(others, "discovered", SOURCE_KEY, ["discovered"])
        return counts | {
            "processed": counts["processed"] - mails, "deduplicated": counts["deduplicated"] + mails
        }

    def _take_out(self, others: list[str], table: str, key: list[str], tables: list[str]) -> int:
        """Rows of this run whose keys another run holds, out of the given tables; returns how many keys."""
        ledger, run_id = self.ledger, self.run_id
        theirs = ledger.read(table).where(F.col("run_id").isin(others)).select(*key)
        name = f"taken-{table}-{uuid.uuid4().hex}"
        taken = self.staged(ledger.read_own(table, run_id).select(*key).join(theirs, key, "left_semi"), name)
        count = taken.count()
        for other in tables if count else ():
            rest = self.staged(ledger.read_own(other, run_id).join(taken, key, "left_anti"), f"{name}-{other}")
            ledger.write(other, run_id, rest)
        return count

    def _write_json(self, table: str) -> None:
        rows = self.ledger.read_own(table, self.run_id)
        json_lines(rows).write.mode("overwrite").text(
            f"{self.ledger.root}/json/{table}/run_id={self.run_id}"
        )


def _source_rows(surveyed: DataFrame, formats: Formats) -> DataFrame:
    """Records of large files themselves, laid out like the other found rows."""
    own = _placed(surveyed).select(
        "path",
        "namespace",
        "date_partition",
        "source_file",
        "entry_ord",
        "container_path",
        F.col("source_file").alias("name"),
        "format",
        F.lit("source").alias("kind"),
        F.col("content_hash").alias("uid"),
        "size",
    )
    missing = [f for f in FOUND if f.name not in own.columns]
    return own.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing})


def manifest_rows(winners: DataFrame, attachment_count: DataFrame) -> DataFrame:
    """Manifest of staged mails: lineage, output path, attachments."""
    n = F.coalesce("n_attachments", F.lit(0))
    place = [F.col("namespace"), F.col("date_partition")]
    return winners.join(attachment_count, "uid", "left").select(
        "uid",
        naming.lineage(
            *place, F.col("source_file"), F.col("container_path"), F.col("name")
        ).alias("source_lineage"),
        "format",
        F.col("uid").alias("content_hash"),
        naming.output_path(*place, F.col("uid"), naming.suffix_of(F.col("name"))).alias(
            "output_path"
        ),
        (n > 0).alias("has_attachments"),
        naming.attachment_dir(*place, F.col("uid"), n).alias("attachment_dir"),
        now().alias("processed_at"),
    )


def _ingest(run: _Run, open_sources) -> DataFrame:
    if run.named and run.ledger.is_completed(run.run_id):
        return run.row()  # done: repeating it would overwrite what it staged
    started = run.ledger.start_run(run.run_id, run.mode)
    try:
        open_sources(run)
        run.commit(started, run.finish())
    except Exception:
        run.ledger.fail_run(run.run_id, run.mode, started)
        raise
    else:
        if run.snapshot is not None:
            run.ledger.drop_snapshots(keep=2)
    finally:
        if not run.options.keep_work:
            _remove_work(run)
    return run.row()


def _remove_work(run: _Run) -> None:
    _remove_spilled(run)
    remove_tree(run.work)


def _remove_spilled(run: _Run) -> None:
    """Containers laid down may be as many as files, so tasks remove them, folder by folder."""
    folders = [f"{run.limits.spill_dir}/{entry.name}" for entry in list_dir(run.limits.spill_dir)]
    if folders:
        try:
            each = run.spark.range(0, len(folders), 1, len(folders))
            each.mapInArrow(_removing(folders), "id long").write.format("noop").mode("overwrite").save()
        except Exception:  # a session that has broken down; the end of the run removes them too
            pass


def _removing(folders: list[str]):
    def remove(batches):
        for batch in batches:
            for number in batch.column("id").to_pylist():
                storage.remove_tree(folders[number])
            yield batch

    return remove


def ingest(
    spark: SparkSession,
    input_root: str,
    output_root: str,
    mode: str = BACKFILL,
    *,
    namespaces: Iterable[str] | None = None,
    dates: Iterable[str] | None = None,
    options: Options = Options(),
    run_id: str | None = None,
) -> DataFrame:
    """Ingest a bucket; the result is the run's row of the run log.

    A ``run_id`` of the caller's makes the run repeatable: after a failure the
    same id starts over, after completion it only gives the row again.
    """
    run = _Run(spark, output_root, mode, options, run_id)
    return _ingest(run, lambda r: r.open_bucket(input_root, namespaces, dates))


def ingest_listing(
    files: DataFrame,
    output_root: str,
    mode: str = BACKFILL,
    *,
    options: Options = Options(),
    run_id: str | None = None,
    root: str | None = None,
) -> DataFrame:
    """Ingest files given by their locations, with the columns of a listing.

    ``root`` says that they are all files there are below it; without it, files that are
    not among them stay in the snapshot of a run by stat. A run by stat that finds
    nothing to look into leaves no trace in the run log, and its result is empty.
    """
    run = _Run(files.sparkSession, output_root, mode, options, run_id)
    if run.named and run.ledger.is_completed(run.run_id):
        return run.row()
    listing = run.staged(files, "listing")
    if root is not None:
        covered = F.startswith("location", F.lit(f"{root.rstrip('/')}/"))
    else:
        covered = F.lit(False)
    rows = run.looked_at(listing, covered)
    if options.by_stat and mode == INCREMENTAL and rows.isEmpty():
        remove_tree(run.work)
        return run.row()
    return _ingest(run, lambda r: r.open_listing(rows))


def ingest_frame(
    files: DataFrame,
    output_root: str,
    mode: str = BACKFILL,
    *,
    options: Options = Options(),
    run_id: str | None = None,
) -> DataFrame:
    """Ingest files that are rows already, such as a micro-batch of a stream."""
    run = _Run(files.sparkSession, output_root, mode, options, run_id)
    return _ingest(run, lambda r: r.open_frame(files))
