"""What lies on disk during a run: nothing that is read no more."""

from __future__ import annotations

import os
import re

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from mailsift import Options, ingest
from mailsift.plans import ingest as plan
from mailsift.schemas import EMAILS, FOUND, MANIFEST, PROCESSED
from mailsift.session import PACKED
from mailsift.sources import bucket
from mailsift.sources.storage import list_dir
from tests.trees import eml, mbox, zipped


def _bucket(root):
    folder = root / "in" / "a" / "timestamp=2024-07-15"
    folder.mkdir(parents=True)
    box = mbox(*[eml("m%d" % n) for n in range(30)])
    (folder / "one.eml").write_bytes(eml("one"))
    (folder / "box.mbox").write_bytes(box)
    (folder / "deep.zip").write_bytes(zipped(("inner.zip", zipped(("b.mbox", box))), ("c.eml", eml("c"))))
    return str(root / "in")


def _files(folder):
    return [os.path.join(at, name) for at, _, names in os.walk(folder) for name in names if not name.startswith((".", "_"))]


def test_staged_tables_go_when_nothing_reads_them_any_more(spark, tmp_path, monkeypatch):
    spilled, left = [], {}
    whole_mails, whole_json = plan._Run._write_mails, plan._Run._write_json

    def mails(self, winners):
        spilled.append(_files(self.limits.spill_dir))
        left["mails"] = {entry.name for entry in list_dir(self.work)}
        return whole_mails(self, winners)

    def json(self, table):
        if table == "manifest":
            left["json"] = {entry.name for entry in list_dir(self.work)}
        return whole_json(self, table)

    monkeypatch.setattr(plan._Run, "_write_mails", mails)
    monkeypatch.setattr(plan._Run, "_write_json", json)
    run = ingest(spark, _bucket(tmp_path), str(tmp_path / "out"), options=Options(inline_bytes=64)).first()
    assert (run.files_discovered, run.files_processed) == (3, 32)
    assert spilled == [[]]  # containers laid down
    assert left["mails"] - {"spill"} == {"found", "winners"}
    assert left["json"] - {"spill"} == set()


def test_staged_work_is_kept_on_request(spark, tmp_path, monkeypatch):
    runs = []
    whole = plan._Run.finish
    monkeypatch.setattr(plan._Run, "finish", lambda self: runs.append(self) or whole(self))
    ingest(spark, _bucket(tmp_path), str(tmp_path / "out"), options=Options(inline_bytes=64, keep_work=True))
    assert {"found", "best", "winners", "listing"} <= {entry.name for entry in list_dir(runs[0].work)}
    assert _files(runs[0].limits.spill_dir)


def test_the_output_is_packed(spark, tmp_path):
    out = tmp_path / "out"
    ingest(spark, _bucket(tmp_path), str(out))
    for table in ("emails", "manifest", "ledger/processed", "ledger/discovered"):
        files = [f for f in _files(out / table) if f.endswith(".parquet")]
        assert files and {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files} == {"ZSTD"}


def test_shuffle_files_go_with_their_query(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        return set(re.findall(r"shuffle_\d+_\d+_\d+\.data", disk.getAllFiles().mkString(" ")))

    before = shuffled()
    rows = spark.range(10_000).groupBy((F.col("id") % 100).alias("key")).agg(F.count("*").alias("n"))
    assert len(rows.collect()) == 100 and len(rows.collect()) == 100  # also where a result is read twice
    assert not shuffled() - before


def test_bytes_and_hashes_begin_no_dictionary():
    """One is built in each row group only to be given up, which takes a tenth of the JVM's time."""
    columns = [f for f in (*FOUND, *EMAILS, *MANIFEST, *PROCESSED) if f.dataType == BinaryType() or f.name in ("uid", "content_hash")]
    assert {f.name for f in columns} >= {"uid", "mail", "box", "content", "content_hash"}
    assert all(PACKED[f"parquet.enable.dictionary#{f.name}"] == "false" for f in columns)
    assert PACKED["parquet.compression.codec.zstd.level"] == "1"  # as fast as the default codec


def test_a_folder_is_listed_in_batches_of_columns(tmp_path, monkeypatch):
    folder = tmp_path / "a" / "timestamp=2024-07-15"
    (folder / "below").mkdir(parents=True)
    names = [f"{n}.eml" for n in range(7)] + ["_odd"]
    for n, name in enumerate([*names, ".hidden"]):
        (folder / name).write_bytes(b"x" * n)
    monkeypatch.setattr(bucket, "_ROWS", 3)
    asked = pa.RecordBatch.from_pylist([{"root": str(tmp_path), "namespace": "a", "date_partition": "2024-07-15"}])
    found = list(bucket._files_below(iter([asked])))
    assert [batch.num_rows for batch in found] == [3, 3, 2]
    rows = {r["source_file"]: r for batch in found for r in batch.to_pylist()}
    assert sorted(rows) == sorted(names)
    for n, name in enumerate(names):
        row = rows[name]
        assert row["path"] == f"a/timestamp=2024-07-15/{name}" and row["location"] == f"{tmp_path}/{row['path']}"
        assert (row["namespace"], row["date_partition"], row["size"]) == ("a", "2024-07-15", n)
        assert abs(row["modified_at"].timestamp() - (folder / name).stat().st_mtime) < 0.001
