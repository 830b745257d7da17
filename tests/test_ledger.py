"""Commits, overlapping runs, compaction."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import UTC, datetime, timedelta

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql.pandas.types import to_arrow_schema

from mailsift import Ledger, ingest, schemas
from mailsift.plans import ingest as plan
from mailsift.plans.ledger import TABLES
from mailsift.sources import storage
from tests.trees import FIRST, eml, zipped


def test_one_of_many_writers_gets_a_number(tmp_path):
    path = str(tmp_path / "a" / "000001.json")
    with ThreadPoolExecutor(16) as pool:
        won = list(pool.map(lambda n: storage.create_new(path, b"%d" % n), range(64)))
    assert sum(won) == 1
    assert int(storage.read_all(path)) == won.index(True)
    assert [e.name for e in storage.list_dir(str(tmp_path / "a"))] == ["000001.json"]


def _bucket(root, files):
    for name, content in files.items():
        path = root / "n" / f"timestamp={FIRST}" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(content)
    return str(root)


def _holds_once(ledger, n):
    for table in ("processed", "manifest", "emails"):
        uids = [r.uid for r in ledger.read(table).select("uid").collect()]
        assert len(uids) == len(set(uids)) == n, table
    keys = [tuple(r) for r in ledger.discovered().select("content_hash", "path").collect()]
    assert len(keys) == len(set(keys))


def test_a_run_gives_way_to_one_that_ended_meanwhile(spark, tmp_path, monkeypatch):
    mails = {f"{i}.eml": eml(f"m{i}") for i in range(6)}
    root, out = _bucket(tmp_path / "in", mails), str(tmp_path / "out")
    commit = plan._Run.commit

    def late(run, *args):
        if run.run_id == "slow":
            _bucket(tmp_path / "in", {"more.zip": zipped(("x.eml", eml("extra")))})
            ingest(spark, root, out, "incremental", run_id="quick")
        commit(run, *args)

    monkeypatch.setattr(plan._Run, "commit", late)
    slow = ingest(spark, root, out, "incremental", run_id="slow").first()
    ledger = Ledger(spark, out)
    _holds_once(ledger, 7)
    quick = ledger.runs().filter("run_id = 'quick'").first()
    assert (quick.files_processed, slow.files_processed, slow.files_deduplicated) == (7, 0, 6)
    lines = spark.read.text(f"{out}/json/manifest/run_id=slow")
    assert lines.count() == 0


def test_a_run_keeps_what_the_other_lacks(spark, tmp_path, monkeypatch):
    one = _bucket(tmp_path / "one", {"a.eml": eml("a"), "b.eml": eml("b")})
    two = _bucket(tmp_path / "two", {"b.eml": eml("b"), "c.eml": eml("c")})
    out, commit = str(tmp_path / "out"), plan._Run.commit

    def late(run, *args):
        if run.run_id == "slow":
            ingest(spark, two, out, run_id="quick")
        commit(run, *args)

    monkeypatch.setattr(plan._Run, "commit", late)
    slow = ingest(spark, one, out, run_id="slow").first()
    ledger = Ledger(spark, out)
    _holds_once(ledger, 3)
    assert (slow.files_processed, slow.files_deduplicated) == (1, 1)
    assert [r.run_id for r in ledger.runs().orderBy("completed_at").collect()] == ["quick", "slow"]


def test_two_runs_at_once_give_each_mail_once(spark, tmp_path):
    root = _bucket(tmp_path / "in", {f"{i}.eml": eml(f"m{i % 9}") for i in range(12)})
    out = str(tmp_path / "out")
    with ThreadPoolExecutor(2) as pool:
        rows = [r.result() for r in [pool.submit(lambda n=n: ingest(spark, root, out, run_id=n).first()) for n in "ab"]]
    _holds_once(Ledger(spark, out), 9)
    assert sum(r.files_processed for r in rows) == 9 and {r.status for r in rows} == {"completed"}


def _written(root, first, last):
    """Small runs as they are left by ``ingest``, without its jobs."""
    began = datetime(2024, 1, 1, tzinfo=UTC)
    for n in range(first, last):
        run_id = f"run-{n:04d}"
        for table in ("processed", "discovered", "skipped", "manifest"):
            schema = to_arrow_schema(TABLES[table][1])
            schema = pa.schema([f for f in schema if f.name != "run_id"])
            key = f"{n * 7919 % 1000:04d}"
            rows = [{"uid": key, "content_hash": key, "path": f"p{n}", "reason": f"r{n}"}]
            rows = [{k: v for k, v in row.items() if k in schema.names} for row in rows]
            folder = root / TABLES[table][0] / f"run_id={run_id}"
            folder.mkdir(parents=True)
            pq.write_table(pa.Table.from_pylist(rows, schema=schema), folder / "part-0.parquet")
        entry = {"run_id": run_id, "mode": "backfill", "status": "completed", "files_discovered": 1, "files_processed": 1,
                 "files_skipped": 0, "files_deduplicated": 0, "event_no": 1,
                 "started_at": began, "completed_at": began + timedelta(seconds=n)}
        yield n + 1, entry


def _seen(ledger):
    return [sorted(map(tuple, ledger.read(t).drop("discovered_at", "processed_at", "source_lineage", "lineage").collect(), ), key=str)
            for t in ("processed", "discovered", "skipped", "manifest")] + [sorted(map(str, ledger.runs().collect()))]


def test_many_small_runs_read_alike_at_every_step_of_a_compaction(spark, tmp_path, monkeypatch):
    ledger = Ledger(spark, str(tmp_path))
    for number, entry in _written(tmp_path, 0, 1000):
        assert ledger.commits.take(number, "run", entry)
    before = _seen(ledger)
    assert len(before[0]) == 1000 and len(before[-1]) == 1000
    # One that breaks off before its commit changes nothing, and a run that commits first goes before it.
    take = ledger.commits.take
    monkeypatch.setattr(ledger.commits, "take", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        ledger.compact(files=3)
    assert _seen(Ledger(spark, str(tmp_path))) == before
    monkeypatch.setattr(ledger.commits, "take", lambda *_: False)
    assert not ledger.compact(files=3)
    monkeypatch.setattr(ledger.commits, "take", take)
    assert ledger.compact(files=3) and _seen(ledger) == before
    ledger.vacuum()
    assert _seen(ledger) == before
    assert not any(True for _ in storage.list_dir(f"{tmp_path}/ledger/processed"))
    assert len(list(storage.list_dir(f"{tmp_path}/ledger/commits"))) == 1
    files = [e.name for e in storage.list_dir(f"{ledger.commits.compaction()[1]}/processed") if e.name.endswith(".parquet")]
    assert len(files) <= 3
    # Later runs stand beside it, and a second compaction takes both in.
    for number, entry in _written(tmp_path, 1000, 1005):
        assert ledger.commits.take(number + 1, "run", entry)
    after = _seen(ledger)
    assert len(after[0]) == 1005 and ledger.read("processed", "run-1002").count() == 1 == ledger.read("processed", "run-0002").count()
    assert ledger.compact() and _seen(ledger) == after
    ledger.vacuum()
    assert _seen(ledger) == after and len(list((tmp_path / "ledger/compacted").iterdir())) == 2
    assert ledger.is_completed("run-0001") and ledger.is_completed("run-1004") and not ledger.is_completed("no")


def test_runs_go_on_after_a_compaction(spark, tmp_path):
    root, out = tmp_path / "in", str(tmp_path / "out")
    _bucket(root, {"a.eml": eml("a"), "b.eml": eml("b")})
    ledger = Ledger(spark, out)
    ingest(spark, str(root), out, "incremental")
    assert ledger.compact()
    ledger.vacuum()
    _bucket(root, {"c.eml": eml("c"), "again.eml": eml("a")})
    row = ingest(spark, str(root), out, "incremental").first()
    assert (row.files_discovered, row.files_processed, row.files_deduplicated) == (2, 1, 1)
    _holds_once(ledger, 3)
    assert ledger.runs().count() == 2 and ledger.emails().count() == 3


def test_schema_of_commits_holds_the_run_log():
    assert set(schemas.RUN_EVENTS.names) < set(schemas.COMMIT.names)
