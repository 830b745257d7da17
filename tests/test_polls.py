"""Listing snapshots, runs by stat, and the bucket as a streaming source."""

from __future__ import annotations

import os
import random
from datetime import UTC, datetime

import pytest

from mailsift import Ledger, Options, ingest, ingest_stream, schemas, watch_bucket
from mailsift.sources import snapshots
from tests.trees import FIRST, SECOND, eml

BY_STAT = Options(by_stat=True, settle_seconds=0)


def _rows(files):
    return [
        (f"n/timestamp={day}/{name}", "n", day, name, f"{root}/n/timestamp={day}/{name}", size,
         None if when is None else datetime(2024, 1, 1, tzinfo=UTC).replace(microsecond=when))
        for (root, day, name), (size, when) in files.items()
    ]


def test_difference_equals_a_plain_one(spark):
    rng = random.Random(6)
    before = {(f"/r{rng.randint(1, 2)}", f"2024-01-{rng.randint(10, 20)}", f"f{i}"): (rng.randint(0, 3), rng.choice([1, 2, None]))
              for i in range(300)}
    now = {k: (v if rng.random() < 0.9 else (v[0] + 1, v[1])) for k, v in before.items() if rng.random() < 0.95}
    now = {k: (size, when or 5) for k, (size, when) in now.items()}
    now |= {("/r1", "2024-02-01", f"new{i}"): (1, 1) for i in range(5)}
    frames = [spark.createDataFrame(_rows(files), schemas.LISTING) for files in (now, before)]
    got = {r.location for r in snapshots.unlike(*frames).collect()}
    want = {f"{root}/n/timestamp={day}/{name}" for (root, day, name), stat in now.items() if before.get((root, day, name)) != stat}
    assert got == want and 20 < len(want) < len(now)
    empty = frames[0].limit(0)
    assert snapshots.unlike(frames[0], empty).count() == len(now) and snapshots.unlike(empty, frames[1]).count() == 0
    # Files that moved from one folder to another are not taken for a folder left as it was.
    swapped = {("/r1", "2024-02-01", f"new{1 - i}"): (i, 1) for i in range(2)}
    straight = {("/r1", "2024-02-01", f"new{i}"): (i, 1) for i in range(2)}
    a, b = (spark.createDataFrame(_rows(f), schemas.LISTING) for f in (swapped, straight))
    assert snapshots.unlike(a, b).count() == 2


def _write(root, name, content, when=1_700_000_000, day=FIRST):
    path = root / "n" / f"timestamp={day}" / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(content)
    os.utime(path, (when, when))


def test_unchanged_files_are_not_opened(spark, tmp_path):
    root, out = tmp_path / "in", str(tmp_path / "out")
    for i in range(4):
        _write(root, f"{i}.eml", eml(f"m{i}"))
    ledger = Ledger(spark, out)
    ingest(spark, str(root), out, "incremental", options=BY_STAT)
    assert ledger.processed().count() == 4
    # Other bytes behind the same size and time: only who opens the file can tell.
    _write(root, "0.eml", eml("m0").swapcase())
    _write(root, "1.eml", eml("other"), 1_700_000_001)
    _write(root, "2.eml", eml("m2"), 1_700_000_002)
    _write(root, "4.eml", eml("m3"))
    _write(root, "5.eml", eml("m5"), day=SECOND)
    row = ingest(spark, str(root), out, "incremental", options=BY_STAT).first()
    assert (row.files_discovered, row.files_processed, row.files_deduplicated) == (3, 2, 1)
    # Without the option all files are hashed, and the disguised one shows.
    row = ingest(spark, str(root), out, "incremental").first()
    assert (row.files_discovered, row.files_processed) == (1, 1)


def test_a_broken_run_leaves_no_snapshot_and_parts_of_a_bucket_keep_the_rest(spark, tmp_path, monkeypatch):
    from mailsift.plans import ingest as plan

    root, out = tmp_path / "in", str(tmp_path / "out")
    _write(root, "a.eml", eml("a"))
    _write(root, "b.eml", eml("b"), day=SECOND)
    with monkeypatch.context() as patch:
        patch.setattr(plan._Run, "commit", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            ingest(spark, str(root), out, "incremental", options=BY_STAT)
    ledger = Ledger(spark, out)
    assert ledger.snapshot().count() == 0
    assert ingest(spark, str(root), out, "incremental", options=BY_STAT).first().files_processed == 2
    _write(root, "c.eml", eml("c"))
    row = ingest(spark, str(root), out, "incremental", dates=[FIRST], options=BY_STAT).first()
    assert row.files_discovered == 1
    names = sorted(r.source_file for r in ledger.snapshot().collect())
    assert names == ["a.eml", "b.eml", "c.eml"]
    (root / "n" / f"timestamp={FIRST}" / "a.eml").unlink()
    assert ingest(spark, str(root), out, "incremental", options=BY_STAT).first().files_discovered == 0
    assert sorted(r.source_file for r in ledger.snapshot().collect()) == ["b.eml", "c.eml"]
    assert len(ledger.snapshots()) == 2  # older ones are gone


def test_fresh_files_are_looked_at_again(spark, tmp_path):
    root, out = tmp_path / "in", str(tmp_path / "out")
    _write(root, "a.eml", eml("a"), when=4_000_000_000)  # not settled
    ingest(spark, str(root), out, "incremental", options=BY_STAT)
    _write(root, "a.eml", eml("a").swapcase(), when=4_000_000_000)
    assert ingest(spark, str(root), out, "incremental", options=BY_STAT).first().files_discovered == 1


def test_a_stream_sees_late_empty_and_replaced_files_alone_in_their_folder(spark, tmp_path):
    root, out = tmp_path / "in", str(tmp_path / "out")
    ledger = Ledger(spark, out)

    def round_():
        ingest_stream(watch_bucket(spark, str(root)), out, str(tmp_path / "ck")).awaitTermination()
        return sorted((r.path.rsplit("/", 1)[1], r.size_bytes) for r in ledger.discovered().collect())

    _write(root, "a.eml", eml("a"))
    sizes = [("a.eml", len(eml("a")))]
    assert round_() == sizes
    _write(root, "_b.eml", eml("b"))
    assert round_() == (sizes := sorted([*sizes, ("_b.eml", len(eml("b")))]))
    _write(root, "none.mbox", b"")
    assert round_() == (sizes := sorted([*sizes, ("none.mbox", 0)]))
    _write(root, "a.eml", eml("a") + b"more", 1_700_000_009)
    assert round_() == sorted([*sizes, ("a.eml", len(eml("a")) + 4)])
    kept = sorted((r.source_file, r.size) for r in ledger.snapshot().collect())
    assert kept == [("_b.eml", len(eml("b"))), ("a.eml", len(eml("a")) + 4), ("none.mbox", 0)]
    runs = ledger.runs().count()
    round_()  # nothing new leaves no run
    assert ledger.runs().count() == runs == 4


def test_an_empty_or_missing_bucket_streams_nothing(spark, tmp_path):
    out = str(tmp_path / "out")
    ingest_stream(watch_bucket(spark, str(tmp_path / "none")), out, str(tmp_path / "ck")).awaitTermination()
    assert Ledger(spark, out).runs().count() == 0
