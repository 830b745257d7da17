"""Files as a stream: rounds of a stream equal one batch."""

from __future__ import annotations

import os
import time

from mailsift import Ledger, ingest, ingest_stream, watch_bucket
from mailsift.plans import ingest as plan
from tests.trees import FIRST, ONE, eml, write_tree, zipped


def test_two_rounds_equal_one_batch(spark, tmp_path):
    root, out = tmp_path / "in", str(tmp_path / "out")
    write_tree(root)

    def round_():
        query = ingest_stream(watch_bucket(spark, str(root)), out, str(tmp_path / "ck"))
        query.awaitTermination()

    round_()
    ledger = Ledger(spark, out)
    # The zero-byte mailbox is there too, though Spark's file source does not see it.
    assert ledger.discovered().count() == 13 and ledger.processed().count() == 11
    late = root / "north" / f"timestamp={FIRST}"
    (late / "late.eml").write_bytes(eml("late"))
    (late / "copies.zip").write_bytes(zipped(("a.eml", ONE), ("b.eml", eml("late"))))
    round_()
    assert ledger.discovered().count() == 15 and ledger.processed().count() == 12
    # Nothing is left for a run over the bucket.
    ingest(spark, str(root), out, "incremental")
    assert ledger.discovered().count() == 15 and ledger.processed().count() == 12

    batch = str(tmp_path / "batch")
    ingest(spark, str(root), batch)
    uids = lambda l: {r.uid for r in l.processed().collect()}
    assert uids(ledger) == uids(Ledger(spark, batch))


def test_a_batch_that_broke_off_is_done_again_once(spark, tmp_path, monkeypatch):
    root, out, check = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ck")
    write_tree(root)
    whole = plan._Run._write_json

    def fail(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(plan._Run, "_write_json", fail)
    try:
        ingest_stream(watch_bucket(spark, str(root)), out, check).awaitTermination()
    except Exception:
        pass
    assert Ledger(spark, out).processed().isEmpty()
    monkeypatch.setattr(plan._Run, "_write_json", whole)
    ingest_stream(watch_bucket(spark, str(root)), out, check).awaitTermination()
    assert Ledger(spark, out).emails().count() == 11


def test_old_files_and_new_checkpoints_lose_nothing(spark, tmp_path):
    root, out = tmp_path / "in", str(tmp_path / "out")
    day = root / "n" / f"timestamp={FIRST}"
    day.mkdir(parents=True)
    for name in ("a", "_b"):
        (day / f"{name}.eml").write_bytes(eml(name))

    def round_(checkpoint):
        ingest_stream(watch_bucket(spark, str(root)), out, str(tmp_path / checkpoint)).awaitTermination()

    round_("one")
    assert Ledger(spark, out).processed().count() == 2
    (day / "old.eml").write_bytes(eml("old"))
    month = time.time() - 30 * 86_400
    os.utime(day / "old.eml", (month, month))
    round_("one")
    assert Ledger(spark, out).processed().count() == 3
    (day / "more.eml").write_bytes(eml("more"))
    round_("two")  # starts at batch 0 again, as another run
    assert Ledger(spark, out).processed().count() == 4
