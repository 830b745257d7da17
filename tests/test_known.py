"""Known keys by filter: only files that can hold one are read, and the result is the whole ledger's."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from mailsift import Ledger, ingest
from mailsift.operators.first_wins import without_known
from mailsift.plans import known
from mailsift.plans.ledger import COMPLETED
from mailsift.sources import storage
from tests.test_ledger import _bucket, _holds_once
from tests.trees import eml


def _hash(number: int) -> str:
    return hashlib.sha256(str(number).encode()).hexdigest()


def _keys(spark, numbers, *others):
    """The hashes of a range of numbers, and other values; made by the JVM."""
    first = spark.range(numbers.start, numbers.stop, 1, 1)
    hashes = first.select(F.sha2(F.col("id").cast("string").cast("binary"), 256).alias("content_hash"))
    more = [F.lit(v).cast("string").alias("content_hash") for v in others]
    for value in more:
        hashes = hashes.unionByName(spark.range(0, 1, 1, 1).select(value))
    return hashes


def _run(ledger, run_id, numbers):
    """A committed run with these keys, and one row without a key."""
    keys = _keys(ledger.spark, numbers, None).coalesce(1)
    path = F.concat(F.lit("p/"), F.coalesce(F.substring("content_hash", 1, 8), F.lit("none")))
    for table in ("discovered", "processed", "skipped", "manifest"):
        schema = ledger.read(table).schema
        own = {"content_hash": F.col("content_hash"), "uid": F.col("content_hash"), "path": path}
        columns = [own.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema if f.name != "run_id"]
        ledger.write(table, run_id, keys.select(*columns))
    counts = dict.fromkeys(("discovered", "processed", "skipped", "deduplicated"), 0)
    assert ledger.complete_run(run_id, "backfill", ledger.start_run(run_id, "backfill"), counts)


def _opened(rows):
    """Names of the compacted files that the plan of these rows reads."""
    return sorted(f.rsplit("/", 1)[1] for f in rows.inputFiles() if "/compacted/" in f and "/processed/" in f)


@pytest.fixture(scope="module")
def compacted(spark, tmp_path_factory):
    ledger = Ledger(spark, str(tmp_path_factory.mktemp("known") / "out"))
    _run(ledger, "a", range(0, 1500))
    _run(ledger, "b", range(1000, 2500))  # a third of them once more
    assert ledger.compact(files=12)
    _run(ledger, "later", range(2550, 2560))
    return ledger


@pytest.mark.parametrize("asked", [range(2400, 2600), range(5000, 5200), range(0)])
def test_few_keys_compare_as_with_the_whole_ledger(spark, compacted, asked):
    rows = _keys(spark, asked, *map(_hash, asked[:3]), None)
    for table in ("processed",) if asked else ("processed", "discovered"):
        near = compacted.may_hold(table, rows)
        got = without_known(rows, near, "content_hash", True).collect()
        want = without_known(rows, compacted.read(table), "content_hash").collect()
        assert sorted(map(str, got)) == sorted(map(str, want))
        # Every row of an asked key is there, with its run.
        mine = rows.distinct()
        held = [sorted(map(str, r.join(mine, "content_hash").select("content_hash", "run_id").collect()))
                for r in (near, compacted.read(table))]
        assert held[0] == held[1]


def test_files_without_an_asked_key_are_not_opened(spark, compacted):
    place = compacted.commits.compaction()[1]
    asked = _keys(spark, range(9000, 9050), _hash(7), _hash(2000))
    chosen = known.files_with(spark, f"{place}/known/processed", asked)
    everything = [e.name for e in storage.list_dir(f"{place}/processed") if e.name.endswith(".parquet")]
    assert 1 <= len(chosen) <= 3 < len(everything)
    near = compacted.may_hold("processed", asked)
    assert {r.content_hash for r in near.join(asked.distinct(), "content_hash").collect()} == {_hash(7), _hash(2000)}
    assert _opened(near) == chosen


def test_without_a_possible_hit_nothing_compacted_is_read(spark, compacted):
    near = compacted.may_hold("processed", _keys(spark, range(0), "no hash at all", ""))
    assert _opened(near) == []


def test_the_filter_lets_all_known_pass_and_few_others(spark, compacted):
    place = f"{compacted.commits.compaction()[1]}/known/processed"
    held = {r.key for r in known.passing(spark, place, _keys(spark, range(2500))).collect()}
    assert held == set(map(_hash, range(2500)))
    assert known.passing(spark, place, _keys(spark, range(10_000, 30_000))).count() <= 20


def test_empty_ledgers_and_compactions_without_a_filter(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "out"))
    asked = _keys(spark, range(1, 2))
    assert ledger.may_hold("processed", asked).count() == 0  # nothing written yet
    assert ledger.compact() and ledger.may_hold("processed", asked).count() == 0
    _run(ledger, "a", range(3))
    assert ledger.compact() and ledger.may_hold("processed", asked).count() == 4  # one small file
    place = ledger.commits.compaction()[1]
    storage.remove_tree(f"{place}/known")
    assert ledger.may_hold("processed", asked).count() == 4
    assert ledger.runs().where(F.col("status") == COMPLETED).count() == 1


@pytest.mark.parametrize("mode", ["incremental", "backfill"])
def test_runs_after_a_compaction_ask_the_filter(spark, tmp_path, monkeypatch, mode):
    root, out = tmp_path / "in", str(tmp_path / "out")
    _bucket(root, {f"{i}.eml": eml(f"m{i}") for i in range(20)})
    ledger = Ledger(spark, out)
    ingest(spark, str(root), out)
    assert ledger.compact(files=4)
    ledger.vacuum()
    asked = []
    files_with = known.files_with
    monkeypatch.setattr(known, "files_with", lambda *a: asked.append(files_with(*a)) or asked[-1])
    _bucket(root, {"new.eml": eml("new"), "copy.eml": eml("m3")})
    row = ingest(spark, str(root), out, mode).first()
    assert asked and row.files_processed == 1
    _holds_once(ledger, 21)
    assert ledger.discovered().count() == 22
