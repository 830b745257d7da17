"""End to end: the edge case bucket through whole runs."""

from __future__ import annotations

import json
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from mailsift import DEFAULT, Ledger, Options, ingest, ingest_frame, run_metrics, status
from mailsift.operators import unpack
from mailsift.plans import export
from mailsift.plans import ingest as plan
from mailsift.sources import bucket as buckets
from tests.trees import FIRST, ONE, SECOND, damaged, eml, eml_with, mbox, write_tree, zipped


def counters(run):
    row = run.first()
    assert row.status == "completed" and row.started_at <= row.completed_at
    return (
        row.files_discovered,
        row.files_processed,
        row.files_deduplicated,
        row.files_skipped,
    )


@pytest.fixture(scope="module")
def done(spark, bucket, tmp_path_factory):
    """One backfill of the edge case bucket, for the tests that only look."""
    out = str(tmp_path_factory.mktemp("done"))
    run = ingest(spark, bucket, out, "backfill", run_id="first")
    return Ledger(spark, out), counters(run), out


def lineages(ledger):
    return [r.asDict(True) for r in ledger.manifest().select("uid", "source_lineage.*").collect()]


def test_counters_of_all_modes(spark, bucket, out):
    assert counters(ingest(spark, bucket, out, "backfill")) == (13, 11, 1, 6)
    assert counters(ingest(spark, bucket, out, "backfill")) == (13, 0, 12, 6)
    assert counters(ingest(spark, bucket, out, "incremental")) == (0, 0, 0, 0)
    ledger = Ledger(spark, out)
    assert ledger.emails().count() == ledger.processed().count() == 11
    assert ledger.discovered().count() == 13
    row = status(spark, out).first()
    assert (row.total_processed, row.total_skipped, row.mode) == (11, 12, "incremental")


def test_skips_say_where_and_why(done):
    ledger, counts, _ = done
    assert counts == (13, 11, 1, 6)
    day = f"north/timestamp={FIRST}/"
    assert Counter((r.path, r.reason) for r in ledger.skipped().collect()) == Counter(
        {
            (day + "year.zip/2023/readme.txt", "unsupported_format"): 1,
            (day + "vault.zip/key.eml", "password_protected"): 1,
            (day + "vault.zip/keys.mbox", "password_protected"): 1,
            (day + "torn.zip", "corrupted"): 1,
            (day + "scan.tiff", "unsupported_format"): 1,
            (day + "contacts.pst", "pst_not_supported"): 1,
        }
    )


def test_lineage_of_nested_mails(done):
    rows = {(r["source_file"], tuple(r["container_path"])) for r in lineages(done[0])}
    assert ("year.zip", ("2023/inbox.mbox", "About.roof@example.org.eml")) in rows
    assert ("year.zip", ("2023/older.zip", "sent.mbox", "About.garden@example.org.eml")) in rows
    assert ("note-0001.eml", ()) in rows
    per_file = Counter(f for f, _ in rows)
    assert (per_file["week.mbox"], per_file["year.zip"], per_file["torn.zip"]) == (3, 4, 1)
    assert not any(f.startswith(("void", "drafts")) for f, _ in rows)


def test_first_copy_in_corpus_order_wins(done):
    from hashlib import sha256

    (row,) = [r for r in lineages(done[0]) if r["uid"] == sha256(ONE).hexdigest()]
    assert (row["date_partition"], row["source_file"]) == (FIRST, "note-0001.eml")


def test_bytes_are_staged_unchanged(spark, done):
    ledger = done[0]
    rows = ledger.emails().select("uid", F.sha2("content", 256).alias("h"), "content", "ext").collect()
    assert len(rows) == 11 and all(r.uid == r.h for r in rows)
    assert ONE in {bytes(r.content) for r in rows}


def test_attachments_lie_beside_their_mail(spark, done, tmp_path):
    ledger = done[0]
    (mail,) = ledger.manifest().filter("has_attachments").collect()
    assert mail.attachment_dir == mail.output_path.replace(".eml", "_attachments")
    rows = export.mail_files(ledger.emails()).unionByName(
        export.attachment_files(ledger.attachments())
    )
    assert export.write_files(rows, str(tmp_path)).count() == 13
    files = {p.name: p.read_bytes() for p in (tmp_path / mail.attachment_dir).iterdir()}
    assert sorted(files.values()) == [b"%PDF map", b"\xff\xd8 view"] and "view.jpg" in files
    for row in ledger.manifest().collect():
        assert (tmp_path / row.output_path).exists()


def test_json_lines_keep_nulls(done):
    out = Path(done[2]) / "json"
    lines = [
        json.loads(line)
        for file in (out / "manifest" / "run_id=first").glob("part-*")
        for line in file.read_text().splitlines()
    ]
    assert len(lines) == 11
    assert set(lines[0]) == {
        "uid",
        "source_lineage",
        "format",
        "content_hash",
        "output_path",
        "has_attachments",
        "attachment_dir",
        "processed_at",
    }
    skips = [x for f in (out / "skipped" / "run_id=first").glob("part-*") for x in f.read_text().splitlines()]
    assert len(skips) == 6


def test_metrics_by_run(spark, done):
    (row,) = run_metrics(spark, done[2]).collect()
    assert (row.namespace, row.discovered, row.processed, row.skipped) == ("north", 13, 11, 6)


def test_replaced_new_and_copied_files(spark, tmp_path, out):
    root = tmp_path / "in"
    write_tree(root)
    ingest(spark, str(root), out)
    day = root / "north" / f"timestamp={FIRST}"
    (day / "note-0001.eml").write_bytes(eml("replaced"))  # new bytes, known path
    (day / "again.eml").write_bytes(ONE)  # known bytes, new path
    (day / "late.zip").write_bytes(zipped(("x.eml", eml("late")), ("y.eml", ONE)))
    assert counters(ingest(spark, str(root), out, "incremental")) == (3, 2, 2, 0)


def test_scope_of_a_run(spark, tmp_path, out):
    root = tmp_path / "in"
    write_tree(root)
    write_tree(root, "beta")
    scoped = ingest(spark, str(root), out, namespaces=["beta"], dates=[SECOND])
    assert counters(scoped) == (4, 3, 0, 0)


def test_listing_sees_what_a_directory_shows(spark, tmp_path):
    day = tmp_path / "ns one" / "timestamp=2024-07-15"
    (day / "sub").mkdir(parents=True)
    for name in ("a b%20c.eml", "_under.eml", ".hidden.eml", "zero.eml", "é.eml"):
        (day / name).write_bytes(b"" if name == "zero.eml" else b"x")
    (day / "sub" / "deep.eml").write_bytes(b"x")
    (tmp_path / ".secret" / "timestamp=2024-07-15").mkdir(parents=True)
    (tmp_path / ".secret" / "timestamp=2024-07-15" / "s.eml").write_bytes(b"x")
    (tmp_path / "ns one" / "date=2024-07-15").mkdir()
    (tmp_path / "ns one" / "timestamp=2024-7-15").mkdir()
    (tmp_path / "file.eml").write_bytes(b"x")
    got = buckets.list_files(spark, str(tmp_path)).collect()
    assert sorted(r.source_file for r in got) == sorted(["a b%20c.eml", "_under.eml", "zero.eml", "é.eml"])
    assert {(r.namespace, r.date_partition) for r in got} == {("ns one", "2024-07-15")}
    assert buckets.list_date_partitions(spark, str(tmp_path), ["none"]).count() == 0
    assert buckets.file_exists(spark, str(tmp_path), "ns one", "2024-07-15", "é.eml").first()[0]
    seen = buckets.scan_binary(spark, str(tmp_path)).select("source_file").collect()
    assert sorted(r[0] for r in seen) == sorted(["a b%20c.eml", "é.eml"])


def test_zero_byte_mail_counts(spark, tmp_path, out):
    day = tmp_path / "n" / "timestamp=2024-07-15"
    day.mkdir(parents=True)
    (day / "none.eml").write_bytes(b"")
    assert counters(ingest(spark, str(tmp_path), out)) == (1, 1, 0, 0)


def test_large_containers_in_parts_equal_whole_ones(spark, tmp_path):
    root = tmp_path / "in"
    write_tree(root)
    day = root / "north" / "timestamp=2023-02-20"
    day.mkdir()
    many = [eml(f"m{n}", "line\n" * (n % 7)) for n in range(60)]
    (day / "big.mbox").write_bytes(mbox(*many, *[b"S: x\n\nno id %d\n" % n for n in range(9)]))
    (day / "big.zip").write_bytes(
        zipped(*((f"{n}.eml", eml(f"z{n}")) for n in range(40)), ("in.mbox", mbox(*many)), ("x.png", b"1"))
    )
    stored = zipped(*((f"{n}.eml", eml(f"d{n}")) for n in range(30)), method=0)
    (day / "torn.zip").write_bytes(damaged(stored, "11.eml"))

    def result(name, **options):
        out = str(tmp_path / name)
        run = counters(ingest(spark, str(root), out, options=Options(**options)))
        ledger = Ledger(spark, out)
        mails = ledger.manifest().select("uid", "source_lineage").collect()
        skips = ledger.skipped().select("path", "reason").collect()
        return run, sorted(map(str, mails)), sorted(map(str, skips))

    whole, parts = result("whole"), result("parts", inline_bytes=600)
    assert whole == parts
    assert whole[0] == (16, 11 + 60 + 9 + 40 + 11, 61, 8)


def test_a_failed_run_leaves_nothing_and_can_be_repeated(spark, bucket, out, monkeypatch):
    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(plan._Run, "_write_json", fail)  # all tables written, no commit
        with pytest.raises(RuntimeError):
            ingest(spark, bucket, out, "incremental", run_id="one")
    ledger = Ledger(spark, out)
    assert ledger.runs().first().status == "failed"
    assert ledger.processed().isEmpty() and ledger.discovered().isEmpty()
    assert status(spark, out).first().total_processed == 0
    assert counters(ingest(spark, bucket, out, "incremental", run_id="one")) == (13, 11, 1, 6)
    assert ledger.emails().count() == 11
    # Once completed, the id stands for what it did.
    assert counters(ingest(spark, bucket, out, "backfill", run_id="one")) == (13, 11, 1, 6)
    assert ledger.emails().count() == 11 and ledger.runs().count() == 1


def test_winners_do_not_depend_on_partitioning(spark):
    rows = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 40).cast("string")).alias("uid"),
        (F.col("id") % 7).cast("string").alias("namespace"),
        F.lit("2024-07-15").alias("date_partition"),
        (F.hash("id") % 11).cast("string").alias("source_file"),
        F.array(F.lit(0), F.col("id")).alias("entry_ord"),
    )
    from mailsift.operators.first_wins import first_wins

    want = sorted(first_wins(rows).collect())
    for n in (1, 3, 16):
        assert sorted(first_wins(rows.repartition(n)).collect()) == want
    best = {}
    for r in rows.collect():
        key = (r.namespace, r.date_partition, r.source_file, r.entry_ord)
        best[r.uid] = min(best.get(r.uid, key), key)
    assert {r.uid: tuple(r)[1:] for r in want} == best


def frame(spark, name, content):
    return spark.createDataFrame(
        [(f"n/timestamp=2023-02-03/{name}", "n", "2023-02-03", name, content)],
        "path string, namespace string, date_partition string, source_file string, content binary",
    )


def test_no_depth_is_too_deep(spark, out):
    inner = zipped(("a.eml", eml("a")))
    for _ in range(24):
        inner = zipped(("again.zip", inner))
    assert counters(ingest_frame(frame(spark, "q.zip", inner), out)) == (1, 1, 0, 0)


def test_a_container_in_itself_ends(spark, out):
    def reader(content):
        yield "self.loop", content
        yield "a.note", b"a"

    own = DEFAULT.register(".note", "single_email").register(".loop", "container", reader)
    run = ingest_frame(frame(spark, "q.loop", b"loop"), out, options=Options(formats=own))
    assert counters(run) == (1, 1, 1, 1)
    assert Ledger(spark, out).skipped().first().reason == "contains_itself"


def test_known_rows_are_dropped_by_keys_alone(spark, out, monkeypatch):
    plans = []
    whole = plan.fetch_rows
    monkeypatch.setattr(plan, "fetch_rows", lambda chosen, *a: plans.append(chosen) or whole(chosen, *a))
    both = frame(spark, "a.eml", eml("a")).unionByName(frame(spark, "b.eml", eml("b")))
    assert counters(ingest_frame(both, out, "incremental")) == (2, 2, 0, 0)
    more = both.unionByName(frame(spark, "c.eml", eml("c")))
    assert counters(ingest_frame(more, out, "incremental")) == (1, 1, 0, 0)
    assert "content" not in plans[0].columns


def test_own_formats(spark, tmp_path, out):
    own = DEFAULT.register(".note", "single_email").register(
        ".pairs", "container", lambda content: ((f"{n}.note", p) for n, p in enumerate(content.split(b"|")))
    )
    day = tmp_path / "n" / "timestamp=2024-07-15"
    day.mkdir(parents=True)
    (day / "x.pairs").write_bytes(b"one|two|one")
    assert counters(ingest(spark, str(tmp_path), out, options=Options(formats=own))) == (1, 2, 1, 0)
    assert {r.ext for r in Ledger(spark, out).emails().collect()} == {".note"}


def test_bad_mode_is_refused(spark, bucket, out):
    with pytest.raises(ValueError):
        ingest(spark, bucket, out, "sometimes")


def test_attachment_test_by_value(spark, tmp_path, out):
    day = tmp_path / "n" / "timestamp=2024-07-15"
    day.mkdir(parents=True)
    (day / "m.eml").write_bytes(
        eml_with([('inline; filename="attachment.png"', b"I"), ('Attachment; filename="b"', b"U")])
    )
    ingest(spark, str(tmp_path), out, options=Options(attachment_test="value"))
    assert [r.name for r in Ledger(spark, out).attachments().collect()] == ["b"]


def test_plans_move_keys_not_bytes(spark, bucket, tmp_path):
    found = unpack.Found(spark, str(tmp_path / "found"))
    found.add_level(unpack.open_stored(buckets.list_files(spark, bucket), DEFAULT, unpack.Limits()))
    from mailsift.operators.first_wins import first_wins

    plan_text = first_wins(found.leaves())._jdf.queryExecution().executedPlan().toString()
    assert "mail" not in plan_text.split("ReadSchema")[1] and "box" not in plan_text.split("ReadSchema")[1]
