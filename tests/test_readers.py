"""What is in one container: archives, mailboxes, attachments."""

from __future__ import annotations

import email
import io
import mailbox
import random
import zipfile

import pytest

from mailsift.functions.formats import DEFAULT
from mailsift.operators.attachments import BY_TEXT, BY_VALUE, _attachments_of
from mailsift.operators.entries import (
    Limits,
    _read_message,
    box_items,
    mbox_items,
    mbox_part_items,
    survey,
    zip_items,
)
from mailsift.sources import storage
from tests.trees import damaged, eml, eml_with, locked, mbox, zipped


def entries_of(content, fmt, limits=Limits()):
    return list(box_items(content, fmt, DEFAULT, limits))


class TestArchive:
    def test_entries_in_order_without_folders(self):
        got = entries_of(zipped(("d/", b""), ("d/a.eml", b"1"), ("b.html", b"2")), "zip")
        assert [(i.kind, i.ord, i.name, i.payload) for i in got] == [
            ("entry", 1, "d/a.eml", b"1"),
            ("entry", 2, "b.html", b"2"),
        ]

    def test_empty_gives_nothing(self):
        assert entries_of(zipped(), "zip") == []

    def test_no_archive_is_corrupted(self):
        (got,) = entries_of(b"not an archive", "zip")
        assert (got.kind, got.reason) == ("broken", "corrupted")

    def test_locked_entries_are_refused_one_by_one(self):
        got = entries_of(locked(zipped(("a.eml", b"1"), ("b.png", b"2"))), "zip")
        assert [(i.kind, i.name, i.reason) for i in got] == [
            ("refused", "a.eml", "password_protected"),
            ("refused", "b.png", "password_protected"),
        ]

    def test_strong_encryption_is_unreadable_and_the_rest_is_read(self):
        got = entries_of(locked(zipped(("a.eml", b"1")), flag=0x41), "zip")
        assert [(i.kind, i.reason) for i in got] == [("refused", "unreadable")]

    def test_damage_midway_keeps_what_came_before(self):
        whole = zipped(*((f"{n}.eml", eml(f"n{n}")) for n in range(4)), method=zipfile.ZIP_STORED)
        got = entries_of(damaged(whole, "2.eml"), "zip")
        assert [i.name for i in got] == ["0.eml", "1.eml", None]
        assert got[-1].reason == "corrupted" and got[-1].cut is None

    def test_damage_in_an_unread_entry_shows_too(self):
        whole = zipped(("x.png", b"p" * 50), ("a.eml", b"1"), method=zipfile.ZIP_STORED)
        assert [i.kind for i in entries_of(damaged(whole, "x.png"), "zip")] == ["broken"]

    def test_two_entries_of_one_name_keep_their_own_bytes(self):
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w") as archive:
            archive.writestr("same.eml", b"first")
            with pytest.warns(UserWarning):
                archive.writestr("same.eml", b"second")
        assert [i.payload for i in entries_of(buffer.getvalue(), "zip")] == [b"first", b"second"]

    def test_bytes_of_unsupported_entries_do_not_travel(self):
        (got,) = entries_of(zipped(("x.png", b"12345")), "zip")
        assert (got.name, got.size, got.payload) == ("x.png", 5, None)

    def test_parts_cover_every_entry_once(self, tmp_path):
        names = [f"{n}.eml" for n in range(25)]
        path = tmp_path / "big.zip"
        path.write_bytes(zipped(*((n, eml(n)) for n in names)))
        _, _, parts = survey(str(path), "zip", 10_000)
        assert len(parts) > 5
        got = []
        for part in parts:
            with storage.open_seekable(str(path)) as file:
                got += zip_items(file, DEFAULT, Limits(), part["start"], part["end"])
        assert [i.name for i in got] == names
        assert got == entries_of(path.read_bytes(), "zip")

    def test_large_nested_container_is_laid_down(self, tmp_path):
        inner = zipped(("a.eml", eml("a")))
        (got,) = entries_of(zipped(("in.zip", inner)), "zip", Limits(inline=10, spill_dir=str(tmp_path)))
        assert got.payload is None and storage.read_all(got.spill) == inner


def by_stdlib(content: bytes, tmp_path):
    path = tmp_path / "box.mbox"
    path.write_bytes(content)
    box = mailbox.mbox(str(path))
    out = [(m.get("Message-ID", ""), m.as_bytes()) for m in box]
    box.close()
    return out


class TestMailbox:
    def test_names_places_and_bytes(self):
        one, two = eml("one"), b"Subject: no id\n\nbody\n"
        first, second = entries_of(mbox(one, two), "mbox")
        assert (first.message_id, first.index, first.ord) == ("<one@example.org>", 0, 0)
        assert first.payload == one.replace(b"\r\n", b"\n")
        assert (second.message_id, second.index, second.payload) == ("", 1, two)

    @pytest.mark.parametrize("content", [b"", b"no mailbox at all\n", b"\n\n"])
    def test_nothing_inside(self, content):
        assert entries_of(content, "mbox") == []

    def test_text_before_the_first_message_is_dropped(self):
        (got,) = entries_of(b"preface\n" + mbox(b"S: x\n\nb\n"), "mbox")
        assert got.payload == b"S: x\n\nb\n" and got.ord == 8

    def test_from_line_needs_no_blank_line_before_it(self):
        got = entries_of(b"From a\nS: 1\n\nx\nFrom b\nS: 2\n\ny\n", "mbox")
        assert [i.payload for i in got] == [b"S: 1\n\nx\n", b"S: 2\n\ny\n"]

    def test_long_headers_are_folded_anew_unless_raw(self):
        raw = b"Subject: " + b"word " * 40 + b"\n\nb\n"
        (folded,) = entries_of(b"From a\n" + raw, "mbox")
        (kept,) = entries_of(b"From a\n" + raw, "mbox", Limits(raw_mbox=True))
        assert folded.payload != raw and kept.payload == raw

    def test_unreadable_messages_are_refused_alone(self):
        content = b"From \xe9\nS: 1\n\nx\n\nFrom b\nMessage-ID: <\xff>\n\nx\n\nFrom c\nS: 3\n\ny\n"
        assert [(i.kind, i.reason, i.index) for i in entries_of(content, "mbox")] == [
            ("refused", "unreadable", 0),
            ("refused", "unreadable", 1),
            ("entry", None, 2),
        ]

    def test_any_mailbox_equals_the_standard_library(self, tmp_path):
        rng = random.Random(7)
        lines = [b"From a b\n", b"\n", b"text\n", b"From \n", b"Subject: s\n", b"\r\n", b"Message-ID: <i@x>\n",
                 b"x From y\n", b">From z\n", b"caf\xc3\xa9\n", b"From"]
        for _ in range(300):
            content = b"".join(rng.choice(lines) for _ in range(rng.randrange(25)))
            got = [(i.message_id, i.payload) for i in mbox_items(content)]
            assert got == by_stdlib(content, tmp_path), content

    def test_any_message_is_written_as_by_the_standard_library(self):
        rng = random.Random(5)
        heads = [b"Subject: s", b"Message-ID: <i@x>", b"X-Long: " + b"w " * 70, b" folded", b"Bad header line",
                 b"Content-Type: text/html; charset=utf-8", b"Content-Type: multipart/mixed; boundary=b",
                 b"Content-Type: message/rfc822", b"Content-Transfer-Encoding: base64", b"X: caf\xe9", b"From x",
                 b"Content-Type: multipart/mixed", b"Content-Type: image/png", b"Content-Type: junk", b":", b""]
        bodies = [b"text", b"--b", b"--b--", b"", b"From y", b"\xff\xfe", b"caf\xc3\xa9", b"Subject: inner", b" "]
        for _ in range(4000):
            end = rng.choice([b"\n", b"\n", b"\r\n", b"\r\n", b"\r"])
            lines = rng.choices(heads, k=rng.randrange(5)) + [b""] + rng.choices(bodies, k=rng.randrange(6))
            raw = end.join(lines) + rng.choice([b"", end, b"\n"])
            message = email.message_from_bytes(raw)
            try:
                want = (message.get("Message-ID", ""), message.as_bytes())
            except Exception:
                with pytest.raises(Exception):
                    _read_message(raw)
                continue
            assert _read_message(raw) == want, raw

    def test_any_cut_gives_the_same_messages(self, tmp_path, monkeypatch):
        monkeypatch.setattr(storage, "CHUNK", 16)
        rng = random.Random(11)
        lines = [b"From a\n", b"\n", b"text text\n", b"Subject: s\n", b"From", b"\nFrom b\n"]
        path = tmp_path / "big.mbox"
        for _ in range(150):
            path.write_bytes(b"".join(rng.choice(lines) for _ in range(rng.randrange(40))))
            whole = list(mbox_items(path.read_bytes()))
            part = rng.choice([1, 7, 20, 64, 10_000])
            digest, size, parts = survey(str(path), "mbox", part)
            got = []
            for p in parts:
                with storage.open_seekable(str(path)) as file:
                    got += mbox_part_items(file, p["start"], p["end"], p["base"])
            assert got == whole


class TestAttachments:
    def test_the_raw_test_fails_no_mail_with_attachments(self, spark):
        mails = [
            eml_with([('attachment; filename="a"', b"A")]),
            eml_with([('attachment; filename="a"', b"A")]).replace(b"Content-Disp", b"CONTENT-disp"),
            eml_with([("=?utf-8?q?attachment?=; filename=a", b"A")]),
            b"\xff\xfe" + eml_with([('attachment; filename="a"', b"A")]),
            eml("none"),
        ]
        from pyspark.sql import functions as F

        from mailsift.operators.attachments import may_have_attachments

        rows = spark.createDataFrame([(m,) for m in mails], "c binary")
        got = [r.t for r in rows.select(may_have_attachments(F.col("c")).alias("t")).collect()]
        assert got == [True, True, True, True, False]

    def test_names_and_bytes(self):
        mail = eml_with([('attachment; filename="a.pdf"', b"A"), ('attachment; filename="a.pdf"', b"B")])
        assert list(_attachments_of(mail, BY_TEXT)) == [("a.pdf", b"A"), ("a.pdf", b"B")]

    def test_no_name_or_no_bytes_is_none(self):
        assert not list(_attachments_of(eml_with([("attachment", b"A"), ('attachment; filename="x"', b"")]), BY_TEXT))

    def test_word_anywhere_or_the_value_alone(self):
        mail = eml_with([('inline; filename="attachment.png"', b"I"), ('ATTACHMENT; filename="b"', b"U")])
        assert [n for n, _ in _attachments_of(mail, BY_TEXT)] == ["attachment.png"]
        assert [n for n, _ in _attachments_of(mail, BY_VALUE)] == ["b"]

    def test_attached_mail_gives_its_own_attachments(self):
        inner = eml_with([('attachment; filename="deep.txt"', b"D")])
        outer = (
            b'MIME-Version: 1.0\r\nContent-Type: multipart/mixed; boundary="o"\r\n\r\n--o\r\n'
            b"Content-Type: message/rfc822\r\n"
            b'Content-Disposition: attachment; filename="fwd.eml"\r\n\r\n' + inner + b"\r\n--o--\r\n"
        )
        assert list(_attachments_of(outer, BY_TEXT)) == [("deep.txt", b"D")]

    def test_junk_is_no_error(self):
        assert list(_attachments_of(b"\xff\xfe\x00 attachment", BY_TEXT)) == []


def test_a_message_of_a_mailbox_above_a_cell_is_recorded(monkeypatch):
    monkeypatch.setattr("mailsift.operators.entries.MAX_CELL", 200)
    box = b"".join(b"From a@b.c Mon Jan  1 00:00:00 2024\nSubject: s\n\n" + b"x" * n + b"\n\n" for n in (10, 500, 20))
    whole = list(mbox_items(box))
    assert [(i.kind, i.index, i.reason) for i in whole] == [("entry", 0, None), ("refused", 1, "too_large"), ("entry", 2, None)]
    assert whole[1].payload is None and whole[1].size > 500
    parts = list(mbox_part_items(io.BytesIO(box), 0, len(box), 0))
    assert [(i.kind, i.reason, i.size) for i in parts] == [(i.kind, i.reason, i.size) for i in whole]
