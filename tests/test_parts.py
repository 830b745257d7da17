"""Containers read in small parts: the same items, without reading or parsing more than that takes."""

from __future__ import annotations

import email
import importlib
import io
import random
import zipfile
from pathlib import Path

from mailsift.functions.formats import DEFAULT
from mailsift.operators import entries
from mailsift.operators.entries import Limits
from mailsift.sources import storage

plan = importlib.import_module("mailsift.plans.ingest")

_NAMES = [b"Subject", b"message-id", b"Message-ID", b"X-A", b"Content-Type", b"content-transfer-encoding", b"From ", b"a=b"]
_WORDS = [b"a", b"<1@x>", b"=?utf-8?q?a?=", b"multipart/mixed;", b":", b"a:b", b"x" * 30, b"x" * 70, b"\xe4", b"\t", b"", b" "]


def _some_message(random) -> bytes:
    lines = [
        random.choice(_NAMES) + random.choice([b": ", b": ", b":", b":  "])
        + b" ".join(random.choice(_WORDS) for _ in range(random.randint(0, 4)))
        for _ in range(random.randint(0, 3))
    ]
    return b"\n".join(lines) + random.choice([b"\n\n", b"\n", b""]) + random.choice([b"", b"body\n", b"--x\n\nb\n", b"\xff \n"])


def test_messages_are_as_the_email_package_writes_them():
    numbers, plain = random.Random(7), 0
    for _ in range(20_000):
        raw = _some_message(numbers)
        plain += entries._PLAIN_HEADERS.fullmatch(raw.partition(b"\n\n")[0]) is not None
        try:
            message = email.message_from_bytes(raw)
            expected = entries._message_id(message), message.as_bytes()
        except Exception:
            continue
        assert entries._read_message(raw) == expected, raw
    assert plain > 200


def test_plain_messages_are_not_parsed(monkeypatch):
    raw = b"Subject: no id\nMessage-ID: <1.2@example.org>\n\na body\n\nFrom: none\n"
    monkeypatch.setattr(entries.email, "message_from_bytes", None)
    assert entries._read_message(raw) == ("<1.2@example.org>", raw)


class _Counted(io.BytesIO):
    taken = 0

    def read(self, size=-1):
        got = super().read(size)
        self.taken += len(got)
        return got


def test_a_small_part_does_not_read_the_rest_of_the_file():
    box = b"".join(b"From a b\nSubject: %d\n\ntext\n\n" % n for n in range(100_000))
    file = _Counted(box)
    found = list(entries.mbox_part_items(file, 0, 256, 0))
    assert len(found) == 1 + box[:256].count(b"\nFrom ")
    assert file.taken <= 128 << 10


def test_parts_of_a_file_that_go_together_open_it_once(tmp_path, monkeypatch):
    path = tmp_path / "a.mbox"
    box = b"".join(b"From a b\nSubject: %d\n\ntext %d\n\n" % (n, n) for n in range(500))
    path.write_bytes(box)
    _, _, parts = entries.survey(str(path), "mbox", 256)
    opened, opens = [], storage.open_seekable
    monkeypatch.setattr(storage, "open_seekable", lambda where: opened.append(where) or opens(where))
    got = list(entries.part_items(str(path), "mbox", parts, DEFAULT, Limits(256, 256)))
    assert got == list(entries.mbox_items(box))
    assert len(parts) > 50 and len(opened) == 1


def test_tasks_remove_what_was_laid_down(spark, tmp_path, out, monkeypatch):
    inner = io.BytesIO()
    with zipfile.ZipFile(inner, "w") as archive:
        for n in range(30):
            archive.writestr(f"{n}.mbox", b"From a b\nSubject: %d\n\n%s\n" % (n, b"long text " * 60))
    folder = tmp_path / "bucket" / "a" / "timestamp=2024-07-15"
    folder.mkdir(parents=True)
    (folder / "a.zip").write_bytes(inner.getvalue())
    own = []
    monkeypatch.setattr(plan, "remove_tree", lambda path: own.append(sorted(p.name for p in Path(path).glob("spill/*"))))
    run = plan.ingest(spark, str(tmp_path / "bucket"), out, options=plan.Options(inline_bytes=256)).first()
    assert run.files_processed == 30
    assert own == [[]]  # the driver finds no folder of them left
