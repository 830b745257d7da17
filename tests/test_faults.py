"""Mails whose MIME breaks the parser: what came before is kept, and a record says so."""

from __future__ import annotations

import pytest

from mailsift import Ledger, ingest
from mailsift.operators.attachments import BY_TEXT, _attachments_of, extract_attachments
from tests.test_ledger import _bucket
from tests.trees import eml

# A header that the standard parser ends in an IndexError on.
_BROKEN = b"Content-Disposition: ;\r\n filenamefilename*0*\r\n\r\nx\r\n"


def _mail(*parts: bytes) -> bytes:
    head = b'Subject: s\r\nMIME-Version: 1.0\r\nContent-Type: multipart/mixed; boundary="b"\r\n\r\n'
    return head + b"".join(b"--b\r\n" + part for part in parts) + b"--b--\r\n"


def _part(name: bytes) -> bytes:
    return b'Content-Disposition: attachment; filename="%s"\r\n\r\nbody of %s\r\n' % (name, name)


BROKEN, WHOLE = _mail(_part(b"a"), _BROKEN, _part(b"late")), _mail(_part(b"a"), _part(b"b"))


@pytest.fixture(autouse=True)
def _breaks():
    faults: list[str] = []
    assert [name for name, _ in _attachments_of(WHOLE, BY_TEXT, faults)] == ["a", "b"] and not faults
    assert len(list(_attachments_of(BROKEN, BY_TEXT, faults))) < 3
    if not faults:
        pytest.skip("this parser reads the header")


def test_faults_are_rows_of_their_own(spark):
    mails = spark.createDataFrame([("w", WHOLE), ("x", BROKEN), ("y", _mail(_BROKEN)), ("z", b"")], "uid string, content binary")
    rows = extract_attachments(mails, faults=True).collect()
    assert sorted((r.uid, r.ord, r.name) for r in rows if r.fault is None) == [("w", 0, "a"), ("w", 1, "b"), ("x", 0, "a")]
    broken = [r for r in rows if r.fault is not None]
    assert sorted(r.uid for r in broken) == ["x", "y"]
    assert all(r.fault.startswith("IndexError") and (r.ord, r.name, r.content) == (None, None, None) for r in broken)
    plain = extract_attachments(mails)
    assert plain.columns == ["uid", "ord", "name", "safe_name", "content"] and plain.count() == 3


def test_a_run_records_mails_that_break(spark, tmp_path):
    out = str(tmp_path / "out")
    root = _bucket(tmp_path / "in", {"w.eml": WHOLE, "x.eml": BROKEN, "y.eml": _mail(_BROKEN), "z.eml": eml("z")})
    row = ingest(spark, root, out).first()
    assert (row.files_processed, row.files_skipped) == (4, 0)
    ledger = Ledger(spark, out)
    named = {r.uid: r.source_lineage.original_filename for r in ledger.manifest().collect()}
    assert sorted((named[r.uid], r.ord) for r in ledger.attachments().collect()) == [("w.eml", 0), ("w.eml", 1), ("x.eml", 0)]
    faults = ledger.attachment_faults().collect()
    assert sorted(named[r.uid] for r in faults) == ["x.eml", "y.eml"] and {r.run_id for r in faults} == {row.run_id}
    attached = {named[r.uid] for r in ledger.manifest().where("has_attachments").collect()}
    assert attached == {"w.eml", "x.eml"}
    assert "fault" not in ledger.attachments().columns
