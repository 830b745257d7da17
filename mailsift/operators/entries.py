"""Per-record helpers that run inside a task: what is in one container.

Each takes one file (bytes in memory, or a seekable handle for a part of a
large one) and yields items; Spark decides which task gets which file or part.
"""

from __future__ import annotations

import email
import hashlib
import io
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from typing import NamedTuple

from mailsift.functions.formats import CONTAINER, SINGLE, Format, Formats, Refused
from mailsift.sources import storage

try:
    from lzma import LZMAError
except ImportError:  # a Python built without lzma
    class LZMAError(Exception):
        pass


# A cell of a row holds less than 2 GiB; a single mail above this is recorded
# as too large instead of being lost.
MAX_CELL = 1_900_000_000

_LOCKED = 0x1  # fixed value: the flag of an encrypted entry
_BROKEN = (zipfile.BadZipFile, zlib.error, EOFError, LZMAError, struct.error)


class Limits(NamedTuple):
    """Sizes that decide how bytes travel; results do not depend on them."""

    inline: int = 64 << 20  # larger containers are read in parts
    part: int = 64 << 20  # size of such a part
    spill_dir: str | None = None  # where large nested containers are laid down
    raw_mbox: bool = False


class Item(NamedTuple):
    kind: str  # source, self, entry, refused, broken
    ord: int | None = None
    name: str | None = None
    message_id: str | None = None
    index: int | None = None
    reason: str | None = None
    uid: str | None = None
    size: int | None = None
    payload: bytes | None = None
    spill: str | None = None
    cut: int | None = None
    may_attach: bool | None = None


def _digest(content: bytes) -> str:
    return hashlib.sha256(content).hexdigest()


def may_attach(content: bytes) -> bool:
    """Whether a mail can have attachments: the name of the header that makes
    one must stand somewhere. Header names are never encoded or folded."""
    return b"content-disposition" in content.lower()


def _bz2_damage(error: OSError) -> bool:
    return error.errno is None and "Invalid data stream" in str(error)


def _entry(ord: int, name: str, payload: bytes, known: Format) -> Item:
    single = known.file_type == SINGLE
    return Item(
        "entry",
        ord,
        name,
        uid=_digest(payload),
        size=len(payload),
        payload=payload,
        may_attach=may_attach(payload) if single else None,
    )


def _pieces(entry) -> Iterator[bytes]:
    while piece := entry.read(1 << 20):
        yield piece


def _hashed(pieces: Iterator[bytes], digest) -> Iterator[bytes]:
    for piece in pieces:
        digest.update(piece)
        yield piece


def _zip_item(archive, info, ord: int, formats: Formats, limits: Limits) -> Item:
    known = formats.of(info.filename)
    single = known is not None and known.supported and known.file_type == SINGLE
    box = known is not None and known.supported and known.file_type == CONTAINER
    with archive.open(info) as entry:
        if single and info.file_size <= MAX_CELL or box and info.file_size <= limits.inline:
            payload = entry.read()
            return _entry(ord, info.filename, payload, known)
        if box and limits.spill_dir:
            name = uuid.uuid4().hex
            target = f"{limits.spill_dir}/{name[:2]}/{name}"
            digest = hashlib.sha256()
            size = storage.write_all(target, _hashed(_pieces(entry), digest))
            return Item("entry", ord, info.filename, uid=digest.hexdigest(), size=size, spill=target)
        # Nobody reads this entry, but damage and encryption must still show.
        size = sum(len(piece) for piece in _pieces(entry))
        if single or box:
            return Item("refused", ord, info.filename, reason="too_large", size=size)
        return Item("entry", ord, info.filename, size=size)


def zip_items(
    source, formats: Formats, limits: Limits, first: int = 0, last: int | None = None
) -> Iterator[Item]:
    """Entries ``first`` to ``last`` of an archive, each read at its own place.

    An entry under a password gives a refusal. Damage ends the archive: what
    was read before it stays, and one broken mark follows. Where only a part is
    read the mark carries its place, so that later parts can be cut off there.
    """
    at = first
    try:
        with zipfile.ZipFile(source) as archive:
            entries = archive.infolist()
            for at in range(first, len(entries) if last is None else min(last, len(entries))):
                info = entries[at]
                if info.is_dir():
                    continue
                try:
                    item = _zip_item(archive, info, at, formats, limits)
                except NotImplementedError:
                    item = Item("refused", at, info.filename, reason="unreadable")
                except RuntimeError:
                    reason = "password_protected" if info.flag_bits & _LOCKED else "unreadable"
                    item = Item("refused", at, info.filename, reason=reason)
                yield item
    except _BROKEN:
        yield Item("broken", at, reason="corrupted", cut=None if last is None else at)
    except (UnicodeDecodeError, ValueError, NotImplementedError):
        yield Item("broken", at, reason="unreadable", cut=None if last is None else at)
    except OSError as error:
        if not _bz2_damage(error):
            raise
        yield Item("broken", at, reason="corrupted", cut=None if last is None else at)


_FROM_LINE = re.compile(rb"^From ", re.M)

# Headers that the ``email`` package writes as they stand: printable ASCII, too short to be folded, one space after
# the colon and between words, none that says how the body is laid out.
_PLAIN_HEADER = rb"(?!content-)(?=[^\n]{1,76}(?:\n|\Z))[!-9;-~]+: [!-~]+(?: [!-~]+)*"
_PLAIN_HEADERS = re.compile(rb"%b(?:\n%b)*" % (_PLAIN_HEADER, _PLAIN_HEADER), re.I)
_PLAIN_ID = re.compile(rb"^message-id: ([^\n]*)", re.I | re.M)


def _read_message(raw: bytes) -> tuple[str, bytes]:
    """Message-ID of a message, and its bytes as the ``email`` package writes them.

    Writing folds long headers anew and ends every line with LF. That touches
    a plain body only in its line ends, so of most messages just the headers
    are parsed. Structured bodies (multipart, message) and anything odd about
    the headers take the whole way. Where the headers too would be written as they
    stand, nothing is parsed.
    """
    if b"\r" not in raw:
        head = raw[: max(raw.find(b"\n\n"), 0)]
        if _PLAIN_HEADERS.fullmatch(head):
            found = _PLAIN_ID.search(head)
            return found.group(1).decode("ascii") if found else "", raw
    end = b"\r\n" if b"\r" in raw else b"\n"
    at = raw.find(end * 2)
    if at > 0 and raw.count(b"\r") == raw.count(b"\r\n"):
        at += 2 * len(end)
        message = email.message_from_bytes(raw[:at])
        plain = message.get_content_maintype() not in ("multipart", "message")
        if plain and not message.defects and not message.get_payload():
            return _message_id(message), message.as_bytes() + raw[at:].replace(b"\r\n", b"\n")
    message = email.message_from_bytes(raw)
    return _message_id(message), message.as_bytes()


def _message_id(message) -> str:
    found = message.get("Message-ID", "")
    if not isinstance(found, str):
        raise ValueError("undecodable Message-ID")
    return found


def _mbox_item(ord: int, index: int, record: bytes, raw_mbox: bool) -> Item:
    if record.endswith(b"\n\n"):  # the blank line before the next message
        record = record[:-1]
    from_line, _, body = record.partition(b"\n")
    try:
        from_line.decode("ascii")
        message_id, payload = _read_message(body)
        payload = body if raw_mbox else payload
    except Exception:
        return Item("refused", ord, None, index=index, reason="unreadable", size=len(body))
    if len(payload) > MAX_CELL:
        return Item("refused", ord, None, index=index, reason="too_large", size=len(payload))
    return Item(
        "entry",
        ord,
        None,
        message_id,
        index,
        uid=_digest(payload),
        size=len(payload),
        payload=payload,
        may_attach=may_attach(payload),
    )


def mbox_items(content: bytes, raw_mbox: bool = False) -> Iterator[Item]:
    """Messages of a mailbox in memory. A message's ``ord`` is its byte offset."""
    start, index = None, -1
    for found in _FROM_LINE.finditer(content):
        if start is not None:
            yield _mbox_item(start, index, content[start : found.start()], raw_mbox)
        start, index = found.start(), index + 1
    if start is not None:
        yield _mbox_item(start, index, content[start:], raw_mbox)


_MARK = b"\nFrom "
_BLOCK = 64 << 10


def mbox_part_items(
    file, start: int, end: int, base: int, raw_mbox: bool = False
) -> Iterator[Item]:
    """Messages that start in ``[start, end)`` of a large mailbox.

    ``base`` is the number of messages before the part. Only the message at
    hand is held; the last one is followed past ``end`` to where it stops.
    """
    if start == 0:
        buffer, offset = bytearray(b"\n"), -1
    else:
        file.seek(start - 1)
        buffer, offset = bytearray(), start - 1
    current, index, scan = None, base - 1, 0
    while True:
        found = buffer.find(_MARK, scan)
        if found >= 0:
            begin = offset + found + 1
            if current is not None:
                record = bytes(buffer[current - offset : begin - offset])
                yield _mbox_item(current, index, record, raw_mbox)
            if begin >= end:
                return
            current, index = begin, index + 1
            del buffer[: found + 1]
            offset, scan = begin, 0
            continue
        scan = max(0, len(buffer) - len(_MARK) + 1)
        if current is None:
            del buffer[:scan]
            offset, scan = offset + scan, 0
            if offset + 1 >= end:
                return
        # Not much more than the part: a small part of a large file must not read all that follows it.
        block = file.read(min(storage.CHUNK, max(end - offset, _BLOCK)))
        if not block:
            break
        buffer += block
    if current is not None:
        yield _mbox_item(current, index, bytes(buffer[current - offset :]), raw_mbox)


def own_reader_items(content: bytes, reader, formats: Formats) -> Iterator[Item]:
    """Entries of a registered container format."""
    for ord, got in enumerate(reader(content)):
        if isinstance(got, Refused):
            kind = "broken" if got.name is None else "refused"
            yield Item(kind, ord, got.name, reason=got.reason)
            continue
        name, payload = got
        known = formats.of(name)
        if known is None or not known.supported:
            yield Item("entry", ord, name, size=len(payload))
            continue
        yield _entry(ord, name, payload, known)


def box_items(content: bytes, fmt: str, formats: Formats, limits: Limits) -> Iterator[Item]:
    """Entries of a container in memory, one level down."""
    own = next((f.reader for f in formats.items if f.name == fmt and f.reader), None)
    if own is not None:
        yield from own_reader_items(content, own, formats)
    elif fmt == "zip":
        yield from zip_items(io.BytesIO(content), formats, limits)
    elif fmt == "mbox":
        yield from mbox_items(content, limits.raw_mbox)


def part_items(
    location: str, fmt: str, parts: list[dict], formats: Formats, limits: Limits
) -> Iterator[Item]:
    """Entries of parts of one large container in storage, part by part."""
    with storage.open_seekable(location) as file:
        for part in parts:
            if fmt == "zip":
                yield from zip_items(file, formats, limits, part["start"], part["end"])
            elif fmt == "mbox":
                yield from mbox_part_items(file, part["start"], part["end"], part["base"], limits.raw_mbox)
            else:
                yield from box_items(file.read(), fmt, formats, limits)


def file_items(
    location: str | None, content: bytes | None, name: str, size: int, formats: Formats, limits: Limits
) -> Iterator[Item]:
    """A file of the bucket: its own record first, then what it holds."""
    known = formats.of(name)
    readable = known is not None and known.supported
    if content is None and (not readable or size > MAX_CELL):
        digest, size = hash_in_storage(location)
        yield Item("source", uid=digest, size=size)
        if readable:
            yield Item("refused", reason="too_large", size=size)
        else:
            yield Item("self", size=size)
        return
    if content is None:
        content = storage.read_all(location)
    digest = _digest(content)
    yield Item("source", uid=digest, size=len(content))
    if not readable:
        yield Item("self", size=len(content))
    elif known.file_type == SINGLE:
        yield Item(
            "self", uid=digest, size=len(content), payload=content, may_attach=may_attach(content)
        )
    else:
        yield from box_items(content, known.name, formats, limits)


def hash_in_storage(location: str) -> tuple[str, int]:
    digest, size = hashlib.sha256(), 0
    with storage.open_seekable(location) as file:
        for block in storage.chunks(file):
            digest.update(block)
            size += len(block)
    return digest.hexdigest(), size


def survey(location: str, fmt: str, part: int) -> tuple[str, int, list[dict]]:
    """Hash of a large container and the parts it can be read in.

    A mailbox is cut by bytes, and the messages before each part are counted
    while hashing; an archive is cut by entries of about ``part`` bytes.
    """
    digest, size = hashlib.sha256(), 0
    counts: dict[int, int] = {}
    tail = b"\n"
    with storage.open_seekable(location) as file:
        for block in storage.chunks(file):
            digest.update(block)
            if fmt == "mbox":
                window = tail + block
                at = window.find(_MARK)
                while at >= 0:
                    begin = size - len(tail) + at + 1
                    counts[begin // part] = counts.get(begin // part, 0) + 1
                    at = window.find(_MARK, at + 1)
                tail = window[-(len(_MARK) - 1) :]
            size += len(block)
        parts = []
        if fmt == "mbox":
            base = 0
            for number in range(max(1, -(-size // part))):
                begin = number * part
                parts.append({"start": begin, "end": min(begin + part, size), "base": base})
                base += counts.get(number, 0)
        elif fmt == "zip":
            parts = _zip_parts(file, part)
        else:
            parts = [{"start": 0, "end": size, "base": 0}]
    return digest.hexdigest(), size, parts


def _zip_parts(file, part: int) -> list[dict]:
    try:
        file.seek(0)
        with zipfile.ZipFile(file) as archive:
            sizes = [info.file_size + 4096 for info in archive.infolist()]
    except (*_BROKEN, UnicodeDecodeError, ValueError, NotImplementedError):
        return [{"start": 0, "end": 1, "base": 0}]  # reading it will say what is wrong
    parts, begin, filled = [], 0, 0
    for number, size in enumerate(sizes):
        if filled and filled + size > part:
            parts.append({"start": begin, "end": number, "base": 0})
            begin, filled = number, 0
        filled += size
    if sizes:
        parts.append({"start": begin, "end": len(sizes), "base": 0})
    return parts
