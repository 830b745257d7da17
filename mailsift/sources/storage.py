"""Byte access to shared storage from inside a task.

Paths are Hadoop-style URIs or absolute paths. They are taken literally: no
percent-decoding, so any file name works.
"""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator
from datetime import UTC, datetime
from functools import lru_cache
from typing import NamedTuple

from pyarrow import fs as pafs

_URI = re.compile(r"^([A-Za-z][A-Za-z0-9+.-]*):(?://([^/]*))?(/.*)?$", re.S)
CHUNK = 8 << 20


class Entry(NamedTuple):
    name: str
    is_dir: bool
    size: int
    modified_at: datetime | None


@lru_cache(maxsize=64)
def _file_system(scheme: str, authority: str) -> tuple[pafs.FileSystem, str]:
    if scheme == "s3a" or scheme == "s3n":
        scheme = "s3"
    fs, base = pafs.FileSystem.from_uri(f"{scheme}://{authority}/")
    return fs, base.rstrip("/")


def locate(path: str) -> tuple[pafs.FileSystem, str]:
    found = _URI.match(path)
    if not found or found.group(1) == "file":
        return pafs.LocalFileSystem(), (found.group(3) if found else path) or "/"
    fs, base = _file_system(found.group(1), found.group(2) or "")
    return fs, base + (found.group(3) or "")


def list_dir(path: str) -> Iterator[Entry]:
    """Direct children of a folder; nothing if it is missing."""
    fs, inner = locate(path)
    if isinstance(fs, pafs.LocalFileSystem):
        try:
            children = os.scandir(inner)
        except (FileNotFoundError, NotADirectoryError):
            return
        with children:
            for child in children:
                if not (child.is_dir() or child.is_file()):
                    continue
                stat = child.stat()
                when = datetime.fromtimestamp(stat.st_mtime, UTC)
                yield Entry(child.name, child.is_dir(), stat.st_size, when)
        return
    for info in fs.get_file_info(pafs.FileSelector(inner, allow_not_found=True)):
        is_dir = info.type == pafs.FileType.Directory
        yield Entry(info.base_name, is_dir, 0 if is_dir else info.size, info.mtime)


def open_seekable(path: str):
    fs, inner = locate(path)
    return fs.open_input_file(inner)


def read_all(path: str) -> bytes:
    with open_seekable(path) as file:
        return file.read()


def chunks(file) -> Iterator[bytes]:
    while block := file.read(CHUNK):
        yield bytes(block)


def write_all(path: str, blocks: Iterator[bytes]) -> int:
    """Write a whole file so that readers see all of it or none."""
    fs, inner = locate(path)
    local = isinstance(fs, pafs.LocalFileSystem)
    target = f"{inner}.{uuid.uuid4().hex}.part" if local else inner
    size = 0
    try:
        with _new_local(target) if local else _new(fs, target) as out:
            for block in blocks:
                out.write(block)
                size += len(block)
    except BaseException:
        if local:
            os.unlink(target)
        raise
    if local:
        os.replace(target, inner)
    return size


def _new(fs: pafs.FileSystem, path: str):
    fs.create_dir(path.rpartition("/")[0], recursive=True)
    return fs.open_output_stream(path)


def _new_local(path: str):
    """The folder is there for all but its first files, so it is made only where it lacks."""
    try:
        return open(path, "xb")
    except FileNotFoundError:
        os.makedirs(path.rpartition("/")[0], exist_ok=True)
        return open(path, "xb")


def create_new(path: str, content: bytes) -> bool:
    """Write a whole file that is not there yet; false if it is. Of several writers one succeeds.

    The local file system and HDFS do this in one step (a link, a rename). An object store
    without such a step is asked first, which leaves two writers a moment to pass each other.
    """
    fs, inner = locate(path)
    fs.create_dir(inner.rpartition("/")[0], recursive=True)
    if fs.get_file_info(inner).type != pafs.FileType.NotFound:
        return False
    kind = fs.type_name
    if kind not in ("local", "hdfs"):
        with fs.open_output_stream(inner) as out:
            out.write(content)
        return True
    draft = f"{inner}.{uuid.uuid4().hex}.part"
    with fs.open_output_stream(draft) as out:
        out.write(content)
    if kind == "local":
        try:
            os.link(draft, inner)
            return True
        except FileExistsError:
            return False
        finally:
            os.unlink(draft)
    try:
        fs.move(draft, inner)  # fails where the target exists
        return True
    except OSError:
        fs.delete_file(draft)
        if fs.get_file_info(inner).type == pafs.FileType.NotFound:
            raise
        return False


def remove_file(path: str) -> None:
    fs, inner = locate(path)
    if fs.get_file_info(inner).type == pafs.FileType.File:
        fs.delete_file(inner)


def remove_tree(path: str) -> None:
    fs, inner = locate(path)
    if fs.get_file_info(inner).type == pafs.FileType.Directory:
        fs.delete_dir(inner)
