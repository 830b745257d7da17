"""Mail files made from the test tables, row by row.

The tables hold no mail. These expressions turn each row into a file of a
bucket; a row's file depends on that row alone, so nothing is grouped and the
corpus grows with the tables. DuckDB can repeat every expression.
"""

from __future__ import annotations

import io
import struct
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mailsift.session import spread


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def wide_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table whose rows are to be worked on in Python."""
    return spread(table(spark, folder, name))


def _day(number: Column) -> Column:
    return F.concat(F.lit("2024-07-"), F.lpad((1 + number % 28).cast("string"), 2, "0"))


def bytes_of(text: Column) -> Column:
    """The bytes of a text as they are; ``encode`` looks at each of them first."""
    return text.cast("binary")


def files(rows: DataFrame, namespace: Column, number: Column, name: Column, content: Column) -> DataFrame:
    """Bucket files with their bytes."""
    day = _day(number)
    return rows.select(
        F.concat(namespace, F.lit("/timestamp="), day, F.lit("/"), name).alias("path"),
        namespace.alias("namespace"),
        day.alias("date_partition"),
        name.alias("source_file"),
        content.alias("content"),
    )


def mail_text() -> Column:
    """A document as a mail. The id stays out, so that copies stay copies."""
    return F.concat(F.lit("Subject: "), F.col("lang"), F.lit("\n\n"), F.col("text"))


def document_mails(spark: SparkSession, folder: str, read=table) -> DataFrame:
    name = F.concat(F.col("doc_id").cast("string"), F.lit(".eml"))
    return files(
        read(spark, folder, "documents"), F.col("source"), F.col("doc_id"), name, bytes_of(mail_text())
    )


def page_files(spark: SparkSession, folder: str, read=table) -> DataFrame:
    name = F.concat(F.lit("page-"), F.col("page_id").cast("string"), F.lit(".HTML"))
    return files(
        read(spark, folder, "pages"), F.lit("web"), F.col("page_id"), name, bytes_of(F.col("html"))
    )


def line_message(identity: Column, line: Column, place: Column) -> Column:
    """One line of a text as a message; every other one has no Message-ID."""
    head = F.when(
        place % 2 == 0,
        F.concat(F.lit("Message-ID: <"), identity, F.lit("."), place.cast("string"), F.lit("@example.org>")),
    ).otherwise(F.lit("Subject: no id"))
    return F.concat(head, F.lit("\n\n"), line, F.lit("\n"))


def mailbox_text(identity: Column, text: Column) -> Column:
    """A text as a mailbox with one message per line, ``From `` lines escaped."""
    return F.array_join(
        F.transform(
            F.split(text, "\n"),
            lambda line, place: F.concat(
                F.lit("From someone Mon Jul 15 10:00:00 2024\n"),
                line_message(identity, F.regexp_replace(line, "^From ", ">From "), place),
                F.lit("\n"),
            ),
        ),
        "",
    )


def document_mailboxes(spark: SparkSession, folder: str) -> DataFrame:
    number = F.col("doc_id").cast("string")
    return files(
        wide_table(spark, folder, "documents"),
        F.col("source"),
        F.col("doc_id"),
        F.concat(number, F.lit(".mbox")),
        bytes_of(mailbox_text(number, F.col("text"))),
    )


def conversation_mailboxes(spark: SparkSession, folder: str) -> DataFrame:
    """One mailbox per turn: columns ``turn_id`` and ``content``."""
    turn_id = F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    return wide_table(spark, folder, "conversations").select(
        turn_id.alias("turn_id"),
        "conv_id",
        bytes_of(mailbox_text(turn_id, F.col("text"))).alias("content"),
    )


def page_mails(spark: SparkSession, folder: str) -> DataFrame:
    """A page as a mail with two attachments and one inline part."""
    part = "--cut-here\n"
    raw = F.concat(
        F.lit(
            "Subject: page\nMIME-Version: 1.0\n"
            'Content-Type: multipart/mixed; boundary="cut-here"\n\n'
            + part
            + "Content-Type: text/plain\n\n"
        ),
        F.col("url"),
        F.lit("\n" + part + "Content-Type: text/html\nContent-Transfer-Encoding: base64\n"),
        F.lit('Content-Disposition: attachment; filename="page-'),
        F.col("page_id").cast("string"),
        F.lit('.html"\n\n'),
        F.base64(bytes_of(F.col("html"))),
        F.lit("\n" + part + "Content-Type: text/plain\nContent-Disposition: attachment;\n"),
        F.lit(' filename="../url.txt"\n\n'),
        F.col("url"),
        F.lit("\n" + part + 'Content-Disposition: inline; filename="shown.txt"\n\nshown\n'),
        F.lit("--cut-here--\n"),
    )
    name = F.concat(F.lit("mail-"), F.col("page_id").cast("string"), F.lit(".eml"))
    return files(
        wide_table(spark, folder, "pages"), F.lit("web"), F.col("page_id"), name, bytes_of(raw)
    )


@F.pandas_udf(T.BinaryType())
def zip_bytes(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """An archive of the row's entries, an array of (name, content).

    A name ending in ``/`` makes a folder. One starting with ``locked/`` is
    marked as encrypted.
    """
    for names_and_bytes in batches:
        yield names_and_bytes.map(_zip)


@F.pandas_udf(T.BinaryType())
def nested_zip_bytes(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """An archive of ``inner.zip``, which holds the row's mailbox, and a page; from name and mailbox.
    Both are made at once, as each step of its own takes a Python worker more on every core."""

    def both(name: str, mailbox: bytes) -> bytes:
        inner = _zip([{"name": f"{name}.mbox", "content": mailbox}])
        return _zip([{"name": "inner.zip", "content": inner}, {"name": "cover.htm", "content": name.encode()}])

    for names, mailboxes in batches:
        yield pd.Series([both(*row) for row in zip(names, mailboxes)], dtype=object)


def _zip(entries) -> bytes:
    buffer = io.BytesIO()
    locked = []
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
        for entry in entries:
            info = zipfile.ZipInfo(entry["name"], (2024, 7, 15, 0, 0, 0))
            archive.writestr(info, bytes(entry["content"]), zipfile.ZIP_DEFLATED, 1)
            if entry["name"].startswith("locked/"):
                locked.append(info)
        directory = archive.start_dir
    data = bytearray(buffer.getvalue())
    if locked:
        _mark_locked(data, {info.header_offset for info in locked}, directory)
    return bytes(data)


def _mark_locked(data: bytearray, offsets: set[int], at: int) -> None:
    while data[at : at + 4] == b"PK\x01\x02":
        name, extra, comment = struct.unpack_from("<3H", data, at + 28)
        (offset,) = struct.unpack_from("<I", data, at + 42)
        if offset in offsets:
            data[at + 8] |= 1
            data[offset + 6] |= 1
        at += 46 + name + extra + comment


def entry(name: Column, content: Column) -> Column:
    return F.struct(name.alias("name"), content.alias("content"))
