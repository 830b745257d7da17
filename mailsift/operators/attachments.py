"""Attachments of mails, in the order of a walk over the MIME parts."""

from __future__ import annotations

import email
from collections.abc import Iterator
from email.policy import default as modern

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mailsift.functions import naming

_FLUSH_BYTES = 16 << 20
_SEARCHED = 512 << 20
_FAULT_CHARS = 200
# How a part is told to be an attachment: by the word anywhere in its
# Content-Disposition header, or by the header's parsed value alone.
BY_TEXT, BY_VALUE = "text", "value"


def may_have_attachments(content: Column) -> Column:
    """A cheap test on the raw bytes that no mail with an attachment fails: the
    name of the header that makes one must stand somewhere. Header names are
    never encoded or folded. Very large mails are not searched."""
    text = F.lower(content.cast("string"))
    return (F.length(content) > _SEARCHED) | text.contains("content-disposition")


def _attachments_of(content: bytes, test: str, faults: list[str] | None = None) -> Iterator[tuple[str, bytes]]:
    """Names and bytes of a mail's attachments. What breaks the walk off is added to ``faults``."""
    found: list[tuple[str, bytes]] = []
    try:
        for part in email.message_from_bytes(content, policy=modern).walk():
            header = part.get("Content-Disposition")
            if header is None:
                continue
            if test == BY_TEXT:
                attached = "attachment" in str(header)
            else:
                attached = getattr(header, "content_disposition", None) == "attachment"
            name = part.get_filename() if attached else None
            payload = part.get_payload(decode=True) if name else None
            if payload:
                found.append((name, payload))
    except Exception as error:
        # Malformed MIME, of which the parser raises anything: what was found before the fault is kept.
        if faults is not None:
            faults.append(_clean(f"{type(error).__name__}: {error}"[:_FAULT_CHARS]))
    return iter(found)


def extract_attachments(
    mails: DataFrame,
    content: str = "content",
    key: str = "uid",
    test: str = BY_TEXT,
    searched: bool = False,
    keep: tuple[str, ...] = (),
    faults: bool = False,
) -> DataFrame:
    """``(key, ord, name, safe_name, content)`` and the ``keep`` columns, one row per attachment.

    Mails that cannot have one are left out before any byte goes to Python,
    unless that has been done (``searched``). With ``faults`` there is a column ``fault`` more,
    and for each mail whose MIME broke the walk off a row that holds only the reason there.
    """
    schema = T.StructType(
        [
            *(mails.schema[name] for name in (key, *keep)),
            T.StructField("ord", T.IntegerType()),
            T.StructField("name", T.StringType()),
            T.StructField("content", T.BinaryType()),
            T.StructField("fault", T.StringType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies, kept = batch.column(0), batch.columns[1:]
            parents: list[int] = []
            rows: list[tuple[int | None, str | None, bytes | None, str | None]] = []
            filled = 0
            for number in range(batch.num_rows):
                broken: list[str] = []
                found = enumerate(_attachments_of(bodies[number].as_py(), test, broken))
                own = [(ord, _clean(name), payload, None) for ord, (name, payload) in found]
                for row in own + [(None, None, None, fault) for fault in broken if faults]:
                    parents.append(number)
                    rows.append(row)
                    filled += len(row[2] or b"")
                    if filled >= _FLUSH_BYTES:
                        yield _batch(kept, parents, rows, schema.names)
                        parents, rows, filled = [], [], 0
            if rows:
                yield _batch(kept, parents, rows, schema.names)

    likely = mails if searched else mails.filter(may_have_attachments(F.col(content)))
    return likely.select(content, key, *keep).mapInArrow(run, schema).select(
        key,
        "ord",
        "name",
        naming.safe_attachment_name(F.col("name"), F.col("ord")).alias("safe_name"),
        "content",
        *keep,
        *(["fault"] if faults else []),
    )


def _clean(name: str) -> str:
    """Text that can be stored: undecodable bytes become replacement marks."""
    return name.encode("utf-8", "replace").decode("utf-8")


def _batch(kept, parents, rows, names) -> pa.RecordBatch:
    ords, titles, bodies, reasons = zip(*rows)
    index = pa.array(parents, pa.int32())
    return pa.RecordBatch.from_arrays(
        [
            *(column.take(index) for column in kept),
            pa.array(ords, pa.int32()),
            pa.array(titles, pa.string()),
            pa.array(bodies, pa.binary()),
            pa.array(reasons, pa.string()),
        ],
        names=names,
    )


def attachment_counts(attachments: DataFrame, key: str = "uid") -> DataFrame:
    return attachments.groupBy(key).agg(F.count(F.lit(1)).alias("n_attachments"))


def nested_attachments(attachments: DataFrame, key: str = "uid") -> DataFrame:
    """All attachments as a map from mail to its names and bytes, one row per mail."""
    pair = F.struct("ord", "name", "content")
    return attachments.groupBy(key).agg(
        F.transform(
            F.array_sort(F.collect_list(pair)),
            lambda x: F.struct(x["name"].alias("name"), x["content"].alias("content")),
        ).alias("attachments")
    )
