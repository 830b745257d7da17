"""Names, paths and lineage, all as built-in expressions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# The bucket layout.
BUCKET_FILE = r"^([^./][^/]*)/timestamp=(\d{4}-\d{2}-\d{2})/([^./][^/]*)$"


def namespace_of(rel_path: Column) -> Column:
    return F.regexp_extract(rel_path, BUCKET_FILE, 1)


def date_of(rel_path: Column) -> Column:
    """``timestamp=YYYY-MM-DD`` becomes the text ``YYYY-MM-DD``."""
    return F.regexp_extract(rel_path, BUCKET_FILE, 2)


def file_of(rel_path: Column) -> Column:
    return F.regexp_extract(rel_path, BUCKET_FILE, 3)


def calendar_date(date_partition: Column) -> Column:
    """The partition date as a date, null where the text names no real day."""
    return F.try_to_date(date_partition, "yyyy-MM-dd")


def safe_message_id(message_id: Column) -> Column:
    """Message-ID as a file name: angle brackets off, odd characters to ``_``, 100 at most."""
    bare = F.btrim(message_id, F.lit("<>"))
    return F.substring(F.regexp_replace(bare, r"[^\p{L}\p{N}_.@-]", "_"), 1, 100)


def mbox_entry_name(message_id: Column, index: Column) -> Column:
    """Name of a message of a mailbox, by its id or else by its place."""
    return F.when(
        F.coalesce(message_id, F.lit("")) != "", F.concat(safe_message_id(message_id), F.lit(".eml"))
    ).otherwise(F.format_string("msg_%04d.eml", index))


def message_name(message_id: str | None, index: int) -> str:
    """``mbox_entry_name`` of one message, for readers that give rows themselves."""
    if not message_id:
        return f"msg_{index:04d}.eml"
    kept = (c if c in "_.@-" or unicodedata.category(c)[0] in "LN" else "_" for c in message_id.strip("<>"))
    return "".join(kept)[:100] + ".eml"


def suffix_of(name: Column, default: str = ".eml") -> Column:
    """Last suffix of a file name with its case kept, or the default."""
    base = F.regexp_extract(name, r"([^/]*)/*$", 1)
    suffix = F.regexp_extract(base, r"(?s)^.+(\.[^.]+)$", 1)
    return F.when(suffix == "", F.lit(default)).otherwise(suffix)


def bucket_dir(namespace: Column, date_partition: Column) -> Column:
    return F.concat(namespace, F.lit("/timestamp="), date_partition)


def output_path(namespace: Column, date_partition: Column, uid: Column, ext: Column) -> Column:
    return F.concat(bucket_dir(namespace, date_partition), F.lit("/"), uid, ext)


def attachment_dir(
    namespace: Column, date_partition: Column, uid: Column, n_attachments: Column
) -> Column:
    """Folder of a mail's attachments, null when it has none."""
    return F.when(
        n_attachments > 0,
        F.concat(bucket_dir(namespace, date_partition), F.lit("/"), uid, F.lit("_attachments")),
    )


def skip_path(
    namespace: Column, date_partition: Column, source_file: Column, chain: Column
) -> Column:
    """Where a skipped item lies: the bucket folder, the file, then the chain inside it."""
    return F.array_join(
        F.concat(F.array(bucket_dir(namespace, date_partition), source_file), chain), "/"
    )


def lineage(
    namespace: Column,
    date_partition: Column,
    source_file: Column,
    container_path: Column,
    original_filename: Column,
) -> Column:
    return F.struct(
        namespace.alias("namespace"),
        date_partition.alias("date_partition"),
        source_file.alias("source_file"),
        container_path.alias("container_path"),
        original_filename.alias("original_filename"),
    )


def safe_attachment_name(name: Column, ordinal: Column) -> Column:
    """A name that stays inside its folder and is unique within the mail.

    The base name is kept; path separators and control characters go. Every
    attachment but the first carries its number in front, and so does a first
    one whose own name looks numbered, so no two names of a mail can meet.
    """
    base = F.regexp_extract(F.regexp_replace(name, r"\\", "/"), r"([^/]*)/*$", 1)
    clean = F.regexp_replace(base, r"[\x00-\x1f\x7f:]", "_")
    clean = F.when(clean.isin("", ".", ".."), F.lit("attachment")).otherwise(clean)
    numbered = F.concat(F.format_string("%03d-", ordinal), clean)
    return F.when((ordinal == 0) & ~clean.rlike(r"^\d{3,}-"), clean).otherwise(numbered)
