"""Declared schemas of every table. Nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _L, _B, _TS = T.StringType(), T.LongType(), T.BinaryType(), T.TimestampType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields.items()])


# One row per file of a bucket, without its bytes.
LISTING = _struct(
    path=_S, namespace=_S, date_partition=_S, source_file=_S, location=_S, size=_L, modified_at=_TS
)

# A listing as the ledger keeps it, to compare the next one with.
SNAPSHOT = T.StructType([*LISTING.fields, T.StructField("run_id", _S, True)])

# Position of a row in its source: [] for the file itself, one number per nesting level below it.
ORD = T.ArrayType(_L)

# What unpacking finds. `mail` and `box` are separate columns so that reading
# mails never touches the bytes of nested containers, and the other way round.
FOUND = _struct(
    path=_S,
    namespace=_S,
    date_partition=_S,
    source_file=_S,
    entry_ord=ORD,
    container_path=T.ArrayType(_S),
    ancestors=T.ArrayType(_S),
    name=_S,
    format=_S,
    kind=_S,
    reason=_S,
    uid=_S,
    size=_L,
    may_attach=T.BooleanType(),
    mail=_B,
    box=_B,
    spill=_S,
    cut=_L,
)

LINEAGE = _struct(
    namespace=_S,
    date_partition=_S,
    source_file=_S,
    container_path=T.ArrayType(_S),
    original_filename=_S,
)

DISCOVERED = _struct(
    path=_S,
    namespace=_S,
    date_partition=_S,
    filename=_S,
    format=_S,
    size_bytes=_L,
    content_hash=_S,
    discovered_at=_TS,
    run_id=_S,
)

MANIFEST = _struct(
    uid=_S,
    source_lineage=LINEAGE,
    format=_S,
    content_hash=_S,
    output_path=_S,
    has_attachments=T.BooleanType(),
    attachment_dir=_S,
    processed_at=_TS,
    run_id=_S,
)

PROCESSED = _struct(
    content_hash=_S,
    uid=_S,
    source_path=_S,
    namespace=_S,
    date_partition=_S,
    output_path=_S,
    lineage=LINEAGE,
    processed_at=_TS,
    run_id=_S,
)

SKIPPED = _struct(
    path=_S, reason=_S, namespace=_S, date_partition=_S, discovered_at=_TS, run_id=_S
)

EMAILS = _struct(
    uid=_S, ext=_S, format=_S, content=_B, run_id=_S, namespace=_S, date_partition=_S
)

# A row with a fault is no attachment: it says where the MIME of a mail broke off.
ATTACHMENTS = _struct(
    uid=_S,
    ord=T.IntegerType(),
    name=_S,
    safe_name=_S,
    content=_B,
    namespace=_S,
    date_partition=_S,
    fault=_S,
    run_id=_S,
)

# Append-only events; the state of a run is its latest event.
RUN_EVENTS = _struct(
    run_id=_S,
    mode=_S,
    started_at=_TS,
    completed_at=_TS,
    status=_S,
    files_discovered=_L,
    files_processed=_L,
    files_skipped=_L,
    files_deduplicated=_L,
    event_no=T.IntegerType(),
)

# One file each; a run's carries its row of the run log, a compaction's what it stands for.
COMMIT = T.StructType(
    [T.StructField("kind", _S), *RUN_EVENTS.fields, T.StructField("upto", _L), T.StructField("place", _S)]
)
COMMIT_NO = T.StructField("commit_no", _L)
