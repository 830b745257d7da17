"""Hashes, time stamps, and records to and from JSON text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mailsift.schemas import LINEAGE


def content_hash(content: Column) -> Column:
    """SHA-256 of the bytes as 64 hex characters; also the uid of a mail."""
    return F.sha2(content, 256)


def now() -> Column:
    """One time stamp for the whole query, in the session time zone UTC."""
    return F.current_timestamp()


def to_json_record(*columns: Column | str) -> Column:
    """A record as JSON with its nulls written out."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def from_json_record(text: Column, schema: T.StructType = LINEAGE) -> Column:
    return F.from_json(text, schema)


def json_lines(df: DataFrame) -> DataFrame:
    return df.select(to_json_record(*df.columns).alias("value"))
