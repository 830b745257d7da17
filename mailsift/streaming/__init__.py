"""Streaming intake."""
from mailsift.streaming.intake import ingest_stream, watch_bucket

__all__ = ["ingest_stream", "watch_bucket"]
