"""Mail corpus ingestion on Spark DataFrames."""

from mailsift.functions.formats import DEFAULT, Format, Formats, Refused
from mailsift.plans.ingest import Options, ingest, ingest_frame
from mailsift.plans.ledger import Ledger
from mailsift.plans.status import run_metrics, status
from mailsift.streaming.intake import ingest_stream, watch_bucket

__all__ = [
    "DEFAULT",
    "Format",
    "Formats",
    "Ledger",
    "Options",
    "Refused",
    "ingest",
    "ingest_frame",
    "ingest_stream",
    "run_metrics",
    "status",
    "watch_bucket",
]
