"""Streams: ingest, dedup, slice refreshes and their log."""

from .ingest import dedup_stream, ingest_to_files, ingest_to_stage, observed
from .log import StreamLog
from .slices import closed_slices, refresh_closed

__all__ = ["StreamLog", "closed_slices", "dedup_stream", "ingest_to_files", "ingest_to_stage", "observed", "refresh_closed"]
