"""Readers: Kafka, JDBC, file tables, and the envelope they all come as."""

from .envelope import (
    POSITION,
    as_envelope,
    key_value,
    require_envelope,
    text_envelope,
)
from .jdbc import JdbcConnection, scalar, scan, scan_quantiles, scan_split
from .kafka import batch_options, kafka_batch, kafka_stream, stream_options
from .tables import file_stream, sequence, spread, table

__all__ = [
    "POSITION",
    "JdbcConnection",
    "as_envelope",
    "batch_options",
    "file_stream",
    "kafka_batch",
    "kafka_stream",
    "key_value",
    "require_envelope",
    "scalar",
    "scan",
    "scan_quantiles",
    "scan_split",
    "sequence",
    "spread",
    "stream_options",
    "table",
    "text_envelope",
]
