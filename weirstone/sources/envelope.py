"""The message envelope every operator works on.

An envelope is a DataFrame in the shape of a Kafka read. Operators take that
DataFrame and never a broker address, so a Kafka read, a landed parquet table
and a stream are interchangeable.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ENVELOPE_TYPES = {
    "key": ("binary", "string"),
    "value": ("binary", "string"),
    "topic": ("string",),
    "partition": ("int",),
    "offset": ("bigint",),
    "timestamp": ("timestamp", "timestamp_ntz"),
}

POSITION = ("topic", "partition", "offset")


def require_envelope(df: DataFrame, columns: tuple[str, ...] = tuple(ENVELOPE_TYPES)) -> DataFrame:
    """Return ``df`` unchanged, or raise naming every column of a wrong type."""
    found = dict(df.dtypes)
    bad = [
        f"{c}: {found.get(c, 'absent')}, expected {' or '.join(ENVELOPE_TYPES[c])}"
        for c in columns
        if found.get(c) not in ENVELOPE_TYPES[c]
    ]
    if bad:
        raise TypeError("not a message envelope; " + "; ".join(bad))
    return df


def text_envelope(df: DataFrame) -> DataFrame:
    """Key and value as text, with the topic, partition, offset and timestamp."""
    return require_envelope(df).selectExpr(
        "CAST(key AS STRING) AS key",
        "CAST(value AS STRING) AS value",
        "topic",
        "partition",
        "offset",
        "timestamp",
    )


def key_value(df: DataFrame) -> DataFrame:
    """Key and value as text only."""
    return require_envelope(df, ("key", "value")).selectExpr(
        "CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value"
    )


def as_envelope(
    df: DataFrame, *, key: str, value: str, topic: str, partition: str, offset: str, timestamp: str
) -> DataFrame:
    """Give any table the envelope shape; all but ``topic`` are SQL expressions."""
    return df.select(
        F.expr(f"CAST(CAST({key} AS STRING) AS BINARY) AS key"),
        F.expr(f"CAST({value} AS BINARY) AS value"),
        F.lit(topic).alias("topic"),
        F.expr(f"CAST({partition} AS INT) AS partition"),
        F.expr(f"CAST({offset} AS BIGINT) AS offset"),
        F.expr(f"{timestamp} AS timestamp"),
    )
