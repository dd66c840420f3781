"""Scalar fix-ups on payload text."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def recode(c: Column | str, values: Mapping[str, str]) -> Column:
    """Replace exact, case-sensitive values; everything else passes through."""
    v = _col(c)
    out = None
    for old, new in values.items():
        out = F.when(v == old, F.lit(new)) if out is None else out.when(v == old, F.lit(new))
    return v if out is None else out.otherwise(v)


def slice_text(c: Column | str, start: int, length: int) -> Column:
    """``length`` characters from 1-based ``start``; short text gives ``''``."""
    return F.substring(_col(c), start, length)


def add_as_text(c: Column | str, n: int) -> Column:
    """``c + n`` as text."""
    return (_col(c) + F.lit(n)).cast("string")


def audit_stamp(run_ts: str | None = None, timestamp_type: str = "timestamp") -> Column:
    """Load time: one value per query, or the given literal."""
    if run_ts is None:
        return F.current_timestamp().cast(timestamp_type)
    return F.lit(run_ts).cast(timestamp_type)
