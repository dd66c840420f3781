"""Text-to-type conversions that give null on bad input.

They never raise and never read a session setting, so one bad record cannot
end a job whether ANSI mode is on or off. All of them are built-in expressions.
``v`` is a column name, a nested field such as ``rcd.ANI``, or a SQL expression.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Blank and control characters that Spark's own casts trim from both ends.
_PAD = r"[\x00-\x20\x7f]*"

# The text is classified before it is cast: a failing try_cast pays for an
# exception per row, a failing pattern does not.
_TO_INT = rf"""
CASE WHEN {{v}} RLIKE r'^{_PAD}[+-]?\d+{_PAD}$' THEN try_cast({{v}} AS INT)
     WHEN {{v}} RLIKE r'^{_PAD}[+-]?\d+\.\d*{_PAD}$' THEN try_cast(substring_index({{v}}, '.', 1) AS INT)
     WHEN {{v}} RLIKE r'^{_PAD}[+-]?\.\d*{_PAD}$' THEN 0 END"""


def to_int(v: str) -> Column:
    """Text to INT; digits after the point are cut off, garbage gives null."""
    return F.expr(_TO_INT.format(v=v))


def to_double(v: str) -> Column:
    """Text to DOUBLE, null on garbage; digits beyond 2**53 are lost."""
    return F.expr(f"try_cast({v} AS DOUBLE)")


def to_timestamp(v: str, timestamp_type: str = "timestamp") -> Column:
    """Text to TIMESTAMP (session time zone) or ``timestamp_ntz``, null on garbage."""
    return F.expr(f"try_cast({v} AS {timestamp_type})")


def to_date(v: str) -> Column:
    """Text ``yyyy-MM-dd`` to DATE, null on anything else."""
    return F.expr(f"try_to_date({v}, 'yyyy-MM-dd')")


def add_ints(*cols: Column | str) -> Column:
    """Sum of INT columns: null if any is null, null on overflow."""
    if not cols:
        raise ValueError("add_ints needs at least one column")
    return reduce(F.try_add, [F.col(c) if isinstance(c, str) else c for c in cols])
