"""Column expressions: casts, value fix-ups and JSON parsing."""

from .casts import add_ints, to_date, to_double, to_int, to_timestamp
from .payload import (
    parse_json,
    parse_json_flagged,
    prune_schema,
    record_schema,
    text_schema,
)
from .values import add_as_text, audit_stamp, recode, slice_text

__all__ = [
    "add_as_text",
    "add_ints",
    "audit_stamp",
    "parse_json",
    "parse_json_flagged",
    "prune_schema",
    "recode",
    "record_schema",
    "slice_text",
    "text_schema",
    "to_date",
    "to_double",
    "to_int",
    "to_timestamp",
]
