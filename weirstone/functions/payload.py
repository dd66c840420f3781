"""JSON payload parsing against fixed schemas."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Without an explicit format a date such as 20200203 is read as a day number.
JSON_OPTIONS = {"dateFormat": "yyyy-MM-dd"}

CORRUPT = "_corrupt_record"


def text_schema(names: Iterable[str]) -> T.StructType:
    """A record of nullable text fields, typed later by casts."""
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def record_schema(fields: Iterable[tuple[str, str]]) -> T.StructType:
    """A record from ``(name, type)`` pairs; the types are ``string`` and ``date``."""
    types = {"string": T.StringType(), "date": T.DateType()}
    return T.StructType([T.StructField(n, types[t]) for n, t in fields])


def prune_schema(schema: T.StructType, names: Iterable[str]) -> T.StructType:
    """Only the named fields, matched without regard to case, in schema order.

    The optimizer keeps the whole parse schema once more than one field is
    read, so the parser would build every field.
    """
    wanted = {n.lower() for n in names}
    kept = [f for f in schema.fields if f.name.lower() in wanted]
    missing = wanted - {f.name.lower() for f in kept}
    if missing:
        raise KeyError(f"not in the payload schema: {sorted(missing)}")
    return T.StructType(kept)


def parse_json(value: Column | str, schema: T.StructType) -> Column:
    """Parse JSON text; a field that cannot be read is null, the row stays."""
    return F.from_json(value, schema, JSON_OPTIONS)


def parse_json_flagged(value: Column | str, schema: T.StructType) -> Column:
    """As :func:`parse_json`, with the raw text of a bad record in one more field.

    With a schema of text fields, a record is bad if and only if it is not
    valid JSON, whichever of its fields the schema names.
    """
    flagged = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return F.from_json(
        value, flagged, {**JSON_OPTIONS, "columnNameOfCorruptRecord": CORRUPT}
    )
