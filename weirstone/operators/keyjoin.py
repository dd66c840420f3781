"""Keep or drop rows by a set of keys, whatever the size or skew of either side."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add, and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import written

BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 * 1024 * 1024
# Rows of one key a single task of a shuffled join may get.
HOT_ROWS = 1_000_000

_FIXED = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)


def _row_bytes(df: DataFrame):
    """Estimated bytes of a row in a hash table: 16 per column plus its text."""

    def one(f: T.StructField):
        if isinstance(f.dataType, _FIXED):
            return F.lit(16)
        text = (
            F.col(f.name)
            if isinstance(f.dataType, (T.StringType, T.BinaryType))
            else F.to_json(F.struct(f.name))
        )
        return F.coalesce(F.octet_length(text), F.lit(0)) + 16

    return reduce(add, [one(f) for f in df.schema.fields])


def fits_broadcast(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    """Whether a count of the rows and bytes of ``df`` is below the bounds.

    Runs one job that returns two numbers.
    """
    rows, size = df.agg(F.count(F.lit(1)), F.sum(_row_bytes(df).cast("bigint"))).first()
    return rows <= max_rows and (size or 0) <= max_bytes


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int) -> DataFrame:
    """Keys of more than ``hot_rows`` rows, as ``__hot_<i>``, with a number of salts.

    The rows are counted before the shuffle. There are no more such keys than
    rows of ``df`` over ``hot_rows``; they are written to the shared folder.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"))
    named = [F.col(k).alias(f"__hot_{i}") for i, k in enumerate(keys)]
    hot = written(counts.where(F.col("__rows") > hot_rows).select(*named, "__rows"), "hot-keys")
    return hot.withColumn("__salts", F.ceil(F.col("__rows") / hot_rows)).drop("__rows")


def _all_equal(left: Sequence[str], right: Sequence[str]) -> Column:
    return reduce(and_, [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(left, right)])


def join_right(
    df: DataFrame,
    keys: Sequence[str],
    right: DataFrame,
    right_keys: Sequence[str],
    how: str,
    *,
    also: Column | None = None,
    broadcast: bool | None = None,
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Join a large ``df`` to a side of unknown size; nulls equal nulls.

    A side that is small by count is broadcast, so ``df`` is not shuffled.
    Beyond that both are shuffled on the keys, and the rows of a key that
    ``df`` has too often are split over one task per ``hot_rows`` of them, to
    each of which the key's rows of ``right`` are repeated. Column names of
    ``right`` must differ from those of ``df``. ``also`` is a further
    condition; ``broadcast`` skips the count if the caller has made it, and
    ``hot_rows=None`` the count of keys that are known to be spread evenly.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"a {how!r} join cannot repeat the right side")
    same = _all_equal(keys, right_keys)
    if also is not None:
        same = same & also
    if broadcast is None:
        broadcast = fits_broadcast(right, max_rows, max_bytes)
    if broadcast:
        return df.join(F.broadcast(right), same, how)
    hot = None if hot_rows is None else hot_keys(df, keys, hot_rows)
    if hot is None or hot.isEmpty():
        return df.join(right, same, how)
    # A list too long for a broadcast is joined like any other side; skewed partitions of it are split at run time.
    hot = F.broadcast(hot) if fits_broadcast(hot) else hot
    names = [f"__hot_{i}" for i in range(len(keys))]
    # Hashing the row parts a hot key, the input partition parts its copies,
    # and both are the same again when a lost task is run again.
    parts = [f.name for f in df.schema if "map<" not in f.dataType.simpleString()]
    salt = F.pmod(F.xxhash64(F.spark_partition_id(), *parts), F.col("__salts"))
    salted = (
        df.join(hot, _all_equal(keys, names), "left")
        .withColumn("__salt", F.coalesce(salt, F.lit(0)))
        .drop(*names, "__salts")
    )
    last = F.coalesce(F.col("__salts"), F.lit(1)) - 1
    repeated = (
        right.join(hot, _all_equal(right_keys, names), "left")
        .withColumn("__salt_of", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
        .drop(*names, "__salts")
    )
    joined = salted.join(repeated, same & (F.col("__salt") == F.col("__salt_of")), how)
    return joined.drop("__salt", "__salt_of")


def filter_by_keys(
    df: DataFrame, keys: Sequence[str], keyset: DataFrame, how: str, **options
) -> DataFrame:
    """``left_semi`` or ``left_anti`` of ``df`` on ``keyset``; nulls equal nulls.

    The keys are reduced to distinct ones first; options as :func:`join_right`.
    """
    if how not in ("left_semi", "left_anti"):
        raise ValueError(f"how must be left_semi or left_anti, not {how!r}")
    if not keys:
        raise ValueError("at least one key is needed")
    names = [f"__key_{i}" for i in range(len(keys))]
    right = keyset.select(*[F.col(k).alias(n) for k, n in zip(keys, names)]).distinct()
    return join_right(df, keys, right, names, how, **options)
