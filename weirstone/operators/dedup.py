"""Latest row per key, and one row per message position."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import written
from ..sources.envelope import POSITION
from .keyjoin import BROADCAST_BYTES, BROADCAST_ROWS, filter_by_keys, fits_broadcast


# Copies above this share of all messages are not rare; the error of its estimate is well below it.
RARE_SHARE, RARE_ERROR = 0.1, 0.02


def sum_columns(df: DataFrame, columns: Sequence[str]) -> Column:
    """Row-wise sum of numeric columns: null if any is null or on overflow."""
    if not columns:
        raise ValueError("at least one column is needed")
    wrong = [c for c in columns if not isinstance(df.schema[c].dataType, T.NumericType)]
    if wrong:
        raise TypeError(f"not numeric, cast them first: {wrong}")
    return reduce(F.try_add, [F.col(c) for c in columns])


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of every key in the given order.

    Each task keeps its own first row per key before the shuffle, so a key
    that holds a third of all rows sends one row per task.
    """
    if not order:
        raise ValueError("an order is needed; without one the kept row is arbitrary")
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", rank).where("__rank = 1").drop("__rank")


def latest_per_key(
    df: DataFrame,
    score_columns: Sequence[str],
    keys: Sequence[str],
    score: str,
    tiebreak: Sequence[str],
) -> DataFrame:
    """The row of the highest score per key; the sum stays as column ``score``.

    ``tiebreak`` columns, highest first, decide between equal scores. A null
    score wins only where all scores of the key are null.
    """
    if not tiebreak:
        raise ValueError("a tiebreak is needed; without one equal scores are arbitrary")
    scored = df.withColumn(score, sum_columns(df, score_columns))
    return first_per_key(scored, keys, [F.col(c).desc() for c in (score, *tiebreak)])


def latest_per_key_agg(
    df: DataFrame,
    score_columns: Sequence[str],
    keys: Sequence[str],
    score: str,
    tiebreak: Sequence[str],
) -> DataFrame:
    """:func:`latest_per_key` as one aggregate instead of a window."""
    if not tiebreak:
        raise ValueError("a tiebreak is needed; without one equal scores are arbitrary")
    scored = df.withColumn(score, sum_columns(df, score_columns))
    rest = [c for c in scored.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(score, *tiebreak))
    return (
        scored.groupBy(*keys)
        .agg(best.alias("__best"))
        .select(*[F.col(c) if c in keys else F.col(f"__best.{c}") for c in scored.columns])
    )


def dedup_envelope(df: DataFrame) -> DataFrame:
    """One row per ``(topic, partition, offset)``; copies are merged before the shuffle."""
    return df.dropDuplicates(list(POSITION))


def dedup_rare_copies(
    df: DataFrame,
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
    share: float = RARE_SHARE,
) -> DataFrame:
    """:func:`dedup_envelope` for a stored envelope in which few messages have copies.

    One scan of the positions estimates the share of copies, without a
    shuffle; above ``share`` all messages are shuffled at once. Else the
    positions alone are counted, and those with copies are written to the
    shared folder. If they fit a broadcast, messages without a copy are
    passed on where they are, and only the copies are shuffled with their
    payload. If they do not, copies are not rare and all messages are shuffled.
    """
    at = list(POSITION)
    rows, messages = df.agg(F.count(F.lit(1)), F.approx_count_distinct(F.xxhash64(*at), RARE_ERROR)).first()
    if messages < (1 - share) * rows:
        return dedup_envelope(df)
    copied = written(df.groupBy(*at).count().where("count > 1").select(*at), "copies")
    if not fits_broadcast(copied, max_rows, max_bytes):
        return dedup_envelope(df)
    single = filter_by_keys(df, at, copied, "left_anti", broadcast=True)
    copies = filter_by_keys(df, at, copied, "left_semi", broadcast=True)
    return single.unionByName(dedup_envelope(copies))
