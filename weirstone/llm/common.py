"""What several operators share: words, small sides of joins, ranks."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator, Sequence
from functools import wraps

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written

# A word is a run of anything but these six white-space characters, which are
# also what bytes.split() splits at.
WORD = r"[^\x20\x09-\x0D]+"


def text_words(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8; none for null."""
    return [] if text is None else text.encode("utf-8", "surrogatepass").split()


def n_words(text: str | Column) -> Column:
    """Number of words of a text column, 0 for null."""
    column = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(column, F.lit(WORD)), F.lit(0)).cast("bigint")


def ranked(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """``df`` with its rank from 1 in a total order.

    Rows are dealt by ranges of the order; a range's start is the number of
    rows in the ranges before it, so the only thing one task sees whole is
    one number per range.
    """
    dealt = written(df.repartitionByRange(*order).withColumn("__range", F.spark_partition_id()), "ranges")
    sizes = dealt.groupBy("__range").agg(F.count(F.lit(1)).alias("__rows"))
    before = F.sum("__rows").over(Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("__range", F.coalesce(before, F.lit(0)).alias("__start"))
    inside = F.row_number().over(Window.partitionBy("__range").orderBy(*order))
    joined = dealt.join(starts, "__range")
    return joined.withColumn(name, F.col("__start") + inside).drop("__range", "__start")


Batches = Iterator[pa.RecordBatch]


def tidy(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """``run`` for ``mapInArrow`` with its memory given back when a task ends.

    Workers live on for other tasks, of other stages too: what one of them had
    at its height would else stay beside the next ones' memory.
    """

    @wraps(run)
    def through(batches: Batches) -> Batches:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return through


def slices(batch: pa.RecordBatch, column: int, rows: int, size: int) -> Batches:
    """Parts of a batch of at most so many rows, and of about so many bytes of one text column unless a text is longer."""
    ends = pc.cumulative_sum(pc.cast(pc.fill_null(pc.binary_length(batch.column(column)), 0), pa.int64())).to_pylist()
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        end = start + 1
        while end < batch.num_rows and end - start < rows and ends[end] - before <= size:
            end += 1
        yield batch.slice(start, end - start)
        start = end
