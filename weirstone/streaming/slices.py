"""Slice refreshes on a stream: a slice is replaced once, when all of it has come."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.keyjoin import join_right
from ..plans.targets import Refresh
from ..session import written
from ..sinks.stages import ParquetStage
from ..sources.tables import file_stream
from .ingest import _trigger


def closed_slices(rows: DataFrame, slices: tuple[str, ...], time: str, gap: str, delay: str) -> DataFrame:
    """Slices of a stream that are complete: their columns, ``__from`` and ``__to`` (exclusive).

    A slice is delivered as a run of messages with less than ``gap`` between
    them. It is closed when the watermark, ``delay`` behind the latest message
    of all, has passed the run's last message by ``gap``. The state holds a row
    for each open run: the slice and two times, no payload.
    """
    when = F.col(time).cast("timestamp").alias("__time")
    runs = rows.select(*slices, when).withWatermark("__time", delay).groupBy(F.session_window("__time", gap).alias("__run"), *slices)
    return runs.agg(F.count(F.lit(1)).alias("__rows")).select(
        *slices, F.col("__run.start").alias("__from"), F.col("__run.end").alias("__to")
    )


def _staged(spark: SparkSession, stage: ParquetStage, schema: T.StructType, closed: DataFrame, refresh: Refresh, time: str) -> DataFrame:
    """The staged rows of the latest run of each closed slice."""
    newest = F.row_number().over(Window.partitionBy(*refresh.slices).orderBy(F.col("__from").desc()))
    runs = closed.withColumn("__rank", newest).where("__rank = 1")
    names = [f"__slice_{i}" for i in range(len(refresh.slices))]
    runs = written(runs.select(*[F.col(c).alias(n) for c, n in zip(refresh.slices, names)], "__from", "__to"), "closed-slices")
    first, last = runs.agg(F.min("__from"), F.max("__to")).first()
    rows = stage.read_all(spark, schema)
    # The times of all runs reach the scan; each row is then held against its own run.
    kind = schema[time].dataType
    near = [F.col(time) >= F.lit(first).cast(kind), F.col(time) < F.lit(last).cast(kind)]
    at = F.col(time).cast("timestamp")
    inside = (at >= F.col("__from")) & (at < F.col("__to"))
    return join_right(rows.where(reduce(and_, near)), list(refresh.slices), runs, names, "left_semi", also=inside)


def refresh_closed(
    spark: SparkSession,
    stage: ParquetStage,
    schema: T.StructType,
    refresh: Refresh,
    checkpoint: str,
    *,
    time: str,
    gap: str,
    delay: str,
    max_files_per_trigger: int | None = None,
    interval: str | None = None,
) -> StreamingQuery:
    """Refresh a table from a growing stage, slice by slice, each when it is complete.

    Reads the stage that ``ingest_to_stage`` fills as a stream, so it never
    runs ahead of what is staged, and the table does not depend on how the
    messages were cut into batches. A run of messages that closes replaces its
    slice by all of its staged rows; of several runs of a slice the latest
    stays. A message that comes after its slice was closed stays in the stage.
    The times and slices go through the state, the rows are read from the
    stage, and a batch that runs again refreshes the same slices by the same rows.
    With ``max_files_per_trigger`` the files must come in the order of their
    times: after a file of later messages those of an earlier one are late.
    """

    def apply(closed: DataFrame, number: int) -> None:
        closed = written(closed, "closed")
        if not closed.isEmpty():
            refresh.apply(_staged(closed.sparkSession, stage, schema, closed, refresh, time))

    # A load that is staged anew replaces its files: those gone have come again under other names.
    rows = file_stream(spark, stage.loads, schema, max_files_per_trigger, ignore_missing=True)
    return (
        closed_slices(rows, refresh.slices, time, gap, delay)
        .writeStream.foreachBatch(apply)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(interval))
        .start()
    )
