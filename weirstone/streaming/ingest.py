"""Incremental ingest with Structured Streaming.

The same flat projection as a batch load, so a stream and a batch give the
same rows. Progress is kept in the checkpoint, which takes the place of the
offset store.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans.feeds import Feed, flatten
from ..plans.load import whole_slices_only
from ..plans.targets import Merge
from ..session import written
from ..sinks.stages import JdbcStage, ParquetStage
from ..sources.envelope import POSITION


# The metric that counts the rows of a batch while they are written.
LOADED = "loaded"


def observed(flat: DataFrame) -> DataFrame:
    """``flat`` with its rows counted into the progress of the stream."""
    return flat.observe(LOADED, F.count(F.lit(1)).alias("rows"))


def _trigger(interval: str | None) -> dict:
    return {"availableNow": True} if interval is None else {"processingTime": interval}


def dedup_stream(stream: DataFrame, delay: str) -> DataFrame:
    """Drop copies of a message that arrive within ``delay`` of it.

    The state holds one position per message of the last ``delay``, hashed
    over the tasks; a copy later than that may pass. The timestamp must have a
    time zone: an NTZ one cannot be a watermark.
    """
    return (
        stream.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
        .withWatermark("timestamp", delay)
        .dropDuplicatesWithinWatermark(list(POSITION))
    )


def ingest_to_files(
    stream: DataFrame,
    feed: Feed,
    path: str,
    checkpoint: str,
    *,
    run_ts: str | None = None,
    timestamp_type: str = "timestamp",
    interval: str | None = None,
) -> StreamingQuery:
    """Flat rows to a parquet folder, each exactly once.

    Takes what is there and stops, unless ``interval`` keeps it running.
    """
    return (
        observed(flatten(stream, feed, run_ts, timestamp_type))
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(interval))
        .start()
    )


def ingest_to_stage(
    stream: DataFrame,
    feed: Feed,
    stage: ParquetStage | JdbcStage,
    checkpoint: str,
    *,
    merges: Sequence[Merge | Callable[[DataFrame], None]] = (),
    run_ts: str | None = None,
    timestamp_type: str = "timestamp",
    interval: str | None = None,
) -> StreamingQuery:
    """Flat rows to a stage and its merges, batch by batch.

    The load key is the query's id and the batch number: a batch that is run again replaces what
    it staged, and the merges are the same when repeated, so the effect is
    exactly once although a batch may run twice. A batch is no whole slice, so
    a ``Refresh`` is refused here: ``refresh_closed`` does it once a slice is complete.
    """
    whole_slices_only(merges)

    def load(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        if getattr(stage, "truncate", False):
            batch = written(batch, "batch")  # looked at, then staged: the batch itself is computed once
            if batch.isEmpty():
                return
        # The query's id lives in its checkpoint: another query's batches have other keys.
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        key = "_".join(x for x in (feed.load_name, query, str(number)) if x)
        stage.write(batch, key)
        staged = stage.read(spark, key)
        for merge in merges:
            (merge if callable(merge) else merge.apply)(staged)

    return (
        observed(flatten(stream, feed, run_ts, timestamp_type))
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(interval))
        .start()
    )
