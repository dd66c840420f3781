"""Kafka readers. The connector package comes from spark-submit ``--packages``."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

Offsets = Mapping[str, Mapping[int, int]]


def _offsets_text(offsets: Offsets | str) -> str:
    if isinstance(offsets, str):
        return offsets
    return json.dumps(
        {t: {str(p): int(o) for p, o in parts.items()} for t, parts in offsets.items()},
        separators=(",", ":"),
    )


def batch_options(
    brokers: str,
    topic: str,
    start: Offsets | str = "earliest",
    end: Offsets | str = "latest",
    *,
    fail_on_data_loss: bool = False,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Options of a bounded read.

    ``end`` defaults to the latest offset of every partition the topic has.
    ``min_partitions`` splits the range of a topic with few partitions over
    more tasks; without it, three partitions mean three tasks.
    """
    options = {
        "kafka.bootstrap.servers": brokers,
        "subscribe": topic,
        "startingOffsets": _offsets_text(start),
        "endingOffsets": _offsets_text(end),
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    return options


def stream_options(
    brokers: str,
    topic: str,
    start: Offsets | str = "earliest",
    *,
    max_offsets_per_trigger: int | None = None,
    fail_on_data_loss: bool = False,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Options of a streaming read; the per-trigger bound works only here."""
    options = batch_options(
        brokers,
        topic,
        start,
        fail_on_data_loss=fail_on_data_loss,
        min_partitions=min_partitions,
    )
    del options["endingOffsets"]
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def kafka_batch(spark: SparkSession, brokers: str, topic: str, *args, **kwargs) -> DataFrame:
    """Bounded read of one topic; arguments as :func:`batch_options`."""
    return (
        spark.read.format("kafka").options(**batch_options(brokers, topic, *args, **kwargs)).load()
    )


def kafka_stream(spark: SparkSession, brokers: str, topic: str, *args, **kwargs) -> DataFrame:
    """Streaming read of one topic; arguments as :func:`stream_options`."""
    return (
        spark.readStream.format("kafka")
        .options(**stream_options(brokers, topic, *args, **kwargs))
        .load()
    )
