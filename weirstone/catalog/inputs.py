"""Envelopes and merge inputs derived from the given tables, row for row.

Some payloads are written wrong on purpose, to have malformed records, absent
fields and values that do not fit among the inputs. No row is left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import as_envelope, spread, table

RUN_TS = "2024-02-01 00:00:00"
NTZ = "timestamp_ntz"

# Where a part of the events ends and the next one starts.
PART_ENDS = ("2024-01-08", "2024-01-16", "2024-01-23")


def _positions(column: str) -> dict[str, str]:
    """Three partitions with gapless offsets from a number that has no gaps."""
    return {"key": column, "partition": f"{column} % 3", "offset": f"{column} div 3"}


def _cut_some(fields: str, column: str) -> str:
    """The fields as JSON; one record in 97 breaks off, as a malformed record does."""
    json = f"to_json(struct({fields}))"
    return f"CASE WHEN {column} % 97 = 0 THEN substring({json}, 1, 20) ELSE {json} END"


_ROUTE_CALL = """
    CAST(event_id AS STRING) AS RecoveryKey,
    CAST(user_id AS STRING) AS RouterCallKeyDay,
    CAST(event_id AS STRING) AS RouterCallKey,
    CAST(ts AS STRING) AS DateTime,
    CAST(length(event_type) AS STRING) AS RequestType,
    concat('555', user_id) AS ANI,
    event_type AS CED,
    user_id % 20 AS CallTypeID,
    event_type AS Variable6,
    props AS Variable7,
    concat('0000', upper(event_type)) AS Variable8,
    if(event_type = 'error', 'MAKEPYMENT', event_type) AS Variable9,
    CAST(value AS STRING) AS RouterCallKeySequenceNumber,
    concat('800', event_id) AS DialedNumberString,
    if(event_id % 5 = 0, 'not a time', CAST(ts AS STRING)) AS DbDateTime"""

_CALL_TYPE = """
    CAST(o_orderdate AS STRING) AS DateTime,
    CAST(o_custkey AS STRING) AS CallTypeID,
    CAST(o_orderkey AS STRING) AS RecoveryKey,
    CAST(o_orderkey % 7 AS STRING) AS RouterCallsAbandQ,
    CAST(o_orderkey % 11 AS STRING) AS CallsRouted,
    CAST(o_orderkey % 23 AS STRING) AS AnswerWaitTime,
    CAST(nullif(o_orderkey % 13, 0) AS STRING) AS CallsHandled,
    CAST(o_orderkey % 17 AS STRING) AS CallsOffered,
    CAST(o_orderkey % 29 AS STRING) AS HandleTime,
    CAST(o_orderkey % 37 AS STRING) AS ServiceLevelCalls,
    CAST(o_orderkey % 5 AS STRING) AS OverflowOut,
    if(o_orderkey % 19 = 0, 'n/a', CAST(o_orderkey % 19 AS STRING)) AS CallsAnswered,
    CAST(o_orderkey % 3 AS STRING) AS TotalCallsAband,
    CAST(o_orderkey % 31 AS STRING) AS MaxCallWaitTime"""

_LOCK = """
    'c7' AS SAPClient,
    CAST(o_orderkey AS STRING) AS LockObject,
    'meter' AS LockObjectCategory,
    'p3' AS ProcessCode,
    o_orderstatus AS LockReason,
    CAST(CAST(o_orderdate AS DATE) AS STRING) AS ValidFrom,
    CAST(date_add(CAST(o_orderdate AS DATE), 14) AS STRING) AS ValidTo,
    o_custkey AS BusinessPartner,
    o_orderkey + 730000000000 AS ContractAccount,
    'Meter point' AS LockObjectCategoryName,
    o_orderpriority AS ProcessCodeName,
    'On hold' AS LockReasonName,
    '' AS ChangedBy,
    '2019-11-05' AS ChangedOn,
    '114500' AS ChangedAt,
    'd19' AS DateID,
    '' AS Identification,
    '3' AS Count,
    '20191105114500' AS DFKKLOCKS_DF_TS,
    'U' AS DFKKLOCKS_DF_DI"""


def route_calls(spark: SparkSession, folder: str, topic: str = "routeCallDetail") -> DataFrame:
    """One route call message per event."""
    return _as_route_calls(spread(table(spark, folder, "events")), topic)


def _as_route_calls(events: DataFrame, topic: str = "routeCallDetail") -> DataFrame:
    return as_envelope(
        events,
        value=_cut_some(_ROUTE_CALL, "event_id"),
        topic=topic,
        timestamp="ts",
        **_positions("event_id"),
    )


def call_types(spark: SparkSession, folder: str, topic: str = "callTypeInterval") -> DataFrame:
    """One call type interval message per order."""
    return as_envelope(
        spread(table(spark, folder, "orders")),
        value=_cut_some(_CALL_TYPE, "o_orderkey"),
        topic=topic,
        timestamp="o_orderdate",
        **_positions("o_orderkey"),
    )


def locks(spark: SparkSession, folder: str, topic: str = "businessLocks_v1") -> DataFrame:
    """One lock message per order."""
    return as_envelope(
        spread(table(spark, folder, "orders")),
        value=_cut_some(_LOCK, "o_orderkey"),
        topic=topic,
        timestamp="o_orderdate",
        **_positions("o_orderkey"),
    )


def event_positions(spark: SparkSession, folder: str) -> DataFrame:
    """Events as messages of topic ``events``, the value being ``props``."""
    return as_envelope(
        table(spark, folder, "events"),
        value="props",
        topic="events",
        timestamp="ts",
        **_positions("event_id"),
    )


def event_positions_many(spark: SparkSession, folder: str) -> DataFrame:
    """Events as messages of two topics of 100 partitions each."""
    return as_envelope(
        table(spark, folder, "events").withColumn("topic", F.expr("if(event_id % 2 = 0, 'many_a', 'many_b')")),
        value="props",
        topic=F.col("topic"),
        timestamp="ts",
        key="event_id",
        partition="event_id div 2 % 100",
        offset="event_id div 200",
    )


def order_positions(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as messages of topic ``orders``, the value being the status."""
    return as_envelope(
        table(spark, folder, "orders"),
        value="o_orderstatus",
        topic="orders",
        timestamp="o_orderdate",
        **_positions("o_orderkey"),
    )


def item_positions(spark: SparkSession, folder: str) -> DataFrame:
    """Line items at the offset of their order: copies, and gaps where an order has none."""
    return as_envelope(
        table(spark, folder, "lineitem"),
        value="l_returnflag",
        topic="lineitem",
        timestamp="l_shipdate",
        **_positions("l_orderkey"),
    )


def item_loads(spark: SparkSession, folder: str) -> list[DataFrame]:
    """The messages of line items as three loads, with copies inside a load and across loads."""
    items = table(spark, folder, "lineitem")
    return [
        as_envelope(
            items.where(F.col("l_linenumber") % 3 == n),
            value="l_returnflag",
            topic="lineitem",
            timestamp="l_shipdate",
            **_positions("l_orderkey"),
        )
        for n in range(3)
    ]


def route_call_parts(spark: SparkSession, folder: str, messages: int) -> tuple[list[DataFrame], int]:
    """The route calls as four parts by time, each later than the one before, and the partitions each has.

    A partition has so many messages on average. The events are dealt to them
    before they become messages, which are ten times as long.
    """
    events = table(spark, folder, "events")
    at = F.col("ts").cast(NTZ)
    ends = [F.lit(day).cast(NTZ) for day in PART_ENDS]
    parts = [
        events.where(((at >= low) if low is not None else F.lit(True)) & ((at < high) if high is not None else F.lit(True)))
        for low, high in zip([None, *ends], [*ends, None])
    ]
    n = max(1, -(-events.count() // (len(parts) * messages)))
    return [_as_route_calls(part.coalesce(1) if n == 1 else part.repartition(n)) for part in parts], n


def order_states(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as a target table: key, status, amount, line, time."""
    return table(spark, folder, "orders").selectExpr(
        "o_orderkey AS order_key",
        "o_orderstatus AS status",
        "o_totalprice AS amount",
        "0 AS line",
        "o_orderdate AS changed_at",
    )


def item_states(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as changes of their order, several per key."""
    return table(spark, folder, "lineitem").selectExpr(
        "l_orderkey AS order_key",
        "l_linestatus AS status",
        "l_extendedprice AS amount",
        "l_linenumber AS line",
        "l_shipdate AS changed_at",
    )


def customer_slices(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as rows of one slice per customer."""
    return table(spark, folder, "orders").selectExpr(
        "o_custkey AS slice",
        "o_orderkey AS item",
        "o_totalprice AS amount",
    )


def user_slices(spark: SparkSession, folder: str) -> DataFrame:
    """Events as new rows of some of those slices."""
    return table(spark, folder, "events").selectExpr(
        "user_id AS slice", "event_id AS item", "value AS amount"
    )
