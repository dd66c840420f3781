"""The three feeds: payload schema, flat result columns, topic and stage table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import (
    add_ints,
    audit_stamp,
    parse_json,
    parse_json_flagged,
    prune_schema,
    record_schema,
    recode,
    slice_text,
    text_schema,
    to_date,
    to_double,
    to_int,
    to_timestamp,
)
from ..functions.payload import CORRUPT
from ..sources.envelope import text_envelope


@dataclass(frozen=True)
class Out:
    """A result column: name, payload field(s), and how it is made."""

    name: str
    source: tuple[str, ...]
    kind: str = "as is"

    def column(self, payload: str, timestamp_type: str) -> Column:
        # Field lookup ignores case, as SQL does.
        fields = [f"{payload}.{f}" for f in self.source]
        match self.kind:
            case "as is":
                made = F.expr(fields[0])
            case "int":
                made = to_int(fields[0])
            case "double":
                made = to_double(fields[0])
            case "date":
                made = to_date(fields[0])
            case "timestamp":
                made = to_timestamp(fields[0], timestamp_type)
            case "sum of ints":
                made = add_ints(*[to_int(f) for f in fields])
            case "state":
                made = slice_text(fields[0], *STATE_SLICE)
            case "intent":
                made = recode(fields[0], INTENT_FIXES)
            case "interval":
                made = F.lit(INTERVAL_TYPE)
            case _:
                raise ValueError(f"unknown kind {self.kind!r}")
        return made.alias(self.name)


@dataclass(frozen=True)
class Feed:
    """What is fixed about a feed; reads, stages and merges are the caller's."""

    name: str
    topic: str
    payload: str
    schema: T.StructType
    columns: tuple[Out, ...]
    stage: str
    load_name: str
    # Whether partition, offset and timestamp are cast to fixed types.
    typed_position: bool

    @property
    def parse_schema(self) -> T.StructType:
        """The payload fields the result columns read, as text; casts come later."""
        read = prune_schema(self.schema, [f for out in self.columns for f in out.source])
        return text_schema(read.names)


# Rules of the contact feeds. The misspelling is what senders write.
INTERVAL_TYPE = "bluesky"
STATE_SLICE = (5, 2)
INTENT_FIXES = {"MAKEPYMENT": "MAKEPAYMENT"}

# Payload fields of the lock feed, with their types.
LOCK_FIELDS = [
    ("SAPClient", "string"),
    ("LockObject", "string"),
    ("LockObjectCategory", "string"),
    ("ProcessCode", "string"),
    ("LockReason", "string"),
    ("ValidFrom", "date"),
    ("ValidTo", "date"),
    ("BusinessPartner", "string"),
    ("ContractAccount", "string"),
    ("LockObjectCategoryName", "string"),
    ("ProcessCodeName", "string"),
    ("LockReasonName", "string"),
    ("ChangedBy", "string"),
    ("ChangedOn", "date"),
    ("ChangedAt", "string"),
    ("DateID", "string"),
    ("Identification", "string"),
    ("Count", "string"),
    ("DFKKLOCKS_DF_TS", "string"),
    ("DFKKLOCKS_DF_DI", "string"),
]

# Payload fields of the call type interval feed, all text.
CALL_TYPE_FIELDS = """
    DateTime CallTypeID TimeZone RecoveryKey RouterQueueWaitTime RouterQueueCalls
    AvgRouterDelayQ RouterCallsAbandQ RouterQueueCallTypeLimit RouterQueueGlobalLimit
    CallsRouted ErrorCount ICRDefaultRouted NetworkDefaultRouted ReturnBusy ReturnRing
    NetworkAnnouncement AnswerWaitTime CallsHandled CallsOffered HandleTime
    ServiceLevelAband ServiceLevelCalls ServiceLevelCallsOffered ServiceLevel TalkTime
    OverflowOut HoldTime IncompleteCalls ShortCalls DelayQAbandTime CallsAnswered
    CallsRoutedNonAgent CallsRONA ReturnRelease CallsQHandled VruUnhandledCalls
    VruHandledCalls VruAssistedCalls VruOptOutUnhandledCalls VruScriptedXferredCalls
    VruForcedXferredCalls VruOtherCalls ServiceLevelType BucketIntervalID
    AnsInterval1 AnsInterval2 AnsInterval3 AnsInterval4 AnsInterval5 AnsInterval6
    AnsInterval7 AnsInterval8 AnsInterval9 AnsInterval10
    AbandInterval1 AbandInterval2 AbandInterval3 AbandInterval4 AbandInterval5
    AbandInterval6 AbandInterval7 AbandInterval8 AbandInterval9 AbandInterval10
    CallsRequeried DbDateTime RouterCallsAbandToAgent TotalCallsAband
    DelayAgentAbandTime CallDelayAbandTime CTDelayAbandTime ServiceLevelError
    ServiceLevelRONA AgentErrorCount VRUTime CTVRUTime Reserved1 Reserved2 Reserved3
    Reserved4 Reserved5 CallsOnHold MaxHoldTime ReportingHalfHour ReportingInterval
    MaxCallWaitTime MaxCallsQueued ReservationCalls rnum
""".split()

# Payload fields of the route call detail feed, all text.
ROUTE_CALL_FIELDS = """
    RecoveryKey DialedNumberID RouterCallKeyDay RouterCallKey RouteID DateTime RequestType
    RoutingClientID OriginatorType Unused RoutingClientCallKey Priority MsgOrigin
    Variable1 Variable2 Variable3 Variable4 Variable5 UserToUser ANI CDPD CED ScriptID
    FinalObjectID CallSegmentTime NetQTime CallTypeID RouterErrorCode RecoveryDay TimeZone
    NetworkTargetID LabelID Originator Variable6 Variable7 Variable8 Variable9 Variable10
    TargetLabelID RouterCallKeySequenceNumber RouterQueueTime VruScripts Label TargetLabel
    DialedNumberString BeganRoutingDateTime BeganCallTypeDateTime TargetType MRDomainID
    RequeryResult VruProgress DbDateTime ECCPayloadID ContactShareRuleID
    ContactShareQueueID ContactShareGroupID ApplicationGatewayID ContactShareErrorCode
    ContactShareResult
""".split()

# Result columns of the lock feed, in order.
LOCK_COLUMNS = (
    Out("sap_client", ("SAPClient",)),
    Out("lock_object", ("LockObject",)),
    Out("lock_object_category", ("LockObjectCategory",)),
    Out("process_code", ("ProcessCode",)),
    Out("lock_reason", ("LockReason",)),
    Out("valid_from", ("ValidFrom",), "date"),
    Out("valid_to", ("ValidTo",), "date"),
    Out("business_partner_number", ("BusinessPartner",)),
    Out("connection_contract_number", ("ContractAccount",)),
    Out("lock_object_category_name", ("LockObjectCategoryName",)),
    Out("process_code_name", ("ProcessCodeName",)),
    Out("lock_reason_name", ("LockReasonName",)),
    Out("changed_by", ("ChangedBy",)),
    Out("changed_on", ("ChangedOn",), "date"),
    Out("changed_at", ("ChangedAt",)),
    Out("date_id", ("DateID",)),
    Out("identification", ("Identification",)),
    Out("record_count", ("Count",)),
    Out("DFKKLOCKS_DF_TS", ("DFKKLOCKS_DF_TS",)),
    Out("DFKKLOCKS_DF_DI", ("DFKKLOCKS_DF_DI",)),
)

# Result columns of the call type interval feed, in order.
CALL_TYPE_COLUMNS = (
    Out("datetime", ("DateTime",), "timestamp"),
    Out("call_type_id", ("CallTypeID",), "int"),
    Out("recovery_key", ("RecoveryKey",), "double"),
    Out("over_flow_out", ("OverflowOut",), "int"),
    Out("router_calls_abandq", ("RouterCallsAbandQ",), "int"),
    Out("calls_routed", ("CallsRouted",), "int"),
    Out("outflow_to_queue", ("CallsHandled", "TotalCallsAband"), "sum of ints"),
    Out("callsoffered", ("CallsOffered",), "int"),
    Out("callsanswered", ("CallsAnswered",), "int"),
    Out("answerwaittime", ("AnswerWaitTime",), "int"),
    Out("handletime", ("HandleTime",), "int"),
    Out("callshandled", ("CallsHandled",), "int"),
    Out("maxcallwaittime", ("MaxCallWaitTime",), "int"),
    Out("total_calls_abandoned", ("TotalCallsAband",), "int"),
    Out("interval_type", (), "interval"),
    Out("service_level_calls", ("ServiceLevelCalls",), "int"),
)

# Result columns of the route call detail feed, in order.
ROUTE_CALL_COLUMNS = (
    Out("recovery_key", ("RecoveryKey",), "double"),
    Out("router_call_keyday", ("RouterCallKeyDay",), "int"),
    Out("router_call_key", ("RouterCallKey",), "int"),
    Out("date_time", ("DateTime",), "timestamp"),
    Out("request_type", ("RequestType",), "int"),
    Out("ani", ("ANI",)),
    Out("ced", ("CED",)),
    Out("call_type_id", ("CallTypeID",), "int"),
    Out("variable_6", ("Variable6",)),
    Out("variable_7", ("Variable7",)),
    Out("variable_8", ("Variable8",)),
    Out("state", ("Variable8",), "state"),
    Out("call_intent", ("Variable9",), "intent"),
    Out("router_call_key_sequence_number", ("RouterCallKeySequenceNumber",), "int"),
    Out("dialed_number_string", ("DialedNumberString",)),
    Out("db_date_time", ("DbDateTime",), "timestamp"),
    Out("interval_type", (), "interval"),
)

BUSINESS_LOCKS = Feed(
    name="businessLocks",
    topic="businessLocks_v1",
    payload="businessLock",
    schema=record_schema(LOCK_FIELDS),
    columns=LOCK_COLUMNS,
    stage="business_locks",
    load_name="businessLocks",
    typed_position=False,
)

CALL_TYPE = Feed(
    name="callType",
    topic="callTypeInterval",
    payload="cti",
    schema=text_schema(CALL_TYPE_FIELDS),
    columns=CALL_TYPE_COLUMNS,
    stage="call_type_interval",
    load_name="callTypeIntervalDataIVRRefresh",
    typed_position=True,
)

ROUTE_CALL_DETAIL = Feed(
    name="routeCallDetail",
    topic="routeCallDetail",
    payload="rcd",
    schema=text_schema(ROUTE_CALL_FIELDS),
    columns=ROUTE_CALL_COLUMNS,
    stage="route_call_detail",
    load_name="RouteCallDetail",
    typed_position=True,
)

FEEDS = {f.name: f for f in (BUSINESS_LOCKS, CALL_TYPE, ROUTE_CALL_DETAIL)}


def feed(name: str) -> Feed:
    """The feed of that name; an unknown name raises KeyError with the choices."""
    try:
        return FEEDS[name]
    except KeyError:
        raise KeyError(f"unknown feed {name!r}; choose from {sorted(FEEDS)}") from None


def parse_feed(envelope: DataFrame, feed: Feed, *, full: bool = False) -> DataFrame:
    """The parsed payload as one struct column, with the message position.

    Only the fields the flat result reads are parsed, as text, and a record
    that is not valid JSON has a null struct, wherever it is broken. ``full``
    is the plain parse of the whole schema: a field that is broken or does
    not fit its type is null, the others stay.
    """
    at = ["topic", "partition", "offset", "timestamp"]
    text, name = text_envelope(envelope), feed.payload
    if full:
        return text.select(parse_json("value", feed.schema).alias(name), *at)
    parsed = text.select(parse_json_flagged("value", feed.parse_schema).alias(name), *at)
    return parsed.selectExpr(f"CASE WHEN {name}.{CORRUPT} IS NULL THEN {name} END AS {name}", *at)


def flatten(
    envelope: DataFrame,
    feed: Feed,
    run_ts: str | None = None,
    timestamp_type: str = "timestamp",
) -> DataFrame:
    """Envelope to flat, typed, audited rows: one row out per message in.

    A malformed payload gives null business columns. The plan is a map over
    the source, batch or stream, without a shuffle. ``run_ts`` fixes the load
    time; ``timestamp_type`` may be ``timestamp_ntz``.
    """
    partition, offset, timestamp = "partition", "offset", "timestamp"
    if feed.typed_position:
        partition = "CAST(partition AS INT)"
        offset = "CAST(offset AS BIGINT)"
        timestamp = f"CAST(timestamp AS {timestamp_type})"
    return parse_feed(envelope, feed).select(
        *[out.column(feed.payload, timestamp_type) for out in feed.columns],
        F.expr("topic AS kafka_topic"),
        F.expr(f"{partition} AS kafka_partition"),
        F.expr(f"{offset} AS kafka_offset"),
        F.expr(f"{timestamp} AS kafka_record_timestamp"),
        audit_stamp(run_ts, timestamp_type).alias("last_updated"),
    )


def preview_locks(envelope: DataFrame) -> DataFrame:
    """Three identifying fields of each lock message."""
    return parse_feed(envelope, BUSINESS_LOCKS).selectExpr(
        "businessLock.SAPClient", "businessLock.BusinessPartner", "businessLock.ContractAccount"
    )
