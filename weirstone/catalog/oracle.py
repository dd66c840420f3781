"""The expected result of each query as DuckDB SQL over the same tables."""

from __future__ import annotations

from ..plans.feeds import CALL_TYPE_FIELDS, ROUTE_CALL_DETAIL, ROUTE_CALL_FIELDS

_STAMP = "TIMESTAMP '2024-02-01 00:00:00'"


def _position(column: str, prefix: str = "") -> str:
    return (
        f"CAST({column} % 3 AS INTEGER) AS {prefix}partition,"
        f" CAST({column} // 3 AS BIGINT) AS {prefix}offset"
    )


def _whole(column: str, expression: str) -> str:
    """The expression, or null where the record is cut off."""
    return f"CASE WHEN {column} % 97 <> 0 THEN {expression} END"


def _event(expression: str) -> str:
    return _whole("event_id", expression)


def _order(expression: str) -> str:
    return _whole("o_orderkey", expression)


_EVENT_JSON = """CAST(to_json({
    'RecoveryKey': CAST(event_id AS VARCHAR), 'RouterCallKeyDay': CAST(user_id AS VARCHAR),
    'RouterCallKey': CAST(event_id AS VARCHAR), 'DateTime': CAST(ts AS VARCHAR),
    'RequestType': CAST(length(event_type) AS VARCHAR), 'ANI': '555' || user_id,
    'CED': event_type, 'CallTypeID': user_id % 20, 'Variable6': event_type,
    'Variable7': props, 'Variable8': '0000' || upper(event_type),
    'Variable9': CASE WHEN event_type = 'error' THEN 'MAKEPYMENT' ELSE event_type END,
    'RouterCallKeySequenceNumber': CAST(value AS VARCHAR),
    'DialedNumberString': '800' || event_id,
    'DbDateTime': CASE WHEN event_id % 5 = 0 THEN 'not a time' ELSE CAST(ts AS VARCHAR) END
}) AS VARCHAR)"""
_EVENT_VALUE = f"CASE WHEN event_id % 97 = 0 THEN substr({_EVENT_JSON}, 1, 20) ELSE {_EVENT_JSON} END"

_EVENT_AT = f"'routeCallDetail' AS topic, {_position('event_id')}"
_CALL_TYPE_AT = f"'callTypeInterval' AS topic, {_position('o_orderkey')}"
_LOCK_AT = f"'businessLocks_v1' AS topic, {_position('o_orderkey')}"

_INTENT = "CASE WHEN event_type = 'error' THEN 'MAKEPAYMENT' ELSE event_type END"
_SEQUENCE = "CAST(trunc(value) AS INTEGER)"
_DB_TIME = "CASE WHEN event_id % 5 <> 0 THEN ts END"
_STATE = "substr(upper(event_type), 1, 2)"

_ROUTE_CALLS = f"""
SELECT {_event('CAST(event_id AS DOUBLE)')} AS recovery_key,
  {_event('CAST(user_id AS INTEGER)')} AS router_call_keyday,
  {_event('CAST(event_id AS INTEGER)')} AS router_call_key,
  {_event('ts')} AS date_time,
  {_event('CAST(length(event_type) AS INTEGER)')} AS request_type,
  {_event("'555' || user_id")} AS ani, {_event('event_type')} AS ced,
  {_event('CAST(user_id % 20 AS INTEGER)')} AS call_type_id,
  {_event('event_type')} AS variable_6, {_event('props')} AS variable_7,
  {_event("'0000' || upper(event_type)")} AS variable_8, {_event(_STATE)} AS state,
  {_event(_INTENT)} AS call_intent,
  {_event(_SEQUENCE)} AS router_call_key_sequence_number,
  {_event("'800' || event_id")} AS dialed_number_string,
  {_event(_DB_TIME)} AS db_date_time, 'bluesky' AS interval_type,
  'routeCallDetail' AS kafka_topic, {_position('event_id', 'kafka_')},
  ts AS kafka_record_timestamp, {_STAMP} AS last_updated
FROM events"""


def _rest(n: int) -> str:
    return f"CAST(o_orderkey % {n} AS INTEGER)"


_HANDLED = f"CASE WHEN o_orderkey % 13 <> 0 THEN {_rest(13)} END"
_ANSWERED = f"CASE WHEN o_orderkey % 19 <> 0 THEN {_rest(19)} END"

_CALL_TYPES = f"""
SELECT {_order('o_orderdate')} AS datetime,
  {_order('CAST(o_custkey AS INTEGER)')} AS call_type_id,
  {_order('CAST(o_orderkey AS DOUBLE)')} AS recovery_key,
  {_order(_rest(5))} AS over_flow_out, {_order(_rest(7))} AS router_calls_abandq,
  {_order(_rest(11))} AS calls_routed,
  {_order(f'({_HANDLED}) + {_rest(3)}')} AS outflow_to_queue,
  {_order(_rest(17))} AS callsoffered, {_order(_ANSWERED)} AS callsanswered,
  {_order(_rest(23))} AS answerwaittime, {_order(_rest(29))} AS handletime,
  {_order(_HANDLED)} AS callshandled, {_order(_rest(31))} AS maxcallwaittime,
  {_order(_rest(3))} AS total_calls_abandoned, 'bluesky' AS interval_type,
  {_order(_rest(37))} AS service_level_calls,
  'callTypeInterval' AS kafka_topic, {_position('o_orderkey', 'kafka_')},
  o_orderdate AS kafka_record_timestamp, {_STAMP} AS last_updated
FROM orders"""

# Payload field, result column, value.
_LOCK_VALUES = [
    ("SAPClient", "sap_client", "'c7'"),
    ("LockObject", "lock_object", "CAST(o_orderkey AS VARCHAR)"),
    ("LockObjectCategory", "lock_object_category", "'meter'"),
    ("ProcessCode", "process_code", "'p3'"),
    ("LockReason", "lock_reason", "o_orderstatus"),
    ("ValidFrom", "valid_from", "CAST(o_orderdate AS DATE)"),
    ("ValidTo", "valid_to", "CAST(o_orderdate AS DATE) + 14"),
    ("BusinessPartner", "business_partner_number", "CAST(o_custkey AS VARCHAR)"),
    ("ContractAccount", "connection_contract_number", "CAST(o_orderkey + 730000000000 AS VARCHAR)"),
    ("LockObjectCategoryName", "lock_object_category_name", "'Meter point'"),
    ("ProcessCodeName", "process_code_name", "o_orderpriority"),
    ("LockReasonName", "lock_reason_name", "'On hold'"),
    ("ChangedBy", "changed_by", "''"),
    ("ChangedOn", "changed_on", "DATE '2019-11-05'"),
    ("ChangedAt", "changed_at", "'114500'"),
    ("DateID", "date_id", "'d19'"),
    ("Identification", "identification", "''"),
    ("Count", "record_count", "'3'"),
    ("DFKKLOCKS_DF_TS", "DFKKLOCKS_DF_TS", "'20191105114500'"),
    ("DFKKLOCKS_DF_DI", "DFKKLOCKS_DF_DI", "'U'"),
]

_LOCKS = f"""
SELECT {', '.join(f'{_order(value)} AS {out}' for _, out, value in _LOCK_VALUES)},
  'businessLocks_v1' AS kafka_topic, {_position('o_orderkey', 'kafka_')},
  o_orderdate AS kafka_record_timestamp, {_STAMP} AS last_updated
FROM orders"""

_CALL_FIELD_VALUES = {
    "RecoveryKey": "CAST(event_id AS VARCHAR)",
    "RouterCallKeyDay": "CAST(user_id AS VARCHAR)",
    "RouterCallKey": "CAST(event_id AS VARCHAR)",
    "DateTime": "CAST(ts AS VARCHAR)",
    "RequestType": "CAST(length(event_type) AS VARCHAR)",
    "ANI": "'555' || user_id",
    "CED": "event_type",
    "CallTypeID": "CAST(user_id % 20 AS VARCHAR)",
    "Variable6": "event_type",
    "Variable7": "props",
    "Variable8": "'0000' || upper(event_type)",
    "Variable9": "CASE WHEN event_type = 'error' THEN 'MAKEPYMENT' ELSE event_type END",
    "RouterCallKeySequenceNumber": "CAST(value AS VARCHAR)",
    "DialedNumberString": "'800' || event_id",
    "DbDateTime": "CASE WHEN event_id % 5 = 0 THEN 'not a time' ELSE CAST(ts AS VARCHAR) END",
}

_LATEST_CALLS = f"""
SELECT call_type_id, router_call_keyday, router_call_key, date_time, kafka_offset
FROM ({_ROUTE_CALLS})
QUALIFY row_number() OVER (PARTITION BY call_type_id, router_call_keyday
  ORDER BY kafka_record_timestamp DESC, kafka_partition DESC, kafka_offset DESC) = 1"""

_EVENT_KEYS = f"CAST(event_id AS VARCHAR) AS key, 'events' AS topic, {_position('event_id')}"
_NEXT = f"""
SELECT 'events' AS topic, CAST(event_id % 3 AS INTEGER) AS partition,
  CAST(max(event_id // 3) + 1 AS BIGINT) AS "offset" FROM events GROUP BY event_id % 3
UNION ALL
SELECT 'orders', CAST(o_orderkey % 3 AS INTEGER), CAST(max(o_orderkey // 3) + 1 AS BIGINT)
FROM orders GROUP BY o_orderkey % 3"""
_NEXT_TEXT = f"""
SELECT topic, '{{' || string_agg('"' || partition || '":' || "offset", ',' ORDER BY partition) || '}}' AS parts
FROM ({_NEXT}) GROUP BY topic"""
_LATEST_SCORE = """
SELECT *, value + event_id AS score FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY value + event_id DESC, event_id DESC) = 1"""
_ORDER_STATES = """SELECT o_orderkey AS order_key, o_orderstatus AS status, o_totalprice AS amount,
  CAST(0 AS INTEGER) AS line, o_orderdate AS changed_at FROM orders"""
_ITEM_STATES = """SELECT l_orderkey AS order_key, l_linestatus AS status, l_extendedprice AS amount,
  l_linenumber AS line, l_shipdate AS changed_at FROM lineitem"""

# What is written into the interval messages: texts, most of them remainders of the key.
_INTERVAL_VALUES = {
    "DateTime": "CAST(o_orderdate AS VARCHAR)",
    "CallTypeID": "CAST(o_custkey AS VARCHAR)",
    "RecoveryKey": "CAST(o_orderkey AS VARCHAR)",
    "CallsHandled": "CAST(nullif(o_orderkey % 13, 0) AS VARCHAR)",
    "CallsAnswered": "CASE WHEN o_orderkey % 19 = 0 THEN 'n/a' ELSE CAST(o_orderkey % 19 AS VARCHAR) END",
} | {
    field: f"CAST(o_orderkey % {n} AS VARCHAR)"
    for field, n in (
        ("RouterCallsAbandQ", 7),
        ("CallsRouted", 11),
        ("AnswerWaitTime", 23),
        ("CallsOffered", 17),
        ("HandleTime", 29),
        ("ServiceLevelCalls", 37),
        ("OverflowOut", 5),
        ("TotalCallsAband", 3),
        ("MaxCallWaitTime", 31),
    )
}

ORACLE: dict[str, str] = {
    "flatten_business_locks": _LOCKS,
    "flatten_call_type": _CALL_TYPES,
    "flatten_route_call_detail": _ROUTE_CALLS,
    "envelope_cast": f"""
SELECT CAST(event_id AS VARCHAR) AS key, {_EVENT_VALUE} AS value, {_EVENT_AT}, ts AS timestamp
FROM events""",
    "envelope_key_value": "SELECT CAST(event_id AS VARCHAR) AS key, props AS value FROM events",
    "parse_explicit_schema": f"""
SELECT {', '.join(f'{_order(value)} AS {field}' for field, _, value in _LOCK_VALUES)}, {_LOCK_AT}
FROM orders""",
    "parse_reflected_schema": "SELECT "
    + ", ".join(
        f"{_event(_CALL_FIELD_VALUES[f])} AS {f}"
        if f in _CALL_FIELD_VALUES
        else f"CAST(NULL AS VARCHAR) AS {f}"
        for f in ROUTE_CALL_FIELDS
    )
    + f", {_EVENT_AT} FROM events",
    "parse_reflected_call_type": "SELECT "
    + ", ".join(
        f"{_order(_INTERVAL_VALUES[f])} AS {f}" if f in _INTERVAL_VALUES else f"CAST(NULL AS VARCHAR) AS {f}"
        for f in CALL_TYPE_FIELDS
    )
    + f", {_CALL_TYPE_AT} FROM orders",
    "json_dates": f"""
SELECT {_order('CAST(o_orderdate AS DATE)')} AS valid_from,
  {_order('CAST(o_orderdate AS DATE) + 14')} AS valid_to,
  {_order("DATE '2019-11-05'")} AS changed_on, {_LOCK_AT} FROM orders""",
    "nested_case_insensitive": f"""
SELECT {_event('CAST(event_id AS VARCHAR)')} AS recovery_key, {_event("'555' || user_id")} AS ani,
  {_event("'800' || event_id")} AS dialed_number_string, {_EVENT_AT} FROM events""",
    "nested_subset": f"""
SELECT {_order("'c7'")} AS SAPClient, {_order('CAST(o_custkey AS VARCHAR)')} AS BusinessPartner,
  {_order('CAST(o_orderkey + 730000000000 AS VARCHAR)')} AS ContractAccount FROM orders""",
    "cast_int": f"""
SELECT {_event('CAST(event_id AS INTEGER)')} AS router_call_key,
  {_event('CAST(user_id % 20 AS INTEGER)')} AS call_type_id,
  {_event(_SEQUENCE)} AS sequence_number, CAST(NULL AS INTEGER) AS not_a_number, {_EVENT_AT}
FROM events""",
    "cast_double": f"""
SELECT {_event('CAST(event_id AS DOUBLE)')} AS recovery_key, {_event('value')} AS sequence_number,
  {_EVENT_AT} FROM events""",
    "cast_timestamp": f"""
SELECT {_event('ts')} AS date_time, {_event(_DB_TIME)} AS db_date_time, {_EVENT_AT} FROM events""",
    "int_sum": f"""
SELECT {_order(f'({_HANDLED}) + {_rest(3)}')} AS outflow_to_queue, {_CALL_TYPE_AT} FROM orders""",
    "substring_state": f"SELECT {_event(_STATE)} AS state, {_EVENT_AT} FROM events",
    "case_intent": f"SELECT {_event(_INTENT)} AS call_intent, {_EVENT_AT} FROM events",
    "literal_tag": f"""
SELECT 'bluesky' AS interval_type, 'events' AS topic, {_position('event_id')} FROM events""",
    "sum_columns": """
SELECT l_orderkey, l_linenumber, l_quantity + l_extendedprice + l_tax AS total FROM lineitem""",
    "sql_view": f"""
SELECT {_event("'555' || user_id")} AS ani, {_event(_STATE)} AS state, {_EVENT_AT} FROM events""",
    "source_count": "SELECT count(*) AS rows FROM events",
    "offset_range": f"""
SELECT {_EVENT_KEYS} FROM events
WHERE event_id // 3 >= CASE event_id % 3 WHEN 0 THEN 1000 WHEN 1 THEN 3000 ELSE 0 END""",
    "load_offsets_snapshots": """
SELECT 'events' AS topic, CAST(event_id % 3 AS INTEGER) AS partition, CAST(max(event_id // 3) + 1 AS BIGINT) AS "offset", 1 AS files
FROM events GROUP BY event_id % 3""",
    "load_gaps": """
WITH placed AS (SELECT CAST(o_orderkey % 3 AS INTEGER) AS part, CAST(o_orderkey // 3 AS BIGINT) AS spot FROM orders),
cut AS (SELECT max(spot) // 3 AS third FROM placed),
loads AS (
  SELECT 1 AS load, part, spot FROM placed, cut WHERE spot < third
  UNION ALL SELECT 2, part, spot FROM placed, cut WHERE spot >= third + 50 AND spot % 10 <> 7),
spans AS (SELECT load, part, min(spot) AS first, max(spot) + 1 AS next, count(*) AS n FROM loads GROUP BY load, part),
found AS (
  SELECT part, first, next, n, max(next) FILTER (load = 1) OVER (PARTITION BY part) AS stored, load FROM spans)
SELECT 'callTypeInterval' AS topic, part AS partition, CASE WHEN load = 2 THEN stored END AS start, first, next,
  CASE WHEN load = 2 THEN greatest(first - stored, 0) ELSE 0 END AS lost_before, next - first - n AS lost_inside
FROM found WHERE next - first > n OR (load = 2 AND first > stored)""",
    "limited_load": f"""
SELECT {_event('CAST(event_id AS DOUBLE)')} AS recovery_key, {_position('event_id', 'kafka_')},
  (ts >= TIMESTAMP '2024-01-08')::INTEGER + (ts >= TIMESTAMP '2024-01-16')::INTEGER + (ts >= TIMESTAMP '2024-01-23')::INTEGER AS batch,
  CAST(max(event_id // 3) OVER (PARTITION BY event_id % 3) + 1 AS BIGINT) AS stored_offset
FROM events""",
    "dedup_against_history": f"""
SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS key, 'lineitem' AS topic, {_position('l_orderkey')} FROM lineitem""",
    "stream_log": """
SELECT '%s' AS load_name, CAST(batch AS BIGINT) AS batch, CASE WHEN batch < 2 THEN n END AS rows,
  CASE WHEN batch < 2 THEN 'done' ELSE 'error' END AS status, CASE WHEN batch = 2 THEN TRUE END AS has_message
FROM (
  SELECT (ts >= TIMESTAMP '2024-01-08')::INTEGER + (ts >= TIMESTAMP '2024-01-16')::INTEGER + (ts >= TIMESTAMP '2024-01-23')::INTEGER AS batch,
    count(*) AS n
  FROM events GROUP BY batch)
WHERE batch <= 2""" % ROUTE_CALL_DETAIL.load_name,
    "stream_refresh": f"""
WITH calls AS (
  SELECT {_event('CAST(user_id AS INTEGER)')} AS router_call_keyday, {_event('CAST(event_id AS INTEGER)')} AS router_call_key,
    {_event('ts')} AS date_time, {_position('event_id', 'kafka_')}, ts FROM events),
starts AS (
  SELECT *, ts - lag(ts) OVER (PARTITION BY router_call_keyday ORDER BY ts) < INTERVAL 12 HOUR AS goes_on FROM calls),
runs AS (
  SELECT *, sum(CASE WHEN goes_on THEN 0 ELSE 1 END) OVER (PARTITION BY router_call_keyday ORDER BY ts) AS run FROM starts),
ends AS (SELECT router_call_keyday, run, max(ts) + INTERVAL 12 HOUR AS until FROM runs GROUP BY ALL),
closed AS (
  SELECT router_call_keyday, max(run) AS run FROM ends
  WHERE until <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events) GROUP BY router_call_keyday)
SELECT r.router_call_keyday, router_call_key, date_time, kafka_partition, kafka_offset
FROM runs r JOIN closed c ON r.router_call_keyday IS NOT DISTINCT FROM c.router_call_keyday AND r.run = c.run""",
    "jdbc_quantile_scan": """
SELECT o_orderkey AS id, o_orderkey * o_orderkey AS skewed, TRUE AS even FROM orders""",
    "merge_upsert_bucketed": f"""
WITH latest AS ({_ITEM_STATES}
  QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber DESC, l_extendedprice DESC, l_linestatus DESC) = 1)
SELECT order_key, CASE WHEN old THEN o.status ELSE l.status END AS status, CASE WHEN old THEN o.amount ELSE l.amount END AS amount,
  CASE WHEN old THEN o.line ELSE l.line END AS line, CASE WHEN old THEN o.changed_at ELSE l.changed_at END AS changed_at
FROM (
  SELECT order_key, o, l, l.order_key IS NULL
    OR (o.order_key IS NOT NULL AND row(o.changed_at, o.line, o.amount, o.status) > row(l.changed_at, l.line, l.amount, l.status)) AS old
  FROM ({_ORDER_STATES}) o FULL JOIN latest l USING (order_key))""",
    "load_append_stage": f"""
WITH third AS (SELECT max(o_orderkey // 3) // 3 + 1 AS size FROM orders)
SELECT CAST(o_orderkey // 3 // size AS INTEGER) AS load, {_position('o_orderkey', 'kafka_')},
  {_order('CAST(o_orderkey AS DOUBLE)')} AS recovery_key
FROM orders, third""",
    "offset_range_many": """
WITH placed AS (
  SELECT CAST(event_id AS VARCHAR) AS key, event_id % 2 = 0 AS in_a, event_id // 2 % 100 AS part, event_id // 200 AS spot FROM events)
SELECT key, CASE WHEN in_a THEN 'many_a' ELSE 'many_b' END AS topic, CAST(part AS INTEGER) AS partition, CAST(spot AS BIGINT) AS "offset"
FROM placed
WHERE CASE WHEN in_a AND part % 7 = 3 THEN TRUE
  WHEN in_a THEN spot >= part % 5 AND (part % 3 <> 0 OR spot < 30 + part % 9)
  WHEN part < 90 THEN spot >= 20 + part % 11
  ELSE TRUE END""",
    "bounded_batch": f"""
WITH span AS (
  SELECT event_id % 3 AS part, min(event_id // 3) AS first, max(event_id // 3) + 1 AS last
  FROM events GROUP BY part),
quota AS (
  SELECT part, first, 100 * ((last - first) / sum(last - first) OVER ()) AS share FROM span)
SELECT {_EVENT_KEYS} FROM events JOIN quota ON part = event_id % 3
WHERE event_id // 3 < first + CASE WHEN share < 1 THEN ceil(share) ELSE floor(share) END""",
    "offset_gaps": """
WITH seen AS (SELECT DISTINCT l_orderkey % 3 AS part, l_orderkey // 3 AS o FROM lineitem),
pairs AS (SELECT part, o, lag(o) OVER (PARTITION BY part ORDER BY o) AS before FROM seen)
SELECT 'lineitem' AS topic, CAST(part AS INTEGER) AS partition,
  CAST(before + 1 AS BIGINT) AS gap_start, CAST(o - 1 AS BIGINT) AS gap_end
FROM pairs WHERE o - before > 1""",
    "offset_gaps_from_start": """
WITH seen AS (SELECT DISTINCT l_orderkey % 3 AS part, l_orderkey // 3 AS o FROM lineitem),
starts AS (SELECT o_orderkey % 3 AS part, min(o_orderkey // 3) - 2 AS start FROM orders GROUP BY 1),
pairs AS (
  SELECT part, o, coalesce(lag(o) OVER (PARTITION BY part ORDER BY o), start - 1) AS before
  FROM seen LEFT JOIN starts USING (part))
SELECT 'lineitem' AS topic, CAST(part AS INTEGER) AS partition,
  CAST(before + 1 AS BIGINT) AS gap_start, CAST(o - 1 AS BIGINT) AS gap_end
FROM pairs WHERE o - before > 1""",
    "next_offsets": _NEXT,
    "offsets_json": f"""
SELECT '{{' || string_agg('"' || topic || '":' || parts, ',' ORDER BY topic) || '}}' AS offsets
FROM ({_NEXT_TEXT})""",
    "offsets_rows": _NEXT,
    "start_offsets": f"""
SELECT '{{"' || topic || '":' || parts || '}}' AS offsets FROM ({_NEXT_TEXT}) WHERE topic = 'events'""",
    "preview": """
SELECT event_id, ts, user_id, event_type FROM events ORDER BY ts DESC, event_id LIMIT 20""",
    "dedup_latest": _LATEST_SCORE,
    "dedup_latest_agg": _LATEST_SCORE,
    "dedup_envelope": f"SELECT {_EVENT_KEYS} FROM events",
    "dedup_rare_copies": f"""
SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS key, 'lineitem' AS topic, {_position('l_orderkey')}
FROM lineitem""",
    "merge_upsert": f"""
WITH changes AS ({_ITEM_STATES}
  QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC,
    l_linenumber DESC, l_extendedprice DESC, l_linestatus DESC) = 1)
SELECT * FROM changes
UNION ALL
SELECT * FROM ({_ORDER_STATES}) WHERE order_key NOT IN (SELECT order_key FROM changes)""",
    "merge_refresh": """
SELECT user_id AS slice, event_id AS item, value AS amount FROM events
UNION ALL
SELECT o_custkey, o_orderkey, o_totalprice FROM orders
WHERE o_custkey NOT IN (SELECT user_id FROM events)""",
    "merge_insert": f"""
{_ITEM_STATES}
UNION ALL
SELECT * FROM ({_ORDER_STATES}) WHERE order_key NOT IN (SELECT l_orderkey FROM lineitem)""",
    "malformed_split": f"""
SELECT {_EVENT_AT}, event_id % 97 = 0 AS malformed,
  CASE WHEN event_id % 97 = 0 THEN substr({_EVENT_JSON}, 1, 20) END AS raw_value,
  {_event("'555' || user_id")} AS ani FROM events""",
    "map_add_string": """
SELECT l_orderkey, l_linenumber, CAST(l_orderkey + 1 AS VARCHAR) AS next_key FROM lineitem""",
    "load_merge": _LATEST_CALLS,
    "load_offsets": """
SELECT 'businessLocks_v1' AS topic, CAST(o_orderkey % 3 AS INTEGER) AS partition,
  CAST(max(o_orderkey // 3) + 1 AS BIGINT) AS "offset" FROM orders GROUP BY o_orderkey % 3""",
    "load_log": """
SELECT 'callTypeIntervalDataIVRRefresh' AS key_name, 'Kafka' AS load_type,
  'callTypeIntervalDataIVRRefresh' AS load_name, 'ErrorProcess' AS step, 'error' AS status,
  true AS has_trace, count(*) AS staged_rows FROM orders""",
    "stream_ingest": _ROUTE_CALLS,
    "stream_merge": _LATEST_CALLS,
    "stream_dedup": f"SELECT {_EVENT_KEYS} FROM events",
    "jdbc_query_scan": """
SELECT o_custkey, CAST(count(*) AS INTEGER) AS orders, max(o_orderkey) AS last_order
FROM orders GROUP BY o_custkey""",
    "jdbc_append_roundtrip": """
SELECT event_id, ts, user_id, value FROM events
UNION ALL SELECT event_id, ts, user_id, value FROM events""",
    "jdbc_write_modes": """
SELECT event_id AS id, (SELECT count(*) FROM orders) AS rows_after_ignore FROM events""",
    "stage_truncate_load": f"""
SELECT {_event('CAST(event_id AS DOUBLE)')} AS recovery_key, 'routeCallDetail' AS kafka_topic
FROM events""",
}
