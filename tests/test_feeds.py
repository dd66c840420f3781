import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from weirstone.functions import parse_json_flagged, prune_schema
from weirstone.operators import mark_malformed, split_malformed
from weirstone.plans import BUSINESS_LOCKS, CALL_TYPE, ROUTE_CALL_DETAIL, feed, flatten, parse_feed
from weirstone.plans.feeds import CALL_TYPE_FIELDS, LOCK_FIELDS, ROUTE_CALL_FIELDS
from weirstone.sources import key_value, require_envelope, sequence, spread, text_envelope

RUN_TS = "2024-02-01 00:00:00"

LOCK = {
    "SAPClient": "c7", "LockObject": "lock-17", "LockObjectCategory": "meter",
    "ProcessCode": "p3", "LockReason": "Q", "ValidFrom": "2021-05-04", "ValidTo": "2021-06-11",
    "BusinessPartner": 1000000001, "ContractAccount": 730000000001,
    "LockObjectCategoryName": "Meter point", "ProcessCodeName": "Reading",
    "LockReasonName": "Held until reviewed", "ChangedBy": "",
    "ChangedOn": "2019-11-05", "ChangedAt": "114500", "DateID": "d19", "Identification": "",
    "Count": "3", "DFKKLOCKS_DF_TS": "20191105114500", "DFKKLOCKS_DF_DI": "U",
}


def envelope(spark, values, topic="t"):
    rows = [
        (b"k", None if v is None else v.encode(), topic, i % 3, i // 3, dt.datetime(2024, 1, 1))
        for i, v in enumerate(values)
    ]
    return spark.createDataFrame(
        rows,
        "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp",
    ).coalesce(1)


def test_payload_widths():
    assert (len(LOCK_FIELDS), len(CALL_TYPE_FIELDS), len(ROUTE_CALL_FIELDS)) == (20, 90, 59)
    assert all(len(set(f)) == len(f) for f in (LOCK_FIELDS, CALL_TYPE_FIELDS, ROUTE_CALL_FIELDS))


@pytest.mark.parametrize("spec,width", [(BUSINESS_LOCKS, 25), (CALL_TYPE, 21), (ROUTE_CALL_DETAIL, 22)])
def test_result_contract(spark, spec, width):
    flat = flatten(envelope(spark, ["{}"]), spec)
    assert len(flat.columns) == width
    assert flat.columns[-5:] == [
        "kafka_topic", "kafka_partition", "kafka_offset", "kafka_record_timestamp", "last_updated",
    ]
    types = dict(flat.dtypes)
    assert (types["kafka_partition"], types["kafka_offset"]) == ("int", "bigint")
    assert types["kafka_record_timestamp"] == types["last_updated"] == "timestamp"


def test_sample_lock(spark):
    row = flatten(envelope(spark, [json.dumps(LOCK)]), BUSINESS_LOCKS, RUN_TS).first()
    assert row.business_partner_number == "1000000001"
    assert row.connection_contract_number == "730000000001"
    assert (row.valid_from, row.valid_to) == (dt.date(2021, 5, 4), dt.date(2021, 6, 11))
    assert row.changed_on == dt.date(2019, 11, 5) and row.changed_by == ""
    assert row.record_count == "3" and row.DFKKLOCKS_DF_DI == "U"


def test_dates_that_do_not_fit(spark):
    given = ["2020-02-03", "20200203", "0000-00-00", "", None]
    values = [json.dumps({**LOCK, "ValidFrom": v}) for v in given]
    rows = flatten(envelope(spark, values), BUSINESS_LOCKS).orderBy("kafka_offset", "kafka_partition").collect()
    assert [r.valid_from for r in rows] == [dt.date(2020, 2, 3), None, None, None, None]
    assert all(r.lock_reason == "Q" for r in rows)


def broken_records(seed, count):
    rng = random.Random(seed)
    out = [None, "", "null", "[]", "[1]", "7", "x", "{", "{}", '{"ANI":"1","ANI":"2"}', '{"ANI":[1,{"a":2}]}',
           '{"ANI":true,"CED":1.50}', '{"Extra":{"ANI":"3"},"ANI":"4"}', '{"ani":"lower"}']
    for i in range(count):
        record = {f: rng.choice(["a", "1", 'q"q', "é", 3, None, True]) for f in rng.sample(ROUTE_CALL_FIELDS, 9)}
        text = json.dumps(record)
        if i % 2:
            cut = rng.randrange(len(text))
            text = text[:cut] + rng.choice(["", "}", '"', "x", "\\", "\x01"]) + text[cut + rng.randrange(2):]
        out.append(text)
    return out


def test_one_row_out_per_message_in_and_pruning_changes_nothing(spark):
    values = broken_records(3, 600)
    source = envelope(spark, values)
    flat = flatten(source, ROUTE_CALL_DETAIL, RUN_TS)
    assert flat.count() == len(values)
    assert len(ROUTE_CALL_DETAIL.parse_schema) == 15
    pruned = parse_feed(source, ROUTE_CALL_DETAIL)
    whole = text_envelope(source).select(
        parse_json_flagged("value", ROUTE_CALL_DETAIL.schema).alias("rcd")
    )
    same = [F.col(f"rcd.{n}").alias(n) for n in ROUTE_CALL_DETAIL.parse_schema.names]
    whole = whole.select(F.when(F.col("rcd._corrupt_record").isNull(), F.col("rcd")).alias("rcd"))
    assert [tuple(r) for r in pruned.select(*same).collect()] == [
        tuple(r) for r in whole.select(*same).collect()
    ]


def test_a_broken_field_empties_the_record_wherever_it_is(spark):
    values = [
        '{"ANI":"1","CED":"x","Label":"y"}',
        '{"ANI":"1","CED":"\\u00e","Label":"y"}',
        '{"ANI":"1","CED":"x","Label":"\\u00e"}',
        '{"ANI":"1","CED":"x"',
    ]
    rows = flatten(envelope(spark, values), ROUTE_CALL_DETAIL).collect()
    assert [(r.ani, r.ced) for r in rows] == [("1", "x")] + [(None, None)] * 3
    assert [r.kafka_offset for r in rows] == [0, 0, 0, 1]


def test_flat_dates_are_the_parsed_dates(spark):
    odd = ["2020-02-03", "2020-2-3", "20200203", "2020-02-30", "0000-00-00", "9999-12-31", "0001-01-01",
           "2020-02-03 ", " 2020-02-03", "2020-02-03T00:00:00", "", "x", None, 20200203, 18000, 1.5, True]
    source = envelope(spark, [json.dumps({**LOCK, "ValidFrom": v}) for v in odd])
    parsed = parse_feed(source, BUSINESS_LOCKS, full=True).select("businessLock.ValidFrom")
    flat = flatten(source, BUSINESS_LOCKS).select("valid_from")
    assert [r[0] for r in flat.collect()] == [r[0] for r in parsed.collect()]


def test_malformed_records_are_set_aside_with_their_text(spark):
    values = ['{"ANI":"1"}', '{"ANI":"2', None, "", "nonsense", "{}"]
    schema = ROUTE_CALL_DETAIL.parse_schema
    rows = mark_malformed(envelope(spark, values), schema).collect()
    assert [r.malformed for r in rows] == [False, True, False, True, True, False]
    assert [r.raw_value for r in rows] == [None, '{"ANI":"2', None, "", "nonsense", None]
    good, bad = split_malformed(envelope(spark, values), schema)
    assert (good.count(), bad.count()) == (3, 3)
    assert "raw_value" not in good.columns and "payload" not in bad.columns


def test_the_parse_is_done_once_per_record(spark):
    plan = flatten(envelope(spark, ["{}"]), CALL_TYPE)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1
    assert "ReservationCalls" not in plan


def test_flatten_does_not_shuffle(spark):
    for spec in (BUSINESS_LOCKS, CALL_TYPE, ROUTE_CALL_DETAIL):
        plan = flatten(envelope(spark, ["{}"]), spec)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan


def test_unknown_names(spark):
    assert feed("callType") is CALL_TYPE
    with pytest.raises(KeyError, match="businessLocks"):
        feed("nothing")
    with pytest.raises(KeyError, match="nofield"):
        prune_schema(CALL_TYPE.schema, ["noField"])
    assert prune_schema(CALL_TYPE.schema, ["RNUM"]).names == ["rnum"]


def test_envelope_check(spark):
    good = envelope(spark, ["{}"])
    assert require_envelope(good) is good
    with pytest.raises(TypeError, match="offset: string"):
        text_envelope(good.withColumn("offset", F.col("offset").cast("string")))
    with pytest.raises(TypeError, match="value: absent"):
        key_value(good.drop("value"))


def test_sequence_and_spread(spark):
    ids = sequence(spark, 1, 100_000)
    assert ids.agg(F.min("id"), F.max("id"), F.count("*")).first()[:] == (1, 100_000, 100_000)
    assert spread(ids.coalesce(1)).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    wide = ids.repartition(16)
    assert spread(wide) is wide
