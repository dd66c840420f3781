import json
import math
import random

import pytest
from pyspark.sql import functions as F

from weirstone.operators import (
    EARLIEST,
    bound_batch,
    decode_offsets,
    encode_offsets,
    next_offsets,
    offset_gaps,
    parse_offsets,
    prorate,
    select_range,
    start_offsets,
    start_offsets_text,
)
from weirstone.operators import offsets as module

AT = "topic string, partition int, offset bigint"


def positions(spark, rows):
    return spark.createDataFrame(rows, AT)


def plan_of(spark, df):
    """The physical plan with its filters spelled out."""
    for name in ("spark.sql.maxMetadataStringLength", "spark.sql.debug.maxToStringFields"):
        spark.conf.set(name, "1000000")
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        for name in ("spark.sql.maxMetadataStringLength", "spark.sql.debug.maxToStringFields"):
            spark.conf.unset(name)


def values(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture
def rows():
    return [("a", p, o) for p in range(3) for o in range(10)] + [("b", 0, o) for o in range(5)]


def brute(rows, starts, ends, unlisted):
    starts, ends = parse_offsets(starts), parse_offsets(ends)
    out = []
    for t, p, o in rows:
        start = starts.get(t, {}).get(p, EARLIEST if unlisted == "all" else None)
        end = ends.get(t, {}).get(p, -1)
        if start is not None and (start == EARLIEST or o >= start) and (end == -1 or o < end):
            out.append((t, p, o))
    return sorted(out)


@pytest.mark.parametrize("limit", [64, 0])
@pytest.mark.parametrize("unlisted", ["all", "none"])
@pytest.mark.parametrize(
    "starts,ends",
    [
        ('{"a":{"0":4,"1":-2}}', "{}"),
        ('{"a":{"0":4,"1":0,"2":9}}', '{"a":{"0":6,"1":-1,"2":-1}}'),
        ('{"a":{"0":4,"1":3}}', '{"a":{"0":6,"1":9}}'),
        ("{}", '{"a":{"0":6}}'),
        ("{}", "{}"),
    ],
)
def test_range(spark, rows, monkeypatch, starts, ends, unlisted, limit):
    monkeypatch.setattr(module, "FILTER_PARTITIONS", limit)
    got = select_range(positions(spark, rows), starts, ends, unlisted=unlisted)
    assert got.columns == ["topic", "partition", "offset"]
    assert values(got) == brute(rows, starts, ends, unlisted)


def test_range_errors(spark, rows):
    frame = positions(spark, rows)
    with pytest.raises(ValueError, match="latest"):
        select_range(frame, {"a": {0: -1}})
    with pytest.raises(ValueError, match="earliest"):
        select_range(frame, {"a": {0: 1}}, {"a": {0: -2}})
    with pytest.raises(ValueError, match="unlisted"):
        select_range(frame, {}, unlisted="some")


@pytest.mark.parametrize("unlisted", ["all", "none"])
def test_range_reaches_the_file_scan(spark, rows, tmp_path, unlisted):
    path = str(tmp_path / "landed")
    positions(spark, rows).write.parquet(path)
    got = select_range(spark.read.parquet(path), {"a": {0: 4}}, unlisted=unlisted)
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        plan = got._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(offset,4)" in plan[plan.index("PushedFilters") :].split("]")[0]


def test_many_ranges_still_bound_the_file_scan(spark, rows, tmp_path):
    path = str(tmp_path / "landed")
    positions(spark, rows).write.parquet(path)
    starts = {"a": {p: 4 + p for p in range(100)}}
    got = select_range(spark.read.parquet(path), starts, unlisted="none")
    plan = plan_of(spark, got)
    assert values(got) == brute(rows, starts, {}, "none")
    assert "BroadcastHashJoin" in plan and "GreaterThanOrEqual(offset,4)" in plan


def test_prorate_shares_the_limit(spark):
    rng = random.Random(5)
    ranges = [("t", p, s, s + rng.choice([0, 1, 7, 5000, 10**13])) for p in range(20) for s in [rng.randrange(100)]]
    frame = spark.createDataFrame(ranges, "topic string, partition int, start bigint, end bigint")
    got = {r.partition: r.end for r in prorate(frame, 1000).collect()}
    total = sum(e - s for _, _, s, e in ranges)
    for _, p, s, e in ranges:
        share = 1000 * ((e - s) / total)
        quota = math.ceil(share) if share < 1 else math.floor(share)
        assert got[p] == min(e, s + quota)
    empty = spark.createDataFrame([("t", 0, 5, 5)], frame.schema)
    assert prorate(empty, 10).first().end == 5


def test_bound_batch_takes_the_first_offsets_without_moving_rows(spark):
    rows = [("a", 0, o) for o in range(900)] + [("a", 1, o) for o in range(50, 150)] + [("b", 0, 3)]
    got = bound_batch(positions(spark, rows), 100)
    assert values(got) == sorted(
        [("a", 0, o) for o in range(90)] + [("a", 1, o) for o in range(50, 60)] + [("b", 0, 3)]
    )
    assert "BroadcastHashJoin" in got._jdf.queryExecution().executedPlan().toString()


def brute_gaps(rows):
    out, seen = [], {}
    for t, p, o in rows:
        seen.setdefault((t, p), set()).add(o)
    for (t, p), offsets in seen.items():
        ordered = sorted(offsets)
        out += [(t, p, a + 1, b - 1) for a, b in zip(ordered, ordered[1:]) if b - a > 1]
    return sorted(out)


def test_gaps_against_brute_force(spark):
    rng = random.Random(11)
    rows = []
    for p in range(4):
        kept = [o for o in range(2000) if rng.random() > (0.02, 0.5, 0.98, 0)[p]]
        rows += [("t", p, o) for o in kept + kept[: len(kept) // 3]]
    edge = 1 << 24
    rows += [("e", 0, o) for o in (0, 63, 64, 127, edge - 1, edge, edge + 1, 3 * edge, 2**40, 2**40 + 1)]
    rows += [("one", 0, 5)]
    assert values(offset_gaps(positions(spark, rows))) == brute_gaps(rows)


def test_gaps_of_one_offset_copied_many_times(spark):
    hot = spark.range(200_000).select(
        F.lit("t").alias("topic"),
        F.lit(0).alias("partition"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).cast("bigint").alias("offset"),
    )
    got = values(offset_gaps(hot))
    assert got == brute_gaps([("t", 0, 7 if i % 3 == 0 else i) for i in range(200_000)])


def test_next_offsets_keep_what_is_not_new_and_never_go_back(spark):
    store = positions(spark, [("a", 0, 5), ("a", 1, 50), ("b", 0, 9), ("a", 0, 4)])
    got = next_offsets(positions(spark, [("a", 0, 7), ("a", 1, 10), ("a", 2, 0)]), store)
    assert values(got) == [("a", 0, 8), ("a", 1, 50), ("a", 2, 1), ("b", 0, 9)]


def test_offset_text_round_trip(spark):
    rows = [("b", 0, 9), ("a", 10, 1), ("a", 2, 3)]
    text = encode_offsets(positions(spark, rows)).first()["offsets"]
    assert text == '{"a":{"2":3,"10":1},"b":{"0":9}}'
    frame = spark.createDataFrame([(text,)], "offsets string")
    assert values(decode_offsets(frame)) == sorted(rows)
    assert encode_offsets(positions(spark, [])).first()["offsets"] == "{}"


def test_start_offsets(spark):
    store = positions(spark, [("a", 0, 5), ("a", 0, 7), ("b", 0, 1)])
    assert start_offsets(store, "a").first()["offsets"] == '{"a":{"0":7}}'
    assert json.loads(start_offsets_text(store, "a", 3)) == {"a": {"0": 7, "1": -2, "2": -2}}
    assert start_offsets_text(store, "unknown") == "earliest"


def test_gaps_before_the_first_offset_read(spark):
    rows = [("t", 0, o) for o in (7, 8, 10)] + [("t", 1, 3)]
    starts = positions(spark, [("t", 0, 4), ("t", 1, 3), ("t", 2, 0)])
    assert values(offset_gaps(positions(spark, rows), starts)) == [("t", 0, 4, 6), ("t", 0, 9, 9)]


def test_a_bounded_batch_filters_the_scan_of_whole_rows(spark, tmp_path):
    path = str(tmp_path / "landed")
    positions(spark, [("a", 0, o) for o in range(1000)] + [("b", 0, 5)]).write.parquet(path)
    got = bound_batch(spark.read.parquet(path), 100)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(offset,100)" in plan
    assert values(got) == sorted([("a", 0, o) for o in range(100)] + [("b", 0, 5)])
    none = bound_batch(spark.read.parquet(path).where("offset < 0"), 100)
    assert values(none) == []


def test_unknown_partitions_below_the_highest_known_start_at_the_earliest(spark):
    store = positions(spark, [("a", 0, 5), ("a", 2, 7)])
    assert json.loads(start_offsets_text(store, "a")) == {"a": {"0": 5, "1": -2, "2": 7}}


def many(partitions, skip=()):
    return {"a": {p: 3 + p % 40 for p in range(partitions) if p not in skip}, "b": {p: 7 for p in range(27) if p != 20}}


@pytest.mark.parametrize("limit", [64, 0])
@pytest.mark.parametrize("unlisted", ["all", "none"])
def test_many_ranges_lose_nothing(spark, monkeypatch, limit, unlisted):
    """Partitions between listed ones, messages without an offset, partition or topic, whatever the number of ranges."""
    monkeypatch.setattr(module, "FILTER_PARTITIONS", limit)
    pick = random.Random(limit)
    given = [(pick.choice("abc"), pick.randrange(-2, 110), pick.randrange(50)) for _ in range(3000)]
    given += [("b", 20, 5), ("b", 26, 5), ("a", 50, 1), ("a", 50, 7)]
    without = [("a", 50, None), ("a", 51, None), ("b", 20, None), ("c", 1, None), ("a", None, 3), (None, 3, 3), (None, None, None)]
    for starts, ends in ((many(50), {}), (many(100, {50}), {"a": {p: 30 for p in range(0, 90, 7) if p != 50}}), ({}, many(100))):
        got = select_range(positions(spark, given + without), starts, ends, unlisted=unlisted)
        read = [r for r in values(got.na.drop())]
        assert read == brute(given, starts, ends, unlisted)
        listed = {(t, p) for m in (starts, ends) for t, parts in m.items() for p in parts}
        kept = sorted((r for r in without if r[:2] not in listed), key=str) if unlisted == "all" else []
        found = [tuple(r) for r in got.where("topic IS NULL OR partition IS NULL OR offset IS NULL").collect()]
        assert sorted(found, key=str) == kept


@pytest.mark.parametrize("most", [1, 5, 64])
def test_clusters_hold_every_range(most):
    pick = random.Random(most)
    ranges = [
        (pick.choice("abc"), p, pick.choice([None, pick.randrange(10**6)]), pick.choice([None, 10**6 + pick.randrange(10**6)]))
        for p in range(700)
    ]
    clusters = module.cluster_ranges(ranges, most)
    assert len(clusters) == most
    for topic, part, start, end in ranges:
        own = [c for c in clusters if part in c[0].get(topic, ())]
        assert len(own) == 1
        assert own[0][1] is None or (start is not None and own[0][1] <= start)
        assert own[0][2] is None or (end is not None and own[0][2] >= end)


def test_clusters_part_far_ranges():
    """Two groups of bounds far apart: no cluster reads from the one to the other."""
    ranges = [("t", p, base + p, base + 100 + p) for base, parts in ((0, range(50)), (10**9, range(50, 100))) for p in parts]
    clusters = module.cluster_ranges(ranges, 2)
    assert sorted((c[1], c[2]) for c in clusters) == [(0, 149), (10**9 + 50, 10**9 + 199)]


def test_many_ranges_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "landed")
    positions(spark, [("t", p, o) for p in range(100) for o in range(5)]).write.parquet(path)
    far = {"t": {p: (p % 2) * 1_000_000 for p in range(100) if p != 7}}
    for unlisted in ("all", "none"):
        got = select_range(spark.read.parquet(path), far, unlisted=unlisted)
        plan = plan_of(spark, got)
        pushed = plan[plan.index("PushedFilters") :].split("ReadSchema")[0]
        assert "GreaterThanOrEqual(offset,1000000)" in pushed and "In(partition" in pushed
        assert "Exchange hash" not in plan
        assert got.count() == 50 * 5 + (5 if unlisted == "all" else 0)
