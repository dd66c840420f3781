import random

import pytest
from pyspark.sql import functions as F

from weirstone.operators import (
    dedup_envelope,
    dedup_rare_copies,
    filter_by_keys,
    fits_broadcast,
    join_right,
    latest_per_key,
    latest_per_key_agg,
    merge_insert,
    merge_refresh,
    merge_upsert,
    sum_columns,
)
from weirstone.operators.keyjoin import hot_keys

SCHEMA = "k int, g string, v bigint"
SHUFFLED = {"max_rows": 0}
SALTED = {"max_rows": 0, "hot_rows": 8}


def frame(spark, rows, parts=5):
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def values(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def key(r, keys):
    return tuple(r["kgv".index(c)] for c in keys)


def rows_of(seed, n, hot=None):
    """Rows with null keys and copies; ``hot`` takes a third of them."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        k = hot if hot is not None and rng.random() < 0.34 else rng.choice([None, *range(40)])
        out.append((k, rng.choice([None, "a", "b"]), rng.randrange(6)))
    return out


@pytest.mark.parametrize(
    "options", [{}, SHUFFLED, SALTED], ids=["broadcast", "shuffled", "salted"]
)
@pytest.mark.parametrize("keys", [["k"], ["k", "g"]])
@pytest.mark.parametrize("seed", [1, 2])
def test_merges_against_brute_force(spark, options, keys, seed):
    target, stage = rows_of(seed, 300, hot=7), rows_of(seed + 10, 90, hot=7)[:60]
    t, s = frame(spark, target), frame(spark, stage, 3)
    touched = {key(r, keys) for r in stage}
    kept = [r for r in target if key(r, keys) not in touched]

    def rank(r):
        return tuple((x is not None, x if x is not None else "") for x in (r[2], r[1], r[0]))

    latest = [max((r for r in stage if key(r, keys) == q), key=rank) for q in touched]
    order = [F.col(c).desc() for c in "vgk"]
    assert values(merge_upsert(t, s, keys, order, **options)) == sorted(kept + latest, key=repr)
    assert values(merge_refresh(t, s, keys, **options)) == sorted(kept + stage, key=repr)
    known = {key(r, keys) for r in target}
    new = [r for r in stage if key(r, keys) not in known]
    assert values(merge_insert(t, s, keys, **options)) == sorted(target + new, key=repr)


def test_merge_is_the_same_when_repeated(spark):
    target, stage = frame(spark, rows_of(3, 100)), frame(spark, rows_of(4, 40))
    order = [F.col(c).desc() for c in "vgk"]
    once = merge_upsert(target, stage, ["k"], order)
    assert values(merge_upsert(once, stage, ["k"], order)) == values(once)
    once = merge_refresh(target, stage, ["k"])
    assert values(merge_refresh(once, stage, ["k"])) == values(once)
    once = merge_insert(target, stage, ["k"])
    assert values(merge_insert(once, stage, ["k"])) == values(once)


def test_a_small_stage_never_shuffles_the_target(spark):
    target = spark.range(0, 200_000, 1, 8).select(F.col("id").cast("int").alias("k"), F.lit("a").alias("g"), "id")
    stage = target.where("k % 1000 = 0")
    plan = merge_refresh(target, stage, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_a_hot_key_is_spread_over_tasks(spark):
    """A third of the target has one key; beyond the broadcast size it goes to many tasks."""
    target = spark.range(0, 120_000, 1, 16).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )
    stage = spark.range(0, 60_000).select(F.col("id").alias("k"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        kept = filter_by_keys(target, ["k"], stage, "left_anti", max_rows=0, hot_rows=1000)
        plan = kept._jdf.queryExecution().executedPlan().toString()
        tasks = kept.where("k = -1").select(F.spark_partition_id().alias("p"), "v")
        assert tasks.count() == 40_000
        assert tasks.select("p").distinct().count() >= 4
        assert kept.count() == 40_000 + 40_000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    main = next(line for line in plan.splitlines() if "LeftAnti" in line)
    assert "SortMergeJoin" in main and "BroadcastNestedLoopJoin" not in plan


def test_hot_keys_and_their_salts(spark):
    df = frame(spark, [(None, "a", 1)] * 25 + [(1, "a", 1)] * 10 + [(2, "a", 1)] * 11)
    assert {tuple(r) for r in hot_keys(df, ["k"], 10).collect()} == {(None, 3), (2, 2)}


def test_copies_of_one_row_are_spread(spark):
    """A third of all rows are the same row."""
    rows = spark.range(0, 30_000, 1, 24).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k")
    )
    keys = spark.range(-1, 20_000).select(F.col("id").alias("k"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        kept = filter_by_keys(rows, ["k"], keys, "left_semi", max_rows=0, hot_rows=500)
        tasks = kept.where("k = -1").select(F.spark_partition_id().alias("p"))
        assert tasks.count() == 10_000
        assert tasks.distinct().count() >= 4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_the_broadcast_bound_counts_rows_and_bytes(spark):
    df = spark.range(1000).select(F.repeat(F.lit("x"), 1000).alias("s"), "id")
    assert fits_broadcast(df)
    assert not fits_broadcast(df, max_rows=999)
    assert not fits_broadcast(df, max_bytes=1_000_000)
    assert fits_broadcast(df, max_bytes=1_100_000)
    nested = spark.range(10).select(F.struct(F.repeat(F.lit("x"), 1000)).alias("s"))
    assert not fits_broadcast(nested, max_bytes=10_000)
    assert fits_broadcast(df.limit(0))


def test_merge_arguments(spark):
    t = frame(spark, rows_of(1, 5))
    with pytest.raises(ValueError, match="differ"):
        merge_refresh(t, t.drop("v"), ["k"])
    with pytest.raises(ValueError, match="order"):
        merge_upsert(t, t, ["k"], [])
    with pytest.raises(ValueError, match="how"):
        filter_by_keys(t, ["k"], t, "inner")
    with pytest.raises(ValueError, match="key"):
        filter_by_keys(t, [], t, "left_anti")
    with pytest.raises(ValueError, match="full"):
        join_right(t, ["k"], t, ["k"], "full")


@pytest.mark.parametrize("latest", [latest_per_key, latest_per_key_agg])
def test_latest_per_key(spark, latest):
    rows = [
        (1, 5, 1, "old"), (1, 5, 2, "tie, higher id"), (1, None, 9, "null score"),
        (2, None, 1, "all null"), (2, None, 2, "all null, higher id"), (None, 1, 1, "null key"),
    ]
    df = spark.createDataFrame(rows, "k int, a int, id int, note string")
    got = latest(df, ["a", "id"], ["k"], "score", ["id"])
    assert got.columns == ["k", "a", "id", "note", "score"]
    assert {r.k: (r.note, r.score) for r in got.collect()} == {
        1: ("tie, higher id", 7), 2: ("all null, higher id", None), None: ("null key", 2),
    }


def test_latest_methods_agree_on_a_hot_key(spark):
    df = spark.createDataFrame(rows_of(8, 5000, hot=3), SCHEMA).withColumn(
        "id", F.monotonically_increasing_id()
    )
    df = df.select("k", "g", F.when(F.col("v") > 0, F.col("v")).alias("v"), "id")
    a = latest_per_key(df, ["v"], ["k"], "score", ["id"])
    assert values(a) == values(latest_per_key_agg(df, ["v"], ["k"], "score", ["id"]))
    plan = a._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan.split("Exchange hashpartitioning")[1]


def test_latest_arguments(spark):
    df = spark.createDataFrame([(1, "x", 2147483647)], "k int, s string, i int")
    with pytest.raises(TypeError, match="s"):
        sum_columns(df, ["s"])
    with pytest.raises(ValueError):
        sum_columns(df, [])
    with pytest.raises(ValueError, match="tiebreak"):
        latest_per_key(df, ["i"], ["k"], "score", [])
    assert df.select(sum_columns(df, ["i", "k"])).first()[0] is None


@pytest.mark.parametrize("options", [{}, SHUFFLED], ids=["broadcast", "shuffled"])
def test_dedup_of_copies(spark, options):
    rng = random.Random(2)
    once = [("t", p, o) for p in range(3) for o in range(300)]
    rows = once + rng.choices(once, k=100) + [("t", 0, 5)] * 600
    df = spark.createDataFrame(rows, "topic string, partition int, offset bigint").repartition(6)
    df = df.withColumn("value", F.concat_ws("-", "topic", "partition", "offset"))
    want = sorted((*r, "-".join(map(str, r))) for r in once)
    assert sorted(tuple(r) for r in dedup_envelope(df).collect()) == want
    assert sorted(tuple(r) for r in dedup_rare_copies(df, **options).collect()) == want
