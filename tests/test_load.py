import datetime as dt
import glob
import json
import os

import pytest
from pyspark.sql import functions as F
from test_feeds import envelope

from weirstone.operators import select_range, start_offsets_text
from weirstone.plans import ROUTE_CALL_DETAIL, Insert, OffsetStore, Refresh, Upsert, ingest, run_load
from weirstone.plans import targets
from weirstone.session import shared_folder
from weirstone.sinks import ParquetStage, load_key

ROW = "g string, k int, v int"


def values(df):
    """Rows as (g, k, v); a partition column comes back last."""
    return sorted((tuple(r) for r in df.select("g", "k", "v").collect()), key=repr)


def files(path):
    return {f: os.path.getmtime(f) for f in glob.glob(f"{path}/*/*.parquet")}


def stage(spark, rows):
    return spark.createDataFrame(rows, ROW)


@pytest.mark.parametrize("limit", [1000, 1])
def test_upsert_rewrites_only_touched_partitions(spark, tmp_path, monkeypatch, limit):
    monkeypatch.setattr(targets, "FILTER_PARTITIONS", limit)
    path = str(tmp_path / "t")
    merge = Upsert(path, ("g", "k"), ("v",), ("g",))
    merge.apply(stage(spark, [("007", 1, 1), ("007", 1, 2), ("b", 1, 1), ("c", 1, 1), (None, 1, 1)]))
    read = spark.read.schema(ROW).parquet(path)
    assert values(read) == [("007", 1, 2), ("b", 1, 1), ("c", 1, 1), (None, 1, 1)]
    before = files(path)
    change = stage(spark, [("007", 2, 5), ("b", 1, 9), (None, 1, 4)])
    for _ in range(2):
        merge.apply(change)
        read = spark.read.schema(ROW).parquet(path)
        assert values(read) == [
            ("007", 1, 2), ("007", 2, 5), ("b", 1, 9), ("c", 1, 1), (None, 1, 4),
        ]
    kept = {f for f in before if f in files(path)}
    assert {f.split("/")[-2] for f in kept} == {"g=c"}


def test_upsert_reads_only_touched_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    Upsert(path, ("g", "k"), ("v",), ("g",)).apply(stage(spark, [("a", 1, 1), ("b", 1, 1)]))
    table = spark.read.schema(ROW).parquet(path)
    plan = targets.touched_partitions(table, stage(spark, [("a", 3, 3)]), ["g"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in text and "PartitionFilters: []" not in text
    two = targets.touched_partitions(table, stage(spark, [("a", 1, 3)]), ["g", "k"])
    assert values(two) == [("a", 1, 1)]


def test_upsert_partitions_must_be_keys(spark, tmp_path):
    with pytest.raises(ValueError, match="partition"):
        Upsert(str(tmp_path / "t"), ("k",), ("v",), ("g",)).apply(stage(spark, [("a", 1, 1)]))


def test_refresh_and_insert_tables(spark, tmp_path):
    slices = Refresh(str(tmp_path / "r"), ("g",))
    slices.apply(stage(spark, [("a", 1, 1), ("a", 2, 1), ("b", 1, 1)]))
    for _ in range(2):
        slices.apply(stage(spark, [("a", 3, 3), ("a", 3, 3)]))
        got = spark.read.schema(ROW).parquet(slices.path)
        assert values(got) == [("a", 3, 3), ("a", 3, 3), ("b", 1, 1)]
    rows = Insert(str(tmp_path / "i"), ("k",))
    rows.apply(stage(spark, [("a", 1, 1)]))
    for _ in range(2):
        rows.apply(stage(spark, [("x", 1, 9), ("y", 2, 2), ("z", None, 3)]))
        got = spark.read.schema(ROW).parquet(rows.path)
        assert values(got) == [("a", 1, 1), ("y", 2, 2), ("z", None, 3)]


@pytest.mark.parametrize("keys", [("g", "k"), ("k",)])
def test_insert_into_partitions(spark, tmp_path, keys):
    rows = Insert(str(tmp_path / "i"), keys, ("g",))
    rows.apply(stage(spark, [("a", 1, 1), ("b", 2, 1)]))
    rows.apply(stage(spark, [("a", 1, 9), ("a", 2, 9), ("c", 3, 9)]))
    got = values(spark.read.schema(ROW).parquet(rows.path))
    new = [("a", 2, 9)] if "g" in keys else []
    assert got == sorted([("a", 1, 1), ("b", 2, 1), ("c", 3, 9), *new], key=repr)


def calls(spark, n, first=0):
    values = [json.dumps({"CallTypeID": str(i % 4), "RouterCallKeyDay": str(i % 5), "ANI": f"n{i}"}) for i in range(first + n)]
    frame = envelope(spark, values, ROUTE_CALL_DETAIL.topic)
    return frame.where(F.col("offset") * 3 + F.col("partition") >= first)


def test_load_stages_merges_and_moves_offsets(spark, tmp_path):
    base = str(tmp_path)
    store = OffsetStore(f"{base}/offsets")
    keep = ParquetStage(f"{base}/stage")
    latest = Upsert(f"{base}/latest", ("call_type_id", "router_call_keyday"), ("kafka_offset",), ("call_type_id",))
    seen = []
    topic = ROUTE_CALL_DETAIL.topic
    assert start_offsets_text(store.read(spark), topic) == "earliest"

    def run(source, key):
        return run_load(source, ROUTE_CALL_DETAIL, keep, merges=[latest, lambda s: seen.append(s.count())], offsets=store, key=key)

    assert run(calls(spark, 30), "1_x") == 30
    assert run(calls(spark, 30), "1_x") == 30
    assert seen == [30, 30]
    assert spark.read.parquet(keep.path).count() == 30
    assert spark.read.parquet(latest.path).count() == 20
    starts = start_offsets_text(store.read(spark), topic)
    assert json.loads(starts) == {topic: {"0": 10, "1": 10, "2": 10}}
    assert run(select_range(calls(spark, 40), starts), "2_x") == 10
    assert spark.read.parquet(keep.path).count() == 40
    newest = spark.read.parquet(latest.path).where("call_type_id = 3 and router_call_keyday = 4")
    assert [r.ani for r in newest.collect()] == ["n39"]


def test_an_empty_read_moves_nothing(spark, tmp_path):
    base, seen = str(tmp_path), []
    store = OffsetStore(f"{base}/offsets")
    rows = run_load(
        calls(spark, 3).where("offset < 0"), ROUTE_CALL_DETAIL, ParquetStage(f"{base}/stage"),
        merges=[seen.append], offsets=store,
    )
    assert (rows, seen, store.read(spark).count()) == (0, [], 0)


def test_a_failed_load_is_logged_and_raised_and_moves_no_offsets(spark, tmp_path):
    base = str(tmp_path)
    store = OffsetStore(f"{base}/offsets")

    def fail(staged):
        raise RuntimeError("it's \"broken\"; drop table x")

    with pytest.raises(RuntimeError, match="broken"):
        run_load(
            calls(spark, 3), ROUTE_CALL_DETAIL, ParquetStage(f"{base}/stage"),
            merges=[fail], offsets=store, log=f"{base}/log",
        )
    row = spark.read.parquet(f"{base}/log").first()
    assert row.load_key.endswith("_RouteCallDetail") and row.load_key.split("_")[0].isdigit()
    assert (row.load_type, row.load_name, row.step, row.status) == (
        "Kafka", "RouteCallDetail", "ErrorProcess", "error",
    )
    assert "it's \"broken\"; drop table x" in row.message and "Traceback" in row.message
    assert abs(row.logged_at - dt.datetime.now()) < dt.timedelta(days=1)
    assert store.read(spark).count() == 0


def test_ingest_reads_from_the_stored_offsets(spark, tmp_path, monkeypatch):
    from weirstone.plans import load

    asked = []

    def fake_topic(spark, brokers, topic, start, **options):
        asked.append((brokers, topic, start, options))
        new = calls(spark, 30) if start == "earliest" else select_range(calls(spark, 33), start)
        return new

    monkeypatch.setattr(load, "kafka_batch", fake_topic)
    store, keep = OffsetStore(f"{tmp_path}/offsets"), ParquetStage(f"{tmp_path}/stage")

    def run(key):
        return ingest(
            spark, "routeCallDetail", "b:1", keep, offsets=store, partitions=4, min_partitions=9, key=key
        )

    assert [run("1_x"), run("2_x"), run("3_x")] == [30, 3, 0]
    topic = ROUTE_CALL_DETAIL.topic
    assert asked[0] == ("b:1", topic, "earliest", {"min_partitions": 9, "fail_on_data_loss": False})
    assert json.loads(asked[1][2]) == {topic: {"0": 10, "1": 10, "2": 10, "3": -2}}
    with pytest.raises(KeyError, match="callType"):
        ingest(spark, "no such feed", "b:1", keep)


def test_load_key():
    assert load_key("x", 1580752394.9) == "1580752394_x"


def test_shared_folder_follows_the_session(spark):
    a, b = shared_folder(spark, "p"), shared_folder(spark, "p")
    assert a != b and a.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_many_touched_partitions_still_prune_the_target(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(targets, "FILTER_PARTITIONS", 1)
    path = f"{tmp_path}/target"
    spark.range(20).selectExpr("id AS v", "cast(id AS int) AS g").write.partitionBy("g").parquet(path)
    stage = spark.createDataFrame([(1, 5), (2, 7), (3, 9)], "v long, g int")
    got = targets.touched_partitions(spark.read.parquet(path), stage, ["g"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "(g#" in plan[plan.index("PartitionFilters") :].split("]")[0] and ">= 5)" in plan
    assert sorted(r.g for r in got.collect()) == [5, 7, 9]
