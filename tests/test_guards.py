"""Rows and columns that must survive: ranges with nulls, empty reads, foreign columns, replays."""

import pytest
from pyspark.sql import functions as F

from weirstone.operators import offsets as o
from weirstone.plans import Insert, Refresh, Upsert, run_load
from weirstone.plans.feeds import BUSINESS_LOCKS

ENVELOPE = "topic string, partition int, offset bigint"
ROWS = [("t", 0, 5), ("t", 0, 50), ("t", 0, None), ("t", None, 5), (None, 0, 5), ("t", 900, 1), ("u", 0, 1), (None, None, None)]


@pytest.mark.parametrize("unlisted", ["all", "none"])
@pytest.mark.parametrize("ends", [None, {"t": {p: 60 for p in range(70)}}])
def test_range_of_nulls_is_the_same_as_filter_and_join(spark, monkeypatch, unlisted, ends):
    envelope = spark.createDataFrame(ROWS, ENVELOPE)
    starts = {"t": {p: 10 for p in range(70)}}
    found = []
    for limit in (1_000, 0):
        monkeypatch.setattr(o, "FILTER_PARTITIONS", limit)
        found.append(sorted(map(repr, o.select_range(envelope, starts, ends, unlisted=unlisted).collect())))
    assert found[0] == found[1]
    assert len(found[0]) == (1 if unlisted == "none" else 6)


def test_many_partitions_reach_the_scan(spark, tmp_path):
    spark.createDataFrame(ROWS, ENVELOPE).write.parquet(str(tmp_path / "e"))
    envelope = spark.read.parquet(str(tmp_path / "e"))
    got = o.select_range(envelope, {"t": {p: 10 for p in range(80)}})
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")
    plan = got._jdf.queryExecution().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = next(line for line in plan.splitlines() if "PushedFilters" in line)
    assert "GreaterThanOrEqual(offset,10)" in pushed


class _Stage:
    """A stage that is emptied before each load."""

    truncate = True

    def __init__(self):
        self.writes = 0

    def write(self, df, key):
        self.writes += 1


def test_an_empty_read_leaves_the_stage_alone(spark):
    schema = "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp, timestampType int"
    stage = _Stage()
    assert run_load(spark.createDataFrame([], schema), BUSINESS_LOCKS, stage) == 0
    assert stage.writes == 0


def test_loads_in_one_second_have_keys_of_their_own(spark, monkeypatch, tmp_path):
    schema = "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp, timestampType int"
    keys = []

    class Keep(_Stage):
        truncate = False

        def write(self, df, key):
            keys.append(key)
            df.write.format("noop").mode("overwrite").save()

    monkeypatch.setattr("weirstone.plans.load.load_key", lambda name: f"1_{name}")
    for _ in range(2):
        run_load(spark.createDataFrame([], schema), BUSINESS_LOCKS, Keep())
    assert len(set(keys)) == 2 and all(k.startswith("1_") for k in keys)


@pytest.mark.parametrize(
    "merge", [lambda p: Upsert(p, ("g", "k"), ("v",), ("g",)), lambda p: Insert(p, ("g", "k"), ("g",)), lambda p: Refresh(p, ("g",))]
)
def test_a_column_of_the_target_alone_is_not_lost(spark, tmp_path, merge):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, 1, 1, 7)], "g int, k int, v int, extra int").write.partitionBy("g").parquet(path)
    with pytest.raises(ValueError, match="extra"):
        merge(path).apply(spark.createDataFrame([(1, 2, 3)], "g int, k int, v int"))


def test_replay_of_an_older_load_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert = Upsert(path, ("g", "k"), ("v",), ("g",))
    loads = [spark.createDataFrame([(1, 1, v), (1, None, v), (1, 10 + v, v)], "g int, k int, v int") for v in (1, 2)]
    for load in (loads[0], loads[1], loads[0]):
        upsert.apply(load)
    got = {(r.k, r.v) for r in spark.read.parquet(path).select("k", F.col("v").cast("int")).collect()}
    assert got == {(1, 2), (None, 2), (11, 1), (12, 2)}


def test_what_an_application_wrote_can_be_removed(spark, tmp_path, monkeypatch):
    from weirstone import session

    assert f"/{spark.sparkContext.applicationId}/" in session.shared_folder(spark, "x")
    # This session's own folder is in use by other tests.
    monkeypatch.setattr(session, "shared_folder", lambda _, purpose: f"{tmp_path}/weirstone/this/{purpose}")
    (tmp_path / "weirstone" / "another").mkdir(parents=True)
    assert session.written(spark.range(3), "numbers").count() == 3
    session.remove_shared(spark)
    assert [f.name for f in (tmp_path / "weirstone").iterdir()] == ["another"]
