"""Loads of a growing source: slices over batches, presence of positions, snapshots, gaps, bounded batches, their log."""

import random

import duckdb
import pytest
from compare import compare
from pyspark.sql import functions as F
from test_load import calls

from weirstone.catalog import ORACLE, queries
from weirstone.operators import drop_present, merge_words, presence_words, start_offsets_text
from weirstone.plans import (
    ROUTE_CALL_DETAIL,
    Insert,
    OffsetStore,
    PresenceStore,
    Refresh,
    Upsert,
    ingest,
    load_in_batches,
    run_load,
)
from weirstone.sinks import ParquetStage
from weirstone.sinks.stages import range_predicates
from weirstone.sources import file_stream
from weirstone.streaming import StreamLog, ingest_to_stage, refresh_closed

RUN_TS = "2024-02-01 00:00:00"
AT = "topic string, partition int, offset bigint"
STAGED = "slice string, item int, seen_at timestamp"


def positions(spark, rows):
    return spark.createDataFrame(rows, AT)


def staged_slices(spark, base, rows, name, parts):
    """Rows (slice, item, minute) staged as so many loads, in the order of their times."""
    stage = ParquetStage(f"{base}/{name}")
    for n in range(parts):
        own = rows[n * len(rows) // parts : (n + 1) * len(rows) // parts]
        frame = spark.createDataFrame([(s, i, m) for s, i, m in own], "slice string, item int, m int")
        frame = frame.select("slice", "item", F.timestamp_seconds(F.col("m") * 60).alias("seen_at"))
        stage.write(frame.coalesce(1), f"{n:03d}")
    return stage


def refreshed(spark, base, stage, name, files=None):
    table = Refresh(f"{base}/table-{name}", ("slice",))
    schema = spark.createDataFrame([], STAGED).schema
    refresh_closed(
        spark, stage, schema, table, f"{base}/mark-{name}", time="seen_at", gap="10 minutes", delay="1 minute", max_files_per_trigger=files
    ).awaitTermination()
    return table


def items(spark, table):
    return sorted(((r.slice, r.item) for r in spark.read.schema(STAGED).parquet(table.path).collect()), key=str)


def test_a_slice_over_many_batches_is_whole(spark, tmp_path):
    """The table is the same whether a slice comes in one file or in ten, read one at a time or together."""
    rows = [("a", i, i) for i in range(10)] + [("other", 99, 60)]
    for parts, files in ((1, None), (11, 1), (11, None), (4, 2)):
        stage = staged_slices(spark, tmp_path, rows, f"s{parts}{files}", parts)
        table = refreshed(spark, tmp_path, stage, f"{parts}{files}", files)
        assert items(spark, table) == [("a", i) for i in range(10)]  # the other one is still open


def test_a_new_run_replaces_its_slice_and_a_late_message_waits(spark, tmp_path):
    rows = [("a", 1, 0), ("a", 2, 5), ("b", 3, 5), (None, 4, 6), ("a", 5, 40), ("b", 6, 41), ("z", 0, 90)]
    stage = staged_slices(spark, tmp_path, rows, "s", 7)
    table = refreshed(spark, tmp_path, stage, "t", 1)
    assert items(spark, table) == sorted([("a", 5), ("b", 6), (None, 4)], key=str)
    late = spark.createDataFrame([("a", 7, 42)], "slice string, item int, m int")
    stage.write(late.select("slice", "item", F.timestamp_seconds(F.col("m") * 60).alias("seen_at")), "100")
    refreshed(spark, tmp_path, stage, "t", 1)
    assert items(spark, table) == sorted([("a", 5), ("b", 6), (None, 4)], key=str)
    assert stage.read_all(spark, spark.createDataFrame([], STAGED).schema).count() == 8


def test_a_load_staged_anew_closes_its_slices_all_the_same(spark, tmp_path):
    stage = staged_slices(spark, tmp_path, [("a", 1, 0), ("z", 0, 60)], "s", 2)
    table = refreshed(spark, tmp_path, stage, "t", 1)
    for _ in range(2):
        again = spark.createDataFrame([("z", 0, 60), ("y", 8, 61)], "slice string, item int, m int")
        stage.write(again.select("slice", "item", F.timestamp_seconds(F.col("m") * 60).alias("seen_at")), "001")
    stage.write(spark.createDataFrame([("x", 9)], "slice string, item int").withColumn("seen_at", F.timestamp_seconds(F.lit(9000))), "002")
    refreshed(spark, tmp_path, stage, "t", 1)
    assert items(spark, table) == [("a", 1), ("y", 8), ("z", 0)]


def test_many_slices_share_folders(spark, tmp_path):
    """Each refresh replaces its own slices; those that share a folder with them stay."""
    pick, table, want = random.Random(5), Refresh(str(tmp_path / "t"), ("g", "h"), 4), {}
    for n in range(4):
        rows = [(pick.choice([None, *range(30)]), pick.choice(["x", None]), 100 * n + i) for i in range(25)]
        own = {r[:2]: sorted(v for *s, v in rows if tuple(s) == r[:2]) for r in rows}
        want |= own
        for _ in range(2):
            table.apply(spark.createDataFrame(rows, "g int, h string, v int"))
            got = spark.read.parquet(table.path)
            assert sorted(((r.g, r.h), r.v) for r in got.where("g IS NOT NULL AND h IS NOT NULL").collect()) == sorted(
                (s, v) for s, vs in want.items() for v in vs if None not in s
            )
            assert got.count() == sum(map(len, want.values()))
    assert len(list((tmp_path / "t").glob("__bucket_of_4=*"))) <= 4 < len(want)
    with pytest.raises(ValueError, match="differ in columns"):
        Refresh(table.path, table.slices, 8).apply(spark.createDataFrame(rows, "g int, h string, v int"))


def test_batches_refuse_to_refresh(spark, tmp_path):
    landed = str(tmp_path / "landed")
    calls(spark, 4).write.parquet(landed)
    stream, stage = file_stream(spark, landed, calls(spark, 1).schema), ParquetStage(str(tmp_path / "s"))
    merges = [Refresh(str(tmp_path / "t"), ("call_type_id",))]
    for start in (ingest_to_stage, load_in_batches):
        with pytest.raises(ValueError, match="part of a slice"):
            start(stream, ROUTE_CALL_DETAIL, stage, str(tmp_path / "mark"), merges=merges)


@pytest.mark.parametrize("options", [{}, {"broadcast": False}])
def test_presence_against_a_set(spark, options):
    pick = random.Random(4)

    def some(n):
        return [(pick.choice("ab"), pick.randrange(3), pick.choice([pick.randrange(-70, 300), 2**24 * 5 + pick.randrange(200), 2**62])) for _ in range(n)]

    old, new = some(300), some(400)
    odd = [("a", 1, None), ("a", None, 5), (None, 1, 5), ("a", None, 5)]
    words = merge_words(presence_words(positions(spark, old + odd)).unionByName(presence_words(positions(spark, old[:9]))))
    assert words.count() == len({(t, p, o >> 6) for t, p, o in old})
    kept = [tuple(r) for r in drop_present(positions(spark, new + odd).repartition(3), words, **options).collect()]
    assert sorted(kept, key=str) == sorted((set(new) - set(old)) | set(odd), key=str)


def test_copies_of_any_age_are_dropped(spark, tmp_path):
    base = str(tmp_path)
    store = PresenceStore(f"{base}/seen")
    rows = Insert(f"{base}/calls", ("kafka_partition", "kafka_offset"))

    def load(messages, key):
        stage = ParquetStage(f"{base}/stage")
        return run_load(messages, ROUTE_CALL_DETAIL, stage, merges=[rows], history=store, key=key, run_ts=RUN_TS)

    first, second = calls(spark, 20), calls(spark, 10, first=20)
    assert load(first.unionByName(first), "one") == 20
    assert load(second.unionByName(first), "two") == 10
    assert load(first.unionByName(second), "three") == 0
    assert load(first, "one") == 0 and spark.read.parquet(rows.path).count() == 30
    assert store.read(spark).select(F.sum(F.bit_count("bits"))).first()[0] == 30


def test_a_load_that_fails_has_seen_nothing(spark, tmp_path):
    base, failures = str(tmp_path), [RuntimeError("executor lost")]
    store = PresenceStore(f"{base}/seen")

    def flaky(staged):
        if failures:
            raise failures.pop()

    def load():
        return run_load(calls(spark, 8), ROUTE_CALL_DETAIL, ParquetStage(f"{base}/s"), merges=[flaky], history=store, key="k", run_ts=RUN_TS)

    with pytest.raises(RuntimeError):
        load()
    assert load() == 8 and load() == 0


def test_only_touched_blocks_are_rewritten(spark, tmp_path):
    store = PresenceStore(str(tmp_path / "seen"))
    store.record(positions(spark, [("t", 0, 1), ("t", 1, 1), ("t", 0, 2**24)]))
    before = {f: f.stat().st_mtime_ns for f in (tmp_path / "seen").rglob("*.parquet")}
    for _ in range(2):
        store.record(positions(spark, [("t", 0, 2**24 + 3), ("t", 2, 9)]))
    kept = {str(f.parent.relative_to(tmp_path / "seen")) for f in before if f.exists()}
    assert kept == {"topic=t/partition=0/block=0", "topic=t/partition=1/block=0"}
    assert store.read(spark).select(F.sum(F.bit_count("bits"))).first()[0] == 5


def test_offsets_are_one_file_that_never_goes_back(spark, tmp_path):
    store = OffsetStore(str(tmp_path / "o"), keep=3)
    assert store.read(spark).count() == 0
    for n in range(8):
        store.advance(positions(spark, [("t", n % 3, n)]), f"load {n}")
    store.advance(positions(spark, [("t", 1, 2), ("u", 0, 0)]), "older")
    rows = store.read(spark)
    assert sorted(tuple(r) for r in rows.collect()) == [
        ("t", 0, 6, "load 6"), ("t", 1, 7, "load 7"), ("t", 2, 5, "load 5"), ("u", 0, 0, "older"),
    ]
    assert len(rows.inputFiles()) == 1
    assert len([f for f in (tmp_path / "o").iterdir() if f.name.startswith("snapshot=")]) == 3


def test_a_snapshot_that_broke_off_does_not_count(spark, tmp_path):
    store = OffsetStore(str(tmp_path / "o"))
    store.advance(positions(spark, [("t", 0, 5)]), "one")
    (tmp_path / "o" / "snapshot=000000000002").mkdir()
    assert store.read(spark).first()["offset"] == 5
    store.advance(positions(spark, [("t", 0, 9)]), "two")
    assert store.read(spark).first()["offset"] == 9


def test_a_silent_partition_is_named_by_the_next_start(spark, tmp_path):
    store = OffsetStore(str(tmp_path / "o"))
    starts = {"routeCallDetail": {0: -2, 1: 0, 2: -2, 7: 40, 8: -1}}
    run_load(calls(spark, 6), ROUTE_CALL_DETAIL, ParquetStage(str(tmp_path / "s")), offsets=store, starts=starts, run_ts=RUN_TS)
    known = {r.partition: r.offset for r in store.read(spark).collect()}
    loaded = {r.partition: r.next for r in calls(spark, 6).groupBy("partition").agg((F.max("offset") + 1).alias("next")).collect()}
    assert known == {0: -2, 2: -2, 7: 40, 1: 0} | loaded
    text = start_offsets_text(store.read(spark), "routeCallDetail")
    assert all(f'"{p}":{o}' in text for p, o in known.items())


def test_the_ledger_names_what_expired(spark, tmp_path):
    base = str(tmp_path)
    topic = calls(spark, 1).first()["topic"]
    placed = calls(spark, 30).withColumn("partition", F.lit(0)).withColumn("offset", F.col("offset") * 0 + F.expr("row_number() over (order by key) - 1"))

    def load(rows):
        run_load(
            rows, ROUTE_CALL_DETAIL, ParquetStage(f"{base}/s"), offsets=OffsetStore(f"{base}/o"), ledger=f"{base}/lost", run_ts=RUN_TS
        )
        return sorted(tuple(r)[1:] for r in spark.read.parquet(f"{base}/lost").collect())

    assert load(placed.where("offset < 10")) == []
    assert load(placed.where("offset >= 10 AND offset < 15")) == []
    assert load(placed.where("offset >= 18 AND offset < 25 AND offset <> 20")) == [(topic, 0, 15, 18, 25, 3, 1)]
    load(placed.where("offset >= 10 AND offset < 12"))  # an older load again: nothing was lost before it
    assert spark.read.parquet(f"{base}/lost").count() == 1


def test_a_bounded_load_reads_each_message_once(spark, tmp_path):
    base, landed = str(tmp_path), str(tmp_path / "landed")
    for n in range(4):
        calls(spark, 5 + n, first=10 * n).coalesce(1).write.mode("append").parquet(landed)
    failures, batches = [RuntimeError("executor lost")], []
    latest = Upsert(f"{base}/latest", ("call_type_id", "router_call_keyday"), ("kafka_offset",), ("call_type_id",))

    def flaky(staged):
        batches.append(staged.count())
        if len(batches) == 3 and failures:
            raise failures.pop()

    def load():
        stream = file_stream(spark, landed, calls(spark, 1).schema, max_files_per_trigger=1)
        return load_in_batches(
            stream, ROUTE_CALL_DETAIL, ParquetStage(f"{base}/s"), f"{base}/mark", merges=[latest, flaky], offsets=OffsetStore(f"{base}/o"), run_ts=RUN_TS
        )

    with StreamLog(spark, f"{base}/log", "calls") as log:
        with pytest.raises(Exception, match="executor lost"):
            load()
    rows = sorted(((r.batch, r.rows, r.status) for r in spark.read.parquet(log.path).collect()))
    assert rows[:2] == [(0, 5, "done"), (1, 6, "done")] and rows[2][0] == 2 and rows[2][2] == "error"  # input rows: read once
    assert load() == 7 + 8
    assert batches == [5, 6, 7, 7, 8]
    staged, table = spark.read.parquet(f"{base}/s"), spark.read.parquet(latest.path)
    assert staged.count() == 26 and table.count() == staged.select(*latest.keys).distinct().count()
    assert load() == 0


def test_a_limited_ingest_needs_a_checkpoint(spark, tmp_path):
    with pytest.raises(ValueError, match="checkpoint"):
        ingest(spark, "routeCallDetail", "nowhere:1", ParquetStage(str(tmp_path)), limit=10)


def test_the_log_counts_what_was_written(spark, tmp_path):
    base, landed = str(tmp_path), str(tmp_path / "landed")
    calls(spark, 12).repartition(3).write.parquet(landed)

    def run(mark):
        stream = file_stream(spark, landed, calls(spark, 1).schema, max_files_per_trigger=1)
        return ingest_to_stage(stream, ROUTE_CALL_DETAIL, ParquetStage(f"{base}/s-{mark}"), f"{base}/{mark}", run_ts=RUN_TS)

    run("before").awaitTermination()
    with StreamLog(spark, f"{base}/log", "calls", every=2) as log:
        run("inside").awaitTermination()
    run("after").awaitTermination()
    rows = spark.read.parquet(log.path).collect()
    assert len(rows) == 3 and sum(r.rows for r in rows) == 12 and len({r.query for r in rows}) == 1
    assert {r.status for r in rows} == {"done"} and all("FileStreamSource" in r.ends for r in rows)


@pytest.mark.parametrize("tasks", [1, 3, 16])
def test_predicates_have_each_offset_once(tasks):
    ranges = [("t", 0, 5, 2_000), ("t", 1, 7, 8), ("it's", 0, 0, 40), ("t", 2, 9, 9)]
    given = range_predicates(ranges, ("topic", "part", "at"), tasks)
    assert len(given) <= tasks
    python = [g.replace("CAST(topic AS VARCHAR(249))", "topic").replace("'it''s'", '"it\'s"').replace(" = ", " == ").replace("AND", "and").replace("OR", "or") for g in given]
    for topic, part, at in [("t", 0, 5), ("t", 0, 1999), ("t", 1, 7), ("it's", 0, 39)] + [("t", 0, n) for n in range(5, 2000, 37)]:
        assert sum(eval(p, {"topic": topic, "part": part, "at": at}) for p in python) == 1
    for topic, part, at in [("t", 0, 4), ("t", 0, 2000), ("t", 1, 8), ("t", 2, 9), ("u", 0, 5)]:
        assert not any(eval(p, {"topic": topic, "part": part, "at": at}) for p in python)
    assert range_predicates([], ("a", "b", "c"), 4) == ["1 = 0"]


def event_table(spark, folder, rows):
    """Events (id, user, day of January 2024, minute of it)."""
    frame = spark.createDataFrame(rows, "event_id bigint, user_id bigint, day int, minute int")
    ts = F.expr("make_timestamp_ntz(2024, 1, day, 0, 0, 0) + make_interval(0, 0, 0, 0, 0, minute)")
    kept = ["event_id", ts.alias("ts"), "user_id", F.lit("view").alias("event_type"), F.lit(1.5).alias("value"), F.lit("{}").alias("props")]
    frame.select(*kept).write.parquet(f"{folder}/events.parquet")


# The second part has one message, the third has none, the last has most.
UNEVEN = [(i, i % 5, 1 + i % 7, i) for i in range(1, 30)] + [(30, 1, 8, 0)] + [(i, i % 5, 23 + i % 8, i) for i in range(31, 97)]


@pytest.mark.parametrize("name", ["limited_load", "stream_refresh", "stream_log"])
def test_a_part_in_several_files_is_one_batch(spark, tmp_path, monkeypatch, name):
    landed, stream = [], queries.file_stream

    def seen(spark, path, schema, max_files_per_trigger):
        landed.append((max_files_per_trigger, [f.rsplit("/", 1)[1] for f in spark.read.parquet(path).inputFiles()]))
        return stream(spark, path, schema, max_files_per_trigger)

    monkeypatch.setattr(queries, "FILE_MESSAGES", 4)
    monkeypatch.setattr(queries, "file_stream", seen)
    rows = [*UNEVEN, (97, 1, 17, 0)] if name == "stream_log" else UNEVEN  # SQL has no row for the error of an empty batch
    event_table(spark, str(tmp_path), rows)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{tmp_path}/events.parquet/*.parquet')")
    assert compare(spark, con, queries.QUERIES[name], ORACLE[name], str(tmp_path)) == []
    (files, names), per_part = landed[0], -(-len(rows) // (4 * 4))
    assert files == per_part > 5 and len(names) == 4 * per_part
