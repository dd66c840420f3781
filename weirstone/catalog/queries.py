"""Every operator as a query over the given tables: ``(spark, folder) -> DataFrame``."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import operators as op
from ..functions import add_as_text, add_ints, recode, slice_text, to_double, to_int, to_timestamp
from ..plans import (
    BUSINESS_LOCKS,
    CALL_TYPE,
    ROUTE_CALL_DETAIL,
    BucketedTable,
    OffsetStore,
    PresenceStore,
    Refresh,
    Upsert,
    buckets_for,
    flatten,
    load_in_batches,
    parse_feed,
    preview_locks,
    run_load,
)
from ..plans.feeds import INTENT_FIXES, INTERVAL_TYPE, STATE_SLICE
from ..session import shared_folder
from ..sinks import JdbcStage, ParquetStage, append, truncate_load, write
from ..sources import JdbcConnection, key_value, scan, scan_quantiles, scan_split, table, text_envelope
from ..sources.tables import file_count, file_stream
from ..streaming import StreamLog, dedup_stream, ingest_to_files, ingest_to_stage, refresh_closed
from . import inputs
from .inputs import NTZ, RUN_TS

POSITION = ["topic", "partition", "offset"]

# The bound of a batch, and the starts of a range read.
BATCH_LIMIT = 100
RANGE_STARTS = '{"events":{"0":1000,"1":3000,"2":0}}'

# Loads whose offsets are stored.
SNAPSHOT_LOADS = 50

# Ranges over two topics of 100 partitions each; some partitions are not listed.
MANY_STARTS = {
    "many_a": {p: p % 5 for p in range(100) if p % 7 != 3},
    "many_b": {p: 20 + p % 11 for p in range(90)},
}
MANY_ENDS = {"many_a": {p: 30 + p % 9 for p in range(0, 100, 3) if p % 7 != 3}}

# Buckets of a small table.
LEAST_BUCKETS = 8

# Messages in a landed file, on average.
FILE_MESSAGES = 50_000

# Folders of a table whose slices are too many for one each.
SLICE_BUCKETS = 32

LATEST_CALL_KEYS = ("call_type_id", "router_call_keyday")
LATEST_CALL_ORDER = ("kafka_record_timestamp", "kafka_partition", "kafka_offset")


def flatten_business_locks(spark: SparkSession, folder: str) -> DataFrame:
    return flatten(inputs.locks(spark, folder), BUSINESS_LOCKS, RUN_TS, NTZ)


def flatten_call_type(spark: SparkSession, folder: str) -> DataFrame:
    return flatten(inputs.call_types(spark, folder), CALL_TYPE, RUN_TS, NTZ)


def flatten_route_call_detail(spark: SparkSession, folder: str) -> DataFrame:
    return flatten(inputs.route_calls(spark, folder), ROUTE_CALL_DETAIL, RUN_TS, NTZ)


def envelope_cast(spark: SparkSession, folder: str) -> DataFrame:
    return text_envelope(inputs.route_calls(spark, folder))


def envelope_key_value(spark: SparkSession, folder: str) -> DataFrame:
    return key_value(inputs.event_positions(spark, folder))


def parse_explicit_schema(spark: SparkSession, folder: str) -> DataFrame:
    return parse_feed(inputs.locks(spark, folder), BUSINESS_LOCKS, full=True).select(
        "businessLock.*", *POSITION
    )


def parse_reflected_schema(spark: SparkSession, folder: str) -> DataFrame:
    return parse_feed(inputs.route_calls(spark, folder), ROUTE_CALL_DETAIL, full=True).select(
        "rcd.*", *POSITION
    )


def parse_reflected_call_type(spark: SparkSession, folder: str) -> DataFrame:
    return parse_feed(inputs.call_types(spark, folder), CALL_TYPE, full=True).select("cti.*", *POSITION)


def json_dates(spark: SparkSession, folder: str) -> DataFrame:
    return parse_feed(inputs.locks(spark, folder), BUSINESS_LOCKS, full=True).select(
        F.col("businessLock.ValidFrom").alias("valid_from"),
        F.col("businessLock.ValidTo").alias("valid_to"),
        F.col("businessLock.ChangedOn").alias("changed_on"),
        *POSITION,
    )


def _calls(spark: SparkSession, folder: str) -> DataFrame:
    return parse_feed(inputs.route_calls(spark, folder), ROUTE_CALL_DETAIL)


def nested_case_insensitive(spark: SparkSession, folder: str) -> DataFrame:
    return _calls(spark, folder).select(
        F.col("rcd.recoverykey").alias("recovery_key"),
        F.col("rcd.ANI").alias("ani"),
        F.col("rcd.dialednumberstring").alias("dialed_number_string"),
        *POSITION,
    )


def nested_subset(spark: SparkSession, folder: str) -> DataFrame:
    return preview_locks(inputs.locks(spark, folder))


def cast_int(spark: SparkSession, folder: str) -> DataFrame:
    return _calls(spark, folder).select(
        to_int("rcd.RouterCallKey").alias("router_call_key"),
        to_int("rcd.CallTypeID").alias("call_type_id"),
        to_int("rcd.RouterCallKeySequenceNumber").alias("sequence_number"),
        to_int("rcd.CED").alias("not_a_number"),
        *POSITION,
    )


def cast_double(spark: SparkSession, folder: str) -> DataFrame:
    return _calls(spark, folder).select(
        to_double("rcd.RecoveryKey").alias("recovery_key"),
        to_double("rcd.RouterCallKeySequenceNumber").alias("sequence_number"),
        *POSITION,
    )


def cast_timestamp(spark: SparkSession, folder: str) -> DataFrame:
    return _calls(spark, folder).select(
        to_timestamp("rcd.DateTime", NTZ).alias("date_time"),
        to_timestamp("rcd.DbDateTime", NTZ).alias("db_date_time"),
        *POSITION,
    )


def int_sum(spark: SparkSession, folder: str) -> DataFrame:
    return parse_feed(inputs.call_types(spark, folder), CALL_TYPE).select(
        add_ints(to_int("cti.CallsHandled"), to_int("cti.TotalCallsAband")).alias("outflow_to_queue"),
        *POSITION,
    )


def substring_state(spark: SparkSession, folder: str) -> DataFrame:
    return _calls(spark, folder).select(
        slice_text("rcd.Variable8", *STATE_SLICE).alias("state"), *POSITION
    )


def case_intent(spark: SparkSession, folder: str) -> DataFrame:
    return _calls(spark, folder).select(
        recode("rcd.Variable9", INTENT_FIXES).alias("call_intent"), *POSITION
    )


def literal_tag(spark: SparkSession, folder: str) -> DataFrame:
    return inputs.event_positions(spark, folder).select(
        F.lit(INTERVAL_TYPE).alias("interval_type"), *POSITION
    )


def sum_columns(spark: SparkSession, folder: str) -> DataFrame:
    items = table(spark, folder, "lineitem")
    total = op.sum_columns(items, ["l_quantity", "l_extendedprice", "l_tax"])
    return items.select("l_orderkey", "l_linenumber", total.alias("total"))


def sql_view(spark: SparkSession, folder: str) -> DataFrame:
    return spark.sql(
        "SELECT calls.rcd.ani AS ani, substring(calls.rcd.variable8, 5, 2) AS state,"
        " topic, partition, offset FROM {calls} AS calls",
        calls=_calls(spark, folder),
    )


def source_count(spark: SparkSession, folder: str) -> DataFrame:
    return op.row_count(flatten_route_call_detail(spark, folder))


def offset_range(spark: SparkSession, folder: str) -> DataFrame:
    return key_position(op.select_range(inputs.event_positions(spark, folder), RANGE_STARTS))


def offset_range_many(spark: SparkSession, folder: str) -> DataFrame:
    messages = inputs.event_positions_many(spark, folder)
    return key_position(op.select_range(messages, MANY_STARTS, MANY_ENDS))


def key_position(envelope: DataFrame) -> DataFrame:
    return envelope.select(F.col("key").cast("string").alias("key"), *POSITION)


def bounded_batch(spark: SparkSession, folder: str) -> DataFrame:
    return key_position(op.bound_batch(inputs.event_positions(spark, folder), BATCH_LIMIT))


def offset_gaps(spark: SparkSession, folder: str) -> DataFrame:
    return op.offset_gaps(inputs.item_positions(spark, folder))


def offset_gaps_from_start(spark: SparkSession, folder: str) -> DataFrame:
    """Gaps of a read that was to start two offsets before the first order of each partition."""
    starts = (
        table(spark, folder, "orders")
        .groupBy((F.col("o_orderkey") % 3).cast("int").alias("partition"))
        .agg((F.min(F.expr("o_orderkey div 3")) - 2).alias("offset"))
        .select(F.lit("lineitem").alias("topic"), "partition", "offset")
    )
    return op.offset_gaps(inputs.item_positions(spark, folder), starts)


def next_offsets(spark: SparkSession, folder: str) -> DataFrame:
    """Orders are stored from before, events are new."""
    store = op.next_offsets(inputs.order_positions(spark, folder))
    return op.next_offsets(inputs.event_positions(spark, folder), store)


def offsets_json(spark: SparkSession, folder: str) -> DataFrame:
    return op.encode_offsets(next_offsets(spark, folder))


def offsets_rows(spark: SparkSession, folder: str) -> DataFrame:
    return op.decode_offsets(offsets_json(spark, folder))


def start_offsets(spark: SparkSession, folder: str) -> DataFrame:
    return op.start_offsets(next_offsets(spark, folder), "events")


def preview(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("event_id", "ts", "user_id", "event_type")
    return op.preview(events, 20, [F.col("ts").desc(), "event_id"])


def dedup_latest(spark: SparkSession, folder: str) -> DataFrame:
    return op.latest_per_key(
        table(spark, folder, "events"), ["value", "event_id"], ["user_id"], "score", ["event_id"]
    )


def dedup_latest_agg(spark: SparkSession, folder: str) -> DataFrame:
    return op.latest_per_key_agg(
        table(spark, folder, "events"), ["value", "event_id"], ["user_id"], "score", ["event_id"]
    )


def dedup_envelope(spark: SparkSession, folder: str) -> DataFrame:
    """Every message delivered twice."""
    once = inputs.event_positions(spark, folder)
    return key_position(op.dedup_envelope(once.unionByName(once)))


def dedup_rare_copies(spark: SparkSession, folder: str) -> DataFrame:
    return key_position(op.dedup_rare_copies(inputs.item_positions(spark, folder)))


def merge_upsert(spark: SparkSession, folder: str) -> DataFrame:
    return op.merge_upsert(
        inputs.order_states(spark, folder),
        inputs.item_states(spark, folder),
        ["order_key"],
        [F.col(c).desc() for c in ("changed_at", "line", "amount", "status")],
    )


def merge_upsert_bucketed(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as a table in buckets of their key, upserted by line items."""
    orders, items = inputs.order_states(spark, folder), inputs.item_states(spark, folder)
    buckets = buckets_for(orders.count() + items.count(), LEAST_BUCKETS)
    target = BucketedTable(f"{shared_folder(spark, 'bucketed')}/orders", ("order_key",), buckets)
    target.create(orders)
    target.upsert(items, ("changed_at", "line", "amount", "status"))
    return target.read(spark)


def merge_refresh(spark: SparkSession, folder: str) -> DataFrame:
    return op.merge_refresh(
        inputs.customer_slices(spark, folder), inputs.user_slices(spark, folder), ["slice"]
    )


def merge_insert(spark: SparkSession, folder: str) -> DataFrame:
    return op.merge_insert(
        inputs.item_states(spark, folder), inputs.order_states(spark, folder), ["order_key"]
    )


def malformed_split(spark: SparkSession, folder: str) -> DataFrame:
    return op.mark_malformed(
        inputs.route_calls(spark, folder), ROUTE_CALL_DETAIL.parse_schema
    ).select(*POSITION, "malformed", "raw_value", F.col("payload.ANI").alias("ani"))


def map_add_string(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", add_as_text("l_orderkey", 1).alias("next_key")
    )


def load_merge(spark: SparkSession, folder: str) -> DataFrame:
    """A whole load: stage, upsert into a partitioned table, read the table."""
    base = shared_folder(spark, "load")
    latest = Upsert(f"{base}/latest", LATEST_CALL_KEYS, LATEST_CALL_ORDER, ("call_type_id",))
    run_load(
        inputs.route_calls(spark, folder),
        ROUTE_CALL_DETAIL,
        ParquetStage(f"{base}/stage"),
        merges=[latest],
        run_ts=RUN_TS,
        timestamp_type=NTZ,
    )
    return _latest_calls(spark, latest.path)


def _latest_calls(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select(
        "call_type_id", "router_call_keyday", "router_call_key", "date_time", "kafka_offset"
    )


def load_offsets(spark: SparkSession, folder: str) -> DataFrame:
    """A whole load that moves the stored offsets on."""
    base = shared_folder(spark, "load")
    store = OffsetStore(f"{base}/offsets")
    run_load(
        inputs.locks(spark, folder),
        BUSINESS_LOCKS,
        ParquetStage(f"{base}/stage"),
        offsets=store,
        run_ts=RUN_TS,
        timestamp_type=NTZ,
    )
    return store.read(spark).select(*POSITION)


def load_offsets_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """Fifty loads' offsets moved on one after the other, in the order of their positions; how many files a read opens."""
    store = OffsetStore(f"{shared_folder(spark, 'load')}/offsets")
    events = inputs.event_positions(spark, folder)
    for n in range(SNAPSHOT_LOADS):
        store.advance(op.next_offsets(events.where(F.col("offset") % SNAPSHOT_LOADS == n)), f"load {n}")
    rows = store.read(spark)
    return rows.select(*POSITION, F.lit(len(rows.inputFiles())).alias("files"))


def load_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """Two loads between which messages expired, and inside the second some are missing: the ledger."""
    base = shared_folder(spark, "load")
    calls, offset = inputs.call_types(spark, folder), F.col("offset")
    third = calls.agg(F.max("offset")).first()[0] // 3
    for rows in (offset < third, (offset >= third + 50) & (offset % 10 != 7)):
        run_load(
            calls.where(rows),
            CALL_TYPE,
            ParquetStage(f"{base}/stage"),
            offsets=OffsetStore(f"{base}/offsets"),
            ledger=f"{base}/ledger",
            run_ts=RUN_TS,
            timestamp_type=NTZ,
        )
    return spark.read.parquet(f"{base}/ledger").select(
        "topic", "partition", "start", "first", "next", "lost_before", "lost_inside"
    )


def dedup_against_history(spark: SparkSession, folder: str) -> DataFrame:
    """Three loads, each without the messages of the ones before; all that was kept."""
    base = shared_folder(spark, "load")
    history = PresenceStore(f"{base}/history")
    for n, load in enumerate(inputs.item_loads(spark, folder)):
        key_position(history.unseen(load)).write.parquet(f"{base}/kept/load={n}")
        history.record(spark.read.parquet(f"{base}/kept/load={n}"))
    return spark.read.parquet(f"{base}/kept").drop("load")


def load_log(spark: SparkSession, folder: str) -> DataFrame:
    """A load whose merge fails after the whole feed is staged; the log it leaves."""
    base = shared_folder(spark, "load")
    broken = Upsert(f"{base}/latest", ("call_type_id",), ("kafka_offset",), ("interval_type",))
    try:
        run_load(
            inputs.call_types(spark, folder),
            CALL_TYPE,
            ParquetStage(f"{base}/stage"),
            merges=[broken],
            log=f"{base}/log",
            run_ts=RUN_TS,
            timestamp_type=NTZ,
        )
    except ValueError:
        pass
    staged = op.row_count(spark.read.parquet(f"{base}/stage")).first()["rows"]
    return spark.read.parquet(f"{base}/log").select(
        F.regexp_replace("load_key", r"^\d+_", "").alias("key_name"),
        "load_type",
        "load_name",
        "step",
        "status",
        F.contains("message", F.lit("Traceback")).alias("has_trace"),
        F.lit(staged).cast("bigint").alias("staged_rows"),
    )


def _landed(spark: SparkSession, envelope: DataFrame) -> DataFrame:
    """The envelope written to files and read back as a stream."""
    path = shared_folder(spark, "landed")
    envelope.write.parquet(path)
    return file_stream(spark, path, envelope.schema)


def stream_ingest(spark: SparkSession, folder: str) -> DataFrame:
    out = shared_folder(spark, "stream")
    stream = _landed(spark, inputs.route_calls(spark, folder))
    ingest_to_files(
        stream,
        ROUTE_CALL_DETAIL,
        f"{out}/rows",
        f"{out}/checkpoint",
        run_ts=RUN_TS,
        timestamp_type=NTZ,
    ).awaitTermination()
    return spark.read.parquet(f"{out}/rows")


def _landed_parts(spark: SparkSession, folder: str) -> DataFrame:
    """The four parts of the route calls, equally many files each, as a stream that takes one part at a time.

    The number of files grows with the messages. A part too small for so many
    gets empty ones, as the stream counts files to tell where a part ends.
    """
    path = shared_folder(spark, "landed")
    parts, files = inputs.route_call_parts(spark, folder, FILE_MESSAGES)
    schema = parts[0].schema
    for n, part in enumerate(parts, 1):
        part.write.mode("append").parquet(path)
        for _ in range(n * files - file_count(spark, path, ".parquet")):
            spark.createDataFrame([], schema).coalesce(1).write.mode("append").parquet(path)
    return file_stream(spark, path, schema, max_files_per_trigger=files)


def limited_load(spark: SparkSession, folder: str) -> DataFrame:
    """A load bounded to a part at a time: the batch each message was staged in."""
    base = shared_folder(spark, "load")
    load_in_batches(
        _landed_parts(spark, folder),
        ROUTE_CALL_DETAIL,
        ParquetStage(f"{base}/stage"),
        f"{base}/checkpoint",
        offsets=OffsetStore(f"{base}/offsets"),
        run_ts=RUN_TS,
        timestamp_type=NTZ,
    )
    store = OffsetStore(f"{base}/offsets").read(spark).select(F.col("partition").alias("kafka_partition"), F.col("offset").alias("stored_offset"))
    staged = spark.read.parquet(f"{base}/stage").join(F.broadcast(store), "kafka_partition")
    batch = F.regexp_extract("load_key", r"_(\d+)$", 1).cast("int")
    return staged.select("recovery_key", "kafka_partition", "kafka_offset", batch.alias("batch"), "stored_offset")


def stream_log(spark: SparkSession, folder: str) -> DataFrame:
    """A streamed load whose third batch fails: the log of it."""
    base = shared_folder(spark, "stream")
    batches: list[int] = []

    def third_fails(staged: DataFrame) -> None:
        batches.append(len(batches))
        if len(batches) == 3:
            raise ValueError("the third batch fails")

    with StreamLog(spark, f"{base}/log", ROUTE_CALL_DETAIL.load_name) as log:
        query = ingest_to_stage(
            _landed_parts(spark, folder),
            ROUTE_CALL_DETAIL,
            ParquetStage(f"{base}/stage"),
            f"{base}/checkpoint",
            merges=[third_fails],
            run_ts=RUN_TS,
            timestamp_type=NTZ,
        )
        try:
            query.awaitTermination()
        except StreamingQueryException:
            pass
    return spark.read.parquet(log.path).select(
        "load_name", "batch", "rows", "status", F.contains("message", F.lit("the third batch fails")).alias("has_message")
    )


def stream_refresh(spark: SparkSession, folder: str) -> DataFrame:
    """Callers as slices, each a run of calls with less than twelve hours between them, over four batches."""
    base = shared_folder(spark, "stream")
    stage = ParquetStage(f"{base}/stage")
    calls = Refresh(f"{base}/calls", ("router_call_keyday",), SLICE_BUCKETS)
    schema = flatten_route_call_detail(spark, folder).schema

    def refresh(staged: DataFrame) -> None:
        """Takes the load just staged as one batch: its files are not in the order of their times."""
        refresh_closed(
            spark, stage, schema, calls, f"{base}/closed", time="kafka_record_timestamp", gap="12 hours", delay="1 hour"
        ).awaitTermination()

    ingest_to_stage(
        _landed_parts(spark, folder),
        ROUTE_CALL_DETAIL,
        stage,
        f"{base}/staged",
        merges=[refresh],
        run_ts=RUN_TS,
        timestamp_type=NTZ,
    ).awaitTermination()
    return spark.read.parquet(calls.path).select("router_call_keyday", "router_call_key", "date_time", "kafka_partition", "kafka_offset")


def stream_merge(spark: SparkSession, folder: str) -> DataFrame:
    out = shared_folder(spark, "stream")
    latest = Upsert(f"{out}/latest", LATEST_CALL_KEYS, LATEST_CALL_ORDER, ("call_type_id",))
    ingest_to_stage(
        _landed(spark, inputs.route_calls(spark, folder)),
        ROUTE_CALL_DETAIL,
        ParquetStage(f"{out}/stage"),
        f"{out}/checkpoint",
        merges=[latest],
        run_ts=RUN_TS,
        timestamp_type=NTZ,
    ).awaitTermination()
    return _latest_calls(spark, latest.path)


def stream_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every message delivered twice, on a stream; the delay spans all events."""
    out = shared_folder(spark, "stream")
    once = inputs.event_positions(spark, folder)
    deduped = dedup_stream(_landed(spark, once.unionByName(once)), "60 days")
    (
        key_position(deduped)
        .writeStream.format("parquet")
        .option("path", f"{out}/rows")
        .option("checkpointLocation", f"{out}/checkpoint")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return spark.read.parquet(f"{out}/rows")


def _database(spark: SparkSession) -> JdbcConnection:
    """The database of ``spark.weirstone.jdbc.url``, or one inside this process.

    The one inside the process has no server and no port, so only a session
    whose tasks all run in the driver process can use it.
    """
    url = spark.conf.get("spark.weirstone.jdbc.url", None)
    if url is not None:
        return JdbcConnection(url)
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("executors cannot reach this; set spark.weirstone.jdbc.url")
    return JdbcConnection(
        f"jdbc:derby:memory:t{uuid.uuid4().hex};create=true",
        driver="org.apache.derby.iapi.jdbc.AutoloadedDriver",
    )


def _table_name() -> str:
    return f"t{uuid.uuid4().hex}"


def jdbc_query_scan(spark: SparkSession, folder: str) -> DataFrame:
    """A grouped query, run in the database, read in four splits."""
    db, name = _database(spark), _table_name()
    append(table(spark, folder, "orders").select("o_orderkey", "o_custkey"), db, name)
    query = (
        f'(SELECT "o_custkey", COUNT(*) AS "orders", MAX("o_orderkey") AS "last_order"'
        f' FROM {name} GROUP BY "o_custkey") q'
    )
    return scan_split(spark, db, query, "o_custkey", 4)


def jdbc_quantile_scan(spark: SparkSession, folder: str) -> DataFrame:
    """A column whose values lie ever further apart, read in splits of about equally many rows."""
    db, name = _database(spark), _table_name()
    orders = table(spark, folder, "orders").select(F.col("o_orderkey").alias("id"))
    append(orders.withColumn("skewed", F.col("id") * F.col("id")), db, name)
    rows = scan_quantiles(spark, db, name, "skewed", 16)
    sizes = rows.groupBy(F.spark_partition_id()).count()
    largest, total, splits = sizes.agg(F.max("count"), F.sum("count"), F.count(F.lit(1))).first()
    return rows.withColumn("even", F.lit(splits > 8 and largest * splits <= 2 * total))


def jdbc_append_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Two appends, one of them after the other: both are there."""
    db, name = _database(spark), _table_name()
    rows = table(spark, folder, "events").select("event_id", "ts", "user_id", "value")
    append(rows, db, name)
    append(rows, db, name)
    return scan_split(spark, db, name, "event_id", 4, options={"preferTimestampNTZ": "true"})


def jdbc_write_modes(spark: SparkSession, folder: str) -> DataFrame:
    """Orders, kept by an ignored write, then replaced by the events' keys."""
    db, name = _database(spark), _table_name()
    orders = table(spark, folder, "orders").select(F.col("o_orderkey").alias("id"))
    events = table(spark, folder, "events").select(F.col("event_id").alias("id"))
    write(orders, db, name, mode="errorifexists")
    write(events, db, name, mode="ignore")
    kept = scan(spark, db, name).agg(F.count(F.lit(1)).alias("n")).first()["n"]
    write(events, db, name, mode="overwrite")
    return scan_split(spark, db, name, "id", 4).select("id", F.lit(kept).cast("bigint").alias("rows_after_ignore"))


def load_append_stage(spark: SparkSession, folder: str) -> DataFrame:
    """Three loads into a table that only grows: the rows each of them read back."""
    base, calls = shared_folder(spark, "load"), inputs.call_types(spark, folder)
    stage = JdbcStage(_database(spark), _table_name(), truncate=False, num_partitions=4)
    third = calls.agg(F.max("offset")).first()[0] // 3 + 1
    for n in range(3):

        def own(staged: DataFrame, n: int = n) -> None:
            rows = staged.select(F.lit(n).alias("load"), "kafka_partition", "kafka_offset", "recovery_key")
            rows.write.mode("append").parquet(f"{base}/seen")

        run_load(
            calls.where(F.floor(F.col("offset") / third) == n),
            CALL_TYPE,
            stage,
            merges=[own],
            run_ts=RUN_TS,
            timestamp_type=NTZ,
        )
    return spark.read.parquet(f"{base}/seen")


def stage_truncate_load(spark: SparkSession, folder: str) -> DataFrame:
    """The stage holds the second load only."""
    db, name = _database(spark), _table_name()
    columns = ("recovery_key", "kafka_topic", "kafka_offset")
    truncate_load(flatten_call_type(spark, folder).select(*columns), db, name)
    truncate_load(flatten_route_call_detail(spark, folder).select(*columns), db, name)
    return scan_split(spark, db, name, "kafka_offset", 4).drop("kafka_offset")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        flatten_business_locks,
        flatten_call_type,
        flatten_route_call_detail,
        envelope_cast,
        envelope_key_value,
        parse_explicit_schema,
        parse_reflected_schema,
        parse_reflected_call_type,
        json_dates,
        nested_case_insensitive,
        nested_subset,
        cast_int,
        cast_double,
        cast_timestamp,
        int_sum,
        substring_state,
        case_intent,
        literal_tag,
        sum_columns,
        sql_view,
        source_count,
        offset_range,
        offset_range_many,
        bounded_batch,
        offset_gaps,
        offset_gaps_from_start,
        next_offsets,
        offsets_json,
        offsets_rows,
        start_offsets,
        preview,
        dedup_latest,
        dedup_latest_agg,
        dedup_envelope,
        dedup_rare_copies,
        merge_upsert,
        merge_upsert_bucketed,
        merge_refresh,
        merge_insert,
        malformed_split,
        map_add_string,
        load_merge,
        load_offsets,
        load_offsets_snapshots,
        load_gaps,
        load_log,
        limited_load,
        dedup_against_history,
        stream_ingest,
        stream_merge,
        stream_dedup,
        stream_log,
        stream_refresh,
        jdbc_query_scan,
        jdbc_quantile_scan,
        jdbc_append_roundtrip,
        jdbc_write_modes,
        stage_truncate_load,
        load_append_stage,
    )
}
