from pyspark.sql import functions as F
from test_load import calls

from weirstone.plans import ROUTE_CALL_DETAIL, Upsert, flatten
from weirstone.sinks import ParquetStage
from weirstone.sources import file_stream
from weirstone.streaming import dedup_stream, ingest_to_files, ingest_to_stage

RUN_TS = "2024-02-01 00:00:00"


def test_a_stream_gives_the_rows_of_a_batch_and_each_once(spark, tmp_path):
    landed, out, mark = (str(tmp_path / n) for n in ("landed", "out", "mark"))
    first, second = calls(spark, 20), calls(spark, 10, first=20)

    def run():
        stream = file_stream(spark, landed, first.schema, max_files_per_trigger=1)
        query = ingest_to_files(stream, ROUTE_CALL_DETAIL, out, mark, run_ts=RUN_TS)
        query.awaitTermination()
        return spark.read.parquet(out)

    first.repartition(3).write.mode("append").parquet(landed)
    assert run().count() == 20
    assert run().count() == 20
    second.write.mode("append").parquet(landed)
    got = run()
    want = flatten(calls(spark, 30), ROUTE_CALL_DETAIL, RUN_TS)
    assert got.count() == 30 and got.exceptAll(want).count() == 0


def test_a_batch_that_runs_again_stages_and_merges_once(spark, tmp_path):
    landed, base = str(tmp_path / "landed"), str(tmp_path)
    keep = ParquetStage(f"{base}/stage")
    latest = Upsert(f"{base}/latest", ("call_type_id", "router_call_keyday"), ("kafka_offset",), ("call_type_id",))
    calls(spark, 20).coalesce(1).write.parquet(landed)
    failures = [RuntimeError("executor lost")]

    def flaky(staged):
        if failures:
            raise failures.pop()

    def run():
        query = ingest_to_stage(
            file_stream(spark, landed, calls(spark, 1).schema), ROUTE_CALL_DETAIL, keep,
            f"{base}/mark", merges=[latest, flaky], run_ts=RUN_TS,
        )
        query.awaitTermination()

    try:
        run()
        raised = False
    except Exception:
        raised = True
    assert raised and spark.read.parquet(keep.path).count() == 20
    run()
    assert spark.read.parquet(keep.path).count() == 20
    assert spark.read.parquet(latest.path).count() == 20


def test_copies_on_a_stream_are_dropped(spark, tmp_path):
    landed, out, mark = (str(tmp_path / n) for n in ("landed", "out", "mark"))
    source = calls(spark, 50)
    for _ in range(2):
        source.coalesce(1).write.mode("append").parquet(landed)
    stream = dedup_stream(file_stream(spark, landed, source.schema, 1), "1 day")
    query = (
        stream.select("topic", "partition", "offset")
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", mark)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    got = spark.read.parquet(out)
    assert got.count() == 50 and got.distinct().count() == 50
    assert got.agg(F.max("offset")).first()[0] == 16
