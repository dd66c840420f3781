"""Time the headline queries; prints one JSON line.

Each query is built and written to a sink that keeps nothing, once to warm up
and then ``BENCH_RUNS`` times; the median is reported. Queries that load or
stream include their writes.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from weirstone.catalog import QUERIES  # noqa: E402
from weirstone.functions import parse_json, text_schema  # noqa: E402
from weirstone.session import local_session  # noqa: E402
from weirstone.sources import spread, table  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINE = [
    "flatten_route_call_detail",
    "flatten_call_type",
    "flatten_business_locks",
    "parse_reflected_schema",
    "malformed_split",
    "source_count",
    "offset_range",
    "bounded_batch",
    "offset_gaps",
    "next_offsets",
    "dedup_latest",
    "dedup_latest_agg",
    "dedup_envelope",
    "dedup_rare_copies",
    "merge_upsert",
    "merge_refresh",
    "merge_insert",
    "load_merge",
    "stream_ingest",
]


def lineitem_json(spark: SparkSession, folder: str) -> DataFrame:
    items = spread(table(spark, folder, "lineitem"))
    names = items.columns
    text = items.select(F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in names])).alias("value"))
    return text.select(parse_json("value", text_schema(names)).alias("r")).select("r.*")


def timed(query, spark: SparkSession) -> float:
    start = time.perf_counter()
    query(spark, FOLDER).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = local_session(CPUS)
    only = sys.argv[1:]
    jobs = {n: QUERIES[n] for n in HEADLINE} | {"lineitem_json": lineitem_json}
    seconds = {}
    for name, query in jobs.items():
        if only and name not in only:
            continue
        timed(query, spark)
        seconds[name] = round(statistics.median(timed(query, spark) for _ in range(RUNS)), 3)
    print(
        json.dumps(
            {
                "metric": "total of headline query medians",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
                "cpus": CPUS,
                "runs": RUNS,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
