"""A target in buckets against a plain upsert, its plan, and its versions; split reads of skewed columns."""

import random
import uuid

import duckdb
import pytest
from compare import compare
from pyspark.sql import functions as F

from weirstone.catalog import ORACLE, queries
from weirstone.plans import BucketedTable, buckets, buckets_for
from weirstone.sources import JdbcConnection, scan
from weirstone.sources import jdbc as module
from weirstone.sources.jdbc import quantile_bounds, scan_quantiles
from weirstone.sinks import append

ROW = "k int, j string, v int, w string"


def frame(spark, rows):
    return spark.createDataFrame(rows, ROW)


def values(df):
    return sorted((tuple(r) for r in df.select("k", "j", "v", "w").collect()), key=repr)


def plain(target, stage):
    """Per key the row of the largest v, the stage's if equal; keys may be null."""
    best = {(k, j): (v is not None, v or 0, 0, w) for k, j, v, w in target}
    for k, j, v, w in stage:
        best[k, j] = max(best.get((k, j), (False, -1, -1, "")), (v is not None, v or 0, 1, w))
    return sorted(((k, j, v if has else None, w) for (k, j), (has, v, _, w) in best.items()), key=repr)


def some(pick, n, keys, side):
    rows = {}
    for i in range(n):
        k, j = pick.choice([None, *range(keys)]), pick.choice(["x", "y", None])
        rows[k, j, i] = (k, j, pick.choice([None, pick.randrange(5), pick.randrange(5)]), f"{side}{i}")
    return list(rows.values())


def test_upserts_in_buckets(spark, tmp_path):
    pick = random.Random(3)
    table = BucketedTable(str(tmp_path / "t"), ("k", "j"), 4)
    unique = {r[:2]: r for r in some(pick, 80, 30, "t")}
    table.create(frame(spark, list(unique.values())))
    want = sorted(unique.values(), key=repr)
    assert values(table.read(spark)) == want
    for n in range(3):
        stage = {(r[:2], r[2]): r for r in some(pick, 60, 40, f"s{n}-")}  # no two rows of a key are equally new
        for _ in range(2):
            table.upsert(frame(spark, list(stage.values())), ("v",))
            want = plain(want, list(stage.values()))
            assert values(table.read(spark)) == want
    assert len(list((tmp_path / "t").glob("version=*"))) == 2


def test_only_the_stage_is_exchanged(spark, tmp_path):
    table = BucketedTable(str(tmp_path / "t"), ("k",), 4)
    table.create(spark.range(2_000).select(F.col("id").cast("int").alias("k"), F.lit("x").alias("j"), F.lit(1).alias("v"), F.lit("w").alias("w")))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        target = table.read(spark).where("k IS NOT NULL")
        merged = table.merged(target, frame(spark, [(1, "x", 9, "new")]), ("v",))
        plan = merged._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    old, new = plan[plan.index("SortMergeJoin") :].split("Exchange", 1)
    assert "FullOuter" in old and "FileScan parquet" in old and "Bucketed: true" in old
    assert "hashpartitioning(k" in new and "Scan ExistingRDD" in new
    assert merged.count() == 2_000


def test_another_session_reads_the_table(spark, tmp_path):
    table = BucketedTable(str(tmp_path / "t"), ("k",), 2)
    table.create(frame(spark, [(1, "x", 1, "a"), (2, "x", 1, "b")]))
    spark.sql(f"DROP TABLE {table._name(1)}")
    assert values(table.read(spark)) == [(1, "x", 1, "a"), (2, "x", 1, "b")]
    table.upsert(frame(spark, [(2, "x", 5, "c")]), ("v",))
    assert values(table.read(spark)) == [(1, "x", 1, "a"), (2, "x", 5, "c")]


def test_a_version_that_broke_off_does_not_count(spark, tmp_path):
    table = BucketedTable(str(tmp_path / "t"), ("k",), 2)
    with pytest.raises(ValueError, match="no table"):
        table.read(spark)
    table.create(frame(spark, [(1, "x", 1, "a")]))
    (tmp_path / "t" / "version=000000002").mkdir()
    table.upsert(frame(spark, [(3, "x", 5, "c")]), ("v",))
    assert values(table.read(spark)) == [(1, "x", 1, "a"), (3, "x", 5, "c")]
    with pytest.raises(ValueError, match="differ in columns"):
        table.upsert(spark.createDataFrame([(1,)], "k int"), ("v",))


def test_more_rows_are_more_buckets(spark, tmp_path, monkeypatch):
    assert [buckets_for(n, 8) for n in (0, 4_000_000, 4_000_001, 400_000_000)] == [8, 8, 9, 800]
    monkeypatch.setattr(buckets, "BUCKET_ROWS", 10)
    day = "make_timestamp_ntz(2024, 1, CAST(1 + id % 28 AS INT), 0, 0, 0)"
    ids = spark.range(120)
    orders = ids.selectExpr("id AS o_orderkey", "'O' AS o_orderstatus", "1.5D * id AS o_totalprice", f"{day} AS o_orderdate")
    items = ids.selectExpr(
        "id * 3 div 2 AS l_orderkey", "'F' AS l_linestatus", "2.5D * id AS l_extendedprice", "CAST(id % 4 AS INT) AS l_linenumber", f"{day} AS l_shipdate"
    )
    con = duckdb.connect()
    for name, rows in (("orders", orders), ("lineitem", items)):
        rows.write.parquet(f"{tmp_path}/{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}.parquet/*.parquet')")
    assert compare(spark, con, queries.merge_upsert_bucketed, ORACLE["merge_upsert_bucketed"], str(tmp_path)) == []
    files = queries.merge_upsert_bucketed(spark, str(tmp_path)).inputFiles()
    assert len({f.rsplit("_", 1)[1] for f in files}) > 8


@pytest.mark.parametrize("cells", [1024, 4])
def test_splits_of_a_skewed_column(spark, monkeypatch, cells):
    monkeypatch.setattr(module, "QUANTILE_CELLS", cells)
    pick = random.Random(1)
    db = JdbcConnection(f"jdbc:derby:memory:t{uuid.uuid4().hex};create=true", driver="org.apache.derby.iapi.jdbc.AutoloadedDriver")
    given = [int(10 ** pick.uniform(0, 12)) * pick.choice([1, 1, -1]) for _ in range(1000)] + list(range(500)) + [None] * 7
    append(spark.createDataFrame([(v,) for v in given], "v long"), db, "t")
    rows = scan_quantiles(spark, db, "t", "v", 10)
    assert sorted(r.v is None or r.v for r in rows.collect()) == sorted(v is None or v for v in given)
    sizes = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) >= 8 and max(sizes) <= 2 * sum(sizes) / len(sizes)
    append(spark.createDataFrame([(7,)] * 900 + [(8,)], "v long"), db, "one")  # a value cannot be split
    assert quantile_bounds(spark, db, "one", "v", 10) == [8]
    append(spark.createDataFrame([(None,)], "v long"), db, "nothing")
    assert quantile_bounds(spark, db, "nothing", "v", 10) == [] and scan_quantiles(spark, db, "nothing", "v", 3).count() == 1
    assert scan(spark, db, "one").count() == 901
