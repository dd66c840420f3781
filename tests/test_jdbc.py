"""JDBC against the embedded database in Spark's own jars: in memory, no server, no port."""

import uuid

import pytest
from test_feeds import envelope

from weirstone.plans import CALL_TYPE, database_call, run_load
from weirstone.sinks import JdbcStage, append, truncate_load, write
from weirstone.sources import JdbcConnection, scalar, scan, scan_split


@pytest.fixture
def db():
    return JdbcConnection(
        f"jdbc:derby:memory:t{uuid.uuid4().hex};create=true",
        driver="org.apache.derby.iapi.jdbc.AutoloadedDriver",
    )


def ids(df):
    return sorted(r.id for r in df.collect())


def rows(spark, *given):
    return spark.createDataFrame([(i, f"n{i}") for i in given], "id int, name string")


def test_write_modes(spark, db):
    write(rows(spark, 1), db, "t")
    write(rows(spark, 2), db, "t", mode="append", batch_size=1, num_partitions=1)
    assert ids(scan(spark, db, "t")) == [1, 2]
    write(rows(spark, 3), db, "t", mode="ignore")
    assert ids(scan(spark, db, "t")) == [1, 2]
    with pytest.raises(Exception, match="exists"):
        write(rows(spark, 3), db, "t", mode="errorifexists")
    write(rows(spark, 3), db, "t", mode="overwrite")
    assert ids(scan(spark, db, "t")) == [3]
    with pytest.raises(ValueError, match="upsert"):
        write(rows(spark, 3), db, "t", mode="upsert")


def test_the_connection_sets_the_default_mode(spark, db):
    again = JdbcConnection(db.url, driver=db.driver, write_mode="overwrite")
    append(rows(spark, 1), again, "t")
    write(rows(spark, 2), again, "t")
    assert ids(scan(spark, db, "t")) == [2]


def test_truncate_load_keeps_the_table_definition(spark, db):
    append(rows(spark, 1, 2), db, "t")
    truncate_load(rows(spark, 3).selectExpr("cast(id as smallint) id", "name"), db, "t")
    got = scan(spark, db, "t")
    assert ids(got) == [3] and dict(got.dtypes)["id"] == "int"


def test_query_scan_and_its_splits(spark, db):
    append(rows(spark, *range(40)), db, "t")
    query = '(SELECT "id" FROM t WHERE "id" >= 10) q'
    assert ids(scan(spark, db, query)) == list(range(10, 40))
    split = scan(spark, db, query, column="id", bounds=(15, 30), num_partitions=3)
    assert split.rdd.getNumPartitions() == 3 and ids(split) == list(range(10, 40))
    by = scan(spark, db, "t", predicates=['"id" < 5', '"id" >= 35'])
    assert by.rdd.getNumPartitions() == 2 and by.count() == 10
    own = scan_split(spark, db, "t", "id", 4)
    assert own.rdd.getNumPartitions() == 4 and ids(own) == list(range(40))
    truncate_load(rows(spark).limit(0), db, "t")
    assert scan_split(spark, db, "t", "id", 4).count() == 0
    append(rows(spark, *range(40)), db, "t")
    with pytest.raises(ValueError, match="bounds"):
        scan(spark, db, "t", column="id")
    plan = scan(spark, db, "t").where("id = 3")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(id,3)" in plan


def test_scalar(spark, db):
    append(rows(spark, 1, 5), db, "t")
    assert scalar(spark, db, '(SELECT MAX("id") AS m FROM t) q') == 5
    assert scalar(spark, db, '(SELECT "id" FROM t WHERE "id" < 0) q') is None


def test_errors_are_raised(spark):
    with pytest.raises(Exception):
        append(rows(spark, 1), JdbcConnection("jdbc:nothing:here"), "t")


def test_the_password_is_not_printed():
    c = JdbcConnection("jdbc:x:y", user="u", password="secret", driver="d")
    assert "secret" not in repr(c)
    assert c.properties() == {"user": "u", "password": "secret", "driver": "d"}


@pytest.mark.parametrize("truncate,total", [(True, 2), (False, 4)])
def test_load_into_a_database_stage(spark, db, truncate, total):
    place = JdbcStage(db, "s", truncate=truncate)
    source = envelope(spark, ['{"CallsHandled":"2","TotalCallsAband":"3.9"}', "{"])
    staged = []
    for _ in range(2):
        assert run_load(source, CALL_TYPE, place, merges=[lambda s: staged.append(s.count())]) == 2
    assert scan(spark, db, "s").count() == total
    assert staged == [2, 2]
    assert {r.outflow_to_queue for r in place.read(spark, "").collect()} == {5, None}


def test_calls_and_log_in_the_database(spark, db):
    source, place = envelope(spark, ['{"CallsHandled":"2"}']), JdbcStage(db, "s")
    done = database_call(db, "(SELECT COUNT(*) AS n FROM s) q")
    assert run_load(source, CALL_TYPE, place, merges=[done]) == 1
    fails = database_call(db, "(SELECT no_such_function() AS n FROM s) q")
    with pytest.raises(Exception, match="(?i)no_such_function"):
        run_load(
            source, CALL_TYPE, place, merges=[fails], log=lambda row: append(row, db, "load_log"),
        )
    logged = scan(spark, db, "load_log").first()
    assert logged.load_name == "callTypeIntervalDataIVRRefresh" and logged.status == "error"
    assert "NO_SUCH_FUNCTION" in logged.message.upper()
