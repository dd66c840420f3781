import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from weirstone.functions import add_as_text, add_ints, recode, slice_text, to_double, to_int, to_timestamp

EDGES = [
    None, "", " ", "0", "12", "-7", "+7", "12.7", "-12.7", ".5", "-.5", ".", "+.", "-", "+", "1.",
    "1..2", "1e3", "1.5e3", "0x10", "2147483647", "2147483648", "-2147483648", "-2147483649",
    "99999999999999999999", "2147483648.5", " 12 ", "\t12\n", "1 2", "12a", "a12", "n/a", "null",
    "NaN", "١٢", "12 ", "\x0112\x1f", "12\x7f", "1,000", "00012", "1.2.3", "--1", "12.a", "12. ",
    " .5 ", "1\n", "\n", "12.7\n",
]


def legacy(spark, frame, expression):
    """The cast with ANSI mode off, as older releases have it."""
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        return [r[0] for r in frame.selectExpr(expression).collect()]
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def frame_of(spark, values):
    return spark.createDataFrame([(v,) for v in values], "v string").coalesce(1)


def test_to_int_is_the_truncating_cast(spark):
    rng = random.Random(7)
    made = ["".join(rng.choices("0123456789.+- ea\t\n", k=rng.randint(1, 7))) for _ in range(20000)]
    frame = frame_of(spark, EDGES + made)
    got = [r[0] for r in frame.select(to_int("v")).collect()]
    want = legacy(spark, frame, "cast(v as int)")
    assert [(v, g) for v, g, w in zip(EDGES + made, got, want) if g != w] == []


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="0123456789.+-eE \t\x00\x7fdfx", max_size=12), min_size=1, max_size=60))
def test_to_int_on_any_text(spark, values):
    frame = frame_of(spark, values)
    assert [r[0] for r in frame.select(to_int("v")).collect()] == legacy(
        spark, frame, "cast(v as int)"
    )


def test_to_double_and_timestamp_never_raise(spark):
    values = ["1.5", "1e3", "x", None, "9007199254740993"]
    got = [r[0] for r in frame_of(spark, values).select(to_double("v")).collect()]
    assert got == [1.5, 1000.0, None, None, 9007199254740992.0]
    values = ["2024-01-01 00:00:07.179575", "2024-01-01", "not a time", "", None]
    got = [
        str(r[0]) for r in frame_of(spark, values).select(to_timestamp("v", "timestamp_ntz")).collect()
    ]
    assert got == ["2024-01-01 00:00:07.179575", "2024-01-01 00:00:00", "None", "None", "None"]


def test_add_ints(spark):
    rows = spark.createDataFrame([(1, 2), (None, 2), (2147483647, 1)], "a int, b int")
    assert [r[0] for r in rows.select(add_ints("a", "b")).collect()] == [3, None, None]
    with pytest.raises(ValueError):
        add_ints()


def test_text_fixups(spark):
    rows = spark.createDataFrame(
        [("MAKEPYMENT", "0000NJxx"), ("makepymnt", "0000"), ("MAKEPYMENT ", None), (None, "12345")],
        "v string, s string",
    )
    got = rows.select(recode("v", {"MAKEPYMENT": "MAKEPAYMENT"}), slice_text("s", 5, 2)).collect()
    assert [tuple(r) for r in got] == [
        ("MAKEPAYMENT", "NJ"), ("makepymnt", ""), ("MAKEPYMENT ", None), (None, "5"),
    ]
    assert [r[0] for r in spark.range(1, 4).select(add_as_text("id", 1)).collect()] == ["2", "3", "4"]
    assert [r[0] for r in rows.select(recode("v", {})).collect()][0] == "MAKEPYMENT"


def test_casts_stay_in_the_jvm(spark):
    plan = spark.range(1).select(to_int("CAST(id AS STRING)"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "UDF" not in plan
