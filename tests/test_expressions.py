import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from ledgerline.functions import expressions as x
from ledgerline.operators import features as feat


def one(spark, rows, schema, **columns):
    df = spark.createDataFrame(rows, schema)
    return [tuple(r) for r in df.select(*[c.alias(n) for n, c in columns.items()]).collect()]


def test_bands_are_left_closed(spark):
    rows = [(29.99,), (30.0,), (60.0,), (99.99,), (100.0,), (-5.0,), (None,), (float("nan"),)]
    band = x.value_band("v", [30, 60, 100], ["a", "b", "c", "d"])
    floored = x.value_band("v", [30, 60, 100], ["a", "b", "c", "d"], floor=0.0)
    got = one(spark, rows, "v double", b=band, f=floored)
    assert [g[0] for g in got] == ["a", "b", "c", "c", "d", "a", None, None]
    assert [g[1] for g in got] == ["a", "b", "c", "c", "d", None, None, None]


def test_day_periods_are_right_closed(spark):
    hours = [0, 5, 6, 9, 10, 15, 16, 19, 20, 23]
    got = one(spark, [(h,) for h in hours], "h int", p=x.day_period("h"))
    assert [g[0] for g in got] == [
        "night", "night", "morning_peak", "morning_peak", "daytime", "daytime",
        "evening_peak", "evening_peak", "late_evening", "late_evening",
    ]


def test_null_and_nan_in_indicators(spark):
    rows = [(101.0,), (0.0,), (None,), (float("nan"),)]
    got = one(
        spark, rows, "v double", over=x.indicator(x.nan_to_null("v") > 100),
        keep=x.indicator(x.nan_to_null("v") > 100, keep_null=True), clip=x.clip(x.nan_to_null("v"), 1, 50),
        ok=x.is_finite("v"),
    )
    assert got == [(1, 1, 50.0, True), (0, 0, 1.0, True), (0, None, None, False), (0, None, None, False)]


def test_row_sum_modes(spark):
    got = one(
        spark, [(1.0, 2.0), (None, 2.0), (None, None)], "a double, b double",
        z=x.row_sum(["a", "b"], "zero"), n=x.row_sum(["a", "b"], "any"), a=x.row_sum(["a", "b"], "all"),
    )
    assert got == [(3.0, 3.0, 3.0), (2.0, 2.0, None), (0.0, None, None)]
    with pytest.raises(ValueError):
        x.row_sum(["a"], "other")


def test_time_parts_and_durations(spark):
    start, end = dt.datetime(2026, 5, 3, 23, 59, 30), dt.datetime(2026, 5, 4, 0, 0, 15, 500000)  # a Sunday
    got = one(
        spark, [(start, end), (None, end)], "s timestamp_ntz, e timestamp_ntz",
        m=x.duration("s", "e"), h=x.hour_of("s"), w=x.weekday_of("s"), k=x.weekend_flag("s"), n=x.weekend_flag("e"),
    )
    assert got[0] == (45.5 / 60, 23, 6, 1, 0)
    assert got[1] == (None, None, None, 0, 0)


def test_keys_ratios_and_codes(spark):
    got = one(
        spark, [(1, 2, 0.0), (None, 2, 4.0)], "a int, b int, d double",
        k=x.composite_key("a", "b"), r=x.ratio("b", "d"), f=x.flag_equals("a", 1),
        m=x.membership_flag(["a", "b"], [2]), n=x.not_code_or_null("a", 1), l=x.label_lookup("a", {1: "one"}),
    )
    assert got == [("1_2", None, 1, 1, False, "one"), (None, 0.5, 0, 1, True, "Other")]


def test_limits_pass_null(spark):
    got = one(
        spark, [(1.0, None), (-1.0, 1.0), (1.0, 9.0)], "a double, b double",
        n=x.nonnegative_or_null(["a", "b"]), w=x.within_limits_or_null({"a": 5, "b": 5}),
    )
    assert got == [(True, True), (False, True), (True, False)]


def test_coercion_and_logs(spark):
    got = one(
        spark, [("2024-01-02 03:04:05", "1.5"), ("no", "no")], "t string, n string",
        t=x.coerce_timestamp("t"), n=x.coerce_number("n"), b=x.unlog_target(x.log_target(x.coerce_number("n"))),
    )
    assert got[0][0] == dt.datetime(2024, 1, 2, 3, 4, 5) and got[0][1] == 1.5
    assert math.isclose(got[0][2], 1.5) and got[1] == (None, None, None)


def test_flags_come_from_unclipped_values(spark):
    df = spark.createDataFrame([(150.0,), (0.0,), (-3.0,), (None,)], "v double")
    got = feat.clip_with_flags(df, "v", 0, 100, capped="c", zero="z", adjusted="a").collect()
    assert [tuple(r) for r in got] == [(100.0, 1, 0, 1), (0.0, 0, 1, 0), (0.0, 0, 0, 1), (None, 0, 0, 0)]


def test_fill_keeps_flags_and_types(spark):
    df = spark.createDataFrame([(None, None), (2, "x")], "a int, b string")
    out = feat.fill_constants(df, {"a": -1, "b": "Unknown"}, flags=True)
    assert dict(out.dtypes)["a"] == "int"
    assert [tuple(r) for r in out.collect()] == [(-1, "Unknown", True, True), (2, "x", False, False)]


def test_one_hot_columns(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "i int, c string")
    out = feat.one_hot_columns(df, ["c"])
    assert out.columns == ["i", "c_a", "c_b", "c_null"]
    assert [tuple(r)[1:] for r in out.orderBy("i").collect()] == [(1, 0, 0), (0, 1, 0), (0, 0, 1)]
    wide = spark.range(1200).selectExpr("CAST(id AS string) AS c", "id % 3 AS d")
    assert len(feat.one_hot_columns(wide, ["c", "d"]).columns) == 1203
    assert feat.one_hot_long(df, ["i"], ["c"]).count() == 3


def test_rounding_is_half_even(spark):
    df = spark.createDataFrame([(0.125,), (0.375,)], "v double")
    assert [r[0] for r in feat.round_columns(df, 2).collect()] == [0.12, 0.38]


def test_two_stage(spark):
    got = one(
        spark, [(1, -2.0), (1, 3.0), (0, 3.0)], "f int, a double", p=x.combine_two_stage(F.col("f"), "a")
    )
    assert got == [(0.0,), (3.0,), (0.0,)]
