"""Column expressions on hand-computed values."""

import datetime as dt
import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmill.functions import days, missing, space

NAN = float("nan")
D = dt.date


def column(spark, values, kind, expression):
    """The expression over one column ``x`` holding ``values``."""
    rows = spark.createDataFrame([(k, v) for k, v in enumerate(values)], f"k int, x {kind}")
    return [r[0] for r in rows.orderBy("k").select(expression).collect()]


# -- missing values ----------------------------------------------------------------------------

def test_undeclared_fill(spark):
    values = [1.0, -5.0, NAN, None, 9e35, 8.99e35, 9.96921e36, math.inf, -math.inf]
    assert column(spark, values, "double", missing.mask_fill("x")) == [
        1.0, -5.0, None, None, None, 8.99e35, None, None, -math.inf
    ]


def test_declared_fill_is_exact_and_the_only_one(spark):
    values = [-999.0, -998.9, 9.9e36, NAN, None]
    assert column(spark, values, "double", missing.mask_fill("x", -999)) == [None, -998.9, 9.9e36, None, None]


@pytest.mark.parametrize("fill", ["unreadable", [1.0]])
def test_unusable_fill_falls_back(spark, fill):
    assert column(spark, [1.0, 9.9e36], "double", missing.mask_fill("x", fill)) == [1.0, None]


def test_nan_as_declared_fill(spark):
    assert column(spark, [1.0, NAN, 9.9e36], "double", missing.mask_fill("x", NAN)) == [1.0, None, 9.9e36]


def test_fill_in_single_precision(spark):
    # -999.9 has no exact float: a comparison in double would miss it
    masked = missing.mask_fill("x", -999.9, T.FloatType())
    assert column(spark, [-999.9, 1.5], "float", masked) == [None, 1.5]


def test_range_is_inclusive_and_keeps_rows(spark):
    values = [0.0, 40.0, -0.1, 40.1, None, NAN]
    assert column(spark, values, "double", missing.mask_range("x", 0, 40)) == [0.0, 40.0, None, None, None, None]


def test_numbers_from_text(spark):
    values = ["1.5", " 2 ", "-3e2", ".5", "7.", "abc", "", None, "NaN", "inf", "-Infinity", "1d", "1f", "0x1p3", "1,5"]
    assert column(spark, values, "string", missing.to_number("x", T.StringType())) == [
        1.5, 2.0, -300.0, 0.5, 7.0, None, None, None, None, math.inf, -math.inf, None, None, None, None
    ]


def test_integers(spark):
    text = ["7", "-7", "7.0", "1.7", "x", None, "9007199254740993", "1e3", "99999999999999999999"]
    assert column(spark, text, "string", missing.to_integer("x", T.StringType())) == [
        7, -7, 7, None, None, None, 9007199254740993, 1000, None
    ]
    numbers = [1.0, 1.7, NAN, None, 1e30, -2.0]
    assert column(spark, numbers, "double", missing.to_integer("x", T.DoubleType())) == [1, None, None, None, None, -2]


# -- longitudes --------------------------------------------------------------------------------

def test_lon_360(spark):
    values = [-180.0, 180.0, 360.0, -500.0, -161.0, 0.0, 359.5, 725.0]
    assert column(spark, values, "double", space.lon_360("x")) == [180.0, 180.0, 0.0, 220.0, 199.0, 0.0, 359.5, 5.0]


def test_lon_pm180(spark):
    assert column(spark, [199.0, 180.0, 179.0, -180.0, 360.0], "double", space.lon_pm180("x")) == [
        -161.0, -180.0, 179.0, -180.0, 0.0
    ]


@pytest.mark.parametrize(
    ("lo", "hi", "intervals"),
    [
        (-10, 10, [(350, 360), (0, 10)]),       # crosses Greenwich
        (170, -170, [(170, 190)]),              # crosses the date line: no seam in 0..360
        (-10, 0, [(350, 360), (0, 0)]),
        (-180, 180, [(0, 360)]),                # the whole circle, not a point
        (-161, -154, [(199, 206)]),
        (120, 125, [(120, 125)]),
        (5, 5, [(5, 5)]),
    ],
)
def test_intervals(spark, lo, hi, intervals):
    got = spark.range(1).select(space.lon_intervals(float(lo), float(hi))).first()[0]
    assert [tuple(i) for i in got] == intervals


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(-360, 360), st.integers(0, 359))
def test_split_covers_exactly_the_box(spark, lo, width):
    """Every whole degree is inside if and only if walking east from ``lo`` reaches it in time."""
    hi = lo + width
    degrees = spark.range(360).select(F.col("id").cast("double").alias("lon"))
    pm180 = F.when(F.col("lon") >= 180, F.col("lon") - 360).otherwise(F.col("lon"))
    rows = degrees.select(
        "lon",
        space.lon_in("lon", float(lo), float(hi)).alias("in_360"),
        space.lon_in(pm180, float(lo), float(hi), "pm180").alias("in_pm180"),
        F.exists(
            space.lon_intervals(float(lo), float(hi)), lambda i: F.col("lon").between(i["lo"], i["hi"])
        ).alias("in_intervals"),
    ).collect()
    for r in rows:
        inside = (r.lon - lo) % 360 <= width
        assert (r.in_360, r.in_pm180, r.in_intervals) == (inside,) * 3, (r.lon, lo, hi)


def test_latitude_bounds_in_any_order(spark):
    values = [-10.0, -7.0, -8.0, -10.1, None]
    expected = [True, True, True, False, None]
    assert column(spark, values, "double", space.lat_in("x", -10.0, -7.0)) == expected
    assert column(spark, values, "double", space.lat_in("x", -7.0, -10.0)) == expected


# -- days --------------------------------------------------------------------------------------

def test_month_range(spark):
    rows = spark.createDataFrame([(2024, 2), (2023, 2), (2023, 12), (2023, 13), (2023, 0)], "y int, m int")
    got = [tuple(r) for r in rows.select(days.month_start("y", "m"), days.month_end("y", "m")).collect()]
    assert got == [
        (D(2024, 2, 1), D(2024, 2, 29)), (D(2023, 2, 1), D(2023, 2, 28)), (D(2023, 12, 1), D(2023, 12, 31)),
        (None, None), (None, None),
    ]


def test_composite_window_across_the_year(spark):
    centre = [dt.datetime(2023, 12, 30, 12), dt.datetime(2024, 1, 2)]
    assert column(spark, centre, "timestamp", days.composite_start("x")) == [D(2023, 12, 27), D(2023, 12, 30)]
    assert column(spark, centre, "timestamp", days.composite_end("x")) == [D(2024, 1, 3), D(2024, 1, 6)]


def test_day_array(spark):
    rows = spark.createDataFrame(
        [(D(2023, 12, 30), D(2024, 1, 1)), (D(2024, 1, 1), D(2024, 1, 1)), (D(2024, 1, 2), D(2024, 1, 1)), (None, None)],
        "a date, b date",
    )
    assert [r[0] for r in rows.select(days.day_array("a", "b")).collect()] == [
        [D(2023, 12, 30), D(2023, 12, 31), D(2024, 1, 1)], [D(2024, 1, 1)], [], []
    ]


def test_utc_window(spark):
    values = [dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 31, 23, 59, 59), dt.datetime(2024, 2, 1),
              dt.datetime(2024, 2, 7, 12), dt.datetime(2024, 2, 8), dt.datetime(2023, 12, 31, 23)]
    d0, d1 = D(2024, 1, 1), D(2024, 1, 31)
    assert column(spark, values, "timestamp", days.in_utc_window("x", d0, d1)) == [True, True] + [False] * 4
    assert column(spark, values, "timestamp", days.in_utc_window("x", d0, d1, 7)) == [True] * 4 + [False] * 2
    closed = days.in_utc_window("x", d0, d1, 1, end_exclusive=False)
    assert column(spark, values, "timestamp", closed) == [True, True, True, False, False, False]


def test_overlap_touches_by_one_day(spark):
    rows = spark.createDataFrame(
        [(D(2024, 1, 25), D(2024, 2, 1)), (D(2024, 1, 24), D(2024, 1, 31)), (D(2024, 2, 29), D(2024, 3, 7)),
         (D(2024, 3, 1), D(2024, 3, 8))], "a date, b date",
    )
    got = rows.select(days.overlaps("a", "b", D(2024, 2, 1), D(2024, 2, 29))).collect()
    assert [r[0] for r in got] == [True, False, True, False]


def test_rfc3339(spark):
    assert column(spark, [dt.datetime(2031, 10, 7, 18, 40, 9, 80706), dt.datetime(2031, 10, 7)], "timestamp_ntz",
                  days.rfc3339_utc("x")) == ["2031-10-07T18:40:09.080706Z", "2031-10-07T00:00:00.000000Z"]


def test_calendar(spark):
    leap = [D(2024, 12, 31), D(2023, 3, 1)]
    assert column(spark, leap, "date", days.day_of_year("x")) == [366, 60]
    assert column(spark, leap, "date", days.month_of_year("x")) == [12, 3]
