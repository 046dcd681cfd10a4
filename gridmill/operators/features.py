"""Lags, differences, rolling statistics and calendar signals per region.

Frames count rows of the region's series, not calendar days, and never look ahead. The input
has one row per region-day, so a window partition is one region's days: bounded by the
calendar, whatever the number of grid cells behind it.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from gridmill.functions.days import day_of_year, month_of_year

DAYS_BACK = 6  # rolling statistics: the current row and six before

# base column -> feature prefix -- fixed values
PREFIXES = {
    "sst_c_mean": "sst",
    "swh_m_mean": "swh",
    "peak_period_s_mean": "peak_period",
    "chl_mg_m3_mean": "chl",
}


def series() -> WindowSpec:
    """A region's days in order."""
    return Window.partitionBy("region_id").orderBy("date")


def lag_columns(prefixes: Mapping[str, str] = PREFIXES) -> list[Column]:
    """The value of the row before."""
    w = series()
    return [F.lag(c, 1).over(w).alias(f"{p}_lag1") for c, p in prefixes.items()]


def diff_columns(prefixes: Mapping[str, str] = PREFIXES) -> list[Column]:
    """The change from the row before, NULL if either value is missing."""
    w = series()
    return [(F.col(c) - F.lag(c, 1).over(w)).alias(f"{p}_diff1") for c, p in prefixes.items()]


def rolling_columns(prefixes: Mapping[str, str] = PREFIXES) -> list[Column]:
    """Mean and sample deviation over up to seven rows, missing values skipped."""
    w = series().rowsBetween(-DAYS_BACK, Window.currentRow)
    statistics = (("ma", F.avg), ("sd", F.stddev_samp))
    return [f(c).over(w).alias(f"{p}_{n}7") for c, p in prefixes.items() for n, f in statistics]


def calendar_columns() -> list[Column]:
    return [day_of_year("date").alias("doy"), month_of_year("date").alias("month")]


def region_daily_features(base: DataFrame) -> DataFrame:
    """The base table with all features: one exchange and one sort for all windows."""
    return base.select(
        "date",
        "region_id",
        *PREFIXES,
        *lag_columns(),
        *diff_columns(),
        *rolling_columns(),
        *calendar_columns(),
    )
