"""Region-day means and the region-day base table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmill.functions.days import day_array

KEY = ("date", "region_id")
WINDOW = ("region_id", "period_start_date", "period_end_date")
SST_MEANS = {"sst_c": "sst_c_mean"}
WAVES_MEANS = {"swh_m": "swh_m_mean", "peak_period_s": "peak_period_s_mean"}


def in_regions(df: DataFrame, regions: Sequence[str] | None = None) -> DataFrame:
    """Only the given regions; none given means all."""
    return df if regions is None else df.where(F.col("region_id").isin(list(regions)))


def region_day_mean(rows: DataFrame, means: Mapping[str, str], regions: Sequence[str] | None = None) -> DataFrame:
    """Mean over a region's cells per day. Map-side partial means, then one row per region-day."""
    return in_regions(rows, regions).groupBy(*KEY).agg(*[F.avg(c).alias(out) for c, out in means.items()])


def window_mean(chl: DataFrame, regions: Sequence[str] | None = None) -> DataFrame:
    """Mean over a region's cells per composite window."""
    return in_regions(chl, regions).groupBy(*WINDOW).agg(F.avg("chl_mg_m3").alias("chl_mg_m3_window_mean"))


def window_days(windows: DataFrame) -> DataFrame:
    """Windows repeated for each of their days."""
    return windows.withColumn("date", F.explode(day_array("period_start_date", "period_end_date")))


def dailyize(chl: DataFrame, regions: Sequence[str] | None = None) -> DataFrame:
    """Composite cells to region-days: the plain mean of the window means that cover a day.

    Aggregate first, expand to days after: windows are few, cells are not, and the optimizer
    never swaps the two.
    """
    return window_days(window_mean(chl, regions)).groupBy(*KEY).agg(
        F.avg("chl_mg_m3_window_mean").alias("chl_mg_m3_mean")
    )


def observed_days(
    sst: DataFrame, waves: DataFrame, chl: DataFrame, regions: Sequence[str] | None = None
) -> DataFrame:
    """All (date, region_id) seen in at least one source."""
    windows = in_regions(chl, regions).select(*WINDOW).distinct()
    days = window_days(windows).select(*KEY)
    for rows in (sst, waves):
        days = days.union(in_regions(rows, regions).select(*KEY))
    return days.distinct()


def region_daily_base(
    sst: DataFrame, waves: DataFrame, chl: DataFrame, regions: Sequence[str] | None = None
) -> DataFrame:
    """One row per observed region-day with the mean of each source, NULL where it has none.

    That is each source's means joined to the observed days. Here the means of all sources are
    stacked and merged by one aggregate instead: every source is scanned once and averaged in
    the scan's own stage, and what is merged are region-days, which the means have already
    hashed by (date, region_id). A region-day has one row per source, so the maximum over the
    stack picks that source's value.
    """
    parts = [
        region_day_mean(sst, SST_MEANS, regions),
        region_day_mean(waves, WAVES_MEANS, regions),
        dailyize(chl, regions),
    ]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    means = [c for c in stacked.columns if c not in KEY]
    return stacked.groupBy(*KEY).agg(*[F.max(c).alias(c) for c in means])
