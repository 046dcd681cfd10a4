"""Quality, load and profile reports. One aggregate each, partial on the map side."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmill.functions.days import in_days
from gridmill.operators.base import in_regions
from gridmill.schemas import SST_RANGE


def fraction(condition: Column) -> Column:
    """Share of rows that meet a condition; NULL counts as not met, no rows gives NULL."""
    return F.try_divide(F.count_if(condition), F.count(F.lit(1)))


def _null_fraction(c: str) -> Column:
    return fraction(F.col(c).isNull())


def _daily_report(rows: DataFrame, regions: Sequence[str] | None, *extra: Column) -> DataFrame:
    # an exact distinct count runs as two aggregates, the first keyed by (region, date): a
    # region with most of the rows is spread over its days
    return in_regions(rows, regions).groupBy("region_id").agg(
        F.min("date").alias("min_date"),
        F.max("date").alias("max_date"),
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("date").alias("n_days"),
        *extra,
    )


def qa_sst(sst: DataFrame, regions: Sequence[str] | None = None) -> DataFrame:
    low, high = SST_RANGE
    return _daily_report(
        sst,
        regions,
        _null_fraction("sst_c").alias("frac_null_sst"),
        fraction((F.col("sst_c") < low) | (F.col("sst_c") > high)).alias("frac_out_of_range_sst"),
    )


def qa_waves(waves: DataFrame, regions: Sequence[str] | None = None) -> DataFrame:
    return _daily_report(
        waves,
        regions,
        _null_fraction("swh_m").alias("frac_null_swh"),
        _null_fraction("peak_period_s").alias("frac_null_peak_period"),
    )


def qa_chl(chl: DataFrame, regions: Sequence[str] | None = None) -> DataFrame:
    return in_regions(chl, regions).groupBy("region_id").agg(
        F.min("period_start_date").alias("min_start"),
        F.max("period_end_date").alias("max_end"),
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("period_start_date", "period_end_date").alias("n_windows"),
        _null_fraction("chl_mg_m3").alias("frac_null_chl"),
    )


def load_check(
    rows: DataFrame,
    d0: dt.date,
    d1: dt.date,
    start: str = "date",
    end: str | None = None,
    regions: Sequence[str] | None = None,
) -> DataFrame:
    """Rows and first and last day per region of what was loaded for [d0, d1].

    For composite windows ``start`` and ``end`` are the period columns; the range is on the start.
    """
    names = ("min_date", "max_date") if end is None else ("min_start", "max_end")
    return in_regions(rows, regions).where(in_days(start, d0, d1)).groupBy("region_id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min(start).alias(names[0]),
        F.max(end or start).alias(names[1]),
    )


def _null_if_empty(c: Column) -> Column:
    return F.when(F.col("n_rows") > 0, c)


def profile_grid(rows: DataFrame) -> DataFrame:
    """One row: rows, first and last date, distinct latitudes and longitudes.

    Two levels: first one row per cell, then the distinct counts over the cells, so that the
    expansion which two exact distinct counts need never meets the full data.
    """
    cells = rows.groupBy("lat", "lon").agg(
        F.count(F.lit(1)).alias("n"), F.min("date").alias("lo"), F.max("date").alias("hi")
    )
    profile = cells.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.min("lo").alias("min_date"),
        F.max("hi").alias("max_date"),
        F.count_distinct("lat").alias("unique_lat"),
        F.count_distinct("lon").alias("unique_lon"),
    )
    return profile.withColumns({c: _null_if_empty(F.col(c)) for c in ("unique_lat", "unique_lon")})


def profile_chl(rows: DataFrame) -> DataFrame:
    """One row: rows, first start, last end, distinct windows.

    Windows with a missing bound count as distinct ones too, so they are counted as rows.
    """
    windows = rows.groupBy("period_start_date", "period_end_date").agg(F.count(F.lit(1)).alias("n"))
    profile = windows.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.min("period_start_date").alias("min_start"),
        F.max("period_end_date").alias("max_end"),
        F.count(F.lit(1)).alias("unique_windows"),
    )
    return profile.withColumn("unique_windows", _null_if_empty(F.col("unique_windows")))


def observed_profile(composite: bool) -> dict[str, Column]:
    """What ``profile_chl`` (of composites) or ``profile_grid`` counts, as aggregates that a write can observe on the way.

    Distinct coordinates and windows are held as sets, which are as large as the axes of a grid, whatever
    the number of its rows.
    """
    if composite:
        windows = F.collect_set(F.struct("period_start_date", "period_end_date"))
        return {"n_rows": F.count(F.lit(1)), "min_start": F.min("period_start_date"), "max_end": F.max("period_end_date"), "unique_windows": F.size(windows).cast("long")}
    return {"n_rows": F.count(F.lit(1)), "min_date": F.min("date"), "max_date": F.max("date"),
            "unique_lat": F.size(F.collect_set("lat")).cast("long"), "unique_lon": F.size(F.collect_set("lon")).cast("long")}


def as_profile(observed: Mapping[str, object]) -> dict[str, object]:
    """Observed values as the row of the profile: without rows there is nothing distinct."""
    return {k: None if k.startswith("unique") and not observed["n_rows"] else v for k, v in observed.items()}
