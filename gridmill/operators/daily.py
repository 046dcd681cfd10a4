"""Sub-daily rows to daily means per cell."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmill.functions.days import day_array, utc_day

CELL = ("region_id", "lat", "lon")


def dense_days(daily: DataFrame, measures: list[str]) -> DataFrame:
    """Cell-days with the absent ones added: rows of NULLs for every day between the first and the
    last one the cell's region has in a month.

    A region-month is the unit of loading, so the result does not depend on how many months are
    loaded together. A cell's month is one row with at most 31 days in it. The days per region come
    from those rows, whose shuffle is computed once and used by both sides of the join; the region
    side is so small that Spark broadcasts it from its measured size. Nothing is lost on the way: rows
    without a region are joined as a region of their own, rows without a date stay one row each, so
    that a check of required values afterwards sees them.
    """
    day = F.struct("date", F.struct(*measures).alias("values"))
    months = daily.groupBy(*CELL, F.trunc("date", "month").alias("month")).agg(F.collect_list(day).alias("held"))
    spans = months.groupBy("region_id", "month").agg(
        F.min(F.array_min("held.date")).alias("first"), F.max(F.array_max("held.date")).alias("last")
    )
    dated = F.col("m.month").isNotNull()
    same = F.expr("m.region_id <=> s.region_id AND m.month <=> s.month")
    each = months.alias("m").join(spans.alias("s"), same).select(
        *[f"m.{c}" for c in CELL], F.when(dated, F.map_from_entries("held")).alias("held"),
        F.when(~dated, F.col("held")[0]["values"]).alias("undated"),
        F.explode(F.when(dated, day_array("first", "last")).otherwise(F.array(F.lit(None).cast("date")))).alias("date"),
    )
    values = F.coalesce(F.try_element_at("held", F.col("date")), F.col("undated"))
    return each.select("region_id", "date", "lat", "lon", *[values[m].alias(m) for m in measures])


def daily_mean(rows: DataFrame, measures: Mapping[str, str], dense: bool = True) -> DataFrame:
    """Mean per (region_id, date, lat, lon) over a UTC day, missing values skipped.

    ``measures`` maps input to output columns. A cell-day with only missing values yields a row
    of NULLs. With ``dense`` so do whole days absent between a region's first and last day of a month.
    The rows are read once, with map-side partial means; only cell-days are densified.
    """
    daily = rows.withColumn("date", utc_day("time")).groupBy("region_id", "date", "lat", "lon").agg(
        *[F.avg(raw).alias(out) for raw, out in measures.items()]
    )
    return dense_days(daily, list(measures.values())) if dense else daily
