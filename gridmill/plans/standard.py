"""Raw long rows of a source to its standard rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmill.functions.days import composite_end, composite_start, in_utc_window, utc_day
from gridmill.functions.missing import not_fill, to_number
from gridmill.functions.space import in_domain
from gridmill.operators.checks import guard_non_nulls, require_columns
from gridmill.operators.daily import daily_mean
from gridmill.operators.grid import select_level, standard_axes
from gridmill.operators.regions import assign_regions
from gridmill.schemas import DAYS_AFTER_CENTRE, DAYS_BEFORE_CENTRE, Source
from gridmill.session import require_utc


def time_window(source: Source, d0: dt.date, d1: dt.date) -> Column:
    """Raw times whose standard rows fall into [d0, d1], or overlap it for composites.

    On the raw time column and with literal bounds, so it is pushed to the scan. Exact: days and
    composite windows depend on the time only, so nothing is left to filter afterwards.
    """
    if source.composite:
        d0 = d0 - dt.timedelta(days=DAYS_AFTER_CENTRE)
        d1 = d1 + dt.timedelta(days=DAYS_BEFORE_CENTRE)
    return in_utc_window("time", d0, d1)


def clean_measures(rows: DataFrame, source: Source, fills: Mapping[str, object] | None = None) -> DataFrame:
    """Measures under their standard names as doubles: fills and impossible values NULL, rows kept.

    ``fills`` gives the declared fill value per raw measure, where the data declares one.
    """
    fills = fills or {}
    cleaned = {}
    for raw, out in source.measures.items():
        dtype = rows.schema[raw].dataType
        if isinstance(dtype, T.FractionalType):
            value = F.col(raw)
        else:
            value, dtype = to_number(raw, dtype), T.DoubleType()
        # one condition for all reasons to drop a value, so one CASE per measure
        keep = not_fill(value, fills.get(raw), dtype)
        if out in source.ranges:
            keep &= value.between(*[F.lit(bound) for bound in source.ranges[out]])
        cleaned[out] = F.when(keep, value.cast("double"))
    return rows.withColumns(cleaned).drop(*[raw for raw, out in source.measures.items() if raw != out])


def standardize(
    raw: DataFrame,
    source: Source,
    *,
    within: Column | None = None,
    d0: dt.date | None = None,
    d1: dt.date | None = None,
    regions: DataFrame | None = None,
    region_id: str | None = None,
    fills: Mapping[str, object] | None = None,
    dense: bool = True,
    lon_domain: str | None = None,
    ingested_at: dt.datetime | None = None,
    guard: bool = True,
) -> DataFrame:
    """Standard rows of one source, for any number of regions and months at once.

    The region comes from ``region_id`` (all rows are one region's), from ``regions`` (boxes, by
    position) or is already a column of ``raw``. ``within`` or ``d0``/``d1`` limit the time.
    ``dense`` fills whole days absent from sub-daily input. ``lon_domain`` turns longitudes into
    "360" or "pm180"; by default they stay as the source has them.
    """
    rows = select_level(standard_axes(raw), source.level)
    require_columns(rows, ["time", "lat", "lon", *source.measures], f"{source.name} input")
    if isinstance(rows.schema["time"].dataType, T.TimestampType):
        require_utc(rows.sparkSession)
    if d0 is not None and d1 is not None:
        rows = rows.where(time_window(source, d0, d1))
    if region_id is not None:
        rows = rows.withColumn("region_id", F.lit(region_id))
    elif regions is not None:
        rows = assign_regions(rows, regions)
    require_columns(rows, ["region_id"], f"{source.name} input")
    if within is not None:
        rows = rows.where(within)

    rows = clean_measures(rows, source, fills)
    if source.composite:
        rows = rows.withColumns(
            {"period_start_date": composite_start("time"), "period_end_date": composite_end("time")}
        )
    elif source.sub_daily:
        rows = daily_mean(rows, {c: c for c in source.outputs}, dense=dense)
    else:
        rows = rows.withColumn("date", utc_day("time"))

    stamp = F.current_timestamp() if ingested_at is None else F.lit(ingested_at).cast("timestamp")
    rows = rows.withColumns({"source": F.lit(source.label), "ingested_at": stamp})
    if lon_domain is not None:
        rows = rows.withColumn("lon", in_domain("lon", lon_domain))
    require_columns(rows, source.columns, f"{source.name} table rows")
    rows = rows.select(*source.columns)
    return guard_non_nulls(rows, source.required, f"{source.name} table rows") if guard else rows
