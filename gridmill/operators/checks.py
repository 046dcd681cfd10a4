"""Checks on frames and on load requests."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmill.functions.days import month_end, month_start
from gridmill.functions.missing import is_missing
from gridmill.operators.regions import lookup_regions
from gridmill.schemas import BAD_ROWS_SHOWN, Source


def require_columns(df: DataFrame, required: Iterable[str], label: str) -> DataFrame:
    """Raise, before any job runs, if columns are missing."""
    missing = set(required) - set(df.columns)
    if missing:
        raise ValueError(f"{label}: no columns {sorted(missing)} among {sorted(df.columns)}")
    return df


def _missing(df: DataFrame, name: str) -> Column:
    return is_missing(name, df.schema[name].dataType)


def missing_counts(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """One row: missing values per column, and rows with at least one. A single pass."""
    columns = list(columns)
    flags = {c: _missing(df, c) for c in columns}
    any_missing = reduce(lambda a, b: a | b, flags.values())
    return df.agg(
        *[F.count_if(flag).alias(f"{c}_missing") for c, flag in flags.items()],
        F.count_if(any_missing).alias("bad_rows"),
    )


def bad_rows(df: DataFrame, columns: Iterable[str], n: int = BAD_ROWS_SHOWN) -> DataFrame:
    """The first rows with a missing value in a required column, for an error message."""
    return df.where(reduce(lambda a, b: a | b, [_missing(df, c) for c in columns])).limit(n)


def null_error(df: DataFrame, columns: Iterable[str], label: str) -> ValueError | None:
    rows = bad_rows(df, columns).collect()
    if not rows:
        return None
    return ValueError(f"{label}: required values are missing, as in\n" + "\n".join(str(r.asDict()) for r in rows))


def require_non_nulls(df: DataFrame, columns: Iterable[str], label: str) -> DataFrame:
    """Raise if a required column has a missing value. Runs a job that stops at the first ten."""
    error = null_error(df, columns, label)
    if error:
        raise error
    return df


def guard_non_nulls(df: DataFrame, columns: Iterable[str], label: str) -> DataFrame:
    """As ``require_non_nulls``, but inside the job that consumes the frame.

    A missing value fails the task, so a write aborts and leaves nothing behind, without a
    separate pass over the data.
    """
    def guarded(name: str) -> Column:
        message = F.lit(f"{label}: required values are missing: {name}")
        failed = F.raise_error(message).cast(df.schema[name].dataType)
        return F.when(_missing(df, name), failed).otherwise(F.col(name))

    return df.withColumns({c: guarded(c) for c in columns})


def check_requests(
    requests: DataFrame, regions: DataFrame, source: Source, today: dt.date | None = None
) -> DataFrame:
    """Requests (region_id, year, month) with their day range, ``valid`` and a ``reason``.

    The month must be 1..12, the year inside what the source covers, the region known; the
    first failed check gives the reason.
    """
    last_year = (today or dt.date.today()).year + source.years_ahead
    reason = (
        F.when(F.col("month").isNull() | ~F.col("month").between(1, 12), "no such month")
        .when(F.col("year").isNull() | ~F.col("year").between(source.first_year, last_year), "year not covered")
        .when(~F.col("region_known"), F.concat(F.lit("no region "), F.coalesce("region_id", F.lit("null"))))
    )
    known = lookup_regions(requests, regions.select("region_id"))
    return known.select(
        "region_id",
        "year",
        "month",
        month_start("year", "month").alias("d0"),
        month_end("year", "month").alias("d1"),
        reason.isNull().alias("valid"),
        reason.alias("reason"),
    )
