"""Longitudes and boxes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DOMAINS = {"360": (0.0, 360.0), "pm180": (-180.0, 180.0)}


def _col(c: Column | str | float) -> Column:
    if isinstance(c, Column):
        return c
    return F.col(c) if isinstance(c, str) else F.lit(float(c))


def lon_360(lon: Column | str | float) -> Column:
    """Longitude in [0, 360). ``pmod``, because ``%`` keeps the sign of values below -360."""
    return F.pmod(_col(lon) + F.lit(360.0), F.lit(360.0))


def lon_pm180(lon: Column | str | float) -> Column:
    """Longitude in [-180, 180)."""
    return F.pmod(_col(lon) + F.lit(180.0), F.lit(360.0)) - F.lit(180.0)


def in_domain(lon: Column | str | float, domain: str) -> Column:
    if domain not in DOMAINS:
        raise ValueError(f"unknown longitude domain {domain!r}")
    return lon_360(lon) if domain == "360" else lon_pm180(lon)


def lon_intervals(lon_min: Column | str | float, lon_max: Column | str | float) -> Column:
    """The longitude range of a box as one or two intervals ``struct(lo, hi)`` in [0, 360].

    A range that crosses the seam at 0 = 360 is split there. A range of 360 degrees or more
    is the whole circle.
    """
    lo, hi = lon_360(lon_min), lon_360(lon_max)

    def interval(a: Column, b: Column) -> Column:
        return F.struct(a.alias("lo"), b.alias("hi"))

    zero, full = F.lit(0.0), F.lit(360.0)
    return (
        F.when(_col(lon_max) - _col(lon_min) >= full, F.array(interval(zero, full)))
        .when(lo <= hi, F.array(interval(lo, hi)))
        .otherwise(F.array(interval(lo, full), interval(zero, hi)))
    )


def lat_in(lat: Column | str, lat_min: Column | str | float, lat_max: Column | str | float) -> Column:
    """Latitude between the bounds, inclusive, in whichever order they are given."""
    lo, hi = _col(lat_min), _col(lat_max)
    return _col(lat).between(F.least(lo, hi), F.greatest(lo, hi))


def lon_in(
    lon: Column | str,
    lon_min: Column | str | float,
    lon_max: Column | str | float,
    domain: str = "360",
) -> Column:
    """Longitude inside the range, seam included, with the data's longitudes left as they are.

    Only the bounds are brought into the data's domain. With literal bounds they fold to
    constants and the predicate reaches the Parquet scan.
    """
    lon = _col(lon)
    lo, hi = in_domain(lon_min, domain), in_domain(lon_max, domain)
    first, last = (F.lit(v) for v in DOMAINS[domain])
    whole = _col(lon_max) - _col(lon_min) >= F.lit(360.0)
    split = lon.between(lo, last) | lon.between(first, hi)
    return whole | ((lo <= hi) & lon.between(lo, hi)) | ((lo > hi) & split)


def box_contains(lat, lon, lat_min, lat_max, lon_min, lon_max, domain: str = "360") -> Column:
    return lat_in(lat, lat_min, lat_max) & lon_in(lon, lon_min, lon_max, domain)
