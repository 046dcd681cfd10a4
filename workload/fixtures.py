"""Inputs in the engine's schemas, derived from the driver's tables.

L (volume): standard tables over 1995-2001 from ``lineitem`` and ``orders``. E (raw, sub-daily):
January 2024 from ``events``. The texts are input definitions only and run in both engines;
where the dialects differ there are two. ``{name}`` stands for a driver table.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

L_SST = """
SELECT CAST(l_shipdate AS DATE) AS date,
       CASE WHEN l_suppkey % 2 = 0 THEN 'NTT' ELSE 'HAWAII' END AS region_id,
       CAST(-10 AS DOUBLE) + CAST(l_partkey % 13 AS DOUBLE) / 4 AS lat,
       CAST(120 AS DOUBLE) + CAST(l_partkey % 21 AS DOUBLE) / 4 AS lon,
       CASE WHEN l_linenumber = 7 THEN NULL ELSE l_quantity END AS sst_c
FROM {lineitem}
"""
# for what depends on gaps in a series: days that one source lacks
GAP_SST = f"SELECT * FROM ({L_SST}) x WHERE day(date) NOT IN (13, 14)"

L_WAVES = """
SELECT CAST(o_orderdate AS DATE) AS date,
       CASE WHEN o_custkey % 2 = 0 THEN 'NTT' ELSE 'HAWAII' END AS region_id,
       CAST(-10 AS DOUBLE) + CAST(o_custkey % 3 AS DOUBLE) AS lat,
       CAST(120 AS DOUBLE) + CAST(o_custkey % 5 AS DOUBLE) AS lon,
       CASE WHEN o_orderkey % 11 = 0 OR o_totalprice > 400000 THEN NULL ELSE o_totalprice / 10000 END AS swh_m,
       CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE CAST(o_orderkey % 60 AS DOUBLE) END AS peak_period_s
FROM {orders}
"""
GAP_WAVES = f"SELECT * FROM ({L_WAVES}) x WHERE day(date) <> 20"

_L_CHL_CELLS = """
             CASE WHEN l_suppkey % 2 = 0 THEN 'NTT' ELSE 'HAWAII' END AS region_id,
             CAST(-10 AS DOUBLE) + CAST(l_partkey % 13 AS DOUBLE) / 4 AS lat,
             CAST(120 AS DOUBLE) + CAST(l_partkey % 21 AS DOUBLE) / 4 AS lon,
             CASE WHEN l_linenumber IN (3, 4) THEN NULL ELSE l_extendedprice / 1000 END AS chl_mg_m3
      FROM {lineitem}) x
"""
L_CHL = """
SELECT date_sub(center, 3) AS period_start_date, date_add(center, 4) AS period_end_date,
       region_id, lat, lon, chl_mg_m3
FROM (SELECT date_add(DATE'1995-01-05', CAST(8 * floor(datediff(CAST(l_shipdate AS DATE), DATE'1995-01-01') / 8)
                      + CASE WHEN l_linenumber = 6 THEN 4 ELSE 0 END AS INT)) AS center,""" + _L_CHL_CELLS
L_CHL_DUCK = """
SELECT center - 3 AS period_start_date, center + 4 AS period_end_date,
       region_id, lat, lon, chl_mg_m3
FROM (SELECT DATE '1995-01-05' + CAST(8 * floor(date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) / 8)
                      + CASE WHEN l_linenumber = 6 THEN 4 ELSE 0 END AS INTEGER) AS center,""" + _L_CHL_CELLS

E_BASE = """
SELECT event_id, ts, event_type, value,
       CASE WHEN user_id % 2 = 0 THEN 'NTT' ELSE 'HAWAII' END AS region_id,
       CAST(CASE WHEN user_id % 2 = 0 THEN -10 + user_id % 3 ELSE 18 + user_id % 3 END AS DOUBLE) AS latitude,
       CAST(CASE WHEN user_id % 2 = 0 THEN 120 + user_id % 5 ELSE 199 + user_id % 5 END AS DOUBLE) AS longitude
FROM {events}
"""

E_SST = """
SELECT ts AS time, region_id, latitude, longitude, CAST(0 AS DOUBLE) AS zlev,
       CASE WHEN event_id % 13 = 0 THEN CAST('9.96921e36' AS DOUBLE) ELSE value / 10 END AS sst
FROM {e}
"""

E_WAVES = """
SELECT ts AS time, region_id, latitude, longitude, CAST(0 AS DOUBLE) AS depth,
       CASE WHEN event_id % 11 = 0 THEN CAST('9.96921e36' AS DOUBLE) ELSE value / 5 END AS Thgt,
       CASE WHEN event_id % 17 = 0 THEN CAST(-1 AS DOUBLE) ELSE CAST(event_id % 70 AS DOUBLE) END AS Tper
FROM {e}
"""

_E_CHL_CELLS = """
       region_id, latitude, longitude, CAST(0 AS DOUBLE) AS altitude,
       CASE WHEN event_id % 7 = 0 THEN CAST('9.96921e36' AS DOUBLE) ELSE value / 100 END AS chlorophyll
FROM {e}
"""
E_CHL = """
SELECT date_add(DATE'2024-01-04', CAST(8 * floor(datediff(CAST(ts AS DATE), DATE'2024-01-01') / 8)
                + CASE WHEN event_id % 29 = 0 THEN 2 ELSE 0 END AS INT)) AS time,""" + _E_CHL_CELLS
E_CHL_DUCK = """
SELECT DATE '2024-01-04' + CAST(8 * floor(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) / 8)
                + CASE WHEN event_id % 29 = 0 THEN 2 ELSE 0 END AS INTEGER) AS time,""" + _E_CHL_CELLS

# one grid cell-hour of E, for grids: mean and maximum of the values
E_HOURLY = """
SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS time, region_id, latitude, longitude,
       avg(value) AS v_mean, max(value) AS v_max
FROM {e}
GROUP BY 1, 2, 3, 4
"""

# global points for the point-in-box join, longitudes 0..360
G_POINTS = """
SELECT l_orderkey, l_linenumber,
       CAST(l_partkey % 1400 AS DOUBLE) / 10 - 70 AS lat,
       CAST((l_suppkey * 7919 + l_partkey) % 3600 AS DOUBLE) / 10 AS lon
FROM {lineitem}
"""

# boxes of all kinds: plain, across Greenwich, across the date line, reversed latitudes
G_BOXES = """
SELECT 'N' || CAST(n_nationkey AS STRING) AS region_id, n_name AS name,
       CAST(n_nationkey * 17 % 120 - 50 AS DOUBLE) AS lat_min,
       CAST(n_nationkey * 17 % 120 - 60 AS DOUBLE) AS lat_max,
       CAST(n_nationkey * 53 % 360 - 180 AS DOUBLE) AS lon_min,
       CAST((n_nationkey * 53 % 360 + 20) % 360 - 180 AS DOUBLE) AS lon_max
FROM {nation}
"""

# longitude ranges between -360 and 720, some wider than the circle
C_BOXES = """
SELECT c_custkey AS box_id, 'box' AS name,
       CAST(0 AS DOUBLE) AS lat_min, CAST(1 AS DOUBLE) AS lat_max,
       CAST(c_custkey * 37 % 720 - 360 AS DOUBLE) AS lon_min,
       CAST(c_custkey * 37 % 720 - 360 + c_custkey * 13 % 401 AS DOUBLE) AS lon_max
FROM {customer}
"""

# raw rows without a region over more than a year: positions on and off the edges of the boxes below, in both
# longitude domains
R_LATS = (-10.1, -8.0, -7.3, -5.0, 0.0, 5.0, 5.2, 6.0)
R_LONS = (120.25, 125.5, -10.1, 349.9, 0.0, 10.2, 10.3, 170.5, -170.5, 189.5, 180.0)
R_BOXES = (("FRAC", "fractions", -10.1, -7.3, 120.25, 125.5), ("GREEN", "seam", -5.0, 5.2, -10.1, 10.2),
           ("LINE", "date line", -5.0, 5.0, 170.5, -170.5))


def _pick(values: tuple, index: str) -> str:
    cases = " ".join(f"WHEN {k} THEN CAST('{v}' AS DOUBLE)" for k, v in enumerate(values))
    return f"CASE {index} {cases} END"


def r_raw(later: str) -> str:
    """``later`` is the dialect's interval of ``event_id % 400`` days."""
    return f"""
SELECT ts + {later} AS time, {_pick(R_LATS, f'event_id % {len(R_LATS)}')} AS latitude,
       {_pick(R_LONS, f'event_id % {len(R_LONS)}')} AS longitude, CAST(0 AS DOUBLE) AS zlev, CAST(0 AS DOUBLE) AS depth,
       CAST(0 AS DOUBLE) AS altitude, value / 10 AS sst, value / 100 AS chlorophyll, value / 5 AS Thgt,
       CAST(event_id % 70 AS DOUBLE) AS Tper
FROM {{events}}
"""


R_RAW = r_raw("make_dt_interval(CAST(event_id % 400 AS INT))")
R_RAW_DUCK = r_raw("to_days(CAST(event_id % 400 AS INTEGER))")

# added before rounding, see ``queries.rounded``
OFF_TIES = 3.1e-9

TABLE = re.compile(r"\{(\w+)\}")


class Inputs:
    """The fixtures as DataFrames over one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:  # listing and schema once per query
            self._tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    def sql(self, text: str, **frames: DataFrame) -> DataFrame:
        """Spark SQL with ``{name}`` read from the driver's tables unless given as a frame."""
        for name in set(TABLE.findall(text)) - set(frames):
            frames[name] = self.e if name == "e" else self.table(name)
        return self.spark.sql(text, **frames)

    @property
    def e(self) -> DataFrame:
        return self.sql(E_BASE)

    @property
    def sst(self) -> DataFrame:
        return self.sql(L_SST)

    @property
    def waves(self) -> DataFrame:
        return self.sql(L_WAVES)

    @property
    def gap_sst(self) -> DataFrame:
        return self.sql(GAP_SST)

    @property
    def gap_waves(self) -> DataFrame:
        return self.sql(GAP_WAVES)

    @property
    def chl(self) -> DataFrame:
        return self.sql(L_CHL)

    @property
    def raw_sst(self) -> DataFrame:
        return self.sql(E_SST)

    @property
    def raw_waves(self) -> DataFrame:
        return self.sql(E_WAVES)

    @property
    def raw_chl(self) -> DataFrame:
        return self.sql(E_CHL)
