"""The same results in DuckDB SQL, written from the definitions and not from the Spark plans."""

from __future__ import annotations

from workload import fixtures as fx


def _cte(**texts: str) -> str:
    """WITH list; ``{table}`` in a fixture becomes the table's or the CTE's name."""
    return "WITH " + ",\n".join(f"{n} AS ({fx.TABLE.sub(lambda m: m[1], t)})" for n, t in texts.items())


def r6(expr: str, name: str) -> str:
    return f"round({expr} + {fx.OFF_TIES}, 6) + 0.0 AS {name}"


L = dict(l_sst=fx.L_SST, l_waves=fx.L_WAVES, l_chl=fx.L_CHL_DUCK)
E = dict(e=fx.E_BASE, e_sst=fx.E_SST, e_waves=fx.E_WAVES, e_chl=fx.E_CHL_DUCK)

DAYS = "CAST(unnest(generate_series(period_start_date, period_end_date, INTERVAL 1 DAY)) AS DATE)"


def _base_ctes(sst: str, waves: str, chl: str) -> dict[str, str]:
    """All values of all sources as (measure, day, region, value), and from that one row per region-day,
    numbered, with the rows of each seven-row frame averaged."""
    pivot = ", ".join(f"avg(value) FILTER (measure = '{k}') AS {c}" for k, c in MEANS.items())
    frame = ", ".join(f"avg(y.{c}) AS {k}_avg, stddev_samp(y.{c}) AS {k}_dev" for k, c in MEANS.items())
    return dict(
        composites=f"""SELECT region_id, period_start_date, period_end_date, avg(chl_mg_m3) AS value FROM {chl}
                       GROUP BY region_id, period_start_date, period_end_date""",
        stacked=f"""SELECT 'sst' AS measure, date, region_id, sst_c AS value FROM {sst}
                    UNION ALL SELECT 'swh', date, region_id, swh_m FROM {waves}
                    UNION ALL SELECT 'peak_period', date, region_id, peak_period_s FROM {waves}
                    UNION ALL SELECT 'chl', {DAYS}, region_id, value FROM composites""",
        base=f"SELECT date, region_id, {pivot} FROM stacked GROUP BY date, region_id",
        numbered="SELECT *, (SELECT count(*) FROM base b WHERE b.region_id = a.region_id AND b.date <= a.date) AS i FROM base a",
        framed=f"""SELECT x.region_id, x.i, {frame} FROM numbered x JOIN numbered y
                   ON y.region_id = x.region_id AND y.i > x.i - 7 AND y.i <= x.i GROUP BY x.region_id, x.i""",
    )


MEANS = {"sst": "sst_c_mean", "swh": "swh_m_mean", "peak_period": "peak_period_s_mean", "chl": "chl_mg_m3_mean"}
BASE_COLS = ", ".join(r6(f"x.{c}", c) for c in MEANS.values())
LAGS = ", ".join(r6(f"p.{c}", f"{k}_lag1") for k, c in MEANS.items())
DIFFS = ", ".join(r6(f"x.{c} - p.{c}", f"{k}_diff1") for k, c in MEANS.items())
ROLLS = ", ".join(r6(f"f.{k}_avg", f"{k}_ma7") + ", " + r6(f"f.{k}_dev", f"{k}_sd7") for k in MEANS)
CALENDAR = "dayofyear(x.date) AS doy, month(x.date) AS month"
AROUND = """FROM numbered x JOIN framed f ON f.region_id = x.region_id AND f.i = x.i
LEFT JOIN numbered p ON p.region_id = x.region_id AND p.i = x.i - 1"""
FEATURES = f"SELECT x.date, x.region_id, {BASE_COLS}, {LAGS}, {DIFFS}, {ROLLS}, {CALENDAR} {AROUND}"

GAPS = dict(l_sst=fx.GAP_SST, l_waves=fx.GAP_WAVES, l_chl=fx.L_CHL_DUCK)
GAP_BASE = _cte(**GAPS, **_base_ctes("l_sst", "l_waves", "l_chl"))
L_BASE = _cte(**L, **_base_ctes("l_sst", "l_waves", "l_chl"))

WAVES_LABEL = "'PacIOOS_WW3_Global_via_ERDDAP_NWW3_Global_Best' AS source"


def _masked_waves(rows: str) -> str:
    return f"""SELECT time, region_id, latitude AS lat, longitude AS lon,
        CASE WHEN Thgt < 9e35 AND Thgt BETWEEN 0 AND 40 THEN Thgt END AS swh,
        CASE WHEN Tper < 9e35 AND Tper BETWEEN 0 AND 60 THEN Tper END AS period FROM {rows}"""


WAVE_DAYS = """SELECT CAST(time AS DATE) AS date, region_id, lat, lon, avg(swh) AS swh_m, avg(period) AS peak_period_s
               FROM masked GROUP BY ALL"""
DENSE = dict(
    daily=WAVE_DAYS,
    span="SELECT region_id, min(date) AS lo, max(date) AS hi FROM daily GROUP BY region_id",
    cells="SELECT DISTINCT region_id, lat, lon FROM daily",
    wanted="""SELECT region_id, lat, lon, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date
              FROM cells JOIN span USING (region_id)""",
    dense="""SELECT date, region_id, lat, lon, swh_m, peak_period_s
             FROM wanted LEFT JOIN daily USING (region_id, lat, lon, date)""",
)
E_STANDARD = dict(
    std_sst="""SELECT CAST(time AS DATE) AS date, region_id, CASE WHEN sst < 9e35 THEN sst END AS sst_c FROM e_sst""",
    std_chl="""SELECT time - 3 AS period_start_date, time + 4 AS period_end_date, region_id,
               CASE WHEN chlorophyll < 9e35 THEN chlorophyll END AS chl_mg_m3 FROM e_chl""",
    masked=_masked_waves("e_waves"),
    **DENSE,
)
E_FEATURES = _cte(**E, **E_STANDARD, **_base_ctes("std_sst", "dense", "std_chl")) + "\n" + FEATURES

LON = "CAST((l_partkey * 31 + l_suppkey) % 10801 AS DOUBLE) / 10 - 540"


def _mod360(x: str) -> str:
    return f"((({x}) % 360 + 360) % 360)"


SEAM = f"""SELECT box_id, lon_max - lon_min >= 360 AS whole, {_mod360('lon_min')} AS a, {_mod360('lon_max')} AS b FROM boxes"""

SQL: dict[str, str] = {
    "region_daily_features": f"{GAP_BASE}\n{FEATURES}",
    "region_daily_base": f"{GAP_BASE}\nSELECT date, region_id, {BASE_COLS} FROM base x",
    "features_end_to_end": E_FEATURES,
    "load_jobs": E_FEATURES,
    "create_or_replace": f"{L_BASE}\nSELECT date, region_id, {BASE_COLS} FROM base x",
    "sst_region_daily_mean": f"{L_BASE}\nSELECT date, region_id, {r6('avg(value)', 'sst_c_mean')} FROM stacked WHERE measure = 'sst' GROUP BY date, region_id",
    "one_region_daily_mean":
        f"""{L_BASE}
SELECT date, region_id, {r6('avg(value)', 'sst_c_mean')} FROM stacked
WHERE measure = 'sst' AND region_id = 'NTT' GROUP BY date, region_id""",
    "waves_region_daily_mean": f"""{L_BASE}
SELECT date, region_id, {r6("avg(value) FILTER (measure = 'swh')", 'swh_m_mean')},
       {r6("avg(value) FILTER (measure = 'peak_period')", 'peak_period_s_mean')}
FROM stacked WHERE measure IN ('swh', 'peak_period') GROUP BY date, region_id""",
    "chl_window_mean": f"""{L_BASE}
SELECT region_id, period_start_date, period_end_date, {r6('value', 'chl_mg_m3_window_mean')} FROM composites""",
    "chl_dailyize": f"{L_BASE}\nSELECT date, region_id, {r6('avg(value)', 'chl_mg_m3_mean')} FROM stacked WHERE measure = 'chl' GROUP BY date, region_id",
    "observed_calendar": f"{GAP_BASE}\nSELECT DISTINCT date, region_id FROM stacked",
    "lag_diff": f"{GAP_BASE}\nSELECT x.date, x.region_id, {LAGS}, {DIFFS} {AROUND}",
    "rolling_7": f"{GAP_BASE}\nSELECT x.date, x.region_id, {ROLLS} {AROUND}",
    "calendar_signals": f"{L_BASE}\nSELECT date, region_id, {CALENDAR} FROM base x",
    "sst_standard": f"""{_cte(**E)}
SELECT CAST(time AS DATE) AS date, region_id, latitude AS lat, longitude AS lon,
       {r6('CASE WHEN sst < 9e35 THEN sst END', 'sst_c')}, 'NOAA_OISST_v2_1_via_ERDDAP' AS source
FROM e_sst WHERE zlev = 0""",
    "chl_standard": f"""{_cte(**E)}
SELECT time - 3 AS period_start_date, time + 4 AS period_end_date, region_id, latitude AS lat, longitude AS lon,
       {r6('CASE WHEN chlorophyll < 9e35 THEN chlorophyll END', 'chl_mg_m3')},
       'NOAA_ERDDAP_erdMBchla8day_LonPM180' AS source
FROM e_chl WHERE time - 3 <= DATE '2024-01-18' AND time + 4 >= DATE '2024-01-09'""",
    "waves_standard": f"""{_cte(**E, masked=_masked_waves('e_waves'), daily=WAVE_DAYS)}
SELECT date, region_id, lat, lon, {r6('swh_m', 'swh_m')}, {r6('peak_period_s', 'peak_period_s')}, {WAVES_LABEL}
FROM daily WHERE date BETWEEN DATE '2024-01-02' AND DATE '2024-01-29'""",
    "waves_standard_dense": f"""{_cte(
        **E, gappy="SELECT * FROM e_waves WHERE CAST(time AS DATE) <> DATE '2024-01-15'",
        masked=_masked_waves('gappy'), **DENSE)}
SELECT date, region_id, lat, lon, {r6('swh_m', 'swh_m')}, {r6('peak_period_s', 'peak_period_s')}, {WAVES_LABEL}
FROM dense""",
    "fill_to_null": f"""{_cte(**E)}
SELECT time, region_id, latitude, longitude,
       {r6('CASE WHEN Thgt < 9e35 THEN Thgt END', 'thgt_undeclared')},
       {r6('NULLIF(Tper, -1)', 'tper_declared')},
       {r6('CASE WHEN Thgt < 9e35 THEN Thgt END', 'thgt_unusable')}
FROM e_waves""",
    "range_mask": f"""{_cte(**E, masked=_masked_waves('e_waves'))}
SELECT time, region_id, lat AS latitude, lon AS longitude, {r6('swh', 'swh_m')}, {r6('period', 'peak_period_s')}
FROM masked""",
    "grid_to_long": f"""{_cte(
        e=fx.E_BASE, hourly=fx.E_HOURLY,
        days="SELECT DISTINCT region_id, CAST(time AS DATE) AS day FROM hourly",
        hours='''SELECT region_id, unnest(generate_series(CAST(day AS TIMESTAMP), CAST(day AS TIMESTAMP) + INTERVAL 23 HOUR,
                 INTERVAL 1 HOUR)) AS time FROM days''',
        lats='''SELECT region_id, time, unnest([0, 1, 2]) + CASE region_id WHEN 'NTT' THEN -10.0::DOUBLE ELSE 18 END
                AS latitude FROM hours''',
        cells='''SELECT region_id, time, latitude,
                 unnest([0, 1, 2, 3, 4]) + CASE region_id WHEN 'NTT' THEN 120.0::DOUBLE ELSE 199 END AS longitude FROM lats''')}
SELECT region_id, time, latitude AS lat, longitude AS lon, {r6('v_mean', 'v_mean')}, {r6('v_max', 'v_max')}
FROM cells LEFT JOIN hourly USING (region_id, time, latitude, longitude)""",
    "measures_align": f"""{_cte(
        e=fx.E_BASE,
        swh_rows='''SELECT ts AS time, event_id, region_id, latitude AS lat, longitude AS lon, value / 5 AS swh
                    FROM e WHERE event_type IN ('click', 'purchase', 'view')''',
        period_rows='''SELECT ts AS time, event_id, region_id, latitude AS lat, longitude AS lon,
                       CAST(event_id % 70 AS DOUBLE) AS period FROM e WHERE event_type IN ('click', 'error', 'signup')''')}
SELECT time, event_id, region_id, lat, lon, {r6('swh', 'swh')}, {r6('period', 'period')}
FROM swh_rows FULL OUTER JOIN period_rows USING (time, event_id, region_id, lat, lon)""",
    "level_select": f"""{_cte(e=fx.E_BASE)}
SELECT event_id, region_id, {r6('value', 'value')} FROM e WHERE event_type = 'click'""",
    "lon_360": f"""SELECT l_orderkey, l_linenumber, {r6(LON, 'lon')}, {r6(_mod360(LON), 'lon_360')},
       {r6(_mod360(f'{LON} + 180') + ' - 180', 'lon_pm180')} FROM lineitem""",
    "lon_seam_split": f"""{_cte(boxes=fx.C_BOXES, ab=SEAM)}
SELECT box_id, {r6('CASE WHEN whole THEN 0.0::DOUBLE ELSE a END', 'lon_lo')},
       {r6('CASE WHEN whole OR a > b THEN 360.0::DOUBLE ELSE b END', 'lon_hi')} FROM ab
UNION ALL
SELECT box_id, 0.0::DOUBLE AS lon_lo, {r6('b', 'lon_hi')} FROM ab WHERE NOT whole AND a > b""",
    "bbox_subset": f"""{_cte(p=fx.G_POINTS)}
SELECT l_orderkey, l_linenumber, {r6('lat', 'lat')}, {r6('lon', 'lon')} FROM p
WHERE (lat BETWEEN -7 AND 18 AND lon BETWEEN 170 AND 190)
   OR (lat BETWEEN -5 AND 5 AND (lon >= 350 OR lon <= 10))""",
    "region_assign": f"""{_cte(
        p=fx.G_POINTS, nations=fx.G_BOXES,
        boxes='''SELECT region_id, lat_min, lat_max, lon_min, lon_max FROM nations UNION ALL
                 SELECT * FROM (VALUES ('NTT', -10, -7, 120, 125), ('HAWAII', 18, 23, -161, -154),
                 ('SEAM', -5, 5, -10, 10), ('DATELINE', -5, 5, 170, -170))''',
        ab=f"SELECT *, {_mod360('lon_min')} AS a, {_mod360('lon_max')} AS b FROM boxes")}
SELECT region_id, l_orderkey, l_linenumber, {r6('lat', 'lat')}, {r6('lon', 'lon')}
FROM p JOIN ab ON lat BETWEEN least(lat_min, lat_max) AND greatest(lat_min, lat_max)
   AND ((a <= b AND lon BETWEEN a AND b) OR (a > b AND (lon >= a OR lon <= b)))""",
    "lon_pieces_concat": f"""{_cte(**L)}
SELECT date, region_id, {r6('lat', 'lat')}, {r6('lon', 'lon')}, {r6('sst_c', 'sst_c')}, how
FROM l_sst, (VALUES ('scan'), ('concat')) AS h(how)""",
    "utc_window": "SELECT event_id, ts FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-19'",
    "month_range": """SELECT DISTINCT year(o_orderdate) AS year, month(o_orderdate) AS month,
       CAST(date_trunc('month', o_orderdate) AS DATE) AS d0, last_day(CAST(o_orderdate AS DATE)) AS d1 FROM orders""",
    "day_filter": f"""{_cte(**L)}
SELECT date, region_id, lat, lon, {r6('sst_c', 'sst_c')} FROM l_sst
WHERE date BETWEEN DATE '1996-02-10' AND DATE '1996-08-12'""",
    "period_overlap": f"""{_cte(**L)}
SELECT period_start_date, period_end_date, region_id, lat, lon, {r6('chl_mg_m3', 'chl_mg_m3')} FROM l_chl
WHERE NOT (period_end_date < DATE '1996-02-01' OR period_start_date > DATE '1996-08-29')""",
    "coerce_schema": f"""WITH t AS (SELECT
       CASE l_linenumber WHEN 1 THEN 'not a day' ELSE CAST(CAST(l_shipdate AS DATE) AS VARCHAR) END AS date,
       CASE l_linenumber WHEN 2 THEN 'n/a' WHEN 3 THEN '1d' ELSE CAST(l_quantity AS VARCHAR) END AS quantity,
       CASE l_linenumber WHEN 3 THEN '1.7' WHEN 4 THEN 'x' WHEN 5 THEN '12.0' ELSE CAST(l_orderkey AS VARCHAR) END
           AS order_key,
       CASE l_linenumber WHEN 6 THEN '24 o''clock'
           ELSE CAST(CAST(l_shipdate AS DATE) AS VARCHAR) || ' 06:30:00' END AS shipped_at,
       l_extendedprice / 3 AS third, l_orderkey AS label, l_returnflag AS shape FROM lineitem)
SELECT TRY_CAST(date AS DATE) AS date, {r6('TRY_CAST(quantity AS DOUBLE)', 'quantity')},
       CASE WHEN TRY_CAST(order_key AS DOUBLE) = floor(TRY_CAST(order_key AS DOUBLE))
            THEN TRY_CAST(order_key AS BIGINT) END AS order_key,
       TRY_CAST(shipped_at AS TIMESTAMP) AS shipped_at,
       CASE WHEN third = floor(third) THEN CAST(third AS BIGINT) END AS third,
       CAST(label AS VARCHAR) AS label, shape FROM t""",
    "null_key_rows": """SELECT count(*) FILTER (WHERE l_linenumber = 1) AS date_missing,
       count(*) FILTER (WHERE l_linenumber = 2) AS region_id_missing,
       count(*) FILTER (WHERE l_linenumber IN (3, 4)) AS lat_missing,
       count(*) FILTER (WHERE l_suppkey % 10 = 3) AS lon_missing,
       count(*) FILTER (WHERE l_linenumber <= 4 OR l_suppkey % 10 = 3) AS bad_rows FROM lineitem""",
    "request_check": """WITH r AS (SELECT DISTINCT ['NTT', 'HAWAII', 'ATLANTIS'][o_custkey % 3 + 1] AS region_id,
           year(o_orderdate) + o_custkey % 5 * 9 - 18 AS year, o_orderkey % 15 AS month FROM orders),
     c AS (SELECT *, CASE WHEN month NOT BETWEEN 1 AND 12 THEN 'no such month'
                          WHEN year < 1980 OR year > 2010 THEN 'year not covered'
                          WHEN region_id = 'ATLANTIS' THEN 'no region ATLANTIS' END AS reason,
                  CASE WHEN month BETWEEN 1 AND 12 THEN make_date(year, month, 1) END AS d0 FROM r)
SELECT region_id, year, month, d0, last_day(d0) AS d1, reason IS NULL AS valid, reason FROM c""",
    "qa_sst": f"""{_cte(**L)}
SELECT region_id, min(date) AS min_date, max(date) AS max_date, count(*) AS n_rows, count(DISTINCT date) AS n_days,
       {r6('count(*) FILTER (WHERE sst_c IS NULL) / NULLIF(count(*), 0)', 'frac_null_sst')},
       {r6('count(*) FILTER (WHERE sst_c < 0 OR sst_c > 40) / NULLIF(count(*), 0)', 'frac_out_of_range_sst')}
FROM l_sst GROUP BY region_id""",
    "qa_waves": f"""{_cte(**L)}
SELECT region_id, min(date) AS min_date, max(date) AS max_date, count(*) AS n_rows, count(DISTINCT date) AS n_days,
       {r6('count(*) FILTER (WHERE swh_m IS NULL) / NULLIF(count(*), 0)', 'frac_null_swh')},
       {r6('count(*) FILTER (WHERE peak_period_s IS NULL) / NULLIF(count(*), 0)', 'frac_null_peak_period')}
FROM l_waves GROUP BY region_id""",
    "qa_chl": f"""{_cte(**L)}
SELECT region_id, min(period_start_date) AS min_start, max(period_end_date) AS max_end, count(*) AS n_rows,
       count(DISTINCT CAST(period_start_date AS VARCHAR) || ':' || CAST(period_end_date AS VARCHAR)) AS n_windows,
       {r6('count(*) FILTER (WHERE chl_mg_m3 IS NULL) / NULLIF(count(*), 0)', 'frac_null_chl')}
FROM l_chl GROUP BY region_id""",
    **{
        f"load_check_{s}": f"""{_cte(**L)}
SELECT region_id, count(*) AS n_rows, min({lo}) AS {names[0]}, max({hi}) AS {names[1]} FROM l_{s}
WHERE {lo} BETWEEN DATE '1996-03-01' AND DATE '1997-10-31' GROUP BY region_id"""
        for s, lo, hi, names in (
            ("sst", "date", "date", ("min_date", "max_date")),
            ("waves", "date", "date", ("min_date", "max_date")),
            ("chl", "period_start_date", "period_end_date", ("min_start", "max_end")),
        )
    },
    "profile_grid": f"""{_cte(**L)}
SELECT count(*) AS n_rows, min(date) AS min_date, max(date) AS max_date,
       count(DISTINCT lat) AS unique_lat, count(DISTINCT lon) AS unique_lon FROM l_sst""",
    "profile_chl": f"""{_cte(**L)}
SELECT count(*) AS n_rows, min(period_start_date) AS min_start, max(period_end_date) AS max_end,
       (SELECT count(*) FROM (SELECT DISTINCT period_start_date, period_end_date FROM l_chl)) AS unique_windows
FROM l_chl""",
    "append_load": f"""{_cte(**L)}
SELECT date, region_id, lat, lon, {r6('swh_m', 'swh_m')}, {r6('peak_period_s', 'peak_period_s')}, {WAVES_LABEL}
FROM l_waves""",
    "standard_scan": f"""{_cte(**L)}
SELECT date, region_id, lat, lon, {r6('sst_c', 'sst_c')}, 'NOAA_OISST_v2_1_via_ERDDAP' AS source FROM l_sst
WHERE region_id = 'NTT' AND date BETWEEN DATE '1996-02-10' AND DATE '1997-08-12'""",
    "replace_days": f"""{_cte(**L)}
SELECT date, region_id, lat, lon,
       {r6('''sst_c + CASE WHEN date BETWEEN DATE '1996-02-01' AND DATE '1996-03-31'
              OR (date BETWEEN DATE '1998-01-10' AND DATE '1998-01-20' AND region_id = 'HAWAII') THEN 100 ELSE 0 END''',
           'sst_c')}
FROM l_sst WHERE NOT (region_id = 'NTT' AND date BETWEEN DATE '1997-05-01' AND DATE '1997-05-31')""",
    "replace_overlap": f"""{_cte(**L)}
SELECT period_start_date, period_end_date, region_id, lat, lon,
       {r6('''chl_mg_m3 + CASE WHEN region_id <> 'NTT' THEN 0
              WHEN period_start_date <= DATE '1996-03-31' AND period_end_date >= DATE '1996-03-01' THEN 1000
              WHEN period_start_date <= DATE '1996-02-29' AND period_end_date >= DATE '1996-02-01' THEN 100
              ELSE 0 END''', 'chl_mg_m3')}
FROM l_chl""",
    "dry_run": f"{_cte(**L)}\nSELECT count(*) AS rows_ready, CAST(0 AS BIGINT) AS rows_written FROM l_sst",
    "run_ledger": f"""{_cte(**L)},
k AS (SELECT unnest([1, 2, 3]) AS k), n AS (SELECT count(*) AS rows FROM l_waves)
SELECT 'run-' || k AS run_id, 'ingest_waves' AS job_name,
       make_timestamp(2024, 2, k, 18, 40, 9.080706) AS start_ts, make_timestamp(2024, 2, k, 18, 41, 0) AS end_ts,
       CASE k WHEN 3 THEN 'FAILED' ELSE 'SUCCESS' END AS status,
       CASE k WHEN 1 THEN rows ELSE 0 END AS rows_written,
       CASE k WHEN 1 THEN repeat('n', 1000) WHEN 2 THEN 'dry_run=True'
              ELSE 'job=ingest_waves run_id=run-3 err=' || left('ValueError: broken ' || repeat('x', 600), 500) END AS notes,
       '2024-02-0' || k || 'T18:40:09.080706Z' AS start_text
FROM k, n""",
    "ingest_assigned": f"""{_cte(
        raw=fx.R_RAW_DUCK,
        boxes="SELECT * FROM (VALUES " + ", ".join(f"('{i}', {b}::DOUBLE, {t}::DOUBLE, {l}::DOUBLE, {r}::DOUBLE)" for i, _, b, t, l, r in fx.R_BOXES)
              + ") AS v(region_id, lat_min, lat_max, lon_min, lon_max)",
        ab=f"SELECT *, {_mod360('lon_min')} AS a, {_mod360('lon_max')} AS b FROM boxes",
        here=f"""SELECT raw.*, region_id, latitude AS lat, longitude AS lon, {_mod360('longitude')} AS x FROM raw JOIN ab
                 ON latitude BETWEEN lat_min AND lat_max
                 AND ((a <= b AND {_mod360('longitude')} BETWEEN a AND b)
                      OR (a > b AND ({_mod360('longitude')} >= a OR {_mod360('longitude')} <= b)))""",
        daily='''SELECT CAST(time AS DATE) AS date, region_id, lat, lon, avg(CASE WHEN Thgt BETWEEN 0 AND 40 THEN Thgt END) AS value,
                   avg(CASE WHEN Tper BETWEEN 0 AND 60 THEN Tper END) AS other FROM here GROUP BY ALL''',
        span="SELECT region_id, date_trunc('month', date) AS m, min(date) AS lo, max(date) AS hi FROM daily GROUP BY ALL",
        cells="SELECT DISTINCT region_id, lat, lon, date_trunc('month', date) AS m FROM daily",
        wanted='''SELECT region_id, lat, lon, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date
                    FROM cells JOIN span USING (region_id, m)''',
        loaded='''SELECT 'sst' AS kind, CAST(time AS DATE) AS date, region_id, lat, lon, sst AS value, sst AS other FROM here
                    UNION ALL SELECT 'chl', CAST(time AS DATE) - 3, region_id, lat, lon, chlorophyll, chlorophyll FROM here
                    UNION ALL SELECT 'waves', date, region_id, lat, lon, value, other
                    FROM wanted LEFT JOIN daily USING (region_id, lat, lon, date)''')}
SELECT kind, date, region_id, {r6('lat', 'lat')}, {r6('lon', 'lon')}, {r6('value', 'value')}, {r6('other', 'other')}
FROM loaded""",
    # a line is a head of 3 to 6 bytes, 12 digits and a line feed
    "landing_triage": """WITH c AS (SELECT event_id // 500 AS chunk, CAST(event_id % 500 >= 20 AS INTEGER) AS part FROM events),
     n AS (SELECT chunk, part, count(*) AS n FROM c GROUP BY chunk, part),
     f AS (SELECT chunk, part, n * (13 + [4, 6, 3, 3, 3][chunk % 5 + 1]) AS size FROM n
           UNION ALL SELECT DISTINCT chunk, 2, NULL FROM c WHERE chunk % 7 = 5)
SELECT chunk * 3 + part AS file, size, COALESCE(size >= 1024 AND chunk % 5 <> 1, FALSE) AS ok,
       CASE WHEN size >= 1024 AND chunk % 5 = 0 THEN 'netcdf4_hdf5'
            WHEN size >= 1024 AND chunk % 5 > 1 THEN 'netcdf_classic' END AS kind,
       CASE WHEN size IS NULL THEN 'missing' WHEN size < 1024 THEN 'too_small'
            WHEN chunk % 5 = 1 THEN 'bad_header' END AS reason
FROM f""",
}
