"""Operators on small frames with known results."""

import datetime as dt
import math

import pytest
from compare import formatted_plan
from pyspark.sql import functions as F

from gridmill.operators import base, checks, features, grid, regions, reports
from gridmill.operators.coerce import coerce
from gridmill.operators.daily import daily_mean
from gridmill.schemas import CHL, SST, SST_DAILY, WAVES
from gridmill.sources.grids import read_grids
from gridmill.sources.regions import read_regions, regions_frame

NAN = float("nan")
D = dt.date


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


# -- grids -------------------------------------------------------------------------------------

T0, T1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 1)


def one_grid(spark):
    a = [float(v) for v in range(12)]
    a[5] = None
    return spark.createDataFrame(
        [([T0, T1], [-10.0, -9.0], [120.0, 121.0, 122.0], a, [v and v * 10 for v in a])],
        "time array<timestamp_ntz>, latitude array<double>, longitude array<double>, a array<double>, b array<double>",
    )


def test_grid_to_long(spark):
    got = rows(grid.grid_to_long(one_grid(spark), ["a", "b"]), "time", "lat", "lon")
    assert len(got) == 12
    assert [r[3] for r in got] == [0.0, 1.0, 2.0, 3.0, 4.0, None, 6.0, 7.0, 8.0, 9.0, 10.0, 11.0]
    assert got[0] == (T0, -10.0, 120.0, 0.0, 0.0)
    assert got[5] == (T0, -9.0, 122.0, None, None)
    assert got[10] == (T1, -9.0, 121.0, 10.0, 100.0)


def test_grid_with_level_axis_and_other_columns(spark):
    g = spark.createDataFrame(
        [("f1", [T0], [0.0, 5.0], [1.0], [7.0, 8.0], [10.0, 11.0, 20.0, 21.0])],
        "file string, time array<timestamp_ntz>, depth array<double>, lat array<double>, lon array<double>, v array<double>",
    )
    long = grid.grid_to_long(g, ["v"], level="depth")
    assert rows(long) == [("f1", T0, 0.0, 1.0, 7.0, 10.0), ("f1", T0, 0.0, 1.0, 8.0, 11.0),
                          ("f1", T0, 5.0, 1.0, 7.0, 20.0), ("f1", T0, 5.0, 1.0, 8.0, 21.0)]
    assert rows(grid.select_level(long, "depth", 5.0)) == [("f1", T0, 1.0, 7.0, 20.0), ("f1", T0, 1.0, 8.0, 21.0)]
    assert grid.select_level(long, "altitude").columns == long.columns


def test_read_grids_from_two_pieces(spark, tmp_path):
    for k, lon in enumerate(([350.0, 355.0], [0.0, 5.0])):
        g = spark.createDataFrame(
            [([T0], [0.0], [1.0], lon, [1.0 + k, 2.0 + k], [5.0, 6.0])],
            "time array<timestamp_ntz>, depth array<double>, latitude array<double>, longitude array<double>, "
            "Thgt array<double>, Tper array<double>",
        )
        g.write.parquet(str(tmp_path / f"piece{k}"))
    long = read_grids(spark, [str(tmp_path / "piece0"), str(tmp_path / "piece1")], WAVES)
    assert [r[1:] for r in rows(long, "lon")] == [
        (0.0, 1.0, 0.0, 2.0, 5.0), (0.0, 1.0, 5.0, 3.0, 6.0), (0.0, 1.0, 350.0, 1.0, 5.0), (0.0, 1.0, 355.0, 2.0, 6.0)
    ]


def test_align_measures(spark):
    a = spark.createDataFrame([(1, 1.0, 1.0, 10.0), (2, 1.0, 1.0, None)], "time int, lat double, lon double, a double")
    b = spark.createDataFrame([(1, 1.0, 1.0, 20.0), (3, 1.0, 1.0, 30.0)], "time int, lat double, lon double, b double")
    assert rows(grid.align_measures({"a": a, "b": b}), "time") == [
        (1, 1.0, 1.0, 10.0, 20.0), (2, 1.0, 1.0, None, None), (3, 1.0, 1.0, None, 30.0)
    ]


def test_standard_axes(spark):
    df = spark.createDataFrame([(1, 2, 3)], "latitude int, longitude int, x int")
    assert grid.standard_axes(df).columns == ["lat", "lon", "x"]
    assert grid.standard_axes(grid.standard_axes(df)).columns == ["lat", "lon", "x"]


# -- regions -----------------------------------------------------------------------------------

BOXES = [
    ("NTT", "", -10.0, -7.0, 120.0, 125.0),
    ("HAWAII", "", 23.0, 18.0, -161.0, -154.0),    # latitudes reversed
    ("SEAM", "", -5.0, 5.0, -10.0, 10.0),
    ("DATELINE", "", -5.0, 5.0, 170.0, -170.0),
    ("BELT", "", -1.0, 1.0, -180.0, 180.0),
]
POINTS = [
    (1, -10.0, 120.0), (2, -6.9, 121.0), (3, 20.0, 199.0), (4, 20.0, -161.0), (5, 0.0, 350.0), (6, 0.0, 0.0),
    (7, 3.0, 10.0), (8, 3.0, 10.5), (9, 3.0, 180.0), (10, 3.0, 190.0), (11, 3.0, -170.0), (12, None, 1.0),
]
EXPECTED = [
    (1, "NTT"), (3, "HAWAII"), (4, "HAWAII"), (5, "BELT"), (5, "SEAM"), (6, "BELT"), (6, "SEAM"), (7, "SEAM"),
    (9, "DATELINE"), (10, "DATELINE"), (11, "DATELINE"),
]


@pytest.mark.parametrize("max_broadcast", [regions.MAX_BROADCAST_TILES, 0])
def test_assign_regions(spark, max_broadcast):
    """Broadcast and shuffle way give the same."""
    points = spark.createDataFrame(POINTS, "id int, lat double, lon double").repartition(5)
    got = regions.assign_regions(points, regions_frame(spark, BOXES), max_broadcast)
    assert got.columns == ["id", "lat", "lon", "region_id"]
    assert rows(got.select("id", "region_id")) == EXPECTED


def test_large_box_table_takes_coarser_tiles(spark):
    many = spark.range(3000).selectExpr(
        "concat('B', id) region_id", "'' name", "-80D lat_min", "80D lat_max", "0D lon_min", "100D lon_max"
    )
    degrees, n = regions._tile_degrees(regions.region_intervals(many))
    assert degrees > 1 and n <= regions.MAX_BROADCAST_TILES
    points = spark.createDataFrame(POINTS, "id int, lat double, lon double")
    assert regions.assign_regions(points, many).groupBy("id").count().where("count <> 3000").count() == 0


def test_within_boxes_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "points")
    spark.createDataFrame(POINTS, "id int, lat double, lon double").write.parquet(path)
    got = regions.within_boxes(spark.read.parquet(path), [BOXES[2][2:]], "360")
    assert [r[0] for r in rows(got.select("id"))] == [5, 6, 7]
    plan = formatted_plan(got)
    pushed = plan[plan.index("PushedFilters"):]
    for part in ("GreaterThanOrEqual(lat,-5.0)", "LessThanOrEqual(lat,5.0)",
                 "GreaterThanOrEqual(lon,350.0)", "LessThanOrEqual(lon,10.0)"):
        assert part in pushed


def test_regions_are_broadcast_without_a_hint(spark):
    facts = spark.range(1000).selectExpr("if(id % 3 = 0, 'NTT', 'X') region_id", "id")
    df = regions.lookup_regions(facts, regions_frame(spark))
    assert "BroadcastHashJoin" in df._jdf.queryExecution().executedPlan().toString()
    assert df.where("region_known").count() == 334 and df.count() == 1000


def test_read_regions(spark, tmp_path):
    regions_frame(spark).write.json(str(tmp_path / "r.json"))
    regions_frame(spark).write.option("header", "true").csv(str(tmp_path / "r.csv"))
    regions_frame(spark).write.parquet(str(tmp_path / "r.parquet"))
    yaml = tmp_path / "r.yaml"
    yaml.write_text(
        "regions:\n  A:\n    name: box\n    boundbox: {lon_min: 1, lon_max: 2.5, lat_min: -3, lat_max: 4}\n"
    )
    expected = rows(regions_frame(spark))
    for kind in ("json", "csv", "parquet"):
        assert rows(read_regions(spark, str(tmp_path / f"r.{kind}"))) == expected
    pytest.importorskip("yaml")
    assert rows(read_regions(spark, str(yaml))) == [("A", "box", -3.0, 4.0, 1.0, 2.5)]


# -- daily means -------------------------------------------------------------------------------

def hourly(spark, data):
    return spark.createDataFrame(data, "region_id string, time timestamp_ntz, lat double, lon double, v double")


def at(day, hour=0):
    return dt.datetime(2024, 1, day, hour)


def test_daily_mean_keeps_masked_cell_days(spark):
    df = hourly(spark, [("A", at(1, 1), 0.0, 0.0, 2.0), ("A", at(1, 2), 0.0, 0.0, None), ("A", at(1, 23), 0.0, 0.0, 4.0),
                        ("A", at(1), 0.0, 1.0, None), ("A", at(1, 5), 0.0, 1.0, None)])
    assert rows(daily_mean(df, {"v": "m"}, dense=False)) == [
        ("A", D(2024, 1, 1), 0.0, 0.0, 3.0), ("A", D(2024, 1, 1), 0.0, 1.0, None)
    ]


def test_dense_days(spark):
    df = hourly(spark, [("A", at(1), 0.0, 0.0, 2.0), ("A", at(4), 0.0, 1.0, 6.0), ("B", at(2), 5.0, 5.0, 1.0)])
    got = rows(daily_mean(df, {"v": "m"}))
    assert len(got) == 2 * 4 + 1        # cells x days of each region
    assert {r for r in got if r[4] is not None} == {
        ("A", D(2024, 1, 1), 0.0, 0.0, 2.0), ("A", D(2024, 1, 4), 0.0, 1.0, 6.0), ("B", D(2024, 1, 2), 5.0, 5.0, 1.0)
    }


def test_dense_does_not_depend_on_the_months_loaded_together(spark):
    jan = [("A", at(d), 0.0, 0.0, 1.0) for d in (2, 5)]
    mar = [("A", dt.datetime(2024, 3, d), 0.0, 0.0, 1.0) for d in (1, 3)]
    together = rows(daily_mean(hourly(spark, jan + mar), {"v": "m"}))
    apart = rows(daily_mean(hourly(spark, jan), {"v": "m"})) + rows(daily_mean(hourly(spark, mar), {"v": "m"}))
    assert together == apart and len(together) == 4 + 3


def test_dense_reads_its_input_once(spark, tmp_path):
    path = str(tmp_path / "hourly")
    hourly(spark, [("A", at(1), 0.0, 0.0, 2.0), ("A", at(4), 0.0, 1.0, 6.0)]).write.parquet(path)
    df = daily_mean(spark.read.parquet(path), {"v": "m"})
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "ReusedExchange" in final
    assert final.count("FileScan") == 1


# -- region-days -------------------------------------------------------------------------------

def test_overlapping_windows_count_the_same_whatever_their_cells(spark):
    chl = spark.createDataFrame(
        [(D(2024, 1, 1), D(2024, 1, 8), "A", 1.0), (D(2024, 1, 1), D(2024, 1, 8), "A", 3.0),
         (D(2024, 1, 1), D(2024, 1, 8), "A", 5.0), (D(2024, 1, 5), D(2024, 1, 12), "A", 9.0),
         (D(2024, 1, 9), D(2024, 1, 3), "A", 100.0)],         # ends before it starts: no days
        "period_start_date date, period_end_date date, region_id string, chl_mg_m3 double",
    )
    got = {r[0].day: r[2] for r in rows(base.dailyize(chl))}
    assert got == {**{d: 3.0 for d in range(1, 5)}, **{d: 6.0 for d in range(5, 9)}, **{d: 9.0 for d in range(9, 13)}}


def sources(spark):
    key = "date date, region_id string"
    sst = spark.createDataFrame([(D(2024, 1, 1), "A", 1.0), (D(2024, 1, 1), "A", None), (D(2024, 1, 9), "A", None)],
                                f"{key}, sst_c double")
    waves = spark.createDataFrame([(D(2024, 1, 1), "A", 2.0, None), (D(2024, 1, 1), "B", 4.0, 5.0)],
                                  f"{key}, swh_m double, peak_period_s double")
    chl = spark.createDataFrame([(D(2024, 1, 1), D(2024, 1, 2), "A", 7.0)],
                                "period_start_date date, period_end_date date, region_id string, chl_mg_m3 double")
    return sst, waves, chl


def test_base_has_all_observed_days(spark):
    assert rows(base.region_daily_base(*sources(spark))) == [
        (D(2024, 1, 1), "A", 1.0, 2.0, None, 7.0),
        (D(2024, 1, 1), "B", None, 4.0, 5.0, None),
        (D(2024, 1, 2), "A", None, None, None, 7.0),
        (D(2024, 1, 9), "A", None, None, None, None),
    ]
    assert rows(base.observed_days(*sources(spark))) == [
        (D(2024, 1, 1), "A"), (D(2024, 1, 1), "B"), (D(2024, 1, 2), "A"), (D(2024, 1, 9), "A")
    ]
    assert {r[1] for r in rows(base.region_daily_base(*sources(spark), regions=["B"]))} == {"B"}


def test_stacked_base_equals_joins(spark):
    sst, waves, chl = sources(spark)
    joined = base.observed_days(sst, waves, chl)
    for part in (base.region_day_mean(sst, base.SST_MEANS), base.region_day_mean(waves, base.WAVES_MEANS),
                 base.dailyize(chl)):
        joined = joined.join(part, ["date", "region_id"], "left")
    assert rows(joined) == rows(base.region_daily_base(sst, waves, chl))


def test_base_aggregates_windows_before_expanding_and_scans_once(spark, tmp_path):
    frames = []
    for name, df in zip(("sst", "waves", "chl"), sources(spark)):
        df.write.parquet(str(tmp_path / name))
        frames.append(spark.read.parquet(str(tmp_path / name)))
    plan = base.region_daily_base(*frames, regions=["A"])._jdf.queryExecution().executedPlan().toString()
    # one shuffle per mean, none to merge them, no join
    assert plan.count("FileScan") == 3 and plan.count("Exchange hashpartitioning") == 4 and "Join" not in plan
    below_explode = plan[plan.index("Generate explode"):]
    assert below_explode.index("HashAggregate") < below_explode.index("FileScan")
    assert plan.count("EqualTo(region_id,A)") == 3       # region filter in every scan


@pytest.mark.parametrize("settings", [("200", "1k"), ("50", "64m"), ("7", "5k")])
def test_base_has_one_row_per_key_however_shuffles_are_merged(spark, settings):
    """The merge relies on means that are hashed alike; merging reduce tasks must not break that."""
    keys = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    before = {k: spark.conf.get(k) for k in keys}
    day = F.date_add(F.lit(D(2024, 1, 1)), (F.col("id") % 300).cast("int"))
    region = F.concat(F.lit("R"), F.col("id") % 7)
    sst = spark.range(60_000).select(day.alias("date"), region.alias("region_id"), F.rand(1).alias("sst_c"))
    waves = spark.range(900).select(day.alias("date"), region.alias("region_id"), F.rand(2).alias("swh_m"),
                                    F.rand(3).alias("peak_period_s"))
    chl = spark.range(3000).select(day.alias("period_start_date"), F.date_add(day, 7).alias("period_end_date"),
                                   region.alias("region_id"), F.rand(4).alias("chl_mg_m3"))
    try:
        for k, v in zip(keys, settings):
            spark.conf.set(k, v)
        got = base.region_daily_base(sst, waves, chl).select("date", "region_id").collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(got) == len(set(got)) == base.observed_days(sst, waves, chl).count()


def test_features(spark):
    values = [1.0, 2.0, None, 4.0, 5.0, 6.0, 7.0, 9.0]
    day = [1, 2, 3, 4, 5, 6, 8, 20]      # frames go by row: gaps do not matter
    b = spark.createDataFrame(
        [(D(2024, 1, d), "A", v, None, 1.0, v) for d, v in zip(day, values)] + [(D(2024, 1, 1), "B", 5.0, 1.0, 1.0, 1.0)],
        "date date, region_id string, sst_c_mean double, swh_m_mean double, peak_period_s_mean double, "
        "chl_mg_m3_mean double",
    )
    f = features.region_daily_features(b)
    assert len(f.columns) == 24
    got = {(r.region_id, r.date.day): r for r in f.collect()}
    assert got["A", 1].sst_lag1 is None and got["A", 1].sst_diff1 is None
    assert got["A", 1].sst_ma7 == 1.0 and got["A", 1].sst_sd7 is None
    assert got["A", 3].sst_lag1 == 2.0 and got["A", 3].sst_diff1 is None and got["A", 3].sst_ma7 == 1.5
    assert got["A", 4].sst_lag1 is None and got["A", 4].sst_diff1 is None
    assert got["A", 8].sst_lag1 == 6.0 and got["A", 8].sst_diff1 == 1.0
    assert got["A", 8].sst_ma7 == pytest.approx(25 / 6)
    last = [2.0, 4.0, 5.0, 6.0, 7.0, 9.0]     # seven rows, one of them NULL
    mean = sum(last) / 6
    assert got["A", 20].sst_ma7 == pytest.approx(mean)
    assert got["A", 20].sst_sd7 == pytest.approx(math.sqrt(sum((v - mean) ** 2 for v in last) / 5))
    assert got["A", 20].swh_ma7 is None and got["A", 20].swh_sd7 is None
    assert got["A", 20].doy == 20 and got["A", 20].month == 1
    assert got["B", 1].sst_lag1 is None


def test_features_need_one_shuffle_and_one_sort(spark, tmp_path):
    path = str(tmp_path / "base")
    spark.createDataFrame([], "date date, region_id string, sst_c_mean double, swh_m_mean double, "
                              "peak_period_s_mean double, chl_mg_m3_mean double").write.parquet(path)
    plan = features.region_daily_features(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and plan.count("Sort [") == 1


# -- coercion and checks -----------------------------------------------------------------------

def test_coerce(spark):
    df = spark.createDataFrame(
        [("2024-01-05", "1.5", "7", "t", 1), ("nope", "x", "1.7", None, 2), (None, None, None, "u", 3)],
        "date string, lat string, n string, region_id string, other int",
    )
    schema = (*SST_DAILY[:3], ("n", "INT64", False), ("other", "GEOGRAPHY", False), ("absent", "DATE", False))
    got = coerce(df, schema)
    assert rows(got, "other") == [
        (D(2024, 1, 5), 1.5, 7, "t", 1), (None, None, None, None, 2), (None, None, None, "u", 3)
    ]
    assert dict(got.dtypes) == {"date": "date", "lat": "double", "n": "bigint", "region_id": "string", "other": "int"}
    numbers = spark.createDataFrame([(5, 1.0)], "date int, n double")
    assert rows(coerce(numbers, (("date", "DATE", True), ("n", "NUMERIC", True)))) == [(None, 1.0)]


def test_require_columns(spark):
    df = spark.createDataFrame([(1, 2)], "b int, a int")
    assert checks.require_columns(df, ["a"], "x") is df
    with pytest.raises(ValueError, match=r"x: no columns \['c', 'd'\] among \['a', 'b'\]"):
        checks.require_columns(df, ["d", "a", "c"], "x")


def test_non_nulls(spark):
    df = spark.createDataFrame([(float(k), None if k < 15 else "r") for k in range(30)] + [(NAN, "r"), (None, "r")],
                               "lat double, region_id string")
    assert checks.missing_counts(df, ["lat", "region_id"]).first().asDict() == {
        "lat_missing": 2, "region_id_missing": 15, "bad_rows": 17
    }
    with pytest.raises(ValueError, match="x: required values are missing") as error:
        checks.require_non_nulls(df, ["lat", "region_id"], "x")
    assert len(str(error.value).splitlines()) == 11     # ten rows are shown
    good = df.where("lat >= 15")
    assert checks.require_non_nulls(good.where("not isnan(lat)"), ["lat", "region_id"], "x").count() == 15
    with pytest.raises(Exception, match="x: required values are missing: lat"):
        checks.guard_non_nulls(df.where("lat is null"), ["lat"], "x").collect()
    assert checks.guard_non_nulls(good.where("not isnan(lat)"), ["lat"], "x").count() == 15


@pytest.mark.parametrize(
    ("source", "first", "last"), [(SST, 1980, 2024), (CHL, 1997, 2025), (WAVES, 2016, 2025)]
)
def test_requests(spark, source, first, last):
    requests = [("NTT", first, 1), ("NTT", first - 1, 1), ("HAWAII", last, 12), ("NTT", last + 1, 1),
                ("NTT", last, 0), ("NTT", last, 13), ("MARS", last, 2), (None, last, 2), ("NTT", None, 2), ("NTT", last, None)]
    frame = spark.createDataFrame([(k, *r) for k, r in enumerate(requests)], "k int, region_id string, year int, month int")
    for k, reason in enumerate([None, "year", None, "year", "no such month", "no such month", "no region MARS",
                                "no region null", "year", "no such month"]):
        got = checks.check_requests(frame.where(F.col("k") == k), regions_frame(spark), source, D(2024, 6, 1)).first()
        assert got.valid == (reason is None) and (got.reason or "").startswith(reason or "")


# -- reports -----------------------------------------------------------------------------------

def test_qa(spark):
    sst = spark.createDataFrame(
        [(D(2024, 1, 1), "A", 20.0), (D(2024, 1, 1), "A", -1.0), (D(2024, 1, 3), "A", 41.0), (D(2024, 1, 3), "A", None)],
        "date date, region_id string, sst_c double",
    )
    assert rows(reports.qa_sst(sst)) == [("A", D(2024, 1, 1), D(2024, 1, 3), 4, 2, 0.25, 0.5)]
    assert rows(reports.qa_sst(sst, ["B"])) == []
    assert rows(reports.load_check(sst, D(2024, 1, 2), D(2024, 1, 31))) == [("A", 2, D(2024, 1, 3), D(2024, 1, 3))]


def test_profiles_of_nothing(spark):
    none = spark.createDataFrame([], "date date, lat double, lon double")
    assert rows(reports.profile_grid(none)) == [(0, None, None, None, None)]
    none = spark.createDataFrame([], "period_start_date date, period_end_date date")
    assert rows(reports.profile_chl(none)) == [(0, None, None, None)]


def test_profile_expands_cells_not_rows(spark):
    df = spark.range(1000).selectExpr("date'2024-01-01' as date", "cast(id % 4 as double) lat", "cast(id % 6 as double) lon")
    profile = reports.profile_grid(df)
    assert rows(profile) == [(1000, D(2024, 1, 1), D(2024, 1, 1), 4, 6)]
    plan = profile._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Expand") < plan.index("keys=[lat") or plan.rindex("HashAggregate") > plan.index("Expand")
