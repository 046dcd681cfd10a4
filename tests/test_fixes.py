"""Faults of an earlier round stay mended."""

import json
from pathlib import Path

import pytest

from pyspark.sql import functions as F

from gridmill.functions.missing import to_integer, to_number
from gridmill.operators import regions, reports
from gridmill.operators.coerce import coerce
from gridmill.operators.grid import grid_to_long
from gridmill.plans.jobs import ingest
from gridmill.plans.standard import standardize
from gridmill.schemas import CHL, SST, WAVES
from gridmill.sources.regions import read_regions
from gridmill.sources.store import Store, Watch
from test_store import D, FEB, JAN, chl_rows, content, sst_rows

GRID = "time array<int>, lat array<double>, lon array<double>, m array<double>"


def test_grid_arrays_fill_their_grid(spark):
    whole = ([1], [0.0, 1.0], [5.0, 6.0])
    assert grid_to_long(spark.createDataFrame([(*whole, None)], GRID), ["m"]).where("m IS NULL").count() == 4
    assert [r.m for r in grid_to_long(spark.createDataFrame([(*whole, [1.0, 2.0, 3.0, 4.0])], GRID), ["m"]).collect()] == [1.0, 2.0, 3.0, 4.0]
    for size in (3, 6):
        with pytest.raises(Exception, match="do not fill its grid"):
            grid_to_long(spark.createDataFrame([(*whole, [0.0] * size)], GRID), ["m"]).collect()


def test_builds_survive_failures(store, spark, tmp_path):
    name = store.create_or_replace("t", spark.range(2).toDF("x"))
    for broken in range(3):
        with pytest.raises(Exception, match="assert_true|is not true"):
            store.create_or_replace("t", spark.range(3).selectExpr("id", "assert_true(id < 1)"))
        assert spark.table(name).count() == 2
    for n in range(4):
        store.create_or_replace("t", spark.table(name).selectExpr("x + 1 AS x"))
    assert sorted(r.x for r in spark.table(name).collect()) == [4, 5]
    assert len(list((tmp_path / "store/features/t_builds").iterdir())) <= 3


def test_recovery_drops_what_had_to_go(store, spark, monkeypatch):
    store.append(SST, sst_rows(spark, [(D(2024, 1, 5), "A", 1.0), (D(2024, 2, 5), "A", 2.0)]))

    def stop(*_):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr(Store, "_publish", stop)
        with pytest.raises(RuntimeError):
            store.replace_days(SST, sst_rows(spark, [(D(2024, 2, 5), "A", 3.0)]), [("A", *JAN), ("A", *FEB)])
    store.replace_days(SST, sst_rows(spark, [(D(2024, 3, 1), "A", 4.0)]), [("A", D(2024, 3, 1), D(2024, 3, 1))])
    assert content(store) == [(D(2024, 2, 5), "A", 3.0), (D(2024, 3, 1), "A", 4.0)]
    left = [t.name for t in spark.catalog.listTables(f"{store.prefix}standard")]
    assert not [t for t in left if "staging" in t]


def test_periods_are_bounded(store, spark):
    rows = chl_rows(spark, [(D(2024, 1, 5), "A", 1.0)])
    assert store.append(CHL, rows) == 1
    for end in (D(2024, 1, 1), D(2024, 1, 10)):
        with pytest.raises(Exception, match="has not 1 to 8 days"):
            store.append(CHL, rows.withColumn("period_end_date", F.lit(end)))


def test_overlap_reads_few_folders(store, spark):
    """A period that began in the month before is replaced, and no folder before that is read."""
    store.append(CHL, chl_rows(spark, [(D(2023, 6, 5), "A", 1.0), (D(2024, 1, 29), "A", 2.0)]))
    seen = []
    real = store.replace_where
    store.replace_where = lambda source, predicate, rows: (seen.append(predicate), real(source, predicate, rows))[1]
    store.replace_overlap(CHL, chl_rows(spark, [(D(2024, 1, 29), "A", 3.0)]), [("A", *FEB)])
    assert [r[2] for r in content(store, CHL, "chl_mg_m3")] == [1.0, 3.0]
    assert "2024-01" in str(seen[0]) and "2023" not in str(seen[0])


def test_other_zones_are_refused(spark, tmp_path):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Makassar")
    try:
        with pytest.raises(ValueError, match="not UTC"):
            Store(spark, str(tmp_path))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_many_boxes_leave_few_candidates(spark):
    boxes = spark.range(250_000).selectExpr(
        "concat('B', id) region_id", "'' name", "id % 357 * 0.5D - 90 lat_min", "id % 357 * 0.5D - 89 lat_max",
        "(id * 7919 % 3590) * 0.1D lon_min", "(id * 7919 % 3590) * 0.1D + 1 lon_max")
    intervals = regions.region_intervals(boxes)
    degrees, n = regions._tile_degrees(intervals)
    assert degrees <= 1 and n <= 10 * 250_000
    points = spark.range(2000).selectExpr("id", "id * 31 % 1700 / 10D - 85 AS lat", "id * 17 % 3600 / 10D AS lon")
    got = {(r.id, r.region_id) for r in regions.assign_regions(points, boxes).select("id", "region_id").collect()}
    inside = points.join(F.broadcast(points.sparkSession.createDataFrame(intervals.toPandas())), F.expr(
        "lat BETWEEN lat_lo AND lat_hi AND lon BETWEEN lon_lo AND lon_hi")).where("id % 40 = 0")
    assert {(r.id, r.region_id) for r in inside.collect()} == {x for x in got if x[0] % 40 == 0}


@pytest.mark.parametrize("text, number, integer", [
    ("1d", None, None), ("0x1p3", None, None), ("1.5F", None, None), ("inf", float("inf"), None), (" 7 ", 7.0, 7), ("1.7", 1.7, None),
    ("12.0", 12.0, 12), ("9007199254740993", 9007199254740992.0, 9007199254740993), ("nan", None, None), ("", None, None), ("1e2", 100.0, 100)])
def test_text_numbers(spark, text, number, integer):
    df = spark.createDataFrame([(text,)], "s string")
    kind = df.schema["s"].dataType
    assert tuple(df.select(to_number("s", kind), to_integer("s", kind)).first()) == (number, integer)


def test_region_file_with_quoted_bounds(spark, tmp_path):
    pytest.importorskip("yaml")
    file = tmp_path / "r.yaml"
    file.write_text("regions:\n  A:\n    name: a\n    boundbox: {lat_min: '-1', lat_max: 1, lon_min: 2, lon_max: '3.5'}\n")
    assert tuple(read_regions(spark, str(file)).first()) == ("A", "a", -1.0, 1.0, 2.0, 3.5)


def test_integers_around_what_doubles_hold(spark):
    texts = ["9223372036854775807", "9223372036854775808", "-9223372036854775808", "1e300", "1e15", " 12 ", "0x1p3", "1d", "n/a", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string").orderBy("i")
    got = [r.v for r in df.select(to_integer("s", df.schema["s"].dataType).alias("v")).collect()]
    assert got == [2**63 - 1, None, -(2**63), None, 10**15, 12, None, None, None, None]


@pytest.mark.parametrize("row, missing", [
    ("NULL, 'A'", "date"), ("TIMESTAMP_NTZ '2024-01-02 03:00:00', CAST(NULL AS STRING)", "region_id")])
def test_dense_loads_fail_by_name_for_rows_without_a_day_or_a_region(spark, row, missing):
    raw = spark.sql(f"""
        SELECT time, region_id, 1D AS lat, 2D AS lon, 1.5D AS Thgt, 3D AS Tper FROM VALUES
        (TIMESTAMP_NTZ '2024-01-01 00:00:00', 'A'), ({row}) AS t(time, region_id)""")
    with pytest.raises(Exception, match=f"required values are missing: {missing}"):
        standardize(raw, WAVES, dense=True).collect()
    rows = standardize(raw, WAVES, dense=True, guard=False)
    assert rows.where(f"{missing} IS NULL").count() == 1 and rows.count() == 2


@pytest.mark.parametrize("text, day", [
    ("2024-02-29", D(2024, 2, 29)), (" 2024-2-9 ", D(2024, 2, 9)), ("2024-02-09T10:00:00", D(2024, 2, 9)), ("2024-02-09 10:00", D(2024, 2, 9)),
    ("2024-02-30", None), ("not a day", None), ("12:30:00", None), ("2024-02-09x", None), ("", None), ("2024-03", D(2024, 3, 1))])
def test_text_days(spark, text, day):
    got = coerce(spark.createDataFrame([(text, text)], "d string, t string"), (("d", "DATE"), ("t", "TIMESTAMP"))).first()
    assert got.d == day and (got.t.date() if got.t else None) == day


def stopped(monkeypatch, at):
    """Calls to publish stop after ``at`` of the switched partitions."""
    real = Store._publish

    def publish(self, table, folder, switch):
        some = dict(list(switch.items())[:at])
        if some:
            noted = Store._noted(self, folder)
            real(self, table, folder, some)
            self._note(folder, {(r, m): old for r, m, old in json.loads(noted)})
        raise RuntimeError("driver lost")

    monkeypatch.setattr(Store, "_publish", publish)


@pytest.mark.parametrize("at", [0, 1, 2, 3])
def test_appends_between_stop_and_recovery_survive(store, spark, monkeypatch, at):
    odd = "O'ahu b/c=d%é"
    store.append(SST, sst_rows(spark, [(D(2024, 1, 5), odd, 1.0), (D(2024, 1, 25), odd, 1.5), (D(2024, 2, 5), odd, 2.0), (D(2024, 3, 5), odd, 3.0)]))
    with monkeypatch.context() as m:
        stopped(m, at)
        with pytest.raises(RuntimeError, match="driver lost"):
            store.replace_days(SST, sst_rows(spark, [(D(2024, 1, 6), odd, 7.0), (D(2024, 3, 6), odd, 8.0)]),
                               [(odd, D(2024, 1, 1), D(2024, 1, 10)), (odd, *FEB), (odd, D(2024, 3, 1), D(2024, 3, 31))])
    added = [(D(2024, m, 20), odd, 9.0) for m in (1, 2, 3, 4)]
    store.append(SST, sst_rows(spark, added))
    store.replace_days(SST, sst_rows(spark, []), [("none", *JAN)])
    want = sorted([(D(2024, 1, 6), odd, 7.0), (D(2024, 1, 25), odd, 1.5), (D(2024, 3, 6), odd, 8.0), *added])
    assert content(store) == want
    store.append(SST, sst_rows(spark, [(D(2024, 2, 21), odd, 5.0)]))
    assert content(store) == sorted([*want, (D(2024, 2, 21), odd, 5.0)])


def test_a_partition_that_changed_meanwhile_is_refused(store, spark, monkeypatch):
    store.append(SST, sst_rows(spark, [(D(2024, 1, 5), "A", 1.0), (D(2024, 2, 5), "A", 2.0)]))
    real = Store._stage

    def slow(self, folder, keyed, source, watch=None):
        n = real(self, folder, keyed, source, watch)
        if len(seen) == 1:      # after the rows that stay have been read
            self.append(SST, sst_rows(spark, [(D(2024, 1, 7), "A", 4.0)]))
        seen.append(n)
        return n

    seen = []
    monkeypatch.setattr(Store, "_stage", slow)
    with pytest.raises(RuntimeError, match="changed while rows for them were staged"):
        store.replace_days(SST, sst_rows(spark, [(D(2024, 1, 6), "A", 9.0)]), [("A", *JAN)])
    assert content(store) == [(D(2024, 1, 5), "A", 1.0), (D(2024, 1, 7), "A", 4.0), (D(2024, 2, 5), "A", 2.0)]
    store.replace_days(SST, sst_rows(spark, [(D(2024, 1, 6), "A", 9.0)]), [("A", *JAN)])
    assert content(store) == [(D(2024, 1, 6), "A", 9.0), (D(2024, 2, 5), "A", 2.0)]


def test_two_loads_at_once(store, spark):
    """Of different months both are right; of one month one may be refused, and nothing is mixed."""
    from concurrent.futures import ThreadPoolExecutor

    store.append(SST, sst_rows(spark, [(D(2024, m, 5), "A", 0.0) for m in (1, 2, 3)]))

    def load(month, value):
        try:
            return store.replace_days(SST, sst_rows(spark, [(D(2024, month, 6), "A", value)]), [("A", D(2024, month, 1), D(2024, month, 28))])
        except RuntimeError as error:
            assert "load again" in str(error)
            return 0

    with ThreadPoolExecutor(4) as pool:
        done = list(pool.map(lambda a: load(*a), [(1, 1.0), (2, 2.0), (3, 3.0), (3, 4.0)]))
    assert done[:2] == [1, 1] and sum(done[2:]) >= 1
    got = content(store)
    assert got[:2] == [(D(2024, 1, 6), "A", 1.0), (D(2024, 2, 6), "A", 2.0)]
    assert got[2:] in ([(D(2024, 3, 6), "A", 3.0)], [(D(2024, 3, 6), "A", 4.0)])


def test_replaced_rows_are_written_once(store, spark):
    """The files of a partition are those that the run wrote; the old ones are gone, and no copy is left."""
    store.append(SST, sst_rows(spark, [(D(2024, 1, d), "A", float(d)) for d in range(1, 29)]))
    old = store.scan(SST).inputFiles()
    store.replace_days(SST, sst_rows(spark, [(D(2024, 1, 6), "A", 9.0)]), [("A", D(2024, 1, 5), D(2024, 1, 7))])
    files = store.scan(SST).inputFiles()
    assert all("standard_runs" in f for f in files) and not set(files) & set(old)
    assert spark.read.parquet(store._runs_folder(store.standard(SST)) + "/*").count() == store.scan(SST).count() == 26
    assert not any(Path(f.removeprefix("file://").removeprefix("file:")).exists() for f in old)


def test_only_builds_that_were_current_go(store, spark, tmp_path):
    folder = tmp_path / "store/features/t_builds"
    store.create_or_replace("t", spark.range(1).toDF("x"))
    for half in "abc":
        spark.range(1).write.parquet(str(folder / half))        # written by somebody else, not a view's yet
    for n in range(4):
        store.create_or_replace("t", spark.range(n + 2).toDF("x"))
    left = {f.name for f in folder.iterdir()}
    assert {"a", "b", "c"} <= left and len(left) == 3 + 2


@pytest.mark.parametrize("source, rows, profile", [
    (SST, lambda s: sst_rows(s, [(D(2024, 1, d), "A", 1.0) for d in (3, 5, 9)]).withColumn("lat", F.dayofmonth("date") % 2 + 0.5), reports.profile_grid),
    (SST, lambda s: sst_rows(s, []), reports.profile_grid),
    (CHL, lambda s: chl_rows(s, [(D(2024, 1, d), "A", 1.0) for d in (4, 4, 12)]), reports.profile_chl),
    (CHL, lambda s: chl_rows(s, []), reports.profile_chl)])
def test_profiles_are_counted_by_the_write(store, spark, source, rows, profile):
    df = rows(spark)
    want = profile(df).first().asDict()
    for write in (lambda w: store.append(source, df, w), lambda w: store.replace(source, df, [("A", *JAN)], w), lambda w: store.dry_run(df, w)):
        watch = Watch(reports.observed_profile(source.composite))
        assert write(watch) == want["n_rows"] and reports.as_profile(watch.get) == want


def test_row_stats_of_a_load_need_no_second_run(store, spark, caplog):
    import logging

    read = spark.sparkContext.accumulator(0)
    raw = spark.sql("SELECT TIMESTAMP_NTZ '2024-01-05 00:00:00' AS time, -8D AS lat, id + 120D AS lon, 'A' AS region_id, 20D AS sst FROM range(3)")
    raw = raw.withColumnRenamed("sst", next(iter(SST.measures)))
    once = F.udf(lambda x: (read.add(1), x)[1], "double").asNondeterministic()
    known = spark.createDataFrame([("A", "", -10.0, -7.0, 120.0, 125.0)], "region_id string, name string, lat_min double, lat_max double, lon_min double, lon_max double")
    with caplog.at_level(logging.INFO):
        n = ingest(store, SST, raw.withColumn("lat", once("lat")), [("A", 2024, 1)], regions=known, log_row_stats=True, today=D(2024, 6, 1))
    assert n == 3 and read.value == 3
    assert any("'unique_lon': 3" in m and "'unique_lat': 1" in m for m in caplog.messages)
