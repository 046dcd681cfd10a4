"""Standardising, load jobs, the ledger, landed files."""

import datetime as dt

import pytest
from compare import formatted_plan
from pyspark.sql import functions as F

from gridmill.plans import jobs
from gridmill.plans.jobs import ingest, run_tracked
from gridmill.plans.standard import clean_measures, standardize
from gridmill.schemas import CHL, SST, WAVES
from gridmill.session import configure
from gridmill.sources.landing import triage
from gridmill.sources.ledger import log_run, read_runs
from gridmill.sources.regions import regions_frame

D = dt.date
TODAY = D(2025, 1, 1)


def raw(spark, source, data, region=True):
    """(time, lat, lon, measures..., [region]) with the source's names."""
    measures = ", ".join(f"{m} double" for m in source.measures)
    schema = f"time timestamp_ntz, latitude double, longitude double, {measures}"
    if region:
        schema += ", region_id string"
    return spark.createDataFrame(data, schema).withColumn(source.level, F.lit(0.0))


def at(month, day, hour=0):
    return dt.datetime(2024, month, day, hour)


def test_sst_rows(spark):
    rows = standardize(raw(spark, SST, [(at(1, 31, 12), -8.0, 121.0, 28.5, "NTT"), (at(2, 1), -8.0, 121.0, 1e36, "NTT")]), SST)
    assert rows.columns == SST.columns
    got = sorted(rows.drop("ingested_at").collect())
    assert [tuple(r) for r in got] == [
        (D(2024, 1, 31), "NTT", -8.0, 121.0, 28.5, SST.label), (D(2024, 2, 1), "NTT", -8.0, 121.0, None, SST.label)
    ]
    # the day after the window, which an inclusive source slice delivers, is trimmed
    trimmed = standardize(raw(spark, SST, [(at(1, 31, 12), 1.0, 1.0, 1.0, "A"), (at(2, 1), 1.0, 1.0, 1.0, "A")]), SST,
                          d0=D(2024, 1, 1), d1=D(2024, 1, 31))
    assert [r.date for r in trimmed.collect()] == [D(2024, 1, 31)]


def test_time_window_is_pushed_to_the_scan(spark, tmp_path):
    for source, bounds in ((SST, ("2024-02-01", "2024-03-01")), (CHL, ("2024-01-28", "2024-03-04"))):
        path = str(tmp_path / source.name)
        raw(spark, source, [(at(2, 1), 1.0, 1.0, 1.0, "A")]).write.parquet(path)
        df = standardize(spark.read.parquet(path), source, d0=D(2024, 2, 1), d1=D(2024, 2, 29))
        plan = formatted_plan(df)
        assert f"GreaterThanOrEqual(time,{bounds[0]}" in plan and f"LessThan(time,{bounds[1]}" in plan


def test_chl_keeps_windows_that_overlap(spark):
    data = [(at(1, d), 1.0, 1.0, 1.0, "A") for d in (27, 28)] + [(at(3, d), 1.0, 1.0, 2.0, "A") for d in (3, 4)]
    got = standardize(raw(spark, CHL, data), CHL, d0=D(2024, 2, 1), d1=D(2024, 2, 29)).collect()
    assert sorted((r.period_start_date, r.period_end_date) for r in got) == [
        (D(2024, 1, 25), D(2024, 2, 1)), (D(2024, 2, 29), D(2024, 3, 7))
    ]


def test_waves_masked_before_the_mean(spark):
    data = [(at(1, 1, 0), 1.0, 1.0, 2.0, 10.0, "A"), (at(1, 1, 1), 1.0, 1.0, 41.0, 61.0, "A"),
            (at(1, 1, 2), 1.0, 1.0, 4.0, -1.0, "A"), (at(1, 1, 3), 1.0, 1.0, 9.96921e36, 20.0, "A"),
            (at(1, 3, 0), 1.0, 1.0, float("nan"), None, "A")]
    got = sorted(standardize(raw(spark, WAVES, data), WAVES).collect())
    assert [(r.date.day, r.swh_m, r.peak_period_s) for r in got] == [(1, 3.0, 15.0), (2, None, None), (3, None, None)]


def test_level_option_text_measures_and_declared_fill(spark):
    df = spark.createDataFrame(
        [("2.5", 0.0, -999.0), ("junk", 0.0, 5.0), ("3.5", 10.0, 6.0)], "Thgt string, depth double, Tper double"
    ).withColumns({"time": F.lit(at(1, 1)), "lat": F.lit(1.0), "lon": F.lit(2.0), "region_id": F.lit("A")})
    cleaned = clean_measures(df, WAVES, {"Tper": -999}).collect()
    assert [(r.swh_m, r.peak_period_s) for r in cleaned] == [(2.5, None), (None, 5.0), (3.5, 6.0)]
    assert standardize(df, WAVES, fills={"Tper": -999}).first().peak_period_s == 5.0      # depth 10 is left out
    assert standardize(df.drop("depth"), WAVES).count() == 1


def test_lon_domain(spark):
    df = raw(spark, SST, [(at(1, 1), 20.0, 199.0, 1.0, "HAWAII")])
    assert standardize(df, SST).first().lon == 199.0
    assert standardize(df, SST, lon_domain="pm180").first().lon == -161.0


def test_missing_raw_columns_raise_without_a_job(spark):
    df = raw(spark, SST, [(at(1, 1), 20.0, 199.0, 1.0, "A")])
    with pytest.raises(ValueError, match=r"sst input: no columns \['sst'\]"):
        standardize(df.drop("sst"), SST)
    with pytest.raises(ValueError, match=r"no columns \['region_id'\]"):
        standardize(df.drop("region_id"), SST)


def ledger(store):
    return [(r.job_name, r.status, r.rows_written) for r in read_runs(store).orderBy("start_ts").collect()]


def test_ingest_many_months_and_regions(store, spark):
    data = [(at(m, d, h), -8.0 if r == "NTT" else 20.0, 121.0 if r == "NTT" else 200.0, 1.0 * m, 5.0, r)
            for m in (1, 2, 3) for d in (1, 2) for h in (0, 12) for r in ("NTT", "HAWAII")]
    requests = [("NTT", 2024, 1), ("NTT", 2024, 2), ("HAWAII", 2024, 2)]
    df = raw(spark, WAVES, data)
    assert ingest(store, WAVES, df, requests, dry_run=True, today=TODAY) == 0
    assert store.scan(WAVES).count() == 0
    for _ in range(2):
        assert ingest(store, WAVES, df, requests, replace=True, today=TODAY, log_row_stats=True) == 6
    assert store.scan(WAVES).count() == 6
    assert ingest(store, WAVES, df, requests[:1], today=TODAY) == 2       # append only: duplicates
    assert store.scan(WAVES, ["NTT"]).count() == 6
    assert ledger(store) == [("ingest_waves", "SUCCESS", n) for n in (0, 6, 6, 2)]
    notes = [r.notes for r in read_runs(store).orderBy("start_ts").collect()]
    assert notes[0].startswith("region=HAWAII,NTT from=2024-01 to=2024-02 requests=3 dry_run=True replace=False table=")
    assert notes[3].startswith("region=NTT year=2024 month=1 dry_run=False replace=False")
    assert all(n.endswith("dataset_id=NWW3_Global_Best") for n in notes)


def test_ingest_chl_month_by_month_loses_and_doubles_nothing(store, spark):
    centres = [D(2024, 1, 4) + dt.timedelta(days=8 * k) for k in range(12)]
    df = raw(spark, CHL, [(dt.datetime(c.year, c.month, c.day), 1.0, 1.0, 1.0, "NTT") for c in centres])
    for month in (1, 2, 3, 2, 1):
        ingest(store, CHL, df, [("NTT", 2024, month)], replace=True, today=TODAY)
    starts = [r.period_start_date for r in store.scan(CHL).collect()]
    expected = [c - dt.timedelta(days=3) for c in centres if c - dt.timedelta(days=3) <= D(2024, 3, 31)]
    assert sorted(starts) == expected


def test_ingest_assigns_regions_by_position(store, spark):
    data = [(at(1, 1), -8.0, 121.0, 1.0), (at(1, 1), 20.0, 200.0, 2.0), (at(1, 1), 20.0, 100.0, 3.0), (at(2, 1), -8.0, 121.0, 4.0)]
    requests = [("NTT", 2024, 1), ("HAWAII", 2024, 1)]
    assert ingest(store, SST, raw(spark, SST, data, region=False), requests, assign=True, today=TODAY) == 2
    assert sorted((r.region_id, r.sst_c) for r in store.scan(SST).collect()) == [("HAWAII", 2.0), ("NTT", 1.0)]


def test_bad_requests_raise_before_tracking(store, spark):
    df = raw(spark, SST, [(at(1, 1), 1.0, 1.0, 1.0, "NTT")])
    for request in (("NTT", 2024, 13), ("NTT", 1979, 1), ("MARS", 2024, 1)):
        with pytest.raises(ValueError):
            ingest(store, SST, df, [request], today=TODAY)
    with pytest.raises(ValueError):
        ingest(store, SST, df, [], today=TODAY)
    assert ledger(store) == []


@pytest.mark.parametrize("how", ["append", "replace", "dry_run"])
def test_null_keys_fail_the_job_and_write_nothing(store, spark, how):
    data = [(at(1, d), float("nan") if d > 5 else 1.0, 1.0, 1.0, "NTT") for d in range(1, 20)]
    with pytest.raises(ValueError, match="sst table rows: required values are missing") as error:
        ingest(store, SST, raw(spark, SST, data), [("NTT", 2024, 1)], replace=how == "replace", dry_run=how == "dry_run",
               today=TODAY)
    assert len(str(error.value).splitlines()) == 11
    assert store.scan(SST).count() == 0
    assert ledger(store) == [("ingest_sst", "FAILED", 0)]
    assert "err=ValueError: sst table rows: required" in read_runs(store).first().notes


def test_tracked_failure_is_logged_and_raised(store):
    def fail():
        raise KeyError("k" * 900)

    with pytest.raises(KeyError):
        run_tracked(store, "job", fail, run_id="r1")
    row = read_runs(store).first()
    assert (row.run_id, row.status, row.rows_written) == ("r1", "FAILED", 0)
    assert row.notes == "job=job run_id=r1 err=" + f"KeyError: '{'k' * 900}'"[:500]
    assert row.start_ts <= row.end_ts


def test_ledger_cuts_notes_and_never_raises(store, spark):
    run = dict(run_id="r", job_name="j", start_ts=at(1, 1, 3), end_ts=at(1, 1, 4), status="SUCCESS", rows_written=1)
    assert log_run(store, notes="n" * 1500, **run)
    assert log_run(store, notes=None, **run)
    assert sorted(len(r.notes) for r in read_runs(store).collect()) == [0, 1000]
    assert read_runs(store).first().start_text == "2024-01-01T03:00:00.000000Z"
    assert read_runs(store, D(2024, 1, 2)).count() == 0 and read_runs(store, D(2024, 1, 1), D(2024, 1, 1)).count() == 2
    spark.sql(f"DROP TABLE {store.runs}")
    assert not log_run(store, notes="", **run)
    assert run_tracked(store, "job", lambda: (5, "fine")) == 5       # the result survives a lost ledger


def test_month_windows():
    assert jobs.month_windows([("A", 2024, 2), ("A", 2023, 12), ("A", 2024, 2)]) == [
        ("A", D(2023, 12, 1), D(2023, 12, 31)), ("A", D(2024, 2, 1), D(2024, 2, 29))
    ]


def test_triage(spark, tmp_path):
    files = {
        "short.nc": b"CDF" + b"x" * 1020, "exact.nc": b"CDF\x01" + b"x" * 1020, "hdf.nc": b"\x89HDF" + b"x" * 2000,
        "page.nc": b"<html>" + b"x" * 2000, "sub/deep.nc": b"CDF\x02" + b"y" * 5000, "almost.nc": b"\x89HDX" + b"x" * 2000,
        "note.txt": b"z" * 9000,
    }
    (tmp_path / "sub").mkdir()
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
    base = f"file:{tmp_path}"
    expected = spark.createDataFrame([(f"{base}/{n}",) for n in ("exact.nc", "gone.nc", "gone.nc")], "path string")
    got = {r.path.removeprefix(base + "/"): (r.ok, r.kind, r.reason) for r in triage(spark, str(tmp_path), expected, glob="*.nc").collect()}
    assert got == {
        "short.nc": (False, None, "too_small"), "exact.nc": (True, "netcdf_classic", None),
        "hdf.nc": (True, "netcdf4_hdf5", None), "page.nc": (False, None, "bad_header"),
        "sub/deep.nc": (True, "netcdf_classic", None), "almost.nc": (False, None, "bad_header"),
        "gone.nc": (False, None, "missing"),
    }
    assert triage(spark, str(tmp_path), min_bytes=6000).where("reason = 'bad_header'").count() == 1


def test_regions_frame_is_a_local_relation(spark):
    assert "LocalTableScan" in regions_frame(spark)._jdf.queryExecution().executedPlan().toString()
    assert regions_frame(spark, []).count() == 0


def test_configure_only_raises_shuffle_partitions(spark):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    try:
        configure(spark, 1)
        assert spark.conf.get(key) == before
        configure(spark, 100 * 128 * 1024 * 1024 + 1)
        assert spark.conf.get(key) == "101"
    finally:
        spark.conf.set(key, before)
