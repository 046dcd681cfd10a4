"""Tables: layout, append, replace, create or replace."""

import datetime as dt

import pytest
from compare import formatted_plan
from pyspark.sql import functions as F

from gridmill.plans.features import build_base, build_features
from gridmill.plans.quality import loaded, quality
from gridmill.schemas import CHL, SST, WAVES
from gridmill.sources.store import merged_windows

D = dt.date
STAMP = dt.datetime(2024, 2, 1)


def sst_rows(spark, data):
    df = spark.createDataFrame(data, "date date, region_id string, sst_c double")
    return df.withColumns({"lat": F.lit(1.0), "lon": F.lit(2.0), "source": F.lit("s"),
                           "ingested_at": F.lit(STAMP).cast("timestamp")})


def chl_rows(spark, data):
    """(centre, region, value): windows of 8 days."""
    df = spark.createDataFrame(data, "centre date, region_id string, chl_mg_m3 double")
    return df.withColumns({
        "period_start_date": F.date_sub("centre", 3), "period_end_date": F.date_add("centre", 4), "lat": F.lit(1.0),
        "lon": F.lit(2.0), "source": F.lit("s"), "ingested_at": F.lit(STAMP).cast("timestamp"),
    })


def content(store, source=SST, value="sst_c"):
    df = store.scan(source).select(source.day_column, "region_id", value)
    return sorted(tuple(r) for r in df.collect())


JAN, FEB, MAR = (D(2024, 1, 1), D(2024, 1, 31)), (D(2024, 2, 1), D(2024, 2, 29)), (D(2024, 3, 1), D(2024, 3, 31))


def test_create_is_repeatable_and_keeps_rows(store, spark):
    store.append(SST, sst_rows(spark, [(D(2024, 1, 1), "A", 1.0)]))
    store.create()
    assert content(store) == [(D(2024, 1, 1), "A", 1.0)]
    assert store.scan(SST).columns == SST.columns
    types = dict(store.scan(SST).dtypes)
    assert types["date"] == "date" and types["ingested_at"] == "timestamp" and types["lat"] == "double"


def test_append_coerces_counts_and_adds(store, spark):
    rows = sst_rows(spark, [(D(2024, 1, 1), "A", 1.0), (D(2024, 2, 1), "B", None)])
    assert store.append(SST, rows.withColumn("date", F.col("date").cast("string")).withColumn("extra", F.lit(1))) == 2
    assert store.append(SST, rows) == 2
    assert content(store).count((D(2024, 1, 1), "A", 1.0)) == 2
    assert len(content(store)) == 4


@pytest.mark.parametrize("column, value", [("date", "'bad day'"), ("lat", "CAST(NULL AS DOUBLE)"), ("source", "CAST(NULL AS STRING)")])
def test_append_of_a_missing_required_value_writes_nothing(store, spark, column, value):
    rows = sst_rows(spark, [(D(2024, 1, 1), "A", 1.0)])
    with pytest.raises(Exception, match=f"required values are missing: {column}"):
        store.append(SST, rows.withColumn(column, F.expr(value)))
    assert content(store) == []


def test_scan_prunes_folders_and_row_groups(store, spark):
    store.append(SST, sst_rows(spark, [(D(2024, m, d), r, 1.0) for m in (1, 2, 3) for d in (1, 15) for r in "AB"]))
    df = store.scan(SST, ["A"], D(2024, 1, 10), D(2024, 2, 10))
    assert sorted(r.date for r in df.collect()) == [D(2024, 1, 15), D(2024, 2, 1)]
    plan = formatted_plan(df)
    folders = plan[plan.index("PartitionFilters"):plan.index("PushedFilters")]
    assert "region_id" in folders and "ym#" in folders and "2024-02" in folders
    assert "GreaterThanOrEqual(date,2024-01-10)" in plan and "LessThanOrEqual(date,2024-02-10)" in plan


def test_files_are_sorted_by_day(store, spark):
    days = [(D(2024, 1, 1 + (k * 7) % 31), "A", float(k)) for k in range(200)]
    store.append(SST, sst_rows(spark, days).repartition(4))
    for path in store.scan(SST).inputFiles():
        got = [r.date for r in spark.read.parquet(path).select("date").collect()]
        assert got == sorted(got)


def test_crowded_partition_is_split_over_tasks(store, spark):
    """One region-month with nearly all rows must not be written by one task."""
    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k"}
    rows = spark.range(0, 200_000, 1, 8).select(
        F.lit(D(2024, 1, 1)).alias("date"), F.when(F.col("id") % 1000 == 0, "B").otherwise("A").alias("region_id"),
        F.rand(1).alias("sst_c"), F.rand(2).alias("lat"), F.rand(3).alias("lon"), F.lit("s").alias("source"),
        F.lit(STAMP).cast("timestamp").alias("ingested_at"),
    )
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        assert store.append(SST, rows) == 200_000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    files = [f for f in store.scan(SST).inputFiles() if "region_id=A" in f]
    assert len(files) > 4
    assert store.scan(SST).count() == 200_000


def test_replace_days(store, spark):
    old = [(D(2024, 1, 31), "A", 1.0), (D(2024, 2, 1), "A", 1.0), (D(2024, 2, 29), "A", 1.0), (D(2024, 3, 1), "A", 1.0),
           (D(2024, 2, 10), "B", 1.0)]
    store.append(SST, sst_rows(spark, old))
    new = [(D(2024, 2, 2), "A", 2.0), (D(2024, 2, 3), "A", None)]
    kept = [old[0], old[3], old[4]]
    for _ in range(2):      # a second time changes nothing
        assert store.replace_days(SST, sst_rows(spark, new), [("A", *FEB)]) == 2
        assert content(store) == sorted(kept + new)


def test_replace_region_names_with_special_characters(store, spark):
    odd = "O'ahu b/c=d%é"
    store.append(SST, sst_rows(spark, [(D(2024, 1, 5), odd, 1.0), (D(2024, 1, 25), odd, 1.0), (D(2024, 2, 5), "A", 1.0)]))
    store.replace_days(SST, sst_rows(spark, [(D(2024, 1, 6), odd, 2.0)]), [(odd, D(2024, 1, 1), D(2024, 1, 10))])
    assert content(store) == [(D(2024, 1, 6), odd, 2.0), (D(2024, 1, 25), odd, 1.0), (D(2024, 2, 5), "A", 1.0)]
    store.replace_days(SST, sst_rows(spark, []), [(odd, *JAN)])
    assert content(store) == [(D(2024, 2, 5), "A", 1.0)]


def test_replace_looks_into_the_windows_folders_only(store, spark):
    seen = {}
    store.append(SST, sst_rows(spark, [(D(2024, m, 5), r, 1.0) for m in range(1, 7) for r in "AB"]))

    def keep(source, predicate, rows):
        seen["plan"] = formatted_plan(spark.table(store.standard(source)).where(predicate))

    store.replace_where = keep
    store.replace_days(SST, sst_rows(spark, []), [("A", *FEB)])
    folders = seen["plan"][seen["plan"].index("PartitionFilters"):].split("\n")[0]
    assert "ym#" in folders and "2024-02" in folders and "region_id" in folders


def test_replace_with_nothing_empties_the_month_only(store, spark):
    old = [(D(2024, 1, 31), "A", 1.0), (D(2024, 2, 1), "A", 1.0), (D(2024, 2, 10), "B", 1.0)]
    store.append(SST, sst_rows(spark, old))
    assert store.replace_days(SST, sst_rows(spark, []), [("A", *FEB)]) == 0
    assert content(store) == [old[0], old[2]]
    assert store.replace_days(SST, sst_rows(spark, []), [("C", *FEB)]) == 0
    assert content(store) == [old[0], old[2]]


def test_replace_part_of_a_month_and_rows_outside_the_window(store, spark):
    old = [(D(2024, 1, d), "A", 1.0) for d in (1, 10, 20, 31)] + [(D(2024, 2, 5), "A", 1.0)]
    store.append(SST, sst_rows(spark, old))
    new = [(D(2024, 1, 12), "A", 2.0), (D(2024, 2, 6), "A", 2.0)]     # the second lies outside
    store.replace_days(SST, sst_rows(spark, new), [("A", D(2024, 1, 5), D(2024, 1, 20))])
    assert content(store) == sorted([old[0], old[3], old[4], *new])


def test_replace_many_windows_at_once(store, spark):
    old = [(D(2024, m, 5), r, 1.0) for m in (1, 2, 3) for r in "ABC"]
    store.append(SST, sst_rows(spark, old))
    windows = [("A", *JAN), ("B", *JAN), ("B", *MAR)]
    new = [(D(2024, 1, 6), "A", 2.0), (D(2024, 3, 6), "B", 2.0)]
    store.replace_days(SST, sst_rows(spark, new), windows)
    gone = {(D(2024, 1, 5), "A"), (D(2024, 1, 5), "B"), (D(2024, 3, 5), "B")}
    assert content(store) == sorted([r for r in old if r[:2] not in gone] + new)


def test_windows_merge():
    months = [(D(2024, m, 1), D(2024, m + 1, 1) - dt.timedelta(1)) for m in range(1, 12)]
    every = [(f"R{k}", *m) for k in range(500) for m in months]
    assert [(r, len(ids)) for r, ids in merged_windows(every).items()] == [(((D(2024, 1, 1), D(2024, 11, 30)),), 500)]
    assert merged_windows([("B", *MAR), ("A", *JAN), ("A", *MAR), ("A", D(2024, 1, 5), D(2024, 1, 9)), ("B", *JAN)]) == {
        (JAN, MAR): ["A", "B"]
    }
    assert merged_windows([("A", *JAN), ("B", *FEB)]) == {(JAN,): ["A"], (FEB,): ["B"]}


def centres(first, last):
    """Every 8 days from 4 January."""
    day, out = D(2024, 1, 4), []
    while day <= last:
        if day >= first:
            out.append(day)
        day += dt.timedelta(days=8)
    return out


def test_replace_overlap_keeps_each_window_once(store, spark):
    """Loading months 1, 2, 3, then 2 and 1 again."""
    every = centres(D(2024, 1, 1), D(2024, 4, 10))

    def load(d0, d1):
        inside = [c for c in every if c - dt.timedelta(3) <= d1 and c + dt.timedelta(4) >= d0]
        store.replace_overlap(CHL, chl_rows(spark, [(c, r, 1.0) for c in inside for r in "AB"]), [("A", d0, d1), ("B", d0, d1)])

    for month in (JAN, FEB, MAR, FEB, JAN):
        load(*month)
    got = [r[:2] for r in content(store, CHL, "chl_mg_m3")]
    expected = [(c - dt.timedelta(3), r) for c in every if c - dt.timedelta(3) <= MAR[1] for r in "AB"]
    assert sorted(got) == sorted(expected)


def test_interrupted_replace_is_finished_by_the_next(store, spark, monkeypatch):
    old = [(D(2024, 2, 1), "A", 1.0), (D(2024, 2, 20), "A", 1.0)]
    store.append(SST, sst_rows(spark, old))

    def lost(*_):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(store, "_publish", lost)
    with pytest.raises(RuntimeError):
        store.replace_days(SST, sst_rows(spark, [(D(2024, 2, 2), "A", 2.0)]), [("A", D(2024, 2, 1), D(2024, 2, 10))])
    monkeypatch.undo()
    assert content(store) == old        # not touched yet
    store.replace_days(SST, sst_rows(spark, [(D(2024, 3, 2), "A", 3.0)]), [("A", *MAR)])
    assert content(store) == [(D(2024, 2, 2), "A", 2.0), old[1], (D(2024, 3, 2), "A", 3.0)]


def test_failed_staging_leaves_the_table_and_is_discarded(store, spark):
    old = [(D(2024, 2, 1), "A", 1.0)]
    store.append(SST, sst_rows(spark, old))
    bad = sst_rows(spark, [(D(2024, 2, 2), "A", 2.0)]).withColumn("lat", F.raise_error(F.lit("bad row")).cast("double"))
    with pytest.raises(Exception, match="bad row"):
        store.replace_days(SST, bad, [("A", *FEB)])
    assert content(store) == old
    store.replace_days(SST, sst_rows(spark, []), [("A", *JAN)])
    assert content(store) == old


def test_dry_run_writes_nothing(store, spark):
    assert store.dry_run(sst_rows(spark, [(D(2024, 1, 1), "A", 1.0)] * 3)) == 3
    assert content(store) == []


def test_settings_are_restored(store, spark):
    parts = "spark.sql.adaptive.coalescePartitions"
    keys = ("spark.sql.sources.partitionOverwriteMode", f"{parts}.minPartitionSize", f"{parts}.minPartitionNum")
    before = [spark.conf.get(k, None) for k in keys]
    store.replace_days(SST, sst_rows(spark, [(D(2024, 1, 1), "A", 1.0)]), [("A", *JAN)])
    assert [spark.conf.get(k, None) for k in keys] == before


def test_create_or_replace(store, spark):
    name = store.create_or_replace("t", spark.range(3).toDF("x"))
    store.create_or_replace("t", spark.table(name).selectExpr("x + 10 AS x", "'b' AS y"))     # reads what it replaces
    assert sorted(tuple(r) for r in spark.table(name).collect()) == [(10, "b"), (11, "b"), (12, "b")]
    with pytest.raises(Exception, match="broken"):
        store.create_or_replace("t", spark.range(1).select(F.raise_error(F.lit("broken")).alias("x")))
    assert spark.table(name).count() == 3       # the old table survives a failed job
    store.create_or_replace("t", spark.range(1).toDF("z"))
    assert spark.table(name).columns == ["z"]


def test_feature_tables_and_reports(store, spark):
    store.append(SST, sst_rows(spark, [(D(2024, 1, d), r, float(d)) for d in (1, 2, 3) for r in "AB"]))
    store.append(CHL, chl_rows(spark, [(D(2024, 1, 4), "A", 5.0)]))
    assert build_base(store, ["B"]).count() == 3
    assert build_base(store).count() == 8 + 3
    got = build_features(store)
    assert len(got.columns) == 24
    assert {(r.region_id, r.date.day): r.sst_lag1 for r in got.collect()}["B", 3] == 2.0
    assert [tuple(r) for r in loaded(store, SST, *JAN, regions=["A"]).collect()] == [
        ("A", 3, D(2024, 1, 1), D(2024, 1, 3))
    ]
    assert [tuple(r) for r in loaded(store, CHL, *JAN).collect()] == [("A", 1, D(2024, 1, 1), D(2024, 1, 8))]
    reports = quality(store)
    assert reports["sst"].count() == 2 and reports["waves"].count() == 0 and reports["chl"].first().n_windows == 1
    assert store.scan(WAVES).count() == 0
