"""One query per operator or pipeline: ``name -> (spark, folder) -> DataFrame``."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmill.functions import days, missing, space
from gridmill.operators import base, checks, features, grid, regions, reports
from gridmill.operators.coerce import coerce
from gridmill.plans.features import build_base, build_features
from gridmill.plans.jobs import ingest, run_tracked
from gridmill.plans.standard import clean_measures, standardize
from gridmill.schemas import CHL, SST, WAVES
from gridmill.session import configure, shared_dir
from gridmill.sources.grids import read_pieces
from gridmill.sources.landing import triage
from gridmill.sources.ledger import read_runs
from gridmill.sources.regions import regions_frame
from gridmill.sources.store import Store
from workload.fixtures import C_BOXES, E_HOURLY, G_BOXES, G_POINTS, OFF_TIES, R_BOXES, R_RAW, Inputs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

STAMP = dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc)
EXTRA_BOXES = (("SEAM", "seam", -5.0, 5.0, -10.0, 10.0), ("DATELINE", "date line", -5.0, 5.0, 170.0, -170.0))


def query(f: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return f(Inputs(configure(spark), folder))

    run.__name__ = f.__name__
    QUERIES[f.__name__] = run
    return f


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to six decimals, never negative zero: engines differ in the last bits only.

    Means of values with few decimals often end exactly on half a unit, where the last bit
    decides. Both engines first move all values by the same small amount off those ties.
    """
    return df.selectExpr(
        *[f"round({c} + {OFF_TIES}D, 6) + 0D AS {c}" if t == "double" else c for c, t in df.dtypes]
    )


def new_store(i: Inputs) -> Store:
    return Store(i.spark, shared_dir(i.spark), f"t{uuid.uuid4().hex[:12]}_").create()


def labelled(rows: DataFrame, source) -> DataFrame:
    return rows.withColumns({"source": F.lit(source.label), "ingested_at": F.lit(STAMP).cast("timestamp")})


# -- features ----------------------------------------------------------------------------------

def l_base(i: Inputs) -> DataFrame:
    return base.region_daily_base(i.gap_sst, i.gap_waves, i.chl)


@query
def region_daily_features(i: Inputs) -> DataFrame:
    return rounded(features.region_daily_features(l_base(i)))


@query
def region_daily_base(i: Inputs) -> DataFrame:
    return rounded(l_base(i))


@query
def features_end_to_end(i: Inputs) -> DataFrame:
    standard = [standardize(raw, s) for raw, s in ((i.raw_sst, SST), (i.raw_waves, WAVES), (i.raw_chl, CHL))]
    return rounded(features.region_daily_features(base.region_daily_base(*standard)))


@query
def sst_region_daily_mean(i: Inputs) -> DataFrame:
    return rounded(base.region_day_mean(i.sst, base.SST_MEANS))


@query
def waves_region_daily_mean(i: Inputs) -> DataFrame:
    return rounded(base.region_day_mean(i.waves, base.WAVES_MEANS))


@query
def one_region_daily_mean(i: Inputs) -> DataFrame:
    return rounded(base.region_day_mean(i.sst, base.SST_MEANS, ["NTT"]))


@query
def chl_window_mean(i: Inputs) -> DataFrame:
    return rounded(base.window_mean(i.chl))


@query
def chl_dailyize(i: Inputs) -> DataFrame:
    return rounded(base.dailyize(i.chl))


@query
def observed_calendar(i: Inputs) -> DataFrame:
    return base.observed_days(i.gap_sst, i.gap_waves, i.chl)


@query
def lag_diff(i: Inputs) -> DataFrame:
    return rounded(l_base(i).select("date", "region_id", *features.lag_columns(), *features.diff_columns()))


@query
def rolling_7(i: Inputs) -> DataFrame:
    return rounded(l_base(i).select("date", "region_id", *features.rolling_columns()))


@query
def calendar_signals(i: Inputs) -> DataFrame:
    return base.observed_days(i.sst, i.waves, i.chl).select("date", "region_id", *features.calendar_columns())


# -- standardisation ---------------------------------------------------------------------------

@query
def sst_standard(i: Inputs) -> DataFrame:
    return rounded(standardize(i.raw_sst, SST).drop("ingested_at"))


@query
def chl_standard(i: Inputs) -> DataFrame:
    d0, d1 = dt.date(2024, 1, 9), dt.date(2024, 1, 18)
    return rounded(standardize(i.raw_chl, CHL, d0=d0, d1=d1).drop("ingested_at"))


@query
def waves_standard(i: Inputs) -> DataFrame:
    d0, d1 = dt.date(2024, 1, 2), dt.date(2024, 1, 29)
    return rounded(standardize(i.raw_waves, WAVES, d0=d0, d1=d1, dense=False).drop("ingested_at"))


@query
def waves_standard_dense(i: Inputs) -> DataFrame:
    raw = i.raw_waves.where(F.to_date("time") != F.lit(dt.date(2024, 1, 15)))
    return rounded(standardize(raw, WAVES).drop("ingested_at"))


@query
def fill_to_null(i: Inputs) -> DataFrame:
    return rounded(
        i.raw_waves.select(
            "time", "region_id", "latitude", "longitude",
            missing.mask_fill("Thgt").alias("thgt_undeclared"),
            missing.mask_fill("Tper", -1).alias("tper_declared"),
            missing.mask_fill("Thgt", "unreadable").alias("thgt_unusable"),
        )
    )


@query
def range_mask(i: Inputs) -> DataFrame:
    rows = clean_measures(i.raw_waves, WAVES)
    return rounded(rows.select("time", "region_id", "latitude", "longitude", *WAVES.outputs))


@query
def grid_to_long(i: Inputs) -> DataFrame:
    return rounded(
        grid.grid_to_long(e_grids(i), ["v_mean", "v_max"]).withColumn("time", F.col("time").cast("timestamp_ntz"))
    )


def e_grids(i: Inputs) -> DataFrame:
    """A grid per region and day from the hourly means: 24 hours x 3 latitudes x 5 longitudes."""
    ntt = F.col("region_id") == "NTT"
    lat0, lon0 = F.when(ntt, -10.0).otherwise(18.0), F.when(ntt, 120.0).otherwise(199.0)
    pos = (F.hour("time") * 15 + (F.col("latitude") - lat0) * 5 + (F.col("longitude") - lon0)).cast("int")
    by_pos = {
        m: F.map_from_entries(F.collect_list(F.struct(pos.alias("pos"), F.col(m).alias("v")))) for m in ("v_mean", "v_max")
    }
    grids = i.sql(E_HOURLY).groupBy("region_id", F.to_date("time").alias("day")).agg(
        *[v.alias(f"{m}_at") for m, v in by_pos.items()]
    )

    def axis(start: Column, n: int) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda k: start + k)

    def values(m: str) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(359)), lambda k: F.try_element_at(F.col(f"{m}_at"), k))

    midnight = F.col("day").cast("timestamp")
    return grids.select(
        "region_id",
        F.transform(F.sequence(F.lit(0), F.lit(23)), lambda h: midnight + F.make_interval(hours=h)).alias("time"),
        axis(lat0, 3).alias("latitude"),
        axis(lon0, 5).alias("longitude"),
        values("v_mean").alias("v_mean"),
        values("v_max").alias("v_max"),
    )


@query
def measures_align(i: Inputs) -> DataFrame:
    e = i.e.select("event_type", F.col("ts").alias("time"), "event_id", "region_id",
                   F.col("latitude").alias("lat"), F.col("longitude").alias("lon"), "value")
    swh = e.where(F.col("event_type").isin("click", "purchase", "view")).withColumn("swh", F.col("value") / 5)
    period = e.where(F.col("event_type").isin("click", "error", "signup")).withColumn(
        "period", (F.col("event_id") % 70).cast("double")
    )
    keys = ["time", "event_id", "region_id", "lat", "lon"]
    return rounded(grid.align_measures({"swh": swh, "period": period}, keys))


@query
def level_select(i: Inputs) -> DataFrame:
    depth = F.when(F.col("event_type") == "view", 0.0).when(F.col("event_type") == "click", 5.0).otherwise(10.0)
    rows = i.e.select("event_id", "region_id", "value", depth.alias("depth"))
    return rounded(grid.select_level(rows, "depth", 5.0))


# -- space -------------------------------------------------------------------------------------

@query
def lon_360(i: Inputs) -> DataFrame:
    lon = ((F.col("l_partkey") * 31 + F.col("l_suppkey")) % 10801).cast("double") / 10 - 540
    points = i.table("lineitem").select("l_orderkey", "l_linenumber", lon.alias("lon"))
    return rounded(points.withColumns({"lon_360": space.lon_360("lon"), "lon_pm180": space.lon_pm180("lon")}))


@query
def lon_seam_split(i: Inputs) -> DataFrame:
    boxes = i.sql(C_BOXES).withColumnRenamed("box_id", "region_id")
    return rounded(
        regions.region_intervals(boxes).select(F.col("region_id").alias("box_id"), "lon_lo", "lon_hi")
    )


@query
def bbox_subset(i: Inputs) -> DataFrame:
    boxes = [(18.0, -7.0, 170.0, -170.0), (-5.0, 5.0, -10.0, 10.0)]
    return rounded(regions.within_boxes(i.sql(G_POINTS), boxes))


@query
def region_assign(i: Inputs) -> DataFrame:
    boxes = i.sql(G_BOXES).unionByName(regions_frame(i.spark)).unionByName(regions_frame(i.spark, EXTRA_BOXES))
    return rounded(
        regions.assign_regions(i.sql(G_POINTS), boxes).select("region_id", "l_orderkey", "l_linenumber", "lat", "lon")
    )


@query
def lon_pieces_concat(i: Inputs) -> DataFrame:
    folder = shared_dir(i.spark)
    west = F.col("lon") < 122.5
    pieces = {"west": i.sst.where(west), "east": i.sst.where(~west)}
    for name, rows in pieces.items():
        rows.write.parquet(f"{folder}/{name}")
    together = read_pieces(i.spark, [f"{folder}/{name}" for name in pieces])
    apart = [read_pieces(i.spark, f"{folder}/{name}") for name in pieces]
    # as one scan, and piece by piece: the same rows twice
    return rounded(
        together.withColumn("how", F.lit("scan")).unionByName(
            grid.concat_pieces(apart, sort=True).withColumn("how", F.lit("concat"))
        )
    )


# -- time --------------------------------------------------------------------------------------

@query
def utc_window(i: Inputs) -> DataFrame:
    d0, d1 = dt.date(2024, 1, 10), dt.date(2024, 1, 16)
    return i.e.where(days.in_utc_window("ts", d0, d1, pad_days=3)).select("event_id", "ts")


@query
def month_range(i: Inputs) -> DataFrame:
    months = i.table("orders").select(
        F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")
    ).distinct()
    return months.select(
        F.col("year").cast("bigint").alias("year"),
        F.col("month").cast("bigint").alias("month"),
        days.month_start("year", "month").alias("d0"),
        days.month_end("year", "month").alias("d1"),
    )


@query
def day_filter(i: Inputs) -> DataFrame:
    return rounded(i.sst.where(days.in_days("date", dt.date(1996, 2, 10), dt.date(1996, 8, 12))))


@query
def period_overlap(i: Inputs) -> DataFrame:
    return rounded(
        i.chl.where(days.overlaps("period_start_date", "period_end_date", dt.date(1996, 2, 1), dt.date(1996, 8, 29)))
    )


# -- checks ------------------------------------------------------------------------------------

@query
def coerce_schema(i: Inputs) -> DataFrame:
    n = F.col("l_linenumber")
    day = F.to_date("l_shipdate").cast("string")
    text = i.table("lineitem").select(
        F.when(n == 1, "not a day").otherwise(day).alias("date"),
        F.when(n == 2, "n/a").when(n == 3, "1d").otherwise(F.col("l_quantity").cast("string")).alias("quantity"),
        F.when(n == 3, "1.7").when(n == 4, "x").when(n == 5, "12.0")
        .otherwise(F.col("l_orderkey").cast("string")).alias("order_key"),
        F.when(n == 6, "24 o'clock").otherwise(F.concat(day, F.lit(" 06:30:00"))).alias("shipped_at"),
        (F.col("l_extendedprice") / 3).alias("third"),
        F.col("l_orderkey").alias("label"),
        F.col("l_returnflag").alias("shape"),
    )
    schema = (
        ("date", "DATE", True), ("quantity", "FLOAT64", False), ("order_key", "INT64", False),
        ("shipped_at", "TIMESTAMP", False), ("third", "INT64", False), ("label", "STRING", False),
        ("shape", "GEOGRAPHY", False), ("absent", "STRING", False),
    )
    return rounded(coerce(text, schema)).withColumn("shipped_at", F.col("shipped_at").cast("timestamp_ntz"))


@query
def null_key_rows(i: Inputs) -> DataFrame:
    n, nan = F.col("l_linenumber"), F.lit(float("nan"))
    rows = i.table("lineitem").select(
        F.when(n != 1, F.to_date("l_shipdate")).alias("date"),
        F.when(n != 2, F.col("l_returnflag")).alias("region_id"),
        F.when(n == 3, nan).when(n != 4, F.col("l_quantity")).alias("lat"),
        F.when(F.col("l_suppkey") % 10 == 3, nan).otherwise(F.col("l_extendedprice")).alias("lon"),
    )
    return checks.missing_counts(rows, ["date", "region_id", "lat", "lon"])


@query
def request_check(i: Inputs) -> DataFrame:
    requests = i.table("orders").select(
        F.element_at(F.array(F.lit("NTT"), F.lit("HAWAII"), F.lit("ATLANTIS")), (F.col("o_custkey") % 3 + 1).cast("int"))
        .alias("region_id"),
        (F.year("o_orderdate") + F.col("o_custkey") % 5 * 9 - 18).cast("int").alias("year"),
        (F.col("o_orderkey") % 15).cast("int").alias("month"),
    ).distinct()
    checked = checks.check_requests(requests, regions_frame(i.spark), SST, today=dt.date(2010, 6, 1))
    return checked.withColumns({c: F.col(c).cast("bigint") for c in ("year", "month")})


# -- reports -----------------------------------------------------------------------------------

@query
def qa_sst(i: Inputs) -> DataFrame:
    return rounded(reports.qa_sst(i.sst))


@query
def qa_waves(i: Inputs) -> DataFrame:
    return rounded(reports.qa_waves(i.waves))


@query
def qa_chl(i: Inputs) -> DataFrame:
    return rounded(reports.qa_chl(i.chl))


MONTHS = (dt.date(1996, 3, 1), dt.date(1997, 10, 31))


@query
def load_check_sst(i: Inputs) -> DataFrame:
    return reports.load_check(i.sst, *MONTHS)


@query
def load_check_waves(i: Inputs) -> DataFrame:
    return reports.load_check(i.waves, *MONTHS)


@query
def load_check_chl(i: Inputs) -> DataFrame:
    return reports.load_check(i.chl, *MONTHS, "period_start_date", "period_end_date")


@query
def profile_grid(i: Inputs) -> DataFrame:
    return reports.profile_grid(i.sst)


@query
def profile_chl(i: Inputs) -> DataFrame:
    return reports.profile_chl(i.chl)


# -- tables ------------------------------------------------------------------------------------

@query
def append_load(i: Inputs) -> DataFrame:
    store = new_store(i)
    store.append(WAVES, labelled(i.waves, WAVES))
    return rounded(store.scan(WAVES).drop("ingested_at"))


@query
def standard_scan(i: Inputs) -> DataFrame:
    store = new_store(i)
    store.append(SST, labelled(i.sst, SST))
    return rounded(store.scan(SST, ["NTT"], dt.date(1996, 2, 10), dt.date(1997, 8, 12)).drop("ingested_at"))


@query
def replace_days(i: Inputs) -> DataFrame:
    """Two whole months, a month that becomes empty, and days inside a month."""
    store = new_store(i)
    store.append(SST, labelled(i.sst, SST))
    two, gone = (dt.date(1996, 2, 1), dt.date(1996, 3, 31)), (dt.date(1997, 5, 1), dt.date(1997, 5, 31))
    part = (dt.date(1998, 1, 10), dt.date(1998, 1, 20))
    windows = [("NTT", *two), ("HAWAII", *two), ("NTT", *gone), ("HAWAII", *part)]
    fresh = i.sst.where(
        days.in_days("date", *two) | (days.in_days("date", *part) & (F.col("region_id") == "HAWAII"))
    ).withColumn("sst_c", F.col("sst_c") + 100)
    for _ in range(2):  # a repeated replace changes nothing
        store.replace_days(SST, labelled(fresh, SST), windows)
    return rounded(store.scan(SST).drop("ingested_at", "source"))


@query
def replace_overlap(i: Inputs) -> DataFrame:
    """February, then March: windows that reach into both are replaced twice, none is lost."""
    store = new_store(i)
    store.append(CHL, labelled(i.chl, CHL))
    for month, add in ((2, 100), (3, 1000)):
        d0, d1 = dt.date(1996, month, 1), dt.date(1996, month + 1, 1) - dt.timedelta(days=1)
        fresh = i.chl.where(
            (F.col("region_id") == "NTT") & days.overlaps("period_start_date", "period_end_date", d0, d1)
        ).withColumn("chl_mg_m3", F.col("chl_mg_m3") + add)
        store.replace_overlap(CHL, labelled(fresh, CHL), [("NTT", d0, d1)])
    return rounded(store.scan(CHL).drop("ingested_at", "source"))


@query
def create_or_replace(i: Inputs) -> DataFrame:
    """The base table for one region, then for all."""
    store = new_store(i)
    for source, rows in ((SST, i.sst), (WAVES, i.waves), (CHL, i.chl)):
        store.append(source, labelled(rows, source))
    build_base(store, ["NTT"])
    return rounded(build_base(store))


@query
def dry_run(i: Inputs) -> DataFrame:
    store = new_store(i)
    ready = store.dry_run(labelled(i.sst, SST))
    return store.scan(SST).agg(F.lit(ready).cast("bigint").alias("rows_ready"), F.count("*").alias("rows_written"))


@query
def run_ledger(i: Inputs) -> DataFrame:
    """A load, a dry run and a failing job, with fixed run ids and times."""
    store = new_store(i)

    def load() -> tuple[int, str]:
        return store.append(WAVES, labelled(i.waves, WAVES)), "n" * 1500

    def rehearse() -> tuple[int, str]:
        store.dry_run(labelled(i.waves, WAVES))
        return 0, "dry_run=True"

    def fail() -> tuple[int, str]:
        store.append(WAVES, labelled(i.waves, WAVES))
        raise ValueError("broken " + "x" * 600)

    for k, job in enumerate((load, rehearse, fail), start=1):
        ticks = iter([dt.datetime(2024, 2, k, 18, 40, 9, 80706), dt.datetime(2024, 2, k, 18, 41)])
        try:
            run_tracked(store, "ingest_waves", job, run_id=f"run-{k}", clock=lambda: next(ticks))
        except ValueError:
            pass
    runs = read_runs(store)
    return runs.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("start_ts", "end_ts")})


@query
def load_jobs(i: Inputs) -> DataFrame:
    """All three loads with replace, the waves twice, then both feature tables."""
    store = new_store(i)
    requests = [("NTT", 2024, 1), ("HAWAII", 2024, 1)]
    for source, raw in ((SST, i.raw_sst), (CHL, i.raw_chl), (WAVES, i.raw_waves), (WAVES, i.raw_waves)):
        ingest(store, source, raw, requests, replace=True, today=dt.date(2025, 1, 1), ingested_at=STAMP)
    build_base(store)
    return rounded(build_features(store))


@query
def ingest_assigned(i: Inputs) -> DataFrame:
    """Raw rows without regions, fifteen months at once, loaded twice: all three tables."""
    store, raw, boxes = new_store(i), i.sql(R_RAW), regions_frame(i.spark, R_BOXES)
    months = [(2024, m) for m in range(1, 13)] + [(2025, m) for m in range(1, 4)]
    requests = [(box[0], *month) for box in R_BOXES for month in months]
    for source in (SST, CHL, WAVES) * 2:
        ingest(store, source, raw, requests, replace=True, assign=True, regions=boxes, today=dt.date(2025, 6, 1), ingested_at=STAMP)
    kept = [
        store.scan(s).select(F.lit(s.name).alias("kind"), F.col(s.day_column).alias("date"), "region_id", "lat", "lon",
                             F.col(s.outputs[0]).alias("value"), F.col(s.outputs[-1]).alias("other"))
        for s in (SST, CHL, WAVES)
    ]
    return rounded(kept[0].unionByName(kept[1]).unionByName(kept[2]))


@query
def landing_triage(i: Inputs) -> DataFrame:
    """All events as landed files: per 500 events a short and a long one, some expected third ones absent."""
    folder = shared_dir(i.spark)
    chunk = F.floor(F.col("event_id") / 500)
    head = (
        F.when(chunk % 5 == 0, F.lit(b"\x89HDF").cast("string")).when(chunk % 5 == 1, "<html>").otherwise("CDF")
    )
    lines = i.e.select(
        (chunk * 3 + F.when(F.col("event_id") % 500 < 20, 0).otherwise(1)).alias("file"),
        F.concat(head, F.format_string("%012d", "event_id")).alias("value"),
    )
    (
        lines.repartition("file").sortWithinPartitions("file", "value")
        .write.partitionBy("file").text(folder)
    )
    absent = i.e.where(chunk % 7 == 5).select((chunk * 3 + 2).alias("file"))
    number = F.regexp_extract("path", r"file=(\d+)", 1).cast("bigint").alias("file")
    return triage(i.spark, folder, expected=lines.select("file").union(absent), key=number, glob="*.txt")
