"""Load jobs: standardise, check, write, and keep the ledger."""

from __future__ import annotations

import calendar
import datetime as dt
import logging
import uuid
from collections.abc import Callable, Iterable, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmill.operators import reports
from gridmill.operators.checks import check_requests, null_error
from gridmill.operators.grid import standard_axes
from gridmill.operators.regions import box_cover, in_cover
from gridmill.plans.standard import standardize, time_window
from gridmill.schemas import ERROR_CHARS, Source
from gridmill.sources.ledger import log_run
from gridmill.sources.regions import regions_frame
from gridmill.sources.store import Store, Watch, Window, windows_where

log = logging.getLogger(__name__)

# (region_id, year, month)
Request = tuple[str, int, int]


def now_utc() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


def run_tracked(
    store: Store,
    job_name: str,
    job: Callable[[], tuple[int, str]],
    *,
    run_id: str | None = None,
    clock: Callable[[], dt.datetime] = now_utc,
) -> int:
    """Run ``job() -> (rows_written, notes)`` and log the run, whatever happens.

    A failing job is logged as FAILED with no rows and its error, which is raised again.
    """
    run_id = run_id or str(uuid.uuid4())
    record = {"run_id": run_id, "job_name": job_name, "start_ts": clock()}
    log.info("tracked run %s of job %s begins", run_id, job_name)
    try:
        rows_written, notes = job()
    except BaseException as error:
        text = f"{type(error).__name__}: {error}"[:ERROR_CHARS]
        log_run(
            store, **record, end_ts=clock(), status="FAILED", rows_written=0,
            notes=f"job={job_name} run_id={run_id} err={text}",
        )
        raise
    log_run(store, **record, end_ts=clock(), status="SUCCESS", rows_written=rows_written, notes=notes)
    return rows_written


def month_windows(requests: Iterable[Request]) -> list[Window]:
    """Requests as (region_id, first day, last day); job parameters, so plain Python."""
    return sorted({
        (region, dt.date(year, month, 1), dt.date(year, month, calendar.monthrange(year, month)[1]))
        for region, year, month in requests
    })


def require_requests(
    store: Store, requests: Iterable[Request], regions: DataFrame, source: Source, today: dt.date | None = None
) -> None:
    """Raise if a request has a wrong month or year or an unknown region."""
    ids, years, months = zip(*requests)
    frame = store.spark.createDataFrame(
        pa.table([pa.array(ids, pa.string()), pa.array(years, pa.int32()), pa.array(months, pa.int32())],
                 ["region_id", "year", "month"])
    )
    bad = check_requests(frame, regions, source, today).where(~F.col("valid")).collect()
    if bad:
        raise ValueError("; ".join(f"{r.region_id} {r.year}-{r.month}: {r.reason}" for r in bad))


def _describe(requests: list[Request]) -> str:
    if len(requests) == 1:
        region, year, month = requests[0]
        return f"region={region} year={year} month={month}"
    first, last = min(r[1:] for r in requests), max(r[1:] for r in requests)
    names = ",".join(sorted({r[0] for r in requests}))
    return f"region={names} from={first[0]}-{first[1]:02d} to={last[0]}-{last[1]:02d} requests={len(requests)}"


def ingest(
    store: Store,
    source: Source,
    raw: DataFrame,
    requests: Iterable[Request],
    *,
    replace: bool = False,
    dry_run: bool = False,
    regions: DataFrame | None = None,
    assign: bool = False,
    fills: Mapping[str, object] | None = None,
    log_row_stats: bool = False,
    run_id: str | None = None,
    today: dt.date | None = None,
    ingested_at: dt.datetime | None = None,
) -> int:
    """Load region-months of one source from raw long rows; returns the rows written.

    ``raw`` carries ``region_id``, or with ``assign`` gets it from the boxes in ``regions``. All
    requests run as one Spark job. ``replace`` makes a repeated load leave the same rows;
    ``dry_run`` does everything except the write. One ledger row per call. Requests are checked
    first, before the run is tracked.
    """
    requests = list(requests)
    if not requests:
        raise ValueError("no requests")
    known = regions if regions is not None else regions_frame(store.spark)
    require_requests(store, requests, known, source, today)
    windows = month_windows(requests)
    wanted = windows_where(windows, lambda d0, d1: time_window(source, d0, d1))
    # the hull of all windows is on the time alone and so reaches the scan in any case
    first, last = min(w[1] for w in windows), max(w[2] for w in windows)

    def job() -> tuple[int, str]:
        rows_in, boxes = raw, None
        if assign:
            ids = sorted({w[0] for w in windows})
            boxes = known.where(F.col("region_id").isin(ids))
            # for any number of boxes, and wider than the exact test, which decides
            rows_in = standard_axes(raw)
            rows_in = rows_in.where(in_cover("lat", "lon", box_cover(boxes)))

        def rows(guard: bool) -> DataFrame:
            return standardize(
                rows_in, source, within=wanted, d0=first, d1=last, regions=boxes, fills=fills,
                ingested_at=ingested_at, guard=guard,
            )

        # counted on the way, in the job that writes
        watch = Watch(reports.observed_profile(source.composite)) if log_row_stats else None
        try:
            if dry_run:
                store.dry_run(rows(True), watch)
                written = 0
            elif replace:
                written = store.replace(source, rows(True), windows, watch)
            else:
                written = store.append(source, rows(True), watch)
        except Exception as error:
            if "required values are missing" in str(error):
                # only now is a second pass worth it: list offending rows
                raise null_error(rows(False), source.required, f"{source.name} table rows") or error from error
            raise
        if watch is not None:
            log.info("rows loaded: %s", reports.as_profile(watch.get))
        notes = (
            f"{_describe(requests)} dry_run={dry_run} replace={replace} "
            f"table={store.standard(source)} dataset_id={source.dataset_id}"
        )
        return written, notes

    return run_tracked(store, source.job_name, job, run_id=run_id)
