"""The run ledger: one row per job run."""

from __future__ import annotations

import datetime as dt
import logging

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmill.functions.days import rfc3339_utc
from gridmill.schemas import NOTES_CHARS, PIPELINE_RUNS
from gridmill.sources.store import Store

log = logging.getLogger(__name__)

COLUMNS = [name for name, _, _ in PIPELINE_RUNS]
ARROW_TYPES = {"STRING": pa.string(), "INT64": pa.int64(), "TIMESTAMP": pa.timestamp("us", tz="UTC")}


def log_run(
    store: Store,
    *,
    run_id: str,
    job_name: str,
    start_ts: dt.datetime,
    end_ts: dt.datetime,
    status: str,
    rows_written: int,
    notes: str | None,
) -> bool:
    """Append the row of one run. Never raises: a ledger failure must not hide the job's result."""
    def utc(ts: dt.datetime) -> dt.datetime:
        # naive times are UTC
        return ts if ts.tzinfo else ts.replace(tzinfo=dt.timezone.utc)

    try:
        row = (run_id, job_name, utc(start_ts), utc(end_ts), status, int(rows_written), notes)
        one = pa.table([pa.array([v], ARROW_TYPES[kind]) for v, (_, kind, _) in zip(row, PIPELINE_RUNS)], COLUMNS)
        (
            store.spark.createDataFrame(one)
            .withColumn("notes", F.coalesce(F.left("notes", F.lit(NOTES_CHARS)), F.lit("")))
            .withColumn("run_date", F.to_date("start_ts"))
            .write.insertInto(store.runs)
        )
        return True
    except Exception as error:
        log.error("the run could not be recorded: %s: %s", type(error).__name__, error)
        return False


def read_runs(store: Store, d0: dt.date | None = None, d1: dt.date | None = None) -> DataFrame:
    """Ledger rows, by run date if given, with the start also as RFC 3339 text."""
    runs = store.spark.table(store.runs)
    if d0 is not None:
        runs = runs.where(F.col("run_date") >= F.lit(d0))
    if d1 is not None:
        runs = runs.where(F.col("run_date") <= F.lit(d1))
    return runs.select(*COLUMNS, rfc3339_utc("start_ts").alias("start_text"))
