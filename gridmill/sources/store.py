"""The tables: fixed-schema standard tables, feature tables, run ledger.

Standard tables are Parquet, partitioned by (region_id, ym) with ``ym`` the month of the row's
day. A month per folder keeps files large where a day per folder would not; inside a file rows
are sorted by day, so a day range skips row groups. ``ym`` is derived and stays inside.
"""

from __future__ import annotations

import datetime as dt
import json
import threading
import uuid
from collections.abc import Iterable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from functools import cache, reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gridmill.functions.days import in_days, month_key, overlaps
from gridmill.operators.base import in_regions
from gridmill.operators.checks import guard_non_nulls
from gridmill.operators.coerce import coerce
from gridmill.schemas import DAYS_AFTER_CENTRE, DAYS_BEFORE_CENTRE, PIPELINE_RUNS, SOURCES, SPARK_TYPES, Source
from gridmill.session import require_utc

PARTITION = ("region_id", "ym")
SWITCH, CURRENT = "_switch.json", "_was_current"  # notes in folders of runs and builds; Spark does not read such names
LONGEST_PERIOD = DAYS_BEFORE_CENTRE + DAYS_AFTER_CENTRE + 1
NULL_KEY = "__HIVE_DEFAULT_PARTITION__"    # how a partition folder spells NULL

# (region_id, first day, last day) to be replaced
Window = tuple[str, dt.date, dt.date]


def merged_windows(windows: Iterable[Window]) -> dict[tuple, list[str]]:
    """Day ranges -> regions: a region's touching windows are one range, regions with the same
    ranges share an entry. Any number of months of any number of regions makes one entry."""
    by_region: dict[str, list] = {}
    for region_id, d0, d1 in sorted(windows):
        ranges = by_region.setdefault(region_id, [])
        if ranges and d0 <= ranges[-1][1] + dt.timedelta(days=1):
            ranges[-1] = (ranges[-1][0], max(d1, ranges[-1][1]))
        else:
            ranges.append((d0, d1))
    by_ranges: dict[tuple, list[str]] = {}
    for region_id, ranges in by_region.items():
        by_ranges.setdefault(tuple(ranges), []).append(region_id)
    return by_ranges


def windows_where(windows: Iterable[Window], range_predicate) -> Column:
    """One small predicate for many windows; ``range_predicate(d0, d1)`` tests one day range."""
    branches = [
        F.col("region_id").isin(ids) & _any(range_predicate(d0, d1) for d0, d1 in ranges)
        for ranges, ids in merged_windows(windows).items()
    ]
    return _any(branches)


def _any(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


@cache
def _lock(name: str) -> threading.RLock:
    """One per table: appends and switches of this process do not meet. Processes are told apart by what they find."""
    return threading.RLock()


def _text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


class Watch:
    """What is counted of rows on their way into a table, in the job that writes them: their number, and any
    further aggregates. For one write."""

    def __init__(self, aggregates: Mapping[str, Column] | None = None):
        self.aggregates = {"n_rows": F.count(F.lit(1)), **(aggregates or {})}
        self.seen = Observation()

    def on(self, rows: DataFrame) -> DataFrame:
        return rows.observe(self.seen, *[c.alias(name) for name, c in self.aggregates.items()])

    @property
    def get(self) -> dict:
        return self.seen.get


def watched(watch: Watch | None) -> tuple[Watch, ...]:
    return () if watch is None else (watch,)


class Store:
    """Tables below one root folder. ``prefix`` keeps several stores of a session apart."""

    def __init__(self, spark: SparkSession, root: str, prefix: str = ""):
        require_utc(spark)
        self.spark = spark
        self.root = root.rstrip("/")
        self.prefix = prefix

    # -- names and definitions ------------------------------------------------------------

    def name(self, layer: str, table: str) -> str:
        return f"{self.prefix}{layer}.{table}"

    def standard(self, source: Source) -> str:
        return self.name("standard", source.table)

    @property
    def runs(self) -> str:
        return self.name("ops", "pipeline_runs")

    def create(self) -> Store:
        """Create the layers, the standard tables and the ledger where they do not exist."""
        for layer in ("standard", "features", "ops"):
            self.spark.sql(
                f"CREATE DATABASE IF NOT EXISTS {self.prefix}{layer} LOCATION {_text(f'{self.root}/{layer}')}"
            )
        for source in SOURCES.values():
            self._create_standard(self.standard(source), source)
        columns = ", ".join(f"{c} {SPARK_TYPES[kind]}" for c, kind, _ in PIPELINE_RUNS)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.runs} ({columns}, run_date date) "
            "USING parquet PARTITIONED BY (run_date)"
        )
        return self

    def _create_standard(self, name: str, source: Source) -> None:
        columns = ", ".join(
            f"{c} {SPARK_TYPES[kind]}{' NOT NULL' if required else ''}" for c, kind, required in source.schema
        )
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}, ym string) "
            "USING parquet PARTITIONED BY (region_id, ym)"
        )

    # -- reading ----------------------------------------------------------------------------

    def scan(
        self,
        source: Source,
        regions: Sequence[str] | None = None,
        d0: dt.date | None = None,
        d1: dt.date | None = None,
    ) -> DataFrame:
        """A standard table's rows. Region and days select folders, days also row groups.

        For composite windows the day range is on the period start.
        """
        rows = in_regions(self.spark.table(self.standard(source)), regions)
        day = source.day_column
        if d0 is not None:
            rows = rows.where((F.col("ym") >= f"{d0:%Y-%m}") & (F.col(day) >= F.lit(d0)))
        if d1 is not None:
            rows = rows.where((F.col("ym") <= f"{d1:%Y-%m}") & (F.col(day) <= F.lit(d1)))
        return rows.select(*source.columns)

    # -- writing ----------------------------------------------------------------------------

    def _keyed(self, rows: DataFrame, source: Source) -> DataFrame:
        """Coerced rows in table order with the partition key. A required value that is missing,
        or that coercion could not read, fails the write."""
        rows = coerce(rows.select(*source.columns), source.schema)
        rows = guard_non_nulls(rows, source.required, f"{source.name} table rows")
        if source.composite:
            days = F.datediff("period_end_date", "period_start_date") + 1
            error = F.raise_error(F.lit(f"a period of {source.name} has not 1 to {LONGEST_PERIOD} days")).cast("date")
            rows = rows.withColumn("period_end_date", F.when(days.isNull() | days.between(1, LONGEST_PERIOD), F.col("period_end_date")).otherwise(error))
        data = [c for c in source.columns if c not in PARTITION]
        keys = {"region_id": F.col("region_id"), "ym": month_key(source.day_column)}
        return rows.select(*data, *[c.alias(k) for k, c in keys.items()])

    @staticmethod
    def _keys_present(rows: DataFrame) -> DataFrame:
        """Keys that cannot be NULL spare the writer its own handling of empty strings, which
        would put a second sort, by the keys alone, in place of the sort by day."""
        return rows.withColumns({k: F.coalesce(k, F.lit(NULL_KEY)) for k in PARTITION})

    def _laid_out(self, rows: DataFrame, source: Source, watch: Watch) -> DataFrame:
        """Rows gathered by partition and sorted by day.

        ``rebalance`` lets the adaptive planner split a partition that holds far more than the
        others over several tasks (and files). Rows are counted after that shuffle, in the stage
        that writes: its tasks count once even if they are retried.
        """
        rows = self._keys_present(rows)
        counted = watch.on(rows.hint("rebalance", *PARTITION))
        return counted.sortWithinPartitions(*PARTITION, source.day_column, "lat", "lon")

    def append(self, source: Source, rows: DataFrame, watch: Watch | None = None) -> int:
        """Append rows under the table's schema; returns their number."""
        watch = watch or Watch()
        keyed, table = self._keyed(rows, source), self.standard(source)
        # no partition moves while files are written to where it is
        with _lock(f"{self.root} {table}"), self._settings(self._write_settings()):
            self._laid_out(keyed, source, watch).write.insertInto(table)
        return watch.get["n_rows"]

    def _write_settings(self) -> dict[str, str]:
        """The hash by partition decides the number of files; merging small reduce tasks further would
        only make few tasks write many files one after the other."""
        return {
            "spark.sql.adaptive.coalescePartitions.minPartitionNum": str(self.spark.sparkContext.defaultParallelism),
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16k",
        }

    def dry_run(self, rows: DataFrame, watch: Watch | None = None) -> int:
        """Run everything except the write; returns the number of rows that are ready."""
        watch = watch or Watch()
        watch.on(rows).write.format("noop").mode("overwrite").save()
        return watch.get["n_rows"]

    def replace_days(self, source: Source, rows: DataFrame, windows: Iterable[Window], watch: Watch | None = None) -> int:
        """Rows of the windows' regions with a day inside them give way to ``rows``."""
        def inside(d0: dt.date, d1: dt.date) -> Column:
            # implied by the days, but this is what selects folders
            months = F.col("ym").between(f"{d0:%Y-%m}", f"{d1:%Y-%m}")
            return months & in_days(source.day_column, d0, d1)

        return self.replace_where(source, windows_where(windows, inside), rows, *watched(watch))

    def replace_overlap(self, source: Source, rows: DataFrame, windows: Iterable[Window], watch: Watch | None = None) -> int:
        """Composite rows of the windows' regions that overlap them give way to ``rows``."""
        def overlap(d0: dt.date, d1: dt.date) -> Column:
            # a period has LONGEST_PERIOD days, which every write checks, so the folders follow
            first = d0 - dt.timedelta(days=LONGEST_PERIOD - 1)
            months = F.col("ym").between(f"{first:%Y-%m}", f"{d1:%Y-%m}")
            return months & overlaps("period_start_date", "period_end_date", d0, d1)

        return self.replace_where(source, windows_where(windows, overlap), rows, *watched(watch))

    def replace(self, source: Source, rows: DataFrame, windows: Iterable[Window], watch: Watch | None = None) -> int:
        return (self.replace_overlap if source.composite else self.replace_days)(source, rows, windows, watch)

    def replace_where(self, source: Source, predicate: Column, rows: DataFrame, watch: Watch | None = None) -> int:
        """Delete what matches ``predicate``, add ``rows``; returns the number of rows added.

        Parquet tables have no DELETE, so partitions are made new, and only those that hold matching or
        new rows. Each call is a run with a folder of its own:

        1. the new rows are written there (the expensive part; the table is not touched);
        2. rows of the affected partitions that stay are added, and what is to be switched is noted down;
        3. the catalog is told that the partitions are in this folder now (those that have become empty
           are dropped), and their old files go. Nothing is copied.

        A failure before 3 changes nothing. A call that stopped during 3 is finished by the next one,
        which takes along rows that were appended in between. If an affected partition has changed since
        its files were listed, the call is refused and changes nothing. Readers can see some partitions
        replaced before others. Only partition keys and file names reach the driver.
        """
        table = self.standard(source)
        self._finish_interrupted(table, source)
        folder = f"{self._runs_folder(table)}/{uuid.uuid4().hex}"
        try:
            old = self.spark.table(table)
            hit = {tuple(r) for r in old.where(predicate).select(*PARTITION).distinct().collect()}
            written = self._stage(folder, self._keyed(rows, source), source, watch)
            affected = hit | set(self._staged(folder))
            before = self._files(table, affected)
            if before:
                stays = old.where(self._in_partitions(before)).where(~F.coalesce(predicate, F.lit(False)))
                self._stage(folder, stays, source)
            switch = {key: sorted(before.get(key, ())) for key in sorted(affected)}
        except BaseException:
            self._path(folder, delete=True)
            raise
        with _lock(f"{self.root} {table}"):
            changed = [key for key, files in self._files(table, affected).items() if sorted(files) != switch[key]]
            if changed or set(before) - self._partitions(table):
                self._path(folder, delete=True)
                raise RuntimeError(f"{table}: partitions {sorted(changed) or sorted(before)} changed while rows for them were staged; load again")
            if switch:
                self._note(folder, switch)
                self._publish(table, folder, switch)
        return written

    # -- runs: folders with staged partitions --------------------------------------------------

    def _runs_folder(self, table: str) -> str:
        return f"{self.root}/standard_runs/{table.split('.')[-1]}"

    def _path(self, name: str, delete: bool = False):
        """(file system, path) by Hadoop, for any scheme Spark knows."""
        context = self.spark.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(name)
        files = path.getFileSystem(context._jsc.hadoopConfiguration())
        if delete:
            files.delete(path, True)
        return files, path

    def _listed(self, folder: str) -> list[str]:
        """Names in a folder; none if it is not there."""
        files, path = self._path(folder)
        return [f.getPath().getName() for f in files.listStatus(path)] if files.exists(path) else []

    def _stage(self, folder: str, keyed: DataFrame, source: Source, watch: Watch | None = None) -> int:
        watch = watch or Watch()
        with self._settings(self._write_settings()):
            self._laid_out(keyed, source, watch).write.mode("append").partitionBy(*PARTITION).parquet(folder)
        return watch.get["n_rows"]

    def _staged(self, folder: str) -> dict[tuple[str, str], str]:
        """Folder of each staged partition."""
        return {
            (unquote(region.split("=", 1)[1]), unquote(month.split("=", 1)[1])): f"{folder}/{region}/{month}"
            for region in self._listed(folder) if region.startswith("region_id=")
            for month in self._listed(f"{folder}/{region}") if month.startswith("ym=")
        }

    def _files(self, table: str, keys: set[tuple[str, str]]) -> dict[tuple[str, str], set[str]]:
        """The files of partitions, those without any left out."""
        self.spark.catalog.refreshTable(table)
        found: dict[tuple[str, str], set[str]] = {}
        for file in self.spark.table(table).where(self._in_partitions(keys)).inputFiles() if keys else ():
            # a file name is a URI of a path in which keys are escaped already
            region, month = unquote(file).rsplit("/", 3)[1:3]
            key = unquote(region.split("=", 1)[1]), unquote(month.split("=", 1)[1])
            if key in keys:
                found.setdefault(key, set()).add(unquote(file))
        return found

    def _note(self, folder: str, switch: dict[tuple[str, str], list[str]]) -> None:
        """What is to be switched, kept beside the staged rows until it is done."""
        files, path = self._path(f"{folder}/{SWITCH}")
        out = files.create(path, True)
        out.write(bytearray(json.dumps([[*key, old] for key, old in switch.items()]).encode()))
        out.close()

    def _noted(self, folder: str) -> str:
        files, path = self._path(f"{folder}/{SWITCH}")
        stream = files.open(path)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _finish_interrupted(self, table: str, source: Source) -> None:
        """Publish what stopped calls had noted down, together with what was appended since."""
        for run in self._listed(self._runs_folder(table)):
            folder = f"{self._runs_folder(table)}/{run}"
            with _lock(f"{self.root} {table}"):
                if SWITCH not in self._listed(folder):
                    continue
                switch = {(region, month): old for region, month, old in json.loads(self._noted(folder))}
                found = self._files(table, set(switch))
                switched = {key for key, files in found.items() if any(f"/{run}/" in f for f in files)}
                left = {key: found.get(key, set()) for key in switch if key not in switched}
                schema = self.spark.table(table).drop(*PARTITION).schema
                later = [
                    self.spark.read.schema(schema).parquet(*sorted(files - set(switch[key]))).withColumns(dict(zip(PARTITION, map(F.lit, key))))
                    for key, files in left.items() if files - set(switch[key])
                ]
                if later:
                    self._stage(folder, reduce(DataFrame.unionByName, later), source)
                self._publish(table, folder, {key: sorted(files) for key, files in left.items()})

    def _publish(self, table: str, folder: str, switch: dict[tuple[str, str], list[str]]) -> None:
        """Switch the partitions to the staged folders, drop the emptied ones, remove old files and the note."""
        staged, present = self._staged(folder), self._partitions(table)
        spec = {key: f"PARTITION (region_id = {_text(key[0])}, ym = {_text(key[1])})" for key in switch}
        added = [f"{spec[key]} LOCATION {_text(staged[key])}" for key in switch if key in staged and key not in present]
        for key in switch:
            if key in staged and key in present:
                self.spark.sql(f"ALTER TABLE {table} {spec[key]} SET LOCATION {_text(staged[key])}")
        if added:
            self.spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(added)}")
        emptied = [spec[key] for key in switch if key not in staged]
        if emptied:
            self.spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(emptied)}")
        self.spark.catalog.refreshTable(table)
        for old in switch.values():
            for file in old:
                self._path(file, delete=True)
        self._path(f"{folder}/{SWITCH}", delete=True)

    @contextmanager
    def _settings(self, wanted: dict[str, str]) -> Iterator[None]:
        """Session settings for one write; ``insertInto`` takes them from nowhere else."""
        before = {key: self.spark.conf.get(key, None) for key in wanted}
        for key, value in wanted.items():
            self.spark.conf.set(key, value)
        try:
            yield
        finally:
            for key, value in before.items():
                if value is None:
                    self.spark.conf.unset(key)
                else:
                    self.spark.conf.set(key, value)

    def _partitions(self, table: str) -> set[tuple[str, str]]:
        """(region_id, ym) of a table's folders, from the catalog."""
        specs = [r["partition"].split("/") for r in self.spark.sql(f"SHOW PARTITIONS {table}").collect()]
        return {tuple(unquote(part.split("=", 1)[1]) for part in spec) for spec in specs}

    @staticmethod
    def _in_partitions(keys: Iterable[tuple[str, str]]) -> Column:
        by_months: dict[tuple, list] = {}
        months_of: dict[str, list] = {}
        for region_id, ym in sorted(keys):
            months_of.setdefault(region_id, []).append(ym)
        for region_id, months in months_of.items():
            by_months.setdefault(tuple(months), []).append(region_id)
        return _any(F.col("region_id").isin(ids) & F.col("ym").isin(list(ms)) for ms, ids in by_months.items())

    def create_or_replace(self, table: str, rows: DataFrame) -> str:
        """A feature table made new from ``rows``, which may read the old one.

        Each build has a folder of its own, and the name is a view on the last one that was written in
        full. One catalog call moves the view, so there is no time without a table, and a build that
        fails or stops at any step leaves the old one in place. Then builds go but this one and the one
        before, which readers may still have open.
        """
        name = self.name("features", table)
        builds = f"{self.root}/features/{table}_builds"
        build = f"{builds}/{uuid.uuid4().hex}"
        try:
            rows.write.parquet(build)
            self.spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM parquet.`{build}`")
        except BaseException:
            self._path(build, delete=True)
            raise
        files, mark = self._path(f"{build}/{CURRENT}")
        files.create(mark, True).close()
        self._drop_old(builds, build)
        return name

    def _drop_old(self, builds: str, newest: str) -> None:
        """Builds go that were the view's before the last one was; others may still be written."""
        files, path = self._path(builds)
        marks = [m for f in files.listStatus(path) for m in (files.globStatus(self._path(f"{f.getPath()}/{CURRENT}")[1]) or [])]
        others = [m for m in marks if m.getPath().getParent().getName() != newest.rsplit("/", 1)[1]]
        for old in sorted(others, key=lambda m: m.getModificationTime())[:-1]:
            files.delete(old.getPath().getParent(), True)
