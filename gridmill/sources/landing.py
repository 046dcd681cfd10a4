"""Triage of landed files: which of them are whole NetCDF or HDF5 files, and why not."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import urlsplit

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmill.schemas import MIN_FILE_BYTES

# File signatures and the formats they stand for -- fixed values
CLASSIC_HEAD = b"CDF"
HDF5_HEAD = b"\x89HDF"


# Schemes whose files executors open by themselves, and the names of theirs that differ -- fixed values
OPENED = ("file", "hdfs", "s3", "s3a", "gs", "abfs", "abfss")
RENAMED = {"s3a": "s3"}
IN_FLIGHT = 16  # files that a task has open at once


def scheme_of(path: str) -> str:
    return urlsplit(path).scheme or "file"


@F.pandas_udf(T.StructType([T.StructField("head", T.BinaryType()), T.StructField("problem", T.StringType())]))
def head4(paths: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    """The first four bytes of each file, or why there are none: ``missing`` if the file has gone since it was
    listed, else ``unreadable``. Spark's own reader would load whole files for them."""
    from pyarrow import fs

    systems: dict[str, fs.FileSystem] = {}

    def read(path: str) -> tuple[bytes | None, str | None]:
        try:
            scheme, host = scheme_of(path), urlsplit(path).netloc
            if scheme == "file":
                system, name = systems.setdefault("", fs.LocalFileSystem()), path.removeprefix("file:")
                name = "/" + name.lstrip("/")
            else:
                root = f"{RENAMED.get(scheme, scheme)}://{host}/"
                if root not in systems:
                    systems[root] = fs.FileSystem.from_uri(root)[0]
                system, name = systems[root], fs.FileSystem.from_uri(RENAMED.get(scheme, scheme) + path[len(scheme):])[1]
            with system.open_input_file(name) as file:
                return file.read_at(4, 0), None
        except FileNotFoundError:
            return None, "missing"
        except Exception:
            return None, "unreadable"

    with ThreadPoolExecutor(IN_FLIGHT) as pool:
        for batch in paths:
            yield pd.DataFrame(list(pool.map(read, batch)), columns=["head", "problem"])


def _headed(files: DataFrame, folder: str, opened: Sequence[str]) -> DataFrame:
    """``files`` (path, size) with head and problem."""
    if scheme_of(folder) in opened:
        return files.withColumn("read", head4("path")).select("path", "size", "read.head", "read.problem")
    # other stores are known to Spark alone: its reader loads the files, and only their heads go on
    heads = (
        files.sparkSession.read.format("binaryFile").option("recursiveFileLookup", "true").option("ignoreMissingFiles", "true")
        .load(folder).select("path", F.substring("content", 1, 4).alias("head"))
    )
    return files.join(heads, "path", "left").withColumn("problem", F.when(F.col("head").isNull(), "missing"))


def triage(
    spark: SparkSession,
    folder: str,
    expected: DataFrame | None = None,
    key: Column | None = None,
    min_bytes: int = MIN_FILE_BYTES,
    glob: str = "*",
    opened: Sequence[str] = OPENED,
) -> DataFrame:
    """Every file below ``folder`` with ``ok``, ``kind`` (good files) and ``reason`` (others).

    A file is good if it has at least ``min_bytes`` and starts like NetCDF classic or HDF5.
    ``expected`` adds what should be there and is not: a frame with one column, matched against
    ``key``, an expression over ``path`` of the same name (by default the path itself). The
    listing reads no content, and only files that are large enough are opened, several at a time, by their
    first bytes. A file that goes between its listing and its opening is ``missing``, one that cannot be
    opened ``unreadable``; neither fails the job. One that has gone before its size was read is not
    there any more: it has a row if it is ``expected``. Files of schemes not in ``opened`` are read by Spark, whole.
    """
    key = F.col("path") if key is None else key
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .option("ignoreMissingFiles", "true")
        .load(folder)
        .select("path", F.col("length").alias("size"))
    )
    large = F.col("size") >= min_bytes
    headed = _headed(files.where(large), folder, opened).unionByName(files.where(~large), allowMissingColumns=True)
    kind = F.when(F.substring("head", 1, 3) == F.lit(CLASSIC_HEAD), "netcdf_classic").when(
        F.col("head") == F.lit(HDF5_HEAD), "netcdf4_hdf5"
    )
    found = headed.select(
        key,
        "size",
        kind.isNotNull().alias("ok"),
        kind.alias("kind"),
        F.when(~large, "too_small").when(F.col("problem").isNotNull(), F.col("problem")).when(kind.isNull(), "bad_header").alias("reason"),
    )
    if expected is None:
        return found
    missing = expected.distinct().join(files.select(key), expected.columns, "left_anti")
    return found.unionByName(
        missing.withColumns({"ok": F.lit(False), "reason": F.lit("missing")}), allowMissingColumns=True
    )
