"""Triage of landed files that go, cannot be opened, or lie in stores that only Spark knows."""

import os

import pytest
from pyspark.sql import functions as F

from gridmill.sources import landing


def land(folder, name, head, size=2000):
    (folder / name).parent.mkdir(parents=True, exist_ok=True)
    (folder / name).write_bytes(head + b"\0" * (size - len(head)))


def found(df):
    return sorted((r.path.rsplit("/", 1)[-1], r.ok, r.kind, r.reason) for r in df.collect())


GOOD = [("a b%20é#.nc", True, "netcdf_classic", None), ("bad.nc", False, None, "bad_header"), ("h5.nc", True, "netcdf4_hdf5", None), ("small.nc", False, None, "too_small")]


@pytest.fixture
def folder(tmp_path):
    land(tmp_path, "sub/a b%20é#.nc", b"CDF\x01")
    land(tmp_path, "h5.nc", b"\x89HDF")
    land(tmp_path, "bad.nc", b"<htm")
    land(tmp_path, "small.nc", b"CDF\x01", 20)
    return tmp_path


@pytest.mark.parametrize("opened", [landing.OPENED, ()])
def test_names_heads_and_reasons(spark, folder, opened):
    assert found(landing.triage(spark, f"file://{folder}", opened=opened)) == GOOD
    assert found(landing.triage(spark, str(folder), opened=opened)) == GOOD


@pytest.mark.parametrize("opened", [landing.OPENED, ()])
def test_an_expected_file_that_goes_meanwhile_gives_a_row(spark, folder, opened):
    names = spark.createDataFrame([(r[0],) for r in GOOD], "path string")
    df = landing.triage(spark, str(folder), names, F.regexp_extract("path", "[^/]*$", 0).alias("path"), opened=opened)
    (folder / "h5.nc").unlink()
    assert found(df) == [("h5.nc", False, None, "missing") if r[0] == "h5.nc" else r for r in GOOD]
    assert len(landing.triage(spark, str(folder), opened=opened).collect()) == 3


def test_a_file_that_cannot_be_opened(spark, folder, monkeypatch):
    real = landing.scheme_of
    rows = spark.createDataFrame([(f"file:{folder}/h5.nc",), ("file:/nowhere/x.nc",), ("nostore://host/x.nc",), (f"file:{folder}",)], "path string")
    got = [(r.read.head and bytes(r.read.head), r.read.problem) for r in rows.coalesce(1).withColumn("read", landing.head4("path")).collect()]
    assert got == [(b"\x89HDF", None), (None, "missing"), (None, "unreadable"), (None, "unreadable")]
    assert real("s3a://bucket/x") == "s3a" and real("/plain") == "file" and os.path.exists(folder)
