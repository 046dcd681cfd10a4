"""The region dimension."""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from gridmill.schemas import REGION_SCHEMA, REGIONS


def regions_frame(spark: SparkSession, regions: Iterable[tuple] = REGIONS) -> DataFrame:
    """Region boxes given in code: (region_id, name, lat_min, lat_max, lon_min, lon_max).

    From an Arrow table the plan holds the rows themselves, so the optimizer knows how few they
    are and broadcasts them in joins.
    """
    columns = list(zip(*regions))
    types = [pa.string()] * 2 + [pa.float64()] * 4
    arrays = [pa.array(c, t) for c, t in zip(columns or [()] * 6, types)]
    return spark.createDataFrame(pa.table(arrays, ["region_id", "name", "lat_min", "lat_max", "lon_min", "lon_max"]))


def read_regions(spark: SparkSession, path: str) -> DataFrame:
    """Region boxes from a file: YAML (``regions: id: {name, boundbox: {...}}``) or JSON lines,
    CSV or Parquet with the columns of ``REGION_SCHEMA``."""
    if path.endswith((".yaml", ".yml")):
        import yaml  # only this format needs it

        # by Spark's file systems, so that the file may lie where the data lies
        entries = yaml.safe_load(spark.read.text(path, wholetext=True).first()[0])["regions"]
        bounds = ("lat_min", "lat_max", "lon_min", "lon_max")
        return regions_frame(
            spark,
            [(key, entry.get("name"), *[float(entry["boundbox"][b]) for b in bounds]) for key, entry in entries.items()],
        )
    kind = next((k for k in ("json", "csv", "parquet") if path.rstrip("/").endswith(k)), "parquet")
    reader = spark.read if kind == "parquet" else spark.read.schema(REGION_SCHEMA)
    return reader.format(kind).options(**({"header": "true"} if kind == "csv" else {})).load(path)
