"""Grid files: Parquet rows that hold one grid chunk each, with arrays for axes and values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from gridmill.operators.grid import concat_pieces, grid_to_long, standard_axes
from gridmill.schemas import Source


def read_pieces(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """All pieces of an area (one, or two where its box crosses the longitude seam) as one input."""
    return spark.read.parquet(*([paths] if isinstance(paths, str) else paths))


def read_grids(spark: SparkSession, paths: str | Sequence[str], source: Source) -> DataFrame:
    """Raw long rows of a source, from its grid pieces."""
    grids = standard_axes(read_pieces(spark, paths))
    level = source.level if source.level in grids.columns else None
    return grid_to_long(grids, list(source.measures), level)


__all__ = ["concat_pieces", "read_grids", "read_pieces"]
