"""Grids and raw long rows: axes, levels, flattening, aligning, concatenating."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEYS = ("time", "lat", "lon")


def standard_axes(df: DataFrame) -> DataFrame:
    """``latitude``/``longitude`` become ``lat``/``lon``; absent names are ignored."""
    return df.withColumnsRenamed({"latitude": "lat", "longitude": "lon"})


def select_level(df: DataFrame, level: str | None, value: float = 0.0) -> DataFrame:
    """Rows at one value of a vertical axis, the axis itself dropped. No such column: unchanged."""
    if level is None or level not in df.columns:
        return df
    return df.where(F.col(level) == F.lit(value)).drop(level)


def grid_to_long(grids: DataFrame, measures: Sequence[str], level: str | None = None) -> DataFrame:
    """Dense grids to one row per (time, [level], lat, lon), missing cells kept as NULL.

    Each input row is one grid: arrays ``time``, ``lat``, ``lon`` (and ``level``) for the axes
    and one flat array per measure, laid out time-major with longitude running fastest. A NULL array is
    a grid of missing cells; an array that does not fill its grid fails the job. Columns
    besides those are repeated for each cell. A Generate and a Project in one codegen stage, no
    shuffle. A grid row should hold a time chunk that fits a task, not a whole archive.
    """
    grids = standard_axes(grids)
    axes = ["time", *([level] if level else []), "lat", "lon"]
    kept = [c for c in grids.columns if c not in axes and c not in measures]

    size = reduce(lambda n, a: n * F.size(a), axes, F.lit(1))
    wrong = reduce(lambda a, b: a | b, [F.col(m).isNotNull() & (F.size(m) != size) for m in measures])
    message = F.lit("a measure's values do not fill its grid")
    places = F.when(wrong, F.raise_error(message).cast("array<int>")).when(size > 0, F.sequence(F.lit(0), size - 1))
    exploded = grids.select(*kept, *axes, *measures, F.explode(places).alias("pos"))

    columns = []
    for i, axis in enumerate(axes):
        # cells per step of this axis = product of the sizes of the faster axes
        inner = reduce(lambda n, a: n * F.size(a), axes[i + 1:], F.lit(1))
        index = F.col("pos") if axis == "lon" else F.floor(F.col("pos") / inner)
        columns.append(F.col(axis)[(index % F.size(axis)).cast("int")].alias(axis))
    return exploded.select(*kept, *columns, *[F.get(m, F.col("pos")).alias(m) for m in measures])


def align_measures(frames: Mapping[str, DataFrame], keys: Sequence[str] = KEYS) -> DataFrame:
    """Measures from separate frames side by side, outer on the coordinates.

    ``frames`` maps a measure to a frame with the keys and that measure; as in a labelled array
    a coordinate occurs once per frame. A union and one aggregate with map-side merging instead
    of full outer joins, so no side is sorted and a heavy key cannot pile up.
    """
    stacked = concat_pieces([df.select(*keys, m) for m, df in frames.items()])
    return stacked.groupBy(*keys).agg(*[F.max(m).alias(m) for m in frames])


def concat_pieces(pieces: Sequence[DataFrame], sort: bool = False) -> DataFrame:
    """Longitude pieces of one area as one table; ``sort`` orders by longitude inside partitions."""
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), pieces)
    return union.sortWithinPartitions("lon") if sort else union
