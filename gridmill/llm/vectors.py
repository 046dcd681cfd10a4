"""Tables of vectors: which rows take part, and their matrices inside tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmill.llm.steps import written

ROOM = 1 << 22  # numbers in a matrix of comparisons


def usable(rows: DataFrame, id_column: str, vector: str, zero: bool) -> DataFrame:
    """(id, v) of rows with an id and only finite components; with a length above 0 unless ``zero``."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    kept = rows.where(F.col(id_column).isNotNull() & F.col(vector).isNotNull() & (F.size(vector) > 0) & ~odd)
    if not zero:
        kept = kept.where(F.exists(vector, lambda x: x != 0))
    return kept.select(F.col(id_column).cast("long").alias("id"), F.col(vector).alias("v"))


def distinct_ids(points: DataFrame) -> DataFrame:
    """One row of each id: of differing vectors the smallest, number by number.

    Ids that repeat are found from the ids alone; only their vectors are shuffled, as partial smallest ones.
    """
    spark = points.sparkSession
    again = written(spark, lambda: points.groupBy("id").count().where("count > 1").select("id"))
    if again.isEmpty():
        return points
    many = points.join(again, "id", "left_semi").groupBy("id").agg(F.min("v").alias("v"))
    return written(spark, lambda: points.join(again, "id", "left_anti").unionByName(many))


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Rows of a column of lists of one length, as doubles."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(column) and pc.count_distinct(pc.list_value_length(column), mode="all").as_py() > 1:
        raise ValueError("vectors differ in length")
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def sample(rows: DataFrame, most: int) -> np.ndarray:
    """At most ``most`` vectors, the first by a hash of the id."""
    found = rows.orderBy(F.xxhash64("id"), "id").limit(most).select("v").collect()
    return np.array([r.v for r in found], np.float64) if found else np.zeros((0, 0))


def first_copies(ids: np.ndarray, vectors: np.ndarray, most: int) -> np.ndarray:
    """Indexes of all rows but those with ``most`` equal vectors of smaller ids.

    With ties going to smaller ids, no result of fewer than ``most`` rows can need the others.
    """
    order = np.argsort(ids, kind="stable")
    raw = np.ascontiguousarray(vectors[order] + 0.0)
    _, group = np.unique(raw.view(np.dtype((np.void, raw.dtype.itemsize * raw.shape[1]))).ravel(), return_inverse=True)
    by = np.argsort(group, kind="stable")
    starts = np.concatenate([[True], group[by][1:] != group[by][:-1]])
    nth = np.arange(len(by)) - np.maximum.accumulate(np.where(starts, np.arange(len(by)), 0))
    return np.sort(order[by[nth < most]])


def unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)
