"""Approximate nearest neighbours by cosine: inverted lists scanned dimension by dimension.

Every vector is in the list of its nearest centroid. Within the lists a query probes, vectors are
compared in a rotated space, a block of columns at a time. A partial distance estimates the whole
one; where a test says that it is too large for the query's k nearest, the candidate is given up.
How far these are at most is known beforehand from a sample of the rows in the same lists. What is
left is scored exactly on the original vectors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridmill.llm.steps import written
from gridmill.llm.vectors import ROOM, distinct_ids, first_copies, matrix, sample, unit, usable

SAMPLE = 1 << 13  # vectors from which centroids are learned, and that bound distances, at most
MOST_LISTS = 1 << 11
ROUNDS = 8
PROBED = 0.75  # share of the lists that a query probes; vectors in clear clusters need far less
LEAST_PROBES = 8
COLUMNS = 16  # in a block
SLACK = 2.1  # of the test: larger gives up fewer candidates
ROUNDING = 1e-9  # of squared distances of unit vectors, at most
SPAN = 1 << 18  # pairs that are tested at a time: their distances stay in a core's cache
MANY, PAIRS = 1 / 16, 1 << 16  # share of pairs left from which on they are taken one by one; so many at a time
LIST_ROWS, QUERY_ROWS = 1 << 14, 1 << 11  # a task's share of a list and of its queries


def centroids(vectors: np.ndarray, count: int) -> np.ndarray:
    """Unit centroids of a spherical k-means; fewer if some stay empty."""
    points = unit(vectors)
    rng = np.random.default_rng(5)
    found = points[rng.permutation(len(points))[:count]]
    for _ in range(ROUNDS):
        nearest = (points @ found.T).argmax(axis=1)
        sums = np.zeros_like(found)
        np.add.at(sums, nearest, points)
        alive = np.linalg.norm(sums, axis=1) > 0
        found = unit(sums[alive])
    return found


def rotation(size: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(11).normal(size=(size, size)))
    return q * np.sign(np.diag(r))


def bounds(queries: np.ndarray, asked: np.ndarray, known: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """Squared distance of unit vectors that each query's k-th nearest row does not exceed: that of its k-th nearest
    among the ``known`` rows, which stand in the lists ``at``; only lists that the query asks count. Infinite if
    these hold too few."""
    found = np.full(len(queries), np.inf)
    if len(known) < k:
        return found
    step = max(1, ROOM // len(known))
    for start in range(0, len(queries), step):
        near = 2 - 2 * queries[start:start + step] @ known.T
        near[~asked[start:start + step][:, at]] = np.inf
        found[start:start + step] = np.partition(near, k - 1, axis=1)[:, k - 1]
    return np.maximum(found, 0) + ROUNDING


def scan(queries: np.ndarray, rows: np.ndarray, k: int, limit: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(query, row) pairs that the tests leave: among them nearly surely each query's k nearest rows, as far as
    their squared distance as unit vectors is at most the query's ``limit``."""
    turn = rotation(rows.shape[1])
    a, b = unit(queries) @ turn, unit(rows) @ turn
    limit = np.full(len(a), np.inf) if limit is None else limit
    out_q, out_r = [], []
    step = max(1, SPAN // len(rows))
    for start in range(0, len(a), step):
        for qi, ri in _left(a[start:start + step], b, k, limit[start:start + step]):
            out_q.append(qi + start)
            out_r.append(ri)
    return np.concatenate([np.zeros(0, np.int64), *out_q]), np.concatenate([np.zeros(0, np.int64), *out_r])


def _left(q: np.ndarray, b: np.ndarray, k: int, limit: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The pairs that no test gives up. While many are left a block of columns is a product of matrices over
    all pairs; once few are, it is taken pair by pair."""
    size = b.shape[1]

    def block(first: int) -> tuple[int, np.ndarray]:
        # partial distances as one product: q.q + b.b - 2 q.b
        d = min(first + COLUMNS, size)
        x, y = q[:, first:d], b[:, first:d]
        left = np.column_stack([-2 * x, (x ** 2).sum(1), np.ones(len(x))])
        return d, left @ np.column_stack([y, np.ones(len(y)), (y ** 2).sum(1)]).T

    def most(bound: np.ndarray, d: int) -> np.ndarray:
        return bound * (1 + SLACK / math.sqrt(d)) ** 2 * (d / size) if d < size else bound

    d, part = block(0)
    # where nothing bounds the k-th distance, whole distances of the k that look nearest so far do
    open_, limit = np.flatnonzero(np.isinf(limit)), limit.copy()
    if len(open_) and k < len(b):
        near = np.argpartition(part[open_], k - 1, axis=1)[:, :k]
        limit[open_] = ((q[open_, None, :] - b[near]) ** 2).sum(axis=2).max(axis=1) + ROUNDING
    alive = part <= most(limit, d)[:, None]
    while d < size and np.count_nonzero(alive) > MANY * alive.size:
        d, more = block(d)
        part += more
        alive &= part <= most(limit, d)[:, None]
    every = np.nonzero(alive)
    for i in range(0, len(every[0]), PAIRS):
        qi, ri = every[0][i:i + PAIRS], every[1][i:i + PAIRS]
        kept, at = part[qi, ri], d
        while at < size:
            columns = slice(at, min(at + COLUMNS, size))
            kept = kept + ((q[qi, columns] - b[ri, columns]) ** 2).sum(axis=1)
            at = columns.stop
            left = kept <= most(limit[qi], at)
            qi, ri, kept = qi[left], ri[left], kept[left]
        yield qi, ri


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, the same for equal rows wherever they stand. Scaled by powers of two, which changes no digit,
    so that squares neither vanish nor overflow."""
    a, b = (x * np.exp2(-np.frexp(np.abs(x).max(axis=1, keepdims=True))[1]) for x in (a, b))
    return (a * b).sum(axis=1) / np.sqrt((a * a).sum(axis=1) * (b * b).sum(axis=1))


def nearest(rows: DataFrame, is_query: Column, k: int = 5, id_column: str = "vec_id", vector: str = "embedding",
            probed: float = PROBED) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows found for each row where ``is_query`` holds.

    ``is_query`` is over ``id``. Rows without an id, and vectors that are null, zero or hold null or
    non-finite components, take no part. Rows of one id are one row, of differing vectors the smallest. All vectors have one length, else
    the job fails. With fewer than k candidates all are returned; an empty table gives no rows.
    """
    spark = rows.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    points = distinct_ids(usable(rows, id_column, vector, zero=False))
    count, seen = points.count(), sample(points, SAMPLE)
    if not count:
        return spark.createDataFrame([], schema)
    lists = centroids(seen, max(1, min(MOST_LISTS, int(math.sqrt(count)))))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = (unit(matrix(batch.column("v"))) @ lists.T).argmax(axis=1) if batch.num_rows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("v"), pa.array(own.astype(np.int32))], names=["id", "v", "list"])

    kind = points.schema["v"].dataType.simpleString()
    index = written(spark, lambda: points.mapInArrow(assign, f"id long, v {kind}, list int"))
    sizes, held_ids = np.zeros(len(lists), np.int64), np.zeros(len(lists), np.int64)
    for number, n, ids in index.groupBy("list").agg(F.count("*"), F.countDistinct("id")).collect():
        sizes[number], held_ids[number] = n, ids
    probes = min(len(lists), max(LEAST_PROBES, math.ceil(probed * len(lists))))
    # lists as the index has them: a query finds the rows that bound its distances
    some = index.orderBy(F.xxhash64("id"), "id").limit(min(SAMPLE, max(1, ROOM // lists.shape[1]))).select("v", "list").toArrow()
    known, at = unit(matrix(some.column("v"))), some.column("list").to_numpy()

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            own = unit(matrix(batch.column("v")))
            order = np.argsort(-(own @ lists.T), axis=1, kind="stable")
            # further lists where the first ones hold too few ids
            enough = (np.cumsum(held_ids[order], axis=1) - held_ids[order]) < 8 * k + 2
            enough[:, :probes] = True
            enough &= held_ids[order] > 0
            q, nth = np.nonzero(enough)
            asks = np.zeros(enough.shape, bool)
            asks[q, order[q, nth]] = True
            limit = bounds(own, asks, known, at, k + 1)  # the query may be one of them
            rows = batch.take(pa.array(q))
            yield pa.RecordBatch.from_arrays(
                [rows.column("id"), rows.column("v"), pa.array(order[q, nth].astype(np.int32)), pa.array(limit[q])], names=["id", "v", "list", "limit"])

    asked = written(spark, lambda: index.where(is_query).select("id", "v").mapInArrow(probe, f"id long, v {kind}, list int, limit double"))
    # long lists, and lists with many queries, are cut so that each pair of parts fits a task
    shares = {number: (max(1, -(-int(sizes[number]) // LIST_ROWS)), max(1, -(-n // QUERY_ROWS)))
              for number, n in asked.groupBy("list").count().collect()}
    cuts = spark.createDataFrame([(a, b, c) for a, (b, c) in shares.items()], "list int, row_parts int, query_parts int")

    def parts(table: DataFrame, own: str, other: str) -> DataFrame:
        each = F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(other)
        return table.join(F.broadcast(cuts), "list").select(*table.columns, F.pmod(F.xxhash64("id"), own).cast("int").alias(own), each)

    keys = ["list", "row_parts", "query_parts"]

    def search(asking: pa.Table, held: pa.Table) -> pa.Table:
        found = {"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)}
        if asking.num_rows and held.num_rows:
            q_ids, q = asking.column("id").to_numpy(), matrix(asking.column("v"))
            ids, v = held.column("id").to_numpy(), matrix(held.column("v"))
            some = first_copies(ids, v, k + 1)
            ids, v = ids[some], v[some]
            qi, ri = scan(q, v, k + 1, asking.column("limit").to_numpy())
            other = q_ids[qi] != ids[ri]
            qi, ri = qi[other], ri[other]
            score = np.concatenate([np.zeros(0), *(cosine(q[qi[i:i + 65536]], v[ri[i:i + 65536]]) for i in range(0, len(qi), 65536))])
            order = np.lexsort((ids[ri], -score, qi))
            qi, ri, score = qi[order], ri[order], score[order]
            nth = np.arange(len(qi)) - np.searchsorted(qi, qi)
            best = nth < k
            found = {"query_id": q_ids[qi[best]], "vec_id": ids[ri[best]], "score": score[best]}
        return pa.table(found)

    hits = parts(asked, "query_parts", "row_parts").groupBy(*keys).cogroup(
        parts(index, "row_parts", "query_parts").groupBy(*keys)).applyInArrow(search, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return hits.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")).withColumn(
        "rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
