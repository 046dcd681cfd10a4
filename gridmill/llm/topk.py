"""Exact top-k by inner product: dual-tree search over cover trees.

A coarse cover (centres picked from a bounded sample, every vector under its nearest one) deals
queries and rows into blocks. A pair of blocks, and within it a pair of tree nodes, is skipped when

    c_q . c_r + |c_q| r_r + |c_r| r_q + r_q r_r

(centres c, covering radii r) is below the worst k-th score among the queries of the group. The first
round compares each query block with the rows under its own centre, which sets those scores; the
second does the pairs of blocks that are left. Bounds only ever skip what cannot be a result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridmill.llm.steps import written
from gridmill.llm.vectors import ROOM, distinct_ids, first_copies, matrix, sample, usable

SAMPLE = 1 << 13  # vectors from which centres are picked, at most
MOST_CENTRES = 1 << 10
ROWS, QUERIES = 1 << 13, 1 << 11  # a task's block of rows and of queries
LEAF = 512
CHILDREN = 32
SCALE = 64  # components are floor(SCALE * x)
MARGIN = 1e-6  # relative, for rounding of the bounds


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Whole numbers, held as doubles."""
    return np.floor(SCALE * vectors)


def largest(a: np.ndarray, b: np.ndarray) -> float:
    """No product of a row of each is larger."""
    return float(np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * a.shape[1])


def best_of_large(q: np.ndarray, q_ids: np.ndarray, v: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, score) of the k best rows of each query, by products of 64-bit numbers; for numbers that
    are too large for exact doubles, and so for the bounds of the trees."""
    if largest(q, v) >= 2**63:
        raise ValueError("a score does not fit 64 bits")
    a, b, out = q.astype(np.int64), v.astype(np.int64), []
    for i in range(0, len(a), max(1, ROOM // max(1, len(b)))):
        scores = a[i:i + max(1, ROOM // max(1, len(b)))] @ b.T
        for j, row in enumerate(scores):
            at = np.lexsort((ids, -row))
            at = at[ids[at] != q_ids[i + j]][:k]
            out.append((np.full(len(at), i + j), at, row[at]))
    return tuple(np.concatenate([np.zeros(0, np.int64), *x]) for x in zip(*out))


@dataclass
class Node:
    """``members`` within ``radius`` of ``centre``; inner nodes also have children that share them out."""

    centre: np.ndarray
    radius: float
    members: np.ndarray
    children: list[Node] = field(default_factory=list)


def cover_tree(points: np.ndarray, members: np.ndarray | None = None, centre: int | None = None) -> Node:
    """Children are centres at least half the node's radius apart, the node's own centre first.

    A node has at most CHILDREN of them; what they do not cover goes to the nearest, and its radius is
    the true one. So radii always cover, which is all that the bounds need.
    """
    members = np.arange(len(points)) if members is None else members
    centre = int(members[0]) if centre is None else centre
    away = np.linalg.norm(points[members] - points[centre], axis=1)
    node = Node(points[centre], float(away.max()), members)
    if len(members) <= LEAF or node.radius == 0:
        return node
    picked, least, owner = [centre], away.copy(), np.zeros(len(members), np.int64)
    while len(picked) < CHILDREN and least.max() > node.radius / 2:
        far = int(least.argmax())
        d = np.linalg.norm(points[members] - points[members[far]], axis=1)
        owner[d < least] = len(picked)
        least = np.minimum(least, d)
        picked.append(int(members[far]))
    for i, p in enumerate(picked):
        own = members[owner == i]
        if len(own):
            node.children.append(cover_tree(points, own, p))
    return node


def bound(a: Node, b: Node) -> float:
    na, nb = float(np.linalg.norm(a.centre)), float(np.linalg.norm(b.centre))
    exact = float(a.centre @ b.centre) + na * b.radius + nb * a.radius + a.radius * b.radius
    return exact + MARGIN * (abs(exact) + na * nb + 1)


class Best:
    """The k best (score, smaller id first) of each query."""

    def __init__(self, queries: np.ndarray, q_ids: np.ndarray, rows: np.ndarray, ids: np.ndarray, least: np.ndarray, k: int):
        self.q, self.q_ids, self.rows, self.ids, self.k = queries, q_ids, rows, ids, k
        self.scores = np.full((len(queries), k), -np.inf)
        self.found = np.full((len(queries), k), np.iinfo(np.int64).max)
        self.least = least.copy()  # no result scores below this

    def search(self, a: Node, b: Node) -> None:
        if bound(a, b) < self.least[a.members].min():
            return
        if not a.children and not b.children:
            self.compare(a.members, b.members)
        elif not b.children or a.children and a.radius > b.radius:
            for child in a.children:
                self.search(child, b)
        else:
            for _, _, child in sorted((-bound(a, c), i, c) for i, c in enumerate(b.children)):
                self.search(a, child)

    def compare(self, at: np.ndarray, of: np.ndarray) -> None:
        scores = self.q[at] @ self.rows[of].T
        scores[self.q_ids[at][:, None] == self.ids[of][None, :]] = -np.inf
        # only pairs that can be results are sorted, with the results so far of their queries
        i, j = np.nonzero((scores >= self.least[at][:, None]) & (scores > -np.inf))
        if not len(i):
            return
        at, i, scores, ids = *np.unique(at[i], return_inverse=True), scores[i, j], self.ids[of[j]]
        i = np.concatenate([i, np.repeat(np.arange(len(at)), self.k)])
        scores = np.concatenate([scores, self.scores[at].ravel()])
        ids = np.concatenate([ids, self.found[at].ravel()])
        order = np.lexsort((ids, -scores, i))
        starts = np.searchsorted(i[order], np.arange(len(at)))
        best = order[starts[:, None] + np.arange(self.k)]  # each query has k at least, empty ones last
        self.scores[at], self.found[at] = scores[best], ids[best]
        self.least[at] = np.maximum(self.least[at], self.scores[at, -1])


def best_of_block(asking: pa.Table, held: pa.Table, k: int) -> pa.Table:
    """(query_id, vec_id, score) of a block of queries (id, v, least) in a block of rows (id, v)."""
    out = {"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0, np.int64)}
    if asking.num_rows and held.num_rows:
        q_ids, q = asking.column("id").to_numpy(), scaled(matrix(asking.column("v")))
        ids, v = held.column("id").to_numpy(), scaled(matrix(held.column("v")))
        some = first_copies(ids, v, k + 1)
        ids, v = ids[some], v[some]
        if largest(q, v) >= 2**53:
            qi, at, score = best_of_large(q, q_ids, v, ids, k)
            return pa.table({"query_id": q_ids[qi], "vec_id": ids[at], "score": score})
        best = Best(q, q_ids, v, ids, asking.column("least").to_numpy(zero_copy_only=False).astype(np.float64), k)
        best.search(cover_tree(q), cover_tree(v))
        qi, at = np.nonzero(best.scores > -np.inf)
        out = {"query_id": q_ids[qi], "vec_id": best.found[qi, at], "score": best.scores[qi, at].astype(np.int64)}
    return pa.table(out)


def pick_centres(vectors: np.ndarray, count: int) -> np.ndarray:
    """The coarse level of the cover: each next centre is the vector farthest from all before."""
    picked = [0]
    least = np.linalg.norm(vectors - vectors[0], axis=1)
    while len(picked) < count and least.max() > 0:
        picked.append(int(least.argmax()))
        least = np.minimum(least, np.linalg.norm(vectors - vectors[picked[-1]], axis=1))
    return vectors[picked]


def top_k(rows: DataFrame, is_query: Column, k: int = 20, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of the largest score for each row where ``is_query`` holds.

    ``is_query`` is over ``id``. Rows without an id, and vectors that are null or hold null or
    non-finite components, take no part. Rows of one id are one row, of differing vectors the smallest.
    All vectors have one length, and scores fit 64 bits, else the job fails. Ties go to smaller ids; with fewer than k candidates all
    are returned; an empty table gives no rows.
    """
    spark = rows.sparkSession
    points = distinct_ids(usable(rows, id_column, vector, zero=True))
    count, seen = points.count(), sample(points, SAMPLE)
    if not count:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    centres = pick_centres(scaled(seen), max(1, min(MOST_CENTRES, math.ceil(2 * count / ROWS))))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squares = (centres ** 2).sum(axis=1)
        for batch in batches:
            v = scaled(matrix(batch.column("v")))
            own = (squares - 2 * v @ centres.T).argmin(axis=1) if len(v) else np.zeros(0, np.int64)
            away = np.linalg.norm(v - centres[own], axis=1) if len(v) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("v"), pa.array(own.astype(np.int32)), pa.array(away)],
                                             names=["id", "v", "centre", "away"])

    kind = points.schema["v"].dataType.simpleString()
    index = written(spark, lambda: points.mapInArrow(assign, f"id long, v {kind}, centre int, away double"))
    asking = index.where(is_query)

    def blocks(table: DataFrame) -> dict[int, tuple[int, float]]:
        return {c: (n, r) for c, n, r in table.groupBy("centre").agg(F.count("*"), F.max("away")).collect()}

    held, asked = blocks(index), blocks(asking)

    def compare(pairs: list[tuple[int, int]], queries: DataFrame) -> DataFrame:
        """Pairs of (query centre, row centre), each cut into parts that fit a task."""
        cut = [(a, b, -(-asked[a][0] // QUERIES), -(-held[b][0] // ROWS)) for a, b in pairs]
        plan = F.broadcast(spark.createDataFrame(cut, "qc int, rc int, q_parts int, r_parts int"))
        part = F.pmod(F.xxhash64("id"), F.col("own")).cast("int")
        left = queries.join(plan, F.expr("centre = qc")).withColumn("own", F.col("q_parts")).select(
            "id", "v", "least", "qc", "rc", part.alias("q_part"), F.explode(F.sequence(F.lit(0), F.col("r_parts") - 1)).alias("r_part"))
        right = index.join(plan, F.expr("centre = rc")).withColumn("own", F.col("r_parts")).select(
            *(F.col(c).alias(c) for c in ("id", "v", "qc", "rc")), part.alias("r_part"), F.explode(F.sequence(F.lit(0), F.col("q_parts") - 1)).alias("q_part"))
        keys = ["qc", "rc", "q_part", "r_part"]
        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
            lambda q, r: best_of_block(q, r, k), "query_id long, vec_id long, score long")

    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")

    def ranked(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    own = [(a, a) for a in asked]
    first = written(spark, lambda: ranked(compare(own, asking.withColumn("least", F.lit(float("-inf"))))).drop("rank"))
    least = first.groupBy("query_id").agg(F.when(F.count("*") >= k, F.min("score")).cast("double").alias("least"))
    queries = asking.join(least, F.expr("id = query_id"), "left").select(
        "id", "v", "centre", F.coalesce("least", F.lit(float("-inf"))).alias("least"))
    worst = dict(queries.groupBy("centre").agg(F.min("least")).collect())
    nodes = [Node(c, 0.0, np.zeros(0)) for c in centres]

    def reach(a: int, b: int) -> float:
        return bound(Node(nodes[a].centre, asked[a][1], nodes[a].members), Node(nodes[b].centre, held[b][1], nodes[b].members))

    rest = [(a, b) for a in asked for b in held if a != b and reach(a, b) >= worst[a]]
    found = first.union(compare(rest, queries)) if rest else first
    return ranked(found).select("query_id", "rank", "vec_id", "score")
