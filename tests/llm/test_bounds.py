"""What is known about a query's nearest rows before its lists are scanned."""

import numpy as np
from pyspark.sql import functions as F

from gridmill.llm import ann
from gridmill.llm.vectors import unit


def test_bounds_leave_few_pairs_to_score():
    """Lists of rows without structure, of which the nearest by some columns are not near: few pairs are left, none of the nearest is lost."""
    rng = np.random.default_rng(8)
    rows, k, lists = rng.normal(size=(6000, 64)), 6, np.arange(6000) % 30
    queries = rows[::100]
    asked = np.ones((len(queries), 30), bool)
    asked[:, 5::6] = False
    limit = ann.bounds(unit(queries), asked, unit(rows[:2000]), lists[:2000], k)
    left, found = 0, set()
    for own in range(30):
        here, q = np.flatnonzero(lists == own), np.flatnonzero(asked[:, own])
        if len(q):
            qi, ri = ann.scan(queries[q], rows[here], k, limit[q])
            left += len(qi)
            found |= set(zip(q[qi].tolist(), here[ri].tolist()))
    near = np.where(asked[:, lists], unit(queries) @ unit(rows).T, -9)
    assert found >= {(i, j) for i, x in enumerate(near) for j in np.argsort(-x)[:k].tolist()}
    assert left < 0.02 * np.count_nonzero(asked[:, lists]), left


def test_bounds_only_of_asked_lists():
    """Rows of lists that a query does not ask bound nothing; too few rows bound nothing."""
    rows = np.eye(8)
    asked = np.array([[True, False], [False, True]])
    found = ann.bounds(rows[:2], asked, rows, np.array([0, 0, 0, 1, 1, 1, 1, 1]), 3)
    assert abs(found - 2).max() < 1e-6
    found = ann.bounds(rows[:2], asked, rows, np.array([0, 0, 0, 1, 1, 1, 1, 1]), 4)
    assert np.isinf(found[0]) and abs(found[1] - 2) < 1e-6
    assert np.isinf(ann.bounds(rows[:2], asked, rows[:2], np.array([0, 0]), 3)).all()


def test_every_query_gets_its_rows(spark):
    """Few lists asked: what a query finds are all rows of these that are nearest, though others bound less."""
    rng = np.random.default_rng(9)
    middle = rng.normal(size=(20, 16))
    v = middle[np.arange(1200) % 20] + 0.2 * rng.normal(size=(1200, 16))
    v[100:140] = v[100]  # copies: ties go to smaller ids
    table = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    got = ann.nearest(table, F.col("id") % 20 == 0, probed=0.1).toPandas().sort_values(["query_id", "rank"])
    u, hits = unit(v), 0
    for i in range(0, 1200, 20):
        s = u @ u[i]
        s[100:140] = s[100]
        s[i] = -9
        own = got[got.query_id == i]
        assert own["rank"].tolist() == [1, 2, 3, 4, 5]
        hits += len(set(np.lexsort((np.arange(1200), -s))[:5].tolist()) & set(own.vec_id))
    assert hits >= 0.95 * 5 * 60
    assert got[got.query_id == 100].vec_id.tolist() == [101, 102, 103, 104, 105]
    assert got[got.query_id == 120].vec_id.tolist() == [100, 101, 102, 103, 104]
