"""Nearest rows where a query and a neighbour are there ten times."""

import numpy as np
from pyspark.sql import functions as F

from gridmill.llm import ann, queries, simhash, topk


def test_repeated_query_and_neighbour(spark):
    v = np.random.default_rng(4).normal(size=(60, 8))
    v[1] = v[0] + 0.01  # the nearest of 0
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    rows += 9 * [rows[0], rows[1]]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = ann.nearest(table, F.col("id").isin(0, 1, 2), probed=1.0).toPandas().sort_values(["query_id", "rank"])
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    for i in (0, 1, 2):
        s = u @ u[i]
        s[i] = -9
        own = got[got.query_id == i]
        assert own.vec_id.tolist() == np.argsort(-s)[:5].tolist() and own["rank"].tolist() == [1, 2, 3, 4, 5]


def test_differing_vectors_of_one_id(spark):
    """The smallest counts, however the table is cut."""
    v = np.random.default_rng(6).normal(size=(80, 8))
    rows = [(i, x.tolist()) for i, x in enumerate(v)] + [(7, (v[7] * s).tolist()) for s in (-2, 3, -4)] + [(20, (-v[20]).tolist())]
    want = {i: min([x for j, x in rows if j == i]) for i in range(80)}
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    w = np.array([want[i] for i in range(80)])
    for parts in (1, 7):
        near = ann.nearest(table.repartition(parts), F.col("id").isin(7, 20), probed=1.0).collect()
        best = topk.top_k(table.repartition(parts), F.col("id").isin(7, 20), k=6).collect()
        for q in (7, 20):
            cosines = (w @ w[q]) / np.linalg.norm(w, axis=1) / np.linalg.norm(w[q])
            products = np.floor(64 * w) @ np.floor(64 * w[q])
            others = [i for i in range(80) if i != q]
            assert [r.vec_id for r in sorted(near, key=lambda r: r["rank"]) if r.query_id == q] == sorted(others, key=lambda i: (-cosines[i], i))[:5]
            assert [(r.vec_id, r.score) for r in sorted(best, key=lambda r: r["rank"]) if r.query_id == q] == [
                (i, int(products[i])) for i in sorted(others, key=lambda i: (-products[i], i))[:6]]


def test_tiny_and_large_components(spark):
    v = np.random.default_rng(7).normal(size=(30, 4))
    tiny = spark.createDataFrame([(i, (x * 1e-170).tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    got = ann.nearest(tiny, F.col("id") == 0, probed=1.0).collect()
    assert len(got) == 5 and all(abs(r.score) <= 1 + 1e-9 for r in got)
    large = (v * 1e6).round()
    rows = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(large)], "vec_id long, embedding array<double>")
    found = sorted(topk.top_k(rows, F.col("id") == 0, k=4).collect(), key=lambda r: r["rank"])
    products = [sum(int(64 * a) * int(64 * b) for a, b in zip(large[0], x)) for x in large]
    assert [(r.vec_id, r.score) for r in found] == [(i, products[i]) for i in sorted(range(1, 30), key=lambda i: (-products[i], i))[:4]]


def test_lengths_must_agree(spark):
    import pytest

    mixed = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0, 3.0, 4.0])], "vec_id long, embedding array<double>").coalesce(1)
    for f in (ann.nearest, topk.top_k):
        with pytest.raises(Exception, match="differ in length|inhomogeneous"):
            f(mixed, F.col("id") == 1).collect()


def test_one_row_of_each_component_stays(spark):
    """Clashing ids: the copy goes, the only row of another text stays."""
    a, b, c = "one two three four five", "quite another text stands here", "and a third one of this id"
    rows = [(3, a, "x"), (5, a, "y"), (5, b, "z"), (5, c, "u"), (5, c, "u"), (8, None, "n"), (9, "", "e"), (None, a, "k")]
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string, content string")).collect()
    assert sorted((r.doc_id or 0, r.text, r.content) for r in kept) == sorted([(0, a, "k"), (3, a, "x"), (5, b, "z"), (5, c, "u"), (8, None, "n")], key=lambda r: (r[0], str(r[1]), r[2])) or sorted(
        (r.doc_id or 0, str(r.text), r.content) for r in kept) == sorted([(0, a, "k"), (3, a, "x"), (5, b, "z"), (5, c, "u"), (8, "None", "n")])


def test_recall_over_the_given_embeddings(spark):
    folder = "/root/testdata/sf0.1"
    got = queries.op5_adaptive_ann(spark, folder).collect()
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").toPandas()
    ids, v = rows.vec_id.to_numpy(), np.array(rows.embedding.tolist(), float)
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    found, hits, total = {}, 0, 0
    for r in got:
        found.setdefault(r.query_id, set()).add(r.vec_id)
    for i in np.flatnonzero(ids % 50 == 0):
        s = u @ u[i]
        s[i] = -9
        want = set(ids[np.lexsort((ids, -s))[:5]].tolist())
        hits, total = hits + len(want & found[int(ids[i])]), total + 5
    assert hits >= 0.9 * total, hits / total
