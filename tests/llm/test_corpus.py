"""Operators against brute force, SQL and held-out labels, on small inputs with odd rows."""

import hashlib
import random

import numpy as np
import pandas as pd
import pytest
from compare import differences, duck
from pyspark.sql import functions as F

from gridmill.llm import ann, langid, mixing, quality, queries, simhash, substrings, topk
from gridmill.llm.steps import components

BIG = "/root/testdata/sf0.01"


def joined(fps):
    parent = list(range(len(fps)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(fps[i + 1:] ^ fps[i]) <= 3):
            a, b = root(i), root(i + 1 + int(j))
            parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(fps))]


def groups(labels):
    return sorted(map(tuple, pd.Series(range(len(labels))).groupby(list(labels)).apply(list)))


def test_trees_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(simhash, "SHARD", 64)
    monkeypatch.setattr(simhash, "BLOCK", 16)
    rng = np.random.default_rng(1)
    found = [int(x) for x in rng.integers(0, 2**63, 800, dtype=np.uint64)]
    for centre in found[:25]:
        for _ in range(40):
            found.append(centre ^ sum({1 << int(b) for b in rng.integers(0, 64, rng.integers(0, 6))}))
    fps = np.unique(np.array(found, np.uint64))
    label = {r.node: r.label for r in components(simhash.links(spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long"))).collect()}
    assert groups([label.get(int(x), int(x)) for x in fps.view(np.int64)]) == groups(joined(fps))


def test_near_duplicates(spark):
    rows = [(1, "a b c d"), (2, "A B  C\nd"), (3, None), (4, ""), (5, "x"), (5, "x"), (None, "a b c d"), (9, "y " * 50)]
    got = {(r.doc_id, r.component_id) for r in simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(1, 1), (2, 1), (3, 3), (4, 3), (5, 5), (None, 1), (9, 9)}
    kept = simhash.keep_one(spark.createDataFrame([(*r, "s") for r in rows], "doc_id long, text string, component_id string"))
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 3, 5, 9]
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def removed(rows):
    first, out = {}, []
    words = [(2**63 - 1 if d is None else d, (t or "").encode().split()) for d, t in rows]
    for d, w in words:
        for i in range(len(w) - 19):
            key = tuple(w[i:i + 20])
            first[key] = min(first.get(key, (d, i)), (d, i))
    for (doc, _), (d, w) in zip(rows, words):
        gone = {j for i in range(len(w) - 19) if first[tuple(w[i:i + 20])] < (d, i) for j in range(i, i + 20)}
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("vocabulary", [3, 40])
def test_passages(spark, vocabulary):
    rng = random.Random(vocabulary)
    names = [f"w{i}" for i in range(vocabulary)]
    shared = [rng.choices(names, k=rng.randint(18, 60)) for _ in range(8)]
    rows = []
    for d in range(80):
        text = [w for _ in range(rng.randint(0, 4)) for w in (rng.choice(shared) if rng.random() < 0.6 else rng.choices(names, k=rng.randint(0, 25)))]
        rows.append((d, " ".join(text[rng.randint(0, 3):])))
    rows += [(200, rows[3][1]), (None, rows[3][1]), (201, None), (202, ""), (5, rows[5][1]), (203, "a " * 50), (204, "  " + rows[7][1].replace(" ", "\n\t"))]
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    got = substrings.digests(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got), key=key) == sorted(removed(rows), key=key)


def test_mix(spark):
    assert not differences(queries.op8_curriculum_mix(spark, BIG), queries.SQL["op8_curriculum_mix"], duck(BIG))
    rows = [(i, "a b c" if i % 4 else None, ("x", "y", None)[i % 3], 7) for i in range(60)] + [(1, "a b c", "y", 7), (None, "d", "x", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size int")
    assert mixing.mix(docs).columns == docs.columns and mixing.mix(docs, whole=True).count() > 0
    plan = mixing.assign(docs).select("size", F.expr("aggregate(copies.words, 0L, (a, w) -> a + w)").alias("taken"), "target", "source_size", "doc.source").toPandas()
    assert (plan.taken <= 2 * plan["size"]).all()
    for _, own in plan.groupby("source", dropna=False):
        assert abs(own.taken.sum() - own.target.iloc[0]) < 1
    assert mixing.mix(docs.limit(0)).count() == 0


def test_vectors(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(400)] + [(i, [1.0] * 8) for i in range(400, 500)]
    rows += [(500, None), (520, [0.0] * 8), (None, [1.0] * 8), (540, [float("nan")] * 8), (560, [None] * 8), (20, rows[20][1])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    ids, v = np.arange(500), np.array([r[1] for r in rows[:500]])
    whole = np.floor(64 * v)
    got = topk.top_k(table, F.col("id") % 20 == 0, 7).toPandas().sort_values(["query_id", "rank"])
    for i in range(0, 500, 20):
        s = whole @ whole[i]
        s[i] = -np.inf
        best = np.lexsort((ids, -s))[:7]
        own = got[got.query_id == i]
        assert own.vec_id.tolist() == best.tolist() and own.score.tolist() == s[best].tolist()
    assert set(got.query_id) == set(range(0, 500, 20)) | {520}
    near = ann.nearest(table, F.col("id") % 50 == 0).toPandas().sort_values(["query_id", "rank"])
    assert near[near.query_id == 450].vec_id.tolist() == [400, 401, 402, 403, 404]
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    hits = 0
    for i in range(0, 400, 50):
        s = u @ u[i]
        s[i] = -9
        hits += len(set(np.argsort(-s)[:5]) & set(near[near.query_id == i].vec_id))
    assert hits >= 0.9 * 5 * 8
    assert ann.nearest(table.limit(0), F.lit(True)).count() == topk.top_k(table.limit(0), F.lit(True)).count() == 0


def test_learned(spark):
    docs = spark.read.parquet(f"{BIG}/documents.parquet").toPandas()
    lang = queries.op2_language_id(spark, BIG).toPandas().merge(docs, on="doc_id")
    assert (lang[lang.held_out].lang_pred == lang[lang.held_out].lang).mean() > 0.97
    assert langid.predict(spark.createDataFrame([(None,), ("12",)], "text string"), {}).first().lang_pred == "und"
    score = queries.op10_quality_votes(spark, BIG).toPandas().merge(pd.read_parquet(f"{BIG}/labels.parquet"), on="doc_id")
    assert (score[score.held_out].predicted == score[score.held_out].quality).mean() > 0.95
    empty = quality.fit(spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "doc_id long, label int"))
    assert quality.score(spark.createDataFrame([(1, None)], "doc_id long, text string"), empty).first().score == 0.5


def test_pipeline(spark):
    import corpus_pipeline

    docs, before = spark.read.parquet(f"{BIG}/documents.parquet"), None
    for name, stage in corpus_pipeline.STAGES:
        docs, before = corpus_pipeline.written(spark, lambda: stage(spark, docs, BIG)), docs
        if name != "encode":
            assert docs.columns == before.columns
        if name == "near_duplicates":
            assert docs.count() == simhash.near_duplicates(before).select("component_id").distinct().count()
    assert docs.count() == before.count() and docs.where("length(ids) <> 4 * n_tokens").count() == 0
