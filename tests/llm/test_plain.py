"""Fingerprint bits, language cosines and quality votes against plain loops; and the pipeline's first three stages."""

import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from gridmill.llm import langid, quality, queries, simhash

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = ["", " \t\n", "One", "one TWO", "A b c", "É é É", "x " * 200 + "tail", "the cat\x0bsat\x0con\rthe\x1cmat\x85 \xa0there", "日本 語 です ね",
         "Same same SAME same", "a\x00b c d e"]


def small(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def plain_fingerprint(text):
    words = WORDS.findall(small(text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def test_fingerprints_bit_by_bit(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").limit(60).collect()
    for text in [*TEXTS, *(r.text for r in rows)]:
        assert simhash.fingerprint(text) == plain_fingerprint(text), text[:50]


def plain_profile(text):
    """Sum over letters of the bound vectors of it and its neighbours; anything but letters is one edge."""
    lowered = []
    for c in f"{text}\n":
        letter = c.isalpha()
        if letter or not lowered or lowered[-1] != 0:
            lowered.append((ord(c.lower()) if len(c.lower()) == 1 else ord(c)) if letter else 0)
    if lowered and lowered[0] != 0:
        lowered.insert(0, 0)
    total = np.zeros(langid.DIMENSIONS, np.int64)
    for a, b, c in zip(lowered, lowered[1:], [*lowered[2:], 0]):
        if b:
            total += np.roll(langid.letter_vector(a), 2).astype(np.int64) * np.roll(langid.letter_vector(b), 1) * langid.letter_vector(c)
    return total


def test_language_cosines(spark):
    learned = [("the cat sat on the mat", "en"), ("and then it ran", "en"), ("der hund lief über die straße", "de"), ("née à l'été", "fr"), (None, "en"), ("no language", None)]
    asked = ["the dog ran", "ein hund", "été", "123 ...", None, "Straße, the"]
    prototypes = langid.learn(spark.createDataFrame(learned, "text string, lang string").repartition(3))
    sums = {}
    for text, lang in learned:
        if text and lang:
            sums[lang] = sums.get(lang, 0) + plain_profile(text)
    assert sorted(prototypes) == sorted(sums)
    for lang, vector in sums.items():
        assert np.allclose(prototypes[lang], vector / np.linalg.norm(vector))
    got = langid.predict(spark.createDataFrame([(i, t) for i, t in enumerate(asked)], "i int, text string"), prototypes).orderBy("i").collect()
    for r, text in zip(got, asked):
        own = plain_profile(text or "")
        if not own.any():
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        cosines = {lang: float(own @ v / np.linalg.norm(own) / np.linalg.norm(v)) for lang, v in sums.items()}
        best = max(sorted(cosines), key=cosines.get)
        assert r.lang_pred == best and r.score == pytest.approx(max(0.0, cosines[best]))


def plain_votes(model, text):
    own = model.project(quality.features([text]))[0].astype(float)
    cosines = [sum(a * b for a, b in zip(own, v)) for v in model.vectors.astype(float).tolist()]
    near = sorted(range(len(cosines)), key=lambda i: -cosines[i])[:quality.NEIGHBOURS]
    weights = [min(1.0, max(0.0, cosines[i])) ** quality.SHARPNESS for i in near]
    return sum(w * model.labels[i] for w, i in zip(weights, near)) / sum(weights) if sum(weights) else model.prior


def test_votes_of_the_nearest(spark):
    folder = "/root/testdata/sf0.001"
    model = queries.quality_model(spark, folder)
    rows = queries.table(spark, folder, "documents").orderBy("doc_id").limit(25)
    got = quality.score(rows.select("doc_id", "text"), model, keep_text=True).collect()
    for r in got:
        assert r.score == pytest.approx(plain_votes(model, r.text or ""), abs=0.02) and r.predicted == (r.score >= 0.3)


def test_stages_against_plain_loops(spark):
    """What quality, near-duplicate and passage stages keep of the smallest table."""
    folder = "/root/testdata/sf0.001"
    docs = queries.table(spark, folder, "documents")
    model = queries.quality_model(spark, folder)
    scores = {r.doc_id: r.score for r in quality.score(docs.select("doc_id", "text"), model).collect()}
    good = corpus_pipeline.quality_stage(spark, docs, folder).cache()
    assert {r.doc_id for r in good.collect()} == {i for i, s in scores.items() if s >= 0.3}
    one = corpus_pipeline.near_duplicate_stage(spark, good, folder).cache()
    rows = sorted((r.doc_id, plain_fingerprint(r.text)) for r in good.collect())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= 3:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    assert sorted(r.doc_id for r in one.collect()) == sorted(rows[i][0] for i in range(len(rows)) if find(i) == i)
    assert one.columns == docs.columns
    seen, want = set(), {}
    for r in one.orderBy("doc_id").collect():
        words = WORDS.findall(r.text or "")
        gone = set()
        for i in range(len(words) - 19):
            window = tuple(words[i:i + 20])
            if window in seen:
                gone.update(range(i, i + 20))
            seen.add(window)
        kept = [w for i, w in enumerate(words) if i not in gone]
        if kept or not words:
            want[r.doc_id] = kept
    cleaned = corpus_pipeline.passage_stage(spark, one, folder).withColumn("at", F.lit(0)).collect()
    assert {r.doc_id: WORDS.findall(r.text or "") for r in cleaned} == want
    assert all(r.n_chars == len(r.text or "") for r in cleaned)
