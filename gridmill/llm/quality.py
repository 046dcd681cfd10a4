"""Quality scores by nearest-neighbour voting among labelled latent-semantic vectors.

A document's terms are trigrams of its letters, of its character shapes (upper and lower case,
digits, white space; signs stand for themselves), and marks of repetition (a word like the one
before, a line that came before, words that came before). Terms are hashed into columns, weighted by
rarity and projected on the leading singular vectors of a bounded sample of labelled documents. Each
document is then compared with all labelled vectors, and the labels of the nearest vote with the
cosine as weight.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmill.llm.arrays import LETTER, NUMBER, codepoints, cut, kinds, lower, slices, tidy

LETTER_COLUMNS, SHAPE_COLUMNS, MARKS = 768, 1024, 32
COLUMNS = LETTER_COLUMNS + SHAPE_COLUMNS + MARKS
SAMPLE = 6144  # labelled documents that are learned from, at most
LATENT = 48
NEIGHBOURS = 25
SHARPNESS = 4  # power of the cosine in a vote
THRESHOLD = 0.3


def _counts(owner: np.ndarray, codes: np.ndarray, texts: int, columns: int) -> np.ndarray:
    """Codes hashed into columns and counted by text."""
    mixed = (codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
    column = (mixed % np.uint64(columns)).astype(np.int64)
    return np.bincount(owner * columns + column, minlength=texts * columns).reshape(texts, columns).astype(np.float32)


def _trigrams(points: np.ndarray) -> np.ndarray:
    p = points.astype(np.uint64)
    return (p[:-2] * np.uint64(0x110000) + p[1:-1]) * np.uint64(0x110000) + p[2:]


def _marks(text: str) -> list[float]:
    """Shares of repetition, each as a few columns that fill up one after the other."""
    words = text.split()
    n = max(1, len(words))
    lines = [x for x in text.split("\n") if x.strip()]
    shares = (
        sum(a == b for a, b in zip(words, words[1:])) / n,
        1 - len(set(words)) / n if len(words) > 1 else 0.0,
        1 - len(set(lines)) / max(1, len(lines)) if len(lines) > 1 else 0.0,
        sum(not w[-1].isalnum() for w in words) / n,
        sum(w.isupper() for w in words) / n,
        sum(not any(c.isalnum() for c in w) for w in words) / n,
        sum(a == b for a, b in zip(lines, lines[1:])) / max(1, len(lines)),
        min(1.0, len(words) / 50),
    )
    return [min(1.0, max(0.0, 4 * s - i)) for s in shares for i in range(4)]


def features(texts: list[str]) -> np.ndarray:
    """Term weights of each text before rarity: square roots of shares within each kind of term."""
    out = np.zeros((len(texts), COLUMNS), np.float32)
    if not texts:
        return out
    points = codepoints("\n".join([*texts, ""]))
    owner = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in texts])
    kind = kinds()[points]
    small = lower()[points]
    # letters: runs of anything else are one edge
    keep = small != 0
    keep[1:] |= small[:-1] != 0
    if keep.sum() > 2:
        out[:, :LETTER_COLUMNS] = _counts(owner[keep][1:-1], _trigrams(small[keep]), len(texts), LETTER_COLUMNS)
    shape = points.copy()
    shape[kind == LETTER] = np.where(points[kind == LETTER] == small[kind == LETTER], ord("a"), ord("A"))
    shape[kind == NUMBER] = ord("0")
    if len(shape) > 2:
        out[:, LETTER_COLUMNS:-MARKS] = _counts(owner[1:-1], _trigrams(shape), len(texts), SHAPE_COLUMNS)
    out[:, -MARKS:] = [_marks(t) for t in texts]
    for a, b in ((0, LETTER_COLUMNS), (LETTER_COLUMNS, COLUMNS - MARKS)):
        total = out[:, a:b].sum(axis=1, keepdims=True)
        out[:, a:b] = np.sqrt(out[:, a:b] / np.maximum(total, 1))
    out[[not t for t in texts]] = 0
    return out


@dataclass(frozen=True)
class Model:
    """Rarity of terms, latent basis, unit vectors of the labelled documents, and their labels."""

    rarity: np.ndarray
    basis: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    @property
    def prior(self) -> float:
        return float(self.labels.mean()) if len(self.labels) else 0.5

    def project(self, terms: np.ndarray) -> np.ndarray:
        latent = (terms * self.rarity) @ self.basis
        lengths = np.linalg.norm(latent, axis=1, keepdims=True)
        return (latent / np.where(lengths > 0, lengths, 1)).astype(np.float32)

    def vote(self, terms: np.ndarray) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(terms), self.prior)
        cosines = self.project(terms) @ self.vectors.T
        k = min(NEIGHBOURS, len(self.labels))
        near = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
        weight = np.clip(np.take_along_axis(cosines, near, axis=1).astype(np.float64), 0, 1) ** SHARPNESS
        total = weight.sum(axis=1)
        score = (weight * self.labels[near]).sum(axis=1) / np.where(total > 0, total, 1)
        return np.clip(np.where(total > 0, score, self.prior), 0, 1)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn from at most ``sample`` labelled rows (doc_id, label 0 or 1), the first by a hash of the id.

    Rows without an id or a label are left out, and labels without a document count for nothing.
    What the driver gets is bounded by ``sample`` rows of COLUMNS numbers.
    """
    chosen = labels.where("doc_id IS NOT NULL AND label IS NOT NULL").select("doc_id", F.col("label").cast("double").alias("label")).orderBy(
        F.xxhash64("doc_id"), "doc_id", "label").limit(sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch.column(1)):
                terms, rows = features(texts).astype(np.float16), cut(batch, part)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array([t.tobytes() for t in terms], pa.binary()), rows.column(2)], names=["doc_id", "terms", "label"])

    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "label").mapInArrow(
        tidy(run), "doc_id long, terms binary, label double").collect()
    rows.sort(key=lambda r: (r.doc_id, bytes(r.terms), r.label))
    terms = np.stack([np.frombuffer(r.terms, np.float16) for r in rows]).astype(np.float32) if rows else np.zeros((0, COLUMNS), np.float32)
    found = (terms > 0).sum(axis=0)
    rarity = np.log((1 + len(rows)) / (1 + found)).astype(np.float32) + 1
    weighted = terms * rarity
    values, basis = np.linalg.eigh((weighted.T @ weighted).astype(np.float64))
    basis = basis[:, ::-1][:, :LATENT].astype(np.float32)
    model = Model(rarity, basis, np.zeros((0, LATENT), np.float32), np.array([r.label for r in rows]))
    return Model(rarity, basis, model.project(terms), model.labels)


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD, keep_text: bool = False) -> DataFrame:
    """All columns (the text only with ``keep_text``), with score and predicted.

    A null or empty text, or one that shares nothing with the labelled ones, gets the mean label;
    without any labels that is 0.5. Columns of these two names are replaced.
    """
    dropped = ("score", "predicted") if keep_text else ("text", "score", "predicted")
    schema = T.StructType([*(f for f in docs.schema.fields if f.name not in dropped),
                           T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    carried = schema.names[:-2]
    # an Arrow batch holds whole rows, so what is read besides the carried columns is the text
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learned = shared.value
        for batch in batches:
            scores = np.concatenate([np.zeros(0), *(learned.vote(features(texts)) for _, texts in slices(batch.column("text")))])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in carried), pa.array(scores), pa.array((scores >= threshold).astype(np.int32))], names=schema.names)

    return docs.select(*dict.fromkeys(["text", *carried])).mapInArrow(tidy(run), schema)
