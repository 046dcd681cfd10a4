"""Language identification with hyperdimensional profiles.

Each letter (and the edge of a word) has a fixed random vector of +1 and -1. A trigram is the
product of its letters' vectors, rotated by their place in it; a text is the sum of its trigrams.
A language's prototype is the sum over its training texts, and a text goes to the prototype of the
largest cosine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmill.llm.arrays import codepoints, lower, slices

DIMENSIONS = 512
SEED = 20
BLOCK = 4096  # distinct trigrams that are turned into vectors at a time
UNKNOWN = "und"

_letters: dict[int, np.ndarray] = {}


def letter_vector(point: int) -> np.ndarray:
    found = _letters.get(point)
    if found is None:
        found = np.random.default_rng((SEED, point)).integers(0, 2, DIMENSIONS).astype(np.int8) * 2 - 1
        if len(_letters) < 1 << 16:
            _letters[point] = found
    return found


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text of each trigram, its number, code points of each number): one trigram around each letter.

    Letters are in lower case; whatever is not a letter is one edge between words.
    """
    points = lower()[codepoints("\n".join([*texts, ""]))]
    owner = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in texts])
    keep = points != 0
    keep[1:] |= points[:-1] != 0
    points, owner = points[keep], owner[keep]
    middle = np.flatnonzero(points)
    letter, alphabet = pd.factorize(np.concatenate([[0], points]).astype(np.int64))
    size = len(alphabet)
    code = (letter[middle] * size + letter[middle + 1]) * size + np.append(letter, 0)[middle + 2]
    number, codes = pd.factorize(code)
    three = np.stack([codes // size // size, codes // size % size, codes % size], axis=1)
    return owner[middle], number, alphabet[three]


def bundles(owner: np.ndarray, count: int, number: np.ndarray, grams: np.ndarray) -> np.ndarray:
    """Sum of the trigram vectors of each owner."""
    out = np.zeros((count, DIMENSIONS), np.float32)
    for start in range(0, len(grams), BLOCK):
        block = grams[start:start + BLOCK]
        here = (number >= start) & (number < start + BLOCK) if len(grams) > BLOCK else slice(None)
        if not len(number[here]):
            continue
        points, at = np.unique(block, return_inverse=True)
        at = at.reshape(block.shape)
        base = np.stack([letter_vector(int(p)) for p in points])
        bound = np.roll(base, 2, axis=1)[at[:, 0]] * np.roll(base, 1, axis=1)[at[:, 1]] * base[at[:, 2]]
        times = np.bincount(owner[here] * len(block) + number[here] - start, minlength=count * len(block))
        out += times.reshape(count, len(block)).astype(np.float32) @ bound.astype(np.float32)
    return out


def learn(docs: DataFrame) -> dict[str, np.ndarray]:
    """Unit prototypes by language, from the texts of all rows that have a language.

    Each task returns one vector per language; they are added on executors. What reaches the driver
    is one vector for each distinct language.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column(1).to_pylist(), object)
            for part, texts in slices(batch.column(0)):
                owner, number, grams = trigrams(texts)
                which, names = pd.factorize(langs[part])
                for name, vector in zip(names, bundles(which[owner], len(names), number, grams)):
                    total[name] = total.get(name, 0) + vector.astype(np.float64)
        for name, vector in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([vector])], names=["lang", "vector"])

    parts = docs.where("lang IS NOT NULL AND text IS NOT NULL").select("text", "lang").mapInArrow(run, "lang string, vector array<double>")
    sums = parts.select("lang", F.posexplode("vector")).groupBy("lang", "pos").agg(F.sum("col").alias("x"))
    found: dict[str, np.ndarray] = {}
    for lang, pos, x in sums.collect():
        found.setdefault(lang, np.zeros(DIMENSIONS))[pos] = x
    return {k: v / n for k, v in sorted(found.items()) if (n := np.linalg.norm(v)) > 0}


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray]) -> DataFrame:
    """All columns but the text, with lang_pred and score (the largest cosine, not below 0).

    A text without letters, or a null one, is ``und`` with score 0; so is every text if nothing has
    been learned. Of equal cosines the first language by code point wins. Columns of these names are
    replaced; repeated rows get equal results.
    """
    names = list(prototypes)
    matrix = np.stack([prototypes[n] for n in names]).T if names else np.zeros((DIMENSIONS, 0))
    schema = T.StructType([*(f for f in docs.schema.fields if f.name not in ("text", "lang_pred", "score")),
                           T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    carried = schema.names[:-2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = [], []
            for _, texts in slices(batch.column("text")):
                owner, number, grams = trigrams(texts)
                vectors = bundles(owner, len(texts), number, grams).astype(np.float64)
                lengths = np.linalg.norm(vectors, axis=1)
                lettered = np.bincount(owner, minlength=len(texts)) > 0
                cosines = vectors @ matrix / np.where(lengths > 0, lengths, 1)[:, None]
                if names:
                    best = cosines.argmax(axis=1)
                    langs += [names[b] if ok else UNKNOWN for b, ok in zip(best, lettered)]
                    scores += np.where(lettered, np.clip(cosines[np.arange(len(texts)), best], 0, 1), 0.0).tolist()
                else:
                    langs += [UNKNOWN] * len(texts)
                    scores += [0.0] * len(texts)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in carried), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=schema.names)

    return docs.select("text", *carried).mapInArrow(run, schema)
