"""Collocations: phrases are counted exactly, in three passes: words, pairs of frequent words, longer ones of frequent pairs.

A phrase cannot occur more often than what it holds, so only words that reach the support in the whole table can
be in a frequent pair, and only such pairs in a frequent longer phrase. In each pass a task counts the phrases of a
few megabytes of text at a time, every one that may be frequent, and Spark adds the counts up by phrase. Nothing
is left out for being rare in a part of the text: what a task reports does not depend on how large the table
is, but for the frequent words and pairs, which become more. Frequent words are numbered; words as numbers are
the keys that are shuffled, so sums are those of the phrases themselves. If the words are too many for every task,
all phrases are counted as they are spelled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridmill.llm.arrays import give_back, only, slices
from gridmill.llm.bpe import distinct
from gridmill.llm.steps import written

LONGEST = 5  # words of a phrase
SUPPORT = 100
SHARD_BYTES = 1 << 24  # text whose phrases a task counts at a time, about
SHARES = 4  # phrases of a shard are told apart a share of them at a time, which bounds memory
BROADCAST_PHRASES, BROADCAST_BYTES = 1 << 20, 1 << 25  # frequent words that go to every task; beyond, phrases are counted as spelled
BROADCAST_PAIRS = 1 << 23  # frequent pairs that go to every task; beyond, longer phrases are made of all pairs
UNKNOWN = "und"

# What bytes are: of a word, between words, between pieces.
INSIDE, GAP, EDGE = range(3)
CLASSES = np.full(256, INSIDE, np.uint8)
CLASSES[[0x20, 0x09]] = GAP
CLASSES[[*b".,;:!?", *range(0x0A, 0x0E)]] = EDGE
SMALL = np.arange(256, dtype=np.uint8)
SMALL[0x41:0x5B] += 0x20


def words_of(texts: list[str]) -> tuple[list[bytes], np.ndarray]:
    """(distinct words, number of the word at each place): texts and pieces are kept apart by a -1."""
    data = SMALL[np.frombuffer("\n".join([*texts, ""]).encode("utf-8", "surrogatepass"), np.uint8)]
    kind = CLASSES[data]
    inside = np.concatenate([[False], kind == INSIDE, [False]])
    turns = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = turns[::2], turns[1::2]
    if not len(starts):
        return [], np.zeros(0, np.int64)
    number, first = distinct(data, starts, ends)
    raw = data.tobytes()
    found = [raw[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist())]
    piece = np.cumsum(kind == EDGE)[starts]
    return found, np.insert(number, np.flatnonzero(piece[1:] != piece[:-1]) + 1, -1)


def numbered(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the equal code, how often each number is there)."""
    import pandas as pd

    numbers, counts, first = np.empty(len(codes), np.int32), [], 0
    share = codes.view(np.uint8)[::8] % SHARES  # the lowest byte, so nothing of the size of the codes is made
    for i in range(SHARES):
        at = np.flatnonzero(share == i)
        own, _ = pd.factorize(codes[at])
        counts.append(np.bincount(own))
        numbers[at] = own + first
        first += len(counts[-1])
    return numbers, np.concatenate(counts)


def _packed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a.astype(np.int64) << 32) | (b.astype(np.int64) & 0xFFFFFFFF)


def among(sorted_codes: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Which of the codes are there."""
    if not len(sorted_codes):
        return np.zeros(len(codes), bool)
    return sorted_codes[np.minimum(np.searchsorted(sorted_codes, codes), len(sorted_codes) - 1)] == codes


def repeated(words: np.ndarray, lengths: range, pairs: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(place of one occurrence, count) of every distinct phrase, and its length; with ``pairs``, of these only.

    ``words`` are numbers, and -1 where no phrase goes on, as it does not at their end.
    """
    at = np.flatnonzero(words >= 0).astype(np.int32)
    codes = words[at].astype(np.int64)
    for length in range(1, lengths.stop):
        of = words  # one word is its own number
        if length in lengths or length > 1:
            number, count = numbered(codes)
            if length in lengths:
                some = np.zeros(len(count), np.int32)
                some[number] = at
                yield some, count, length
                if length + 1 == lengths.stop:
                    return
            if length > 1:
                of = np.full(len(words), -1, np.int32)
                of[at] = number
        # one word more: both phrases that are one word shorter must be there
        at = at[(of[at + 1] >= 0) & (words[at + length] >= 0)]
        if length == 1 and pairs is not None:
            at = at[among(pairs, _packed(words[at], words[at + 1]))]
        codes = _packed(of[at], words[at + length])


class Shard:
    """Words of one language as numbers: those of ``numbers``, others -1; by default each word gets one when it comes."""

    def __init__(self, numbers: dict[bytes, int] | None = None):
        self.parts, self.open, self.many = [], numbers is None, 0
        self.numbers = {} if numbers is None else numbers

    def add(self, texts: list[str]) -> None:
        found, places = words_of(texts)
        if not found:
            return
        self.many += int((places >= 0).sum())
        number = (lambda w: self.numbers.setdefault(w, len(self.numbers))) if self.open else (lambda w: self.numbers.get(w, -1))
        # the last one stands for the -1 between pieces
        numbers = np.array([*map(number, found), -1], np.int32)
        self.parts += [numbers[places], np.array([-1], np.int32)]

    def words(self) -> np.ndarray:
        return np.concatenate([*self.parts, np.full(LONGEST, -1, np.int32)])


def _by_language(batch: pa.RecordBatch) -> Iterator[tuple[int, list[tuple[str, list[str]]]]]:
    """Texts of neighbouring rows by language; the number is that of their characters."""
    langs = batch.column(0).to_pylist()
    for part, texts in slices(batch.column(1)):
        groups: dict[str, list[str]] = {}
        for lang, text in zip(langs[part], texts):
            groups.setdefault(lang, []).append(text)
        yield sum(map(len, texts)), list(groups.items())


def _shards(batches: Iterator[pa.RecordBatch], make: Callable[[str], Shard]) -> Iterator[dict[str, Shard]]:
    """The texts of a task in shards of about SHARD_BYTES, by language."""
    only("bpe")
    shards, read = {}, 0
    for batch in batches:
        for size, groups in _by_language(batch):
            if read and read + size > SHARD_BYTES:
                yield shards
                shards, read = {}, 0
                give_back()
            for lang, texts in groups:
                if lang not in shards:
                    shards[lang] = make(lang)
                shards[lang].add(texts)
            read += size
    yield shards
    give_back()


def spelled_counts(rows: DataFrame, lengths: range) -> DataFrame:
    """(lang, phrase, words, count) of every phrase of every shard of ``rows`` (lang, text); without a phrase, of all words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shards in _shards(batches, lambda lang: Shard()):
            while shards:
                lang, shard = shards.popitem()
                yield table([lang], [None], 0, np.array([shard.many]))
                words, spelled = shard.words(), [w.decode("utf-8", "surrogatepass") for w in shard.numbers]
                del shard
                for at, count, length in repeated(words, lengths):
                    for i in range(0, len(at), 1 << 16):
                        columns = [map(spelled.__getitem__, words[at[i:i + (1 << 16)] + k].tolist()) for k in range(length)]
                        found = [" ".join(x) for x in zip(*columns)]
                        yield table([lang] * len(found), found, length, count[i:i + (1 << 16)])

    def table(langs: list, found: list, length: int, count: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.string()), pa.array(found, pa.string()), pa.array(np.full(len(found), length, np.int32)), pa.array(count.astype(np.int64))],
            names=["lang", "phrase", "words", "count"])

    return rows.mapInArrow(run, "lang string, phrase string, words int, count long")


class Known:
    """The frequent words of all languages, numbered in order, and the frequent pairs of their numbers, if they are known."""

    def __init__(self, rows: list[tuple[str, str]], pairs: np.ndarray | None = None):
        self.rows, self.pairs = rows, pairs

    @cached_property
    def numbers(self) -> dict[str, dict[bytes, int]]:
        own: dict[str, dict[bytes, int]] = {}
        for i, (lang, word) in enumerate(self.rows):
            own.setdefault(lang, {})[word.encode("utf-8", "surrogatepass")] = i
        return own


# A phrase of numbered words: the first and second, the third and fourth, the fifth; -1 for none.
KEYS = ("head", "middle", "last")


def numbered_counts(rows: DataFrame, shared: Broadcast, lengths: range) -> DataFrame:
    """(head, middle, last, count) of every phrase of known words, and known pairs, of every shard of ``rows`` (lang, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for shards in _shards(batches, lambda lang: Shard(known.numbers.get(lang, {}))):
            # numbers tell the languages apart
            words = np.concatenate([shard.words() for shard in shards.values()]) if shards else np.full(LONGEST, -1, np.int32)
            shards.clear()
            for at, count, length in repeated(words, lengths, known.pairs):
                for i in range(0, len(at), 1 << 16):
                    own = at[i:i + (1 << 16)]
                    w = [words[own + k] if k < length else np.full(len(own), -1, np.int32) for k in range(LONGEST)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(_packed(w[0], w[1])), pa.array(_packed(w[2], w[3])), pa.array(w[4]), pa.array(count[i:i + (1 << 16)].astype(np.int64))],
                        names=[*KEYS, "count"])

    return rows.mapInArrow(run, "head long, middle long, last int, count long")


def spelled(found: DataFrame, shared: Broadcast) -> DataFrame:
    """(lang, phrase, words, f) of (head, middle, last, f)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every = shared.value.rows
        for batch in batches:
            head, middle, last = (batch.column(i).to_numpy() for i in range(3))
            pairs = [(x >> 32, x.astype(np.int32)) for x in (head, middle)]
            numbers = list(zip(*(x.tolist() for pair in pairs for x in pair), last.tolist()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([every[n[0]][0] for n in numbers], pa.string()), pa.array([" ".join(every[i][1] for i in n if i >= 0) for n in numbers], pa.string()),
                 pa.array([sum(i >= 0 for i in n) for n in numbers], pa.int32()), batch.column(3)], names=["lang", "phrase", "words", "f"])

    return found.mapInArrow(run, "lang string, phrase string, words int, f long")


def _frequent(local: DataFrame, keys: tuple[str, ...], support: int) -> DataFrame:
    return local.groupBy(*keys).agg(F.sum("count").alias("f")).where(F.col("f") >= support)


def frequent_phrases(docs: DataFrame, support: int = SUPPORT) -> DataFrame:
    """(lang, phrase, words, f) of all phrases of up to LONGEST words with at least ``support`` occurrences.

    One row more per language has no phrase, 0 words, and the number of all words.
    """
    spark = docs.sparkSession
    rows = docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), "text")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # a phrase is reported once by each shard, so small neighbours go together
    near = rows.coalesce(max(1, -(-total // SHARD_BYTES)))
    key = ("lang", "phrase", "words")

    def all_of(lengths: range) -> DataFrame:
        counts = spelled_counts(near, lengths).groupBy(*key).agg(F.sum("count").alias("f"))
        return written(spark, lambda: counts.where((F.col("f") >= support) | F.col("phrase").isNull()))

    words = all_of(range(1, 2))
    frequent = words.where("phrase IS NOT NULL").select("lang", "phrase")
    many, size = frequent.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("phrase")), F.lit(0))).first()
    if many > BROADCAST_PHRASES or size > BROADCAST_BYTES:
        return all_of(range(1, LONGEST + 1))
    own = sorted(map(tuple, frequent.collect()))
    shared = spark.sparkContext.broadcast(Known(own))
    pairs = written(spark, lambda: _frequent(numbered_counts(near, shared, range(2, 3)), KEYS, support))
    codes = np.sort(pairs.select("head").toArrow()["head"].to_numpy()) if pairs.count() <= BROADCAST_PAIRS else None
    shared = spark.sparkContext.broadcast(Known(own, codes))
    longer = written(spark, lambda: _frequent(numbered_counts(near, shared, range(3, LONGEST + 1)), KEYS, support))
    return written(spark, lambda: words.unionByName(spelled(pairs.unionByName(longer), shared)))


def _part(first: Column, count: Column) -> Column:
    return F.array_join(F.slice("w", first, count), " ")


def collocations(docs: DataFrame, most: int = 2000, support: int = SUPPORT) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``most`` strongest phrases of 2 to LONGEST words.

    ``docs`` has lang (null: ``und``) and text (null: empty). Words are runs of anything but space and tab
    inside pieces between ``.,;:!?`` and line breaks; A-Z are lower-cased, nothing else is changed. a is the
    phrase's count, n the language's words; of all cuts in two, with counts l and r, the one of the smallest
    floor(1000 a n / (l r)) counts, ties to the shortest first part. Phrases inside a longer one that occurs
    as often are left out. Ties of the score go to the larger a, then to the phrase in byte order. Repeated
    rows count again; an empty table gives no rows. Extra columns are ignored.
    """
    every = frequent_phrases(docs, support)
    counts = every.where("phrase IS NOT NULL")
    totals = every.where("phrase IS NULL").select("lang", F.col("f").alias("n"))
    several = counts.where("words > 1").select("lang", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))
    size = F.size("w")
    # parts of a frequent phrase are frequent, so they all have a count
    cuts = several.select("lang", "phrase", "a", "w", F.explode(F.sequence(F.lit(1), size - 1)).alias("k")).select(
        "lang", "phrase", "a", "k", _part(F.lit(1), F.col("k")).alias("left"), _part(F.col("k") + 1, size - F.col("k")).alias("right"))

    def named(part: str, out: str) -> DataFrame:
        return counts.select("lang", F.col("phrase").alias(part), F.col("f").alias(out))

    wide = "decimal(19,0)"  # products of two of these are exact in 38 digits
    score = F.expr(f"(CAST(a AS {wide}) * CAST(n AS {wide}) * 1000BD) div (CAST(l AS {wide}) * CAST(r AS {wide}))")
    scored = cuts.join(named("left", "l"), ["lang", "left"]).join(named("right", "r"), ["lang", "right"]).join(totals, "lang").withColumn("score", score)
    best = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    inner = several.where(size > 2).select(
        "lang", F.col("a").alias("longer"), "w", F.explode(F.sequence(F.lit(2), size - 1)).alias("m")).select(
        "lang", "longer", "w", "m", F.explode(F.sequence(F.lit(1), size - F.col("m") + 1)).alias("at")).select(
        "lang", "longer", _part(F.col("at"), F.col("m")).alias("phrase"))
    inside = inner.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = best.join(inside, ["lang", "phrase"], "left").where("longer IS NULL OR 100 * longer < 100 * a")
    order = Window.partitionBy("lang").orderBy(F.col("cut.score").desc(), F.col("a").desc(), "phrase")
    return kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
