"""Mixing sources to target weights along a curriculum. DataFrame functions only.

Each source has a weight that changes over training time t in [0, 1]:

    weight(t) = base * (1 + tilt * (2t - 1)),   |tilt| < 1,

so its integral over the whole time is ``base``, and the share of its words that has been asked for
by time t is t + tilt * (t^2 - t). Words of a source are laid end to end in a fixed order (by a hash
of the id), pass after pass until its target is reached; inverting the cumulative demand gives each
copy of a document its training position, and documents are range-sorted by that position.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WEIGHTS = (5, 2, 1)
TILTS = (-0.5, 0.0, 0.5)
SHARE, MOST = 1.5, 2
WORD = r"[^\x20\x09-\x0D]+"
# Hex digits of the hash that split a source into parts, so that none is summed or sorted in one task.
PART_DIGITS = 3


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _cycle(values: Sequence[float], number: Column) -> Column:
    return F.element_at(F.array(*[F.lit(float(v)) for v in values]), (number % len(values) + 1).cast("int"))


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, tilts: Sequence[float] = TILTS,
            share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size) to the same with weight, tilt and target.

    Sources in code-point order, null last, take weights and tilts in turn. ``share`` of all words is
    split by weight; a target stops at ``most`` times its source's size and what is over is split
    again. In order of size per weight, sources stop until the level of the rest is below their own
    limit; that is where repeated splitting ends. One row per source, so windows over all are small.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    by_limit = Window.orderBy("limit_ratio", "number").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    stop = F.col("source_size") * F.lit(float(most))
    return (
        sizes.withColumn("number", F.row_number().over(order) - 1)
        .withColumn("weight", _cycle(weights, F.col("number")))
        .withColumn("tilt", _cycle(tilts, F.col("number")))
        .withColumn("limit_ratio", stop / F.col("weight"))
        .withColumn("stopped", F.coalesce(F.sum(stop).over(by_limit), F.lit(0.0)))
        .withColumn("weight_before", F.coalesce(F.sum("weight").over(by_limit), F.lit(0.0)))
        .withColumn("level", (F.sum("source_size").over(everything) * F.lit(float(share)) - F.col("stopped"))
                    / (F.sum("weight").over(everything) - F.col("weight_before")))
        # the level where the first source stays below its limit holds for all after it
        .withColumn("level", F.min(F.when(F.col("limit_ratio") >= F.col("level"), F.struct("limit_ratio", "number", "level")))
                    .over(everything)["level"])
        .withColumn("target", F.least(stop, F.coalesce(F.col("level") * F.col("weight"), stop)))
        .select("source", "source_size", "weight", "tilt", "target")
    )


def assign(docs: DataFrame, weights: Sequence[float] = WEIGHTS, tilts: Sequence[float] = TILTS,
           share: float = SHARE, most: int = MOST, whole: bool = False) -> DataFrame:
    """One row per document: doc (all its columns), size, source_size, target, copies.

    ``copies`` holds a (copy, words, position) for each copy that the mix takes. The copy in which a
    source's target is reached is cut there; with ``whole`` it is taken whole if at least half of it
    is asked for, else not at all. Null and empty texts have size 0 and no copies. A null source is a
    source of its own, null ids are ordered like an empty text. Rows of one id are ordered by size;
    equal rows are interchangeable. Any order of input rows gives the same result.
    """
    key = F.md5(F.coalesce(F.col("doc.doc_id").cast("string"), F.lit("")))
    sized = docs.select(F.struct("*").alias("doc")).select(
        "doc", F.col("doc.source").alias("source"), words(F.col("doc.text")).alias("size"), key.alias("key"),
        F.substring(key, 1, PART_DIGITS).alias("part"))
    parts = sized.groupBy("source", "part").agg(F.sum("size").alias("part_size"))
    sums = targets(parts.groupBy("source").agg(F.sum("part_size").alias("source_size")), weights, tilts, share, most)
    before = Window.partitionBy("source").orderBy("part")
    parts = parts.withColumn("before", F.sum("part_size").over(before) - F.col("part_size")).alias("p").join(
        sums.alias("s"), F.expr("p.source <=> s.source")).select(
        F.col("p.source").alias("of"), F.col("part").alias("in_part"), "before", "source_size", "tilt", "target")
    inside = Window.partitionBy("source", "part").orderBy("key", F.col("doc.doc_id"), "size")
    offset = F.col("before") + F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    goal = F.floor(F.col("target"))

    def copy(i: Column) -> Column:
        start = F.col("offset") + i * F.col("source_size")
        left = F.greatest(F.lit(0), F.least(F.col("size"), goal - start))
        taken = F.when(left * 2 >= F.col("size"), F.col("size")).otherwise(0) if whole else left
        share_done = F.least(F.lit(1.0), (start + left / F.lit(2.0)) / goal)
        a = F.col("tilt")
        place = F.lit(2.0) * share_done / ((F.lit(1.0) - a) + F.sqrt((F.lit(1.0) - a) * (F.lit(1.0) - a) + F.lit(4.0) * a * share_done))
        return F.struct(i.cast("int").alias("copy"), taken.cast("long").alias("words"), place.alias("position"))

    found = sized.join(parts, F.expr("source <=> of AND part = in_part")).withColumn("offset", offset)
    return found.select(
        "doc", "size", "source_size", "target",
        F.filter(F.transform(F.sequence(F.lit(0), F.lit(int(most) - 1)), copy), lambda c: c["words"] > 0).alias("copies"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: one row per copy, with the columns of ``docs``, in training order.

    Rows are range-sorted by position, so files of the result read in order are the curriculum. The
    text of a cut copy is its first words, joined by one space.
    """
    copies = assign(docs, **options).select("doc", "size", F.explode("copies").alias("c")).orderBy("c.position", "doc.doc_id", "c.copy")
    first = F.array_join(F.slice(F.split(F.regexp_replace("doc.text", r"^[\x20\x09-\x0D]+", ""), r"[\x20\x09-\x0D]+"), 1, F.col("c.words").cast("int")), " ")
    text = F.when(F.col("c.words") < F.col("size"), first).otherwise(F.col("doc.text"))
    return copies.select(*[text.alias(n) if n == "text" else F.col(f"doc.`{n}`") for n in docs.columns])
