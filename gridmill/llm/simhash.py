"""Near-duplicates by SimHash, linked exactly through vantage-point trees.

Fingerprints that differ in 3 or fewer of 64 bits differ in 1 or none of the bits of one of their
halves. So there are two forests, one over each half, searched with radius 1: a tree of vantage
points splits the halves by Hamming distance into shards; triangle bounds decide which shards a
fingerprint near a boundary must visit besides its own; and within a shard a further tree is searched
in the same way down to small blocks, where whole fingerprints are compared. Only distinct
fingerprints are indexed, and a block returns one link per fingerprint to its local component.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmill.llm.arrays import slices, tidy
from gridmill.llm.steps import components, written

SEED = 42
SHINGLE = 3
BITS = 3  # differing bits of a link
REACH = BITS // 2  # differing bits of the nearer half
SAMPLE = 1 << 14  # fingerprints from which the shared tree is grown, at most
SHARD = 1 << 13  # fingerprints a shard should hold
BLOCK = 512  # fingerprints that are compared directly
SLICE = 1 << 16  # shingles of a text that are counted at a time


def fingerprint(text: str) -> int:
    """SimHash of word shingles, as an unsigned number; 0 without words."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    size = min(SHINGLE, len(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(lengths) - 1
    starts = ends + 1 - lengths
    starts, ends = starts[:len(words) - size + 1], ends[size - 1:]
    digest = xxhash.xxh64_intdigest
    totals = np.zeros(64, np.int64)
    for i in range(0, len(starts), SLICE):
        hashes = np.fromiter([digest(joined[a:b], SEED) for a, b in zip(starts[i:i + SLICE].tolist(), ends[i:i + SLICE].tolist())], np.uint64)
        totals += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * totals > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns in ``keep`` and fp, a signed 64-bit number. Null and empty texts have 0."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t) for _, texts in slices(batch.column(0)) for t in texts], np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(found.view(np.int64))], names=[*keep, "fp"])

    schema = T.StructType([*(docs.schema[c] for c in keep), T.StructField("fp", T.LongType())])
    return docs.select("text", *keep).mapInArrow(tidy(run), schema)


def half(fp: np.ndarray, side: int) -> np.ndarray:
    """The lower (0) or upper (1) half of fingerprints."""
    return (fp.view(np.uint64) >> np.uint64(32 * side)).astype(np.uint32)


def vantage(values: np.ndarray) -> tuple[int, int]:
    """A point from which distances spread most, and the median distance; -1 if they cannot be split."""
    best = (-1.0, 0, -1)
    for point in values[:: max(1, len(values) // 4)][:5]:
        d = np.bitwise_count(values ^ point)
        radius = int(np.sort(d)[(len(d) - 1) // 2])
        if d.max() <= radius:
            radius -= 1
        inside = int((d <= radius).sum())
        if inside:
            # balanced, with few near the boundary
            worth = min(inside, len(d) - inside) - 0.5 * int((np.abs(d.astype(int) - radius) <= REACH).sum())
            best = max(best, (worth + len(d), int(point), radius))
    return best[1], best[2]


def grow(values: np.ndarray, levels: int) -> tuple[np.ndarray, np.ndarray]:
    """Vantage points and radii of a complete tree, children of i at 2i + 1 (inside) and 2i + 2."""
    points, radii = np.zeros((1 << levels) - 1, np.uint32), np.full((1 << levels) - 1, -1, np.int64)
    held = {0: values}
    for i in range(len(points)):
        own = held.pop(i)
        if len(own) > 1:
            points[i], radii[i] = vantage(own)
        inside = np.bitwise_count(own ^ points[i]) <= radii[i]
        held[2 * i + 1], held[2 * i + 2] = own[inside], own[~inside]
    return points, radii


def place(values: np.ndarray, tree: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index, shard, at home): the shard each value lives in and those it visits.

    A value outside that is within reach of the boundary visits the inside; so of two near values
    that a boundary parts, the outer one meets the inner one there. A visitor goes on to every side
    where a value within reach of it could live.
    """
    points, radii = tree
    index = np.arange(len(values))
    node, home = np.zeros(len(values), np.int64), np.ones(len(values), bool)
    for _ in range(int(math.log2(len(points) + 1))):
        d = np.bitwise_count(values[index] ^ points[node]).astype(np.int64)
        r = radii[node]
        inside = d <= r
        own = np.where(inside, 2 * node + 1, 2 * node + 2)
        other = np.where(inside, 2 * node + 2, 2 * node + 1)
        also = np.where(inside, ~home & (d > r - REACH), d <= r + REACH)
        index = np.concatenate([index, index[also]])
        node = np.concatenate([own, other[also]])
        home = np.concatenate([home, np.zeros(int(also.sum()), bool)])
    return index, node - len(points), home


def block_links(fps: np.ndarray, home: np.ndarray) -> list[tuple[np.ndarray, int]]:
    """(members, first member) of the components in a block that hold a fingerprint at home."""
    free = np.ones(len(fps), bool)
    seeds = np.flatnonzero(home)
    linked = []
    for i in range(0, len(seeds), BLOCK):
        rows = seeds[i:i + BLOCK]
        near = np.zeros(len(rows), np.int64)
        for j in range(0, len(fps), 1 << 13):
            near += (np.bitwise_count(fps[rows][:, None] ^ fps[j:j + (1 << 13)][None, :]) <= BITS).sum(axis=1)
        linked.append(rows[near > 1])
    out = []
    for seed in (int(s) for rows in linked for s in rows):
        if not free[seed]:
            continue
        free[seed] = False
        members, front = [np.array([seed])], np.array([seed])
        while len(front):
            pool = np.flatnonzero(free)
            found = np.zeros(len(pool), bool)
            for one in front:
                found |= np.bitwise_count(fps[pool] ^ fps[one]) <= BITS
            front = pool[found]
            free[front] = False
            members.append(front)
        out.append((np.concatenate(members), seed))
    return out


def shard_links(fps: np.ndarray, home: np.ndarray, side: int) -> Iterator[tuple[np.ndarray, int]]:
    """Components of a shard, from the blocks of a tree over the shard's own fingerprints."""
    halves = half(fps, side)
    todo = [np.arange(len(fps))]
    while todo:
        at = todo.pop()
        own = at[home[at]]
        if not len(own):
            continue
        point, radius = vantage(halves[own]) if len(own) > BLOCK else (0, -1)
        # of an unsplittable group all share a half: the whole fingerprints are compared
        if radius < 0:
            for members, seed in block_links(fps[at], home[at]):
                yield at[members], int(at[seed])
            continue
        mask = np.zeros(len(fps), bool)
        d = np.bitwise_count(halves[at] ^ np.uint32(point)).astype(np.int64)
        inner, outer = at[d <= radius + REACH], at[np.where(home[at], d > radius, d > radius - REACH)]
        # what lives outside visits the inside: the flag is kept per branch by splitting the fingerprints
        mask[at[d <= radius]] = True
        yield from shard_links_with(fps, home & mask, side, inner)
        todo.append(outer)


def shard_links_with(fps: np.ndarray, home: np.ndarray, side: int, at: np.ndarray) -> Iterator[tuple[np.ndarray, int]]:
    for members, seed in shard_links(fps[at], home[at], side):
        yield at[members], int(at[seed])


def links(distinct: DataFrame) -> DataFrame:
    """Links (a, b) that join all fingerprints (fp, each once) at most BITS bits apart."""
    count = distinct.count()
    sample = np.array([r.fp for r in distinct.orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).collect()], np.int64)
    levels = max(0, math.ceil(math.log2(max(1, count / SHARD))))
    levels = min(levels, max(0, int(math.log2(max(1, len(sample) / 8)))))
    trees = [grow(half(sample, side), levels) for side in (0, 1)]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False)
            for side, tree in enumerate(trees):
                index, shard, home = place(half(fps, side), tree)
                yield pa.RecordBatch.from_arrays([pa.array(2 * shard + side), pa.array(fps[index]), pa.array(home)], names=["shard", "fp", "home"])

    def match(rows: pa.Table) -> pa.Table:
        side = rows.column("shard")[0].as_py() % 2
        fps, home = rows.column("fp").to_numpy().view(np.uint64), rows.column("home").to_numpy()
        found = [(fps[m], fps[s]) for m, s in shard_links(fps, home, side)]
        a = np.concatenate([np.zeros(0, np.uint64), *(m for m, _ in found)])
        b = np.concatenate([np.zeros(0, np.uint64), *(np.full(len(m), s) for m, s in found)])
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    dealt = distinct.select("fp").mapInArrow(deal, "shard long, fp long, home boolean")
    return dealt.groupBy("shard").applyInArrow(match, "a long, b long").where("a <> b")


def _classes(distinct: DataFrame) -> DataFrame:
    """``distinct`` (fp, each once, and other columns) with label, the smallest fingerprint of the component."""
    found = components(links(distinct))
    return distinct.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("label", F.coalesce("label", "fp"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row.

    Texts without words have fingerprint 0 and are linked like any other. Rows without an id are
    linked too, but are never the smallest; a component of such rows only has a null id. Repeated
    rows give repeated rows. An empty table gives an empty one.
    """
    spark = docs.sparkSession
    rows = written(spark, lambda: fingerprints(docs))
    distinct = written(spark, lambda: rows.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("rows")))
    classes = _classes(distinct)
    smallest = classes.where("rows > 1 OR label <> fp OR first IS NULL").select("label").distinct()
    # components of one row need no look-up: they are their own smallest
    ids = classes.join(smallest, "label", "left_semi").groupBy("label").agg(F.min("first").alias("component_id"))
    of = classes.join(ids, "label").select("fp", "component_id", F.lit(True).alias("known"))
    return rows.join(of, "fp", "left").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.when(F.col("known"), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest id, of several the one of the smallest
    fingerprint, text hash and row hash.

    Rows without an id cannot be named by a component and stay.
    """
    spark = docs.sparkSession
    ided = docs.where("doc_id IS NOT NULL")
    # 128 bits stand for a text, so rows of one id and different texts are told apart
    text = F.coalesce("text", F.lit(""))
    content = F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit("content"), text).alias("b"))
    rows = written(spark, lambda: fingerprints(ided.select("doc_id", "text", content.alias("content")), ("doc_id", "content")))
    distinct = written(spark, lambda: rows.groupBy("fp").agg(F.min(F.struct("doc_id", "content")).alias("first")))
    chosen = _classes(distinct).groupBy("label").agg(F.min(F.struct("first.doc_id", "fp", "first.content")).alias("one")).select(
        F.col("one.doc_id").alias("chosen_id"), F.col("one.content").alias("chosen_content"))
    packed = ided.select(F.struct("*").alias("doc"), F.col("doc_id").alias("own_id"), content.alias("own_content"))
    kept = packed.join(chosen, F.expr("own_id = chosen_id AND own_content = chosen_content"), "left_semi")
    one = kept.groupBy("own_id", "own_content").agg(F.min_by("doc", F.xxhash64("doc")).alias("doc")).select("doc.*")
    return one.unionByName(docs.where("doc_id IS NULL"))
