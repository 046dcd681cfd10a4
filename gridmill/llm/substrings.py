"""Removal of long passages that also start earlier, through difference-cover anchors.

The offsets {0, 1, 3, 9} are a difference cover modulo 13: for any two positions some shift below 13
takes both to an offset of the cover. So two equal windows of 20 words share an anchor, 8 equal words
at a shift where both are on cover positions of their documents. Only anchors are hashed and shuffled
for all texts; windows are extended, hashed in 128 bits and compared just where an anchor also occurs
elsewhere. Equal rows of a task are merged before each shuffle, so a passage in every document is no
larger a group than there are tasks' batches.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridmill.llm.arrays import held, runs, slices, tidy
from gridmill.llm.steps import written

WINDOW = 20
PERIOD, COVER = 13, (0, 1, 3, 9)
ANCHOR = WINDOW - PERIOD + 1
SPACES = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
LAST = 2**63 - 1  # where rows without an id stand in the order
FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)  # odd


@held("substrings")
@lru_cache(maxsize=8)
def _powers(n: int, which: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    def rising(x: int) -> np.ndarray:
        out = np.full(n, x, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    codes = np.random.default_rng(90 + which).integers(1, 2**63, 256, dtype=np.uint64)
    return codes, rising(FACTORS[which]), rising(pow(FACTORS[which], -1, 2**64))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


class Words:
    """The words of some texts, with hashes of runs of words."""

    def __init__(self, texts: list[str]):
        raw = [t.encode("utf-8", "surrogatepass") for t in texts]
        self.data = np.frombuffer(b"\n".join([*raw, b""]), np.uint8)
        sizes = np.fromiter(map(len, raw), np.int64, len(raw)) + 1
        inside = np.concatenate([[False], ~SPACES[self.data], [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        self.starts, self.ends = edges[::2], edges[1::2]
        self.first = np.searchsorted(self.starts, np.concatenate([[0], np.cumsum(sizes)]))
        self.counts = np.diff(self.first)
        self.sums: dict[int, np.ndarray] = {}

    def hashes(self, at: np.ndarray, size: int, which: int = 0) -> np.ndarray:
        """Of ``size`` words from each of ``at``, by one of two independent hash functions."""
        if which not in self.sums:
            codes, up, down = _powers(1 << max(16, int(len(self.data)).bit_length()), which)
            total = np.zeros(len(self.data) + 1, np.uint64)
            np.cumsum(codes[self.data] * up[: len(self.data)], out=total[1:])
            word = (total[self.ends] - total[self.starts]) * down[self.starts]
            word = _mixed(word ^ (self.ends - self.starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
            self.sums[which] = np.zeros(len(word) + 1, np.uint64)
            np.cumsum(word * up[: len(word)], out=self.sums[which][1:])
        _, _, down = _powers(1 << max(16, int(len(self.data)).bit_length()), which)
        total = self.sums[which]
        return _mixed((total[at + size] - total[at]) * down[at])


def _text_hash() -> Column:
    return F.xxhash64("text")


def _order() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST))


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchors of texts. Of equal ones one keeps its hash, the others are spread; those known to occur
    elsewhere have ``~pos``. Rows stay in the order of the texts, which compresses best."""
    for batch in batches:
        ids = batch.column(0).to_numpy()
        for part, texts in slices(batch.column(1)):
            words = Words(texts)
            of = np.repeat(np.arange(len(texts)), words.counts)
            pos = np.arange(len(of)) - words.first[of]
            size = words.counts[of]
            here = (size >= WINDOW) & (pos + ANCHOR <= size) & np.isin(pos % PERIOD, COVER)
            at = np.flatnonzero(here)
            hashes, text, pos = words.hashes(at, ANCHOR), ids[part][of[at]], pos[at]
            if not len(at):
                continue
            order = np.lexsort((pos, text, hashes))
            h, t, p = hashes[order], text[order], pos[order]
            other = np.concatenate([[True], h[1:] != h[:-1]])
            # the same place of an equal text is no other occurrence
            copy = ~other & np.concatenate([[False], (t[1:] == t[:-1]) & (p[1:] == p[:-1])])
            group = np.cumsum(other) - 1
            known = np.bincount(group, ~copy)[group] > 1
            hashes[order] = np.where(other, h, _mixed(h + np.arange(len(h), dtype=np.uint64)))
            pos[order] = np.where(known, ~p, p)
            keep = np.sort(order[~copy])
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes[keep].view(np.int64)), pa.array(text[keep]), pa.array(pos[keep].astype(np.int32))],
                names=["hash", "content", "pos"])


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows around anchors. The earliest of equal ones keeps its hash; the others are known to be
    later, which ``~pos`` says."""
    for batch in batches:
        ids, contents = batch.column("ord").to_numpy(), batch.column("content").to_numpy()
        places = batch.column("places")
        for rows, texts in slices(batch.column("text")):
            words = Words(texts)
            flags = places.slice(rows.start, len(texts))
            at = flags.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            of = np.repeat(np.arange(len(texts)), np.fromiter((len(x) for x in flags), np.int64, len(texts)))
            low = np.maximum(at - PERIOD + 1, 0)
            high = np.minimum(at, words.counts[of] - WINDOW)
            of, low, high = of[high >= low], low[high >= low], high[high >= low]
            start = np.unique(runs(words.first[of] + low, high - low + 1))
            if not len(start):
                continue
            of = np.searchsorted(words.first, start, side="right") - 1
            a, b = words.hashes(start, WINDOW), words.hashes(start, WINDOW, 1)
            doc, content, pos = ids[rows][of], contents[rows][of], start - words.first[of]
            order = np.lexsort((pos, doc, b, a))
            x, y, d, p = a[order], b[order], doc[order], pos[order]
            new = np.concatenate([[True], (x[1:] != x[:-1]) | (y[1:] != y[:-1])])
            lead = np.flatnonzero(new)[np.cumsum(new) - 1]
            later = (d > d[lead]) | (p > p[lead])
            # later ones are settled and need no group; spread them
            a[order] = np.where(later, _mixed(x + np.arange(len(x), dtype=np.uint64)), x)
            pos[order] = np.where(later, ~p, p)
            yield pa.RecordBatch.from_arrays(
                [pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), pa.array(doc), pa.array(content),
                 pa.array(pos.astype(np.int32))], names=["a", "b", "ord", "content", "pos"])


def repeats(docs: DataFrame) -> DataFrame:
    """(ord, content, starts, whole): by row identity, the first words of windows that start earlier too.

    ``ord`` is the id (a null id counts as the largest number) and ``content`` a hash of the text;
    ``whole`` marks a copy of a whole text with a smaller id. Rows without any are left out.
    """
    spark = docs.sparkSession
    texts = docs.where("text IS NOT NULL").select(_order().alias("ord"), _text_hash().alias("content"), "text")
    # copies of a whole text: the one of the smallest id stands for all
    twin = F.struct(F.col("content"), F.xxhash64(F.lit("twin"), "text").alias("more"))
    ids = written(spark, lambda: texts.select("ord", twin.alias("twin")).distinct())
    models = ids.groupBy("twin").agg(F.min("ord").alias("model"), F.count("*").alias("rows"))
    copies = ids.join(models.where("rows > 1"), "twin").where("ord > model").select("ord", F.col("twin.content").alias("content"))

    def places() -> DataFrame:
        """(ord, content, places): anchors that also occur elsewhere, of one text of each content."""
        group = Window.partitionBy("hash")
        place = F.expr("IF(pos < 0, ~pos, pos)")
        anchors = texts.select("content", "text").mapInArrow(tidy(_anchors), "hash long, content long, pos int")
        spread = F.expr("pos < 0") | (F.min("content").over(group) < F.max("content").over(group)) | (F.min(place).over(group) < F.max(place).over(group))
        hits = anchors.withColumn("hit", spread).where("hit").groupBy("content").agg(F.collect_set(place).alias("places"))
        return hits.join(models.groupBy("twin.content").agg(F.min("model").alias("ord")), "content")

    def starts() -> DataFrame:
        """(ord, content, starts): windows that start earlier too."""
        same = Window.partitionBy("a", "b")
        windows = texts.join(anchored, ["ord", "content"]).select("ord", "content", "text", "places").mapInArrow(
            tidy(_windows), "a long, b long, ord long, content long, pos int")
        least = F.min(F.struct("ord", F.expr("IF(pos < 0, ~pos, pos)").alias("pos"))).over(same)
        found = windows.withColumn("least", least).where("pos < 0 OR struct(ord, pos) > least")
        return found.groupBy("ord", "content").agg(F.collect_set(F.expr("IF(pos < 0, ~pos, pos)")).alias("starts"))

    anchored = written(spark, places)
    return written(spark, starts).select("ord", "content", "starts", F.lit(False).alias("whole")).union(
        copies.select("ord", "content", F.lit(None).cast("array<int>"), F.lit(True)))


def kept_runs(count: int, starts: np.ndarray | None, whole: bool) -> list[tuple[int, int]]:
    """(first, end) of the runs of words that stay."""
    if whole and count >= WINDOW:
        return []
    if starts is None or not len(starts):
        return [(0, count)] if count else []
    change = np.zeros(count + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + WINDOW, -1)
    stays = np.concatenate([[False], np.cumsum(change)[:count] == 0, [False]])
    edges = np.flatnonzero(stays[1:] != stays[:-1])
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


def _with_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` in a struct ``doc``, with starts and whole."""
    rows = docs.select(F.struct("*").alias("doc"), _order().alias("ord"), _text_hash().alias("content"))
    return rows.join(repeats(docs.select("doc_id", "text")), ["ord", "content"], "left")


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every row.

    A null text has no words. Rows of one id are not earlier than each other; null ids come after all
    others. Repeated rows give repeated rows, an empty table an empty one.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, gone, sums = [], [], []
            for text, starts, whole in zip(batch.column(1).to_pylist(), batch.column(2), batch.column(3).to_pylist()):
                words = (text or "").encode("utf-8", "surrogatepass").split()
                kept = kept_runs(len(words), np.asarray(starts.values) if starts.is_valid else None, bool(whole))
                counts.append(len(words))
                gone.append(len(words) - sum(b - a for a, b in kept))
                sums.append(hashlib.sha256(b" ".join(w for a, b in kept for w in words[a:b])).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(gone, pa.int64()), pa.array(sums, pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    flat = _with_repeats(docs.select("doc_id", "text")).select(F.col("doc.doc_id").cast("long").alias("doc_id"), "doc.text", "starts", "whole")
    return flat.mapInArrow(tidy(run), "doc_id long, n_words long, n_removed long, kept_sha256 string")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` without passages that start earlier too; texts without any stay as they are.

    Runs of words that stay keep the white space between them; runs are joined by one space. A row
    of which nothing stays is dropped; one that had no words before is not.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fields, starts, whole = batch.column(0).flatten(), batch.column(1), batch.column(2)
            for rows, texts in slices(fields[at]):
                size, new = len(texts), []
                for text, places, all_of_it in zip(texts, starts.slice(rows.start, size), whole.slice(rows.start, size).to_pylist()):
                    words = Words([text])
                    kept = kept_runs(int(words.counts[0]), np.asarray(places.values) if places.is_valid else None, bool(all_of_it))
                    raw = words.data.tobytes()
                    new.append(b" ".join(raw[words.starts[a]:words.ends[b - 1]] for a, b in kept).decode("utf-8", "surrogatepass"))
                left = pa.array(np.flatnonzero([t != "" for t in new]))
                columns = [pa.array(new, pa.string()) if i == at else f.slice(rows.start, size) for i, f in enumerate(fields)]
                yield pa.RecordBatch.from_arrays([c.take(left) for c in columns], names=names)

    names, at = docs.columns, docs.columns.index("text")
    rows = _with_repeats(docs)
    hit = F.col("whole").isNotNull() & (F.size(F.regexp_extract_all("doc.text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))) >= WINDOW)
    done = rows.where(hit).select("doc", "starts", "whole").mapInArrow(tidy(run), docs.schema)
    same = rows.where(~F.coalesce(hit, F.lit(False))).select("doc.*")
    return done.unionByName(same)
