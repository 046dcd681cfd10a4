"""Spelling variants: words one edit apart, found by k-d trees over letter counts.

One replaced letter takes one from a letter's count and adds one to another's (L1 distance two); one inserted
letter adds one to a count (L1 distance one). So words of each length are split by letter counts, and a word
is looked up among those of its own length, where a box may ask for one letter more and one less, and among
those one letter longer, where it may ask for one more and none less. A tree grown from a sample deals boxes
out to tasks; a word goes to its own box and, as a question, to those that it could have near words in. In
a task a further tree leads each question to small leaves, where the order of letters decides.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmill.llm.arrays import only, runs, slices
from gridmill.llm.steps import written

SHORTEST, LEAST, RATIO = 7, 2, 10  # letters and occurrences of a word; how much more frequent its form is
DAMAGE = 31  # one run in so many loses a letter
RUNS = re.compile(f"[a-zÀ-ÿ]{{{SHORTEST},}}")  # after A-Z became small
HELD_WORDS = 1 << 18  # distinct words a task counts before it hands them on
SAMPLE = 1 << 15  # words from which the dealing trees are grown, at most
BOX = 1 << 15  # words of a box, about
LEAF = 24  # words that are compared letter by letter
ASKED = 1 << 12  # questions that go down a tree together
NONE, USED = -1, 127  # of a box's wish for one letter more or less: not yet, not allowed

# a-z and the letters from 00C0 to 00FF as numbers
LETTERS = np.full(256, 0, np.uint8)
LETTERS[0x61:0x7B] = np.arange(26)
LETTERS[0xC0:] = 26 + np.arange(64)
SIZE = 90


def damaged(run: str, prefix: int) -> str:
    """The run, without one letter if the checksum of document and run says so."""
    h = zlib.crc32(run.encode(), prefix)
    if h % DAMAGE:
        return run
    k = h % len(run)
    return run[:k] + run[k + 1:]


def words(docs: DataFrame) -> DataFrame:
    """(word, n) of all words with at least LEAST occurrences in ``docs`` (doc_id, text); a null id counts as an empty one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only()
        counts: Counter = Counter()

        def handed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"])

        for batch in batches:
            ids = batch.column(0).to_pylist()
            for part, texts in slices(batch.column(1)):
                for doc_id, text in zip(ids[part], texts):
                    prefix = zlib.crc32(f"{doc_id or ''}:".encode())
                    small = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")  # of bytes: A-Z only
                    for found, n in Counter(RUNS.findall(small)).items():
                        word = damaged(found, prefix)
                        if len(word) >= SHORTEST:
                            counts[word] += n
                    if len(counts) > HELD_WORDS:
                        yield handed()
                        counts = Counter()
        yield handed()

    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInArrow(run, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST)


def letters(found: list[str]) -> np.ndarray:
    """Words of one length as rows of bytes."""
    raw = np.frombuffer("".join(found).encode("latin-1"), np.uint8)
    return raw.reshape(len(found), -1)


def counted(codes: np.ndarray) -> np.ndarray:
    """How often each letter stands in each word."""
    n, length = codes.shape
    flat = np.repeat(np.arange(n) * SIZE, length) + LETTERS[codes].ravel()
    return np.bincount(flat, minlength=n * SIZE).astype(np.int8).reshape(n, SIZE)


class Tree:
    """Boxes of letter counts: a node sends counts up to its limit to the left, others to the right."""

    def __init__(self, counts: np.ndarray, leaf: int):
        self.letter, self.limit, self.left, self.right = [], [], [], []
        self.members: list[np.ndarray] = []  # of the leaves
        todo = [(np.arange(len(counts)), None, 0)]
        while todo:
            at, parent, side = todo.pop()
            letter, limit = self._cut(counts[at]) if len(at) > leaf else (NONE, 0)
            me = len(self.letter)
            if parent is not None:
                (self.right if side else self.left)[parent] = me
            self.letter.append(letter)
            self.limit.append(limit)
            self.left.append(len(self.members) if letter == NONE else 0)
            self.right.append(0)
            if letter == NONE:
                self.members.append(at)
            else:
                low = counts[at, letter] <= limit
                todo += [(at[~low], me, 1), (at[low], me, 0)]
        self.letter, self.limit = np.array(self.letter, np.int16), np.array(self.limit, np.int8)
        self.left, self.right = np.array(self.left, np.int64), np.array(self.right, np.int64)

    @staticmethod
    def _cut(counts: np.ndarray) -> tuple[int, int]:
        """The letter and limit that come closest to halves."""
        best = (0.5, NONE, 0)
        for limit in range(3):
            share = np.abs((counts <= limit).mean(axis=0) - 0.5)
            letter = int(share.argmin())
            if share[letter] < best[0]:
                best = (float(share[letter]), letter, limit)
        return best[1], best[2]

    def reach(self, counts: np.ndarray, less: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(question, leaf): all leaves that may hold words with one letter more, and if ``less`` one fewer of another."""
        for start in range(0, len(counts), ASKED):
            some = counts[start:start + ASKED]
            q, node = np.arange(len(some)), np.zeros(len(some), np.int64)
            more, fewer = np.full(len(some), NONE, np.int16), np.full(len(some), NONE if less else USED, np.int16)
            while len(q):
                letter = self.letter[node]
                end = letter == NONE
                if end.any():
                    yield q[end] + start, self.left[node[end]]
                    q, node, more, fewer, letter = q[~end], node[~end], more[~end], fewer[~end], letter[~end]
                over = some[q, letter] - self.limit[node]  # above 0: belongs to the right
                left = (over <= 0) | ((over == 1) & ((fewer == NONE) | (fewer == letter)))
                right = (over > 0) | ((over == 0) & ((more == NONE) | (more == letter)))
                fewer_left = np.where(over > 0, letter, fewer)
                more_right = np.where(over <= 0, letter, more)
                q, node, more, fewer = (
                    np.concatenate([q[left], q[right]]), np.concatenate([self.left[node[left]], self.right[node[right]]]),
                    np.concatenate([more[left], more_right[right]]), np.concatenate([fewer_left[left], fewer[right]]))

    def home(self, counts: np.ndarray) -> np.ndarray:
        """The leaf of each."""
        node = np.zeros(len(counts), np.int64)
        while True:
            letter = self.letter[node]
            going = np.flatnonzero(letter != NONE)
            if not len(going):
                return self.left[node]
            right = counts[going, letter[going]] > self.limit[node[going]]
            node[going] = np.where(right, self.right[node[going]], self.left[node[going]])


def one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Do rows differ in exactly one letter?"""
    return (a != b).sum(axis=1) == 1


def one_inserted(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Is each row of ``long`` that of ``short`` with one letter more?"""
    n, length = short.shape
    head, tail = short != long[:, :-1], short != long[:, 1:]
    first = np.where(head.any(axis=1), head.argmax(axis=1), length)
    last = np.where(tail.any(axis=1), length - tail[:, ::-1].argmax(axis=1), 0)
    return last <= first


def pairs(tree: Tree, asked: np.ndarray, held: np.ndarray, less: bool) -> tuple[np.ndarray, np.ndarray]:
    """(question, held word) that are one edit apart, from letters of both."""
    sizes = np.array([len(m) for m in tree.members])
    order, starts = np.concatenate(tree.members), np.cumsum(sizes) - sizes
    same, out_q, out_p = one_replaced if less else one_inserted, [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for q, leaf in tree.reach(counted(asked), less):
        q, p = np.repeat(q, sizes[leaf]), order[runs(starts[leaf], sizes[leaf])]
        hit = same(asked[q], held[p])
        out_q.append(q[hit])
        out_p.append(p[hit])
    return np.concatenate(out_q), np.concatenate(out_p)


def _best(of: np.ndarray, other: np.ndarray, n: np.ndarray, rank: np.ndarray):
    """(word, how many near it, the most frequent of these) for every word with any; ties to the smallest rank."""
    order = np.lexsort((rank[other], -n[other], of))
    of, other = of[order], other[order]
    first = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]])) if len(of) else np.zeros(0, np.int64)
    return of[first], np.diff(np.append(first, len(of))), other[first]


def near(found: DataFrame) -> DataFrame:
    """(word, n_near, best): how many words of ``found`` (word, n) are one edit away, and the most frequent of these.

    ``best`` is a struct (less, other): the negated n, so that its smallest is the largest n, ties to the smaller word.
    """
    spark = found.sparkSession
    sizes = {r.length: r["count"] for r in found.groupBy(F.length("word").alias("length")).count().collect()}
    sampled: dict[int, list[str]] = {}
    for r in found.orderBy(F.xxhash64("word"), "word").limit(SAMPLE).select("word").collect():
        sampled.setdefault(len(r.word), []).append(r.word)
    # a tree per length, with about one leaf per BOX words
    trees = {length: Tree(counted(letters(some)), max(1, -(-len(some) * BOX // sizes[length]))) for length, some in sampled.items()}
    nothing = Tree(np.zeros((0, SIZE), np.int8), 1)
    for tree in trees.values():
        tree.members = []  # boxes only, not what they were grown from
    grown = spark.sparkContext.broadcast(trees)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only()
        known = grown.value

        def rows(at: np.ndarray, length: int, leaf: np.ndarray, role: int) -> pa.RecordBatch:
            part = batch.take(pa.array(at))
            return pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(length << 32 | leaf), pa.array(np.full(len(at), role, np.int32))], names=["word", "n", "box", "role"])

        for batch in batches:
            every = batch.column(0).to_pylist()
            of = np.array([len(w) for w in every], np.int64)
            for length in np.unique(of).tolist():
                at = np.flatnonzero(of == length)
                counts = counted(letters([every[i] for i in at.tolist()]))
                own, longer = known.get(length, nothing), known.get(length + 1, nothing)
                home = own.home(counts)
                yield rows(at, length, home, 0)
                for q, leaf in own.reach(counts, True):
                    away = leaf != home[q]
                    yield rows(at[q[away]], length, leaf[away], 1)
                if length + 1 in sizes:
                    for q, leaf in longer.reach(counts, False):
                        yield rows(at[q], length + 1, leaf, 2)

    def match(table: pa.Table) -> pa.Table:
        role, n = table.column("role").to_numpy(), table.column("n").to_numpy()
        every = np.array(table.column("word").to_pylist(), object)
        held = np.flatnonzero(role == 0)
        out: dict[str, list] = {"word": [], "n_near": [], "less": [], "other": []}
        if len(held):
            codes = letters(every[held].tolist())
            tree = Tree(counted(codes), LEAF)
            rank = np.empty(len(every), np.int64)
            rank[np.argsort(every, kind="stable")] = np.arange(len(every))

            def add(of: np.ndarray, other: np.ndarray) -> None:
                of, many, best = _best(of, other, n, rank)
                out["word"] += every[of].tolist()
                out["n_near"] += many.tolist()
                out["less"] += (-n[best]).tolist()
                out["other"] += every[best].tolist()

            alike, short = np.flatnonzero(role < 2), np.flatnonzero(role == 2)
            q, p = pairs(tree, letters(every[alike].tolist()), codes, True)
            add(alike[q], held[p])
            if len(short):
                q, p = pairs(tree, letters(every[short].tolist()), codes, False)
                add(short[q], held[p])
                add(held[p], short[q])
        return pa.table(out, schema=pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("less", pa.int64()), ("other", pa.string())]))

    dealt = found.mapInArrow(deal, "word string, n long, box long, role int")
    links = dealt.groupBy("box").applyInArrow(match, "word string, n_near long, less long, other string")
    return links.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct("less", "other")).alias("best"))


def variants(docs: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of ``docs`` (doc_id, text).

    Words are what is left of runs of letters (A-Z and the range 00C0 to 00FF; A-Z in small letters) of
    SHORTEST letters or more that occur LEAST times in all. The form of a word is the most frequent word one
    edit away, ties to the smaller one, if it occurs RATIO times as often; the root is the last of the forms
    that follow. A null text is an empty one; a null id counts as an empty text in the checksum; repeated
    rows count again; an empty table gives no rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    found = written(spark, lambda: words(docs))
    close = written(spark, lambda: near(found))
    form = F.when(-F.col("best.less") >= RATIO * F.col("n"), F.col("best.other"))
    formed = written(spark, lambda: found.join(close, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), form.alias("form"), F.when(form.isNotNull(), -F.col("best.less")).alias("form_n")))
    # each form occurs RATIO times as often, so chains are short; every round doubles what a pointer spans
    roots = formed.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        step = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        jumped = written(spark, lambda: roots.join(step, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        roots = jumped.select("word", "root")
        if not jumped.where("moved").limit(1).count():
            break
    return formed.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
