"""Spelling variants against plain comparisons of all words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from gridmill.llm import queries, spelling


def brute_words(rows):
    found = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 7 and n >= 2}


def brute(rows):
    """By keys: a word with one place blanked, or one letter left out."""
    found = brute_words(rows)
    near = {w: set() for w in found}
    blanked: dict = {}
    for w in found:
        for i in range(len(w)):
            blanked.setdefault((w[:i], w[i + 1:]), []).append(w)
    for some in blanked.values():
        for a in some:
            near[a].update(b for b in some if b != a)
    for w in found:
        for i in range(len(w)):
            short = w[:i] + w[i + 1:]
            if short in found:
                near[w].add(short)
                near[short].add(w)
    form = {}
    for w, some in near.items():
        if some:
            best = min(some, key=lambda x: (-found[x], x))
            if found[best] >= 10 * found[w]:
                form[w] = best
    out = set()
    for w, n in found.items():
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n, len(near[w]), found[form[w]] if w in form else None))
    return out


def ours(df):
    got = [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()]
    assert len(set(got)) == len(got)
    return set(got)


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    assert ours(queries.op13_spelling_variants(spark, folder)) == brute(rows)


@pytest.mark.parametrize("box", [1 << 15, 40])
def test_close_words(spark, monkeypatch, box):
    monkeypatch.setattr(spelling, "BOX", box)
    monkeypatch.setattr(spelling, "LEAF", 3)
    monkeypatch.setattr(spelling, "HELD_WORDS", 50)
    rng = random.Random(4)
    some = ["".join(rng.choice("abÀÿ") for _ in range(rng.randint(6, 10))) for _ in range(300)]
    rows = []
    for i in range(1500):
        weight = rng.choice([1, 1, 2, 30])
        word = some[int(rng.random() ** 3 * len(some))]
        rows.append((rng.choice([i, None]), f"{word.upper() if word.isascii() and rng.random() < .2 else word}, " * weight + rng.choice(["", "Ab1é ×÷", "\n"])))
    rows += [(1, None), (2, ""), (3, "x" * 20_000), (3, "x" * 20_000), (0, "abababa abababa")]
    docs = spark.createDataFrame([(*r, "w", 1) for r in rows], "doc_id long, text string, word string, n int").repartition(5)
    assert ours(spelling.variants(docs)) == brute(rows)


def test_empty(spark):
    assert spelling.variants(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert ours(spelling.variants(spark.createDataFrame([(1, "single words only here"), (2, "abcdefgh abcdefgh")], "doc_id long, text string"))) == {
        ("abcdefgh", None, "abcdefgh", 2, 0, None)}


def test_edits():
    short, long = spelling.letters(["abc"] * 5), spelling.letters(["xabc", "abxc", "abcc", "axbx", "bacx"])
    assert spelling.one_inserted(short, long).tolist() == [True, True, True, False, False]
    assert spelling.one_replaced(short, spelling.letters(["abc", "abd", "bbc", "cba", "xyc"])).tolist() == [False, True, True, False, False]


def test_trees_reach_all_close_counts():
    rng = np.random.default_rng(1)
    held = rng.integers(0, 4, (400, spelling.SIZE)).astype(np.int8)
    held[:, 4:] = 0
    tree = spelling.Tree(held, 5)
    leaf = np.empty(len(held), np.int64)
    for i, m in enumerate(tree.members):
        leaf[m] = i
    assert (tree.home(held) == leaf).all()
    for less in (True, False):
        reached = {(a, b) for q, at in tree.reach(held, less) for a, b in zip(q.tolist(), at.tolist())}
        diff = held[None].astype(int) - held[:, None]
        close = ((np.maximum(diff, 0).sum(2) == 1) & (np.maximum(-diff, 0).sum(2) == less))
        assert {(a, leaf[b]) for a, b in zip(*np.nonzero(close))} <= reached
