"""Numbers of equal slices, and where pieces of texts start, against plain loops."""

import random

import numpy as np
import pytest

from gridmill.llm import bpe


def plain(raw, starts, ends):
    seen, number, first = {}, [], []
    for i, (a, b) in enumerate(zip(starts, ends)):
        if raw[a:b] not in seen:
            seen[raw[a:b]] = len(seen)
            first.append(i)
        number.append(seen[raw[a:b]])
    return number, first


@pytest.mark.parametrize("words", [bpe.WORDS, (1, 1, 1), (0, 0, 0)])
def test_slices_of_all_lengths(monkeypatch, words):
    """Whatever the hash says of first and last bytes: zero bytes, slices that differ in the middle or in length only, empty ones."""
    monkeypatch.setattr(bpe, "WORDS", words)
    rng = random.Random(5)
    parts = [b"", b"\0", b"\0\0", b"a", b"a\0", b"a" * 7, b"a" * 8, b"a" * 9, b"a" * 16, b"a" * 17, b"a" * 24, b"a" * 40]
    parts += [b"12345678" + bytes([rng.choice(b"xy") for _ in range(n)]) + b"87654321" for n in range(12) for _ in range(4)]
    parts += [bytes(rng.choice(b"ab\0\xff") for _ in range(rng.randrange(20))) for _ in range(300)]
    rng.shuffle(parts)
    raw = b"".join(parts)
    ends = np.cumsum([len(p) for p in parts])
    starts = ends - [len(p) for p in parts]
    number, first = bpe.distinct(np.frombuffer(raw, np.uint8), starts, ends)
    assert (number.tolist(), first.tolist()) == plain(raw, starts.tolist(), ends.tolist())


def test_few_passes_over_the_bytes(monkeypatch):
    """Only slices of over 16 bytes are hashed byte by byte."""
    sizes, own = [], bpe._powers

    def powers(n):
        sizes.append(n)
        return own(n)

    monkeypatch.setattr(bpe, "_powers", powers)
    data = np.frombuffer(b"some words " * 30000 + b"one of more than sixteen bytes", np.uint8)
    gaps = np.flatnonzero(data == 0x20)[:60000]
    number, first = bpe.distinct(data, np.append(gaps[:-1], len(data) - 30), np.append(gaps[1:], len(data)))
    assert len(first) == 3 and sizes == [1 << 16]


def test_cache_keeps_no_long_pieces():
    asked = []

    def encode(pieces):
        asked.append(list(pieces))
        return [np.array([len(p)], "<u4").tobytes() for p in pieces]

    cache = bpe.Cache(encode)
    pieces = [b"ab", b"c" * 64, b"d" * 65, b"d" * 65]
    for _ in range(2):
        assert [int.from_bytes(x, "little") for x in cache.ids(pieces)] == [2, 64, 65, 65]
    assert asked == [pieces, pieces[2:]] and set(cache.known) == set(pieces[:2])


@pytest.mark.parametrize("words", [bpe.WORDS, (0, 0, 0)])
def test_ids_of_slices_lately_met(monkeypatch, words):
    """The ids of slices are those of the encoder, whether their slots hold them, others or nothing."""
    monkeypatch.setattr(bpe, "WORDS", words)
    monkeypatch.setattr(bpe, "SLOTS", 16)

    def encode(pieces):
        return [np.frombuffer(p[::-1] + p, np.uint8)[: len(p) + len(p) % 2].astype("<u4").tobytes() for p in pieces]

    cache, rng = bpe.Cache(encode, most=40), random.Random(6)
    for _ in range(60):
        parts = [b"the", b"\0" * 5, b"x" * 17, b"y" * 70, *{bytes(rng.choice(b"ab\0") for _ in range(rng.randrange(1, 19))) for _ in range(8)}]
        ends = np.cumsum([len(p) for p in parts])
        ids, sizes = cache.of_slices(np.frombuffer(b"".join(parts), np.uint8), ends - [len(p) for p in parts], ends)
        want = [np.frombuffer(x, "<u4").tolist() for x in encode(parts)]
        assert sizes.tolist() == [len(x) for x in want] and ids.tolist() == [i for x in want for i in x]
    for _ in range(3):  # after the first time nothing is asked for, if both have slots of their own
        got = [cache.of_slices(np.frombuffer(b"one two", np.uint8), np.array([a]), np.array([b]))[0].tolist() for a, b in ((0, 3), (3, 7))]
        assert got == [np.frombuffer(x, "<u4").tolist() for x in encode([b"one", b" two"])]


def test_slots_spare_the_dictionary():
    cache = bpe.Cache(lambda pieces: [np.array([len(p)], "<u4").tobytes() for p in pieces])
    data, starts, ends = np.frombuffer(b"some words", np.uint8), np.array([0, 4]), np.array([4, 10])
    first = cache.of_slices(data, starts, ends)
    cache.known, cache.older, cache.encode = {}, {}, lambda pieces: [b"" for _ in pieces]
    again = cache.of_slices(data, starts, ends)
    assert [x.tolist() for x in first] == [x.tolist() for x in again] == [[4, 6], [1, 1]]
