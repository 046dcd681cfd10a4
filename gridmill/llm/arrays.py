"""Texts as numpy arrays of code points, in chunks of bounded size, for use inside tasks."""

from __future__ import annotations

import ctypes
import functools
import gc
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Code points worked on at a time. A longer text is a chunk of its own.
CHUNK = 1 << 19

# White space by Unicode's White_Space property (fixed values).
BLANKS = (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
LETTER, NUMBER, OTHER, BLANK = range(4)

# Letters and numbers of Unicode 16.0 that are younger than 15.1 (fixed values, first and last). The
# tokenizers' classes are those of 16.0, whatever the Python that runs this knows.
LETTERS_16 = (
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85),
    (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7),
    (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C),
    (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0))
NUMBERS_16 = (
    (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9),
    (0x1E5F1, 0x1E5FA))


@functools.cache
def kinds() -> np.ndarray:
    """LETTER, NUMBER, OTHER or BLANK of every code point."""
    of = {"L": LETTER, "N": NUMBER}
    table = np.fromiter((of.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    for first, last in LETTERS_16:
        table[first:last + 1] = LETTER
    for first, last in NUMBERS_16:
        table[first:last + 1] = NUMBER
    table[list(BLANKS)] = BLANK
    return table


@functools.cache
def lower() -> np.ndarray:
    """Code points of letters in lower case (where that is one code point); 0 for anything but letters."""
    table = np.zeros(0x110000, np.uint32)
    for c in np.flatnonzero(kinds() == LETTER).tolist():
        small = chr(c).lower()
        table[c] = ord(small) if len(small) == 1 else c
    return table


_HELD: dict[str, list] = {}


def held(owner: str):
    """Marks a cached function whose results are kept in a worker for ``owner``, until ``only`` lets them go."""
    def mark(f):
        _HELD.setdefault(owner, []).append(f)
        return f

    return mark


def only(*owners: str) -> None:
    """Let go of what a worker holds for others than these. Workers live on between stages, so the tables,
    models and caches of an earlier one would stand beside those of the next."""
    for owner, functions in _HELD.items():
        if owner not in owners:
            for f in functions:
                f.cache_clear()
    give_back()


def tidy(run):
    """``run`` over Arrow batches, which hands memory back before each batch it is given and at its end: a worker
    that waits for its next task, as those of an earlier step do, then holds little."""
    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch
                del batch
                give_back()

        yield from run(each())
        give_back()

    return tidied


def codepoints(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def chunks(texts: list[str], limit: int = CHUNK) -> Iterator[range]:
    """Ranges of neighbours with at most ``limit`` code points together, or one longer text."""
    start = size = 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > limit:
            yield range(start, i)
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield range(start, len(texts))


def slices(column: pa.Array, limit: int = CHUNK) -> Iterator[tuple[slice, list[str]]]:
    """(rows, their texts) of neighbours with at most ``limit`` bytes together, or one longer text; a
    null is an empty text. Only these texts are Python objects at a time."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    start = size = 0
    for i, own in enumerate(sizes.tolist()):
        if i > start and size + own > limit:
            yield slice(start, i), [t or "" for t in column.slice(start, i - start).to_pylist()]
            start, size = i, 0
        size += own
    if start < len(sizes):
        yield slice(start, len(sizes)), [t or "" for t in column.slice(start).to_pylist()]


def cut(batch: pa.RecordBatch, rows: slice) -> pa.RecordBatch:
    return batch.slice(rows.start, rows.stop - rows.start)


def give_back() -> None:
    """Hand freed memory back to the system. Workers live on between stages and their allocators keep
    what they once held, which on a shared machine is missing for others."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def runs(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each run, end to end."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if total < 1 << 30 and (not total or int(starts.max()) < 1 << 30) else np.int64  # half the memory to move
    return np.arange(total, dtype=kind) + np.repeat((starts - ends + lengths).astype(kind), lengths)
