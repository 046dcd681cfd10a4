"""Byte-level BPE: encode whole texts by a table of ranks, and decode ids back to bytes.

Texts are cut into pieces without a regular expression. Each code point becomes a symbol (its class,
with up to two code points of look-ahead folded in); each symbol is a transition function over the
eight states of a small automaton; composing functions is associative, so the state at every code
point comes from a blocked prefix scan over table look-ups. The pieces are hashed by their first and
last bytes, long ones from prefix sums, each distinct piece is merged once and kept in a bounded cache,
and the ids of all pieces are then gathered by index. Offsets of ids are kept, so that any range of ids can be traced to its bytes.
"""

from __future__ import annotations

import base64
import functools
import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from gridmill.llm.arrays import BLANK, CHUNK, OTHER, chunks, codepoints, cut, give_back, held, kinds, only, runs, slices

# States: what the code point before belongs to. ONE and TWO: a short form with as many letters to go.
FRESH, LETTERS, NUMBERS, OTHERS, SPACE, BLANKS, ONE, TWO = range(8)
# Symbols: letter, number, other, apostrophe before one or two letters of a short form, space,
# other white space, both as the last before something else, end of a text.
S_LETTER, S_NUMBER, S_OTHER, S_QUOTE1, S_QUOTE2, S_SPACE, S_BLANK, S_LAST_SPACE, S_LAST_BLANK, S_END = range(10)

# The short forms that the pattern sets apart.
SHORT1, SHORT2 = "stmd", ("re", "ve", "ll")


def _next(state: int, symbol: int) -> int:
    if symbol == S_LETTER:
        return {TWO: ONE, ONE: FRESH}.get(state, LETTERS)
    if symbol in (S_QUOTE1, S_QUOTE2):
        joined = state in (OTHERS, SPACE, ONE, TWO)
        return OTHERS if joined else (ONE if symbol == S_QUOTE1 else TWO)
    return {S_NUMBER: NUMBERS, S_OTHER: OTHERS, S_SPACE: SPACE, S_BLANK: BLANKS,
            S_LAST_SPACE: SPACE, S_LAST_BLANK: BLANKS, S_END: FRESH}[symbol]


def _starts(state: int, symbol: int) -> bool:
    """Does a piece start at this symbol?"""
    if state == FRESH or symbol == S_END:
        return True
    if state in (ONE, TWO):
        return False
    if symbol in (S_LAST_SPACE, S_LAST_BLANK):
        return True
    if symbol in (S_SPACE, S_BLANK):
        return state not in (SPACE, BLANKS)
    own = {S_LETTER: LETTERS, S_NUMBER: NUMBERS}.get(symbol, OTHERS)
    return state not in (own, SPACE)


@functools.cache
def _automaton() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All compositions of transition functions: (of symbols, products, values, piece starts)."""
    single = [tuple(_next(s, x) for s in range(8)) for x in range(10)]
    found = {f: i for i, f in enumerate(dict.fromkeys(single))}
    queue = list(found)
    for f in queue:
        for g in single:
            h = tuple(g[s] for s in f)
            if h not in found:
                found[h] = len(found)
                queue.append(h)
    functions = list(found)
    products = np.array([[found[tuple(g[s] for s in f)] for g in functions] for f in functions], np.uint16)
    begins = np.array([[_starts(s, x) for x in range(10)] for s in range(8)])
    return np.array([found[f] for f in single], np.uint16), products.ravel(), np.array(functions, np.uint8), begins


def _scan(f: np.ndarray, width: int = 64) -> np.ndarray:
    """Inclusive products of transition functions: columns of a block one by one, all blocks at once."""
    _, products, values, _ = _automaton()
    count, n = np.uint16(len(values)), len(f)
    if n <= width:
        out = f.copy()
        for i in range(1, n):
            out[i] = products[out[i - 1] * count + f[i]]
        return out
    rows = -(-n // width)
    block = np.zeros(rows * width, np.uint16)
    block[:n] = f
    block = np.ascontiguousarray(block.reshape(rows, width).T)
    for j in range(1, width):
        block[j] = products[block[j - 1] * count + block[j]]
    before = _scan(block[-1], width)[:-1]
    block[:, 1:] = products[before * count + block[:, 1:]]
    return block.T.ravel()[:n]


@functools.cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Symbol of every code point without look-ahead; does a piece start at a symbol, by the function up to it."""
    _, _, values, begins = _automaton()
    # class -> symbol: letters, numbers and others keep their number, white space moves up
    symbols = kinds().copy()
    symbols[symbols == BLANK] = S_BLANK
    symbols[0x20] = S_SPACE
    return symbols, begins[values[:, FRESH]].ravel()


def piece_starts(points: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Indexes at which pieces start; ``ends`` are those of the separators, one after each text."""
    of_symbol, begins = _automaton()[0], _tables()[1]
    symbols = _tables()[0][points]
    symbols[ends] = S_END
    at = np.flatnonzero((symbols == S_SPACE) | (symbols == S_BLANK))
    quotes = np.flatnonzero(points == 0x27)
    quotes = quotes[symbols[quotes] == OTHER]
    if len(quotes):
        padded = np.concatenate([points[:], np.zeros(2, np.uint32)])
        padded[ends] = 0
        one, two = padded[quotes + 1], padded[quotes + 2]
        short = np.isin(one, [ord(c) for c in SHORT1])
        pair = np.zeros(len(quotes), bool)
        for a, b in SHORT2:
            pair |= (one == ord(a)) & (two == ord(b))
        symbols[quotes[short]] = S_QUOTE1
        symbols[quotes[pair]] = S_QUOTE2
    symbols[at[symbols[at + 1] < S_SPACE]] += S_LAST_SPACE - S_SPACE
    before = np.empty(len(symbols), np.uint16)
    before[0], before[1:] = of_symbol[S_END], _scan(of_symbol[symbols])[:-1]  # the end of a text leads to FRESH
    return np.flatnonzero(begins[before * np.uint16(10) + symbols])


# --- pieces of many texts -------------------------------------------------------------------------

FACTOR = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64


@held("bpe")
@functools.lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    def rising(x: int) -> np.ndarray:
        out = np.full(n, x, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    codes = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64)
    return codes, rising(FACTOR), rising(pow(FACTOR, -1, 2**64))


WORDS = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93)  # odd: of a slice's first and last bytes and its length


def edges(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first eight bytes, last eight if there are more, a hash of both and the length) of slices, zeros after
    shorter ones. With its length, the first two are all of a slice of at most 16 bytes."""
    lengths = ends - starts
    padded = np.append(data, np.zeros(8, np.uint8))
    eight = np.ndarray(len(data) + 1, np.uint64, padded, strides=(1,))  # the eight bytes from each position
    masks = np.frombuffer(np.tri(9, 8, -1, np.uint8) * np.uint8(255), np.uint64)
    low = eight[starts] & masks[np.minimum(lengths, 8)]
    high = np.where(lengths > 8, eight[np.maximum(ends - 8, 0)], np.uint64(0))
    a, b, c = map(np.uint64, WORDS)
    return low, high, low * a + high * b + lengths.astype(np.uint64) * c


def distinct(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the equal slice, index of a first slice of each number), exactly.

    Slices are told apart by a hash of their first and last eight bytes and their length, and where these
    are not all, of the whole slice from prefix sums. Then each is compared with the first of its number,
    and if any differed the bytes themselves would decide.
    """
    import pandas as pd

    lengths = ends - starts
    low, high, keys = edges(data, starts, ends)
    long = np.flatnonzero(lengths > 16)
    own = data[runs(starts[long], lengths[long])]  # their bytes end to end
    stop = np.cumsum(lengths[long])
    start = stop - lengths[long]
    if len(long):
        codes, up, down = _powers(1 << max(16, int(len(own) + 1).bit_length()))
        total = np.zeros(len(own) + 1, np.uint64)
        np.cumsum(codes[own] * up[: len(own)], out=total[1:])
        keys[long] += (total[stop] - total[start]) * down[start]
    number, _ = pd.factorize(keys)
    first = np.zeros(int(number.max()) + 1 if len(number) else 0, np.int64)
    first[number[::-1]] = np.arange(len(number))[::-1]
    model = first[number]
    same = all(bool((x[model] == x).all()) for x in (lengths, low, high))
    if same and len(long):
        same = bool((own == data[runs(starts[model[long]], lengths[long])]).all())
    if not same:
        raw = data.tobytes()
        number, _ = pd.factorize(np.array([raw[a:b] for a, b in zip(starts, ends)], object))
        first = np.zeros(int(number.max()) + 1, np.int64)
        first[number[::-1]] = np.arange(len(number))[::-1]
    return number, first


# ids of pieces, little-endian, 32 bits each
Encoder = Callable[[list[bytes]], list[bytes]]


SLOTS, INLINE = 1 << 19, 8  # slots: a power of two


class Cache:
    """Ids of pieces, kept up to a number of pieces; ``encode`` gets the unknown ones.

    Two halves: when the newer one is full it becomes the older one, and pieces met again move back.
    So frequent pieces stay whatever passes by. Short pieces met lately also stand in slots of arrays, where
    all slices of a text are looked up at once.
    """

    def __init__(self, encode: Encoder, most: int = 1 << 18):
        self.encode, self.most, self.known, self.older = encode, most, {}, {}
        # lately met pieces of at most 16 bytes and INLINE ids, one in a slot: (first bytes, last bytes, length, ids, number of them)
        self.slots = [np.zeros(SLOTS, np.uint64), np.zeros(SLOTS, np.uint64), np.zeros(SLOTS, np.int64), np.zeros((SLOTS, INLINE), np.uint32), np.zeros(SLOTS, np.int64)]

    def ids(self, pieces: list[bytes]) -> list[bytes]:
        out = list(map(self.known.get, pieces))
        missing = [i for i, x in enumerate(out) if x is None]
        asked = [pieces[i] for i in missing]
        found = list(map(self.older.get, asked))
        new = [j for j, x in enumerate(found) if x is None]
        for j, x in zip(new, self.encode([asked[j] for j in new])):
            found[j] = x
        for i, x in zip(missing, found):
            out[i] = x
        if len(self.known) + len(found) > self.most // 2:
            self.older, self.known = self.known, {}
        self.known.update(zip(asked, found))
        for p in asked:
            if len(p) > 64:
                self.known.pop(p, None)
        return out

    def of_slices(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of distinct slices end to end, how many each has)."""
        low, high, lengths, inline, counts = self.slots
        first, last, keys = edges(data, starts, ends)
        size, slot = ends - starts, (keys >> np.uint64(64 - SLOTS.bit_length() + 1)).astype(np.int64)
        met = (low[slot] == first) & (high[slot] == last) & (lengths[slot] == size)
        there, new = np.flatnonzero(met), np.flatnonzero(~met)
        raw = data.tobytes()
        found = self.ids([raw[a:b] for a, b in zip(starts[new].tolist(), ends[new].tolist())])
        sizes = counts[slot]
        sizes[new] = np.fromiter(map(len, found), np.int64, len(found)) // 4
        at = np.cumsum(sizes) - sizes
        out = np.empty(int(sizes.sum()), np.uint32)
        out[runs(at[there], sizes[there])] = inline[slot[there]][np.arange(INLINE) < sizes[there, None]]
        out[runs(at[new], sizes[new])] = np.frombuffer(b"".join(found), "<u4")
        kept = new[(size[new] <= 16) & (size[new] > 0) & (sizes[new] <= INLINE)]
        kept = kept[np.unique(slot[kept], return_index=True)[1]]
        own = np.zeros((len(kept), INLINE), np.uint32)
        own[np.arange(INLINE) < sizes[kept, None]] = out[runs(at[kept], sizes[kept])]
        for table, x in zip(self.slots, (first[kept], last[kept], size[kept], own, sizes[kept])):
            table[slot[kept]] = x
        return out, sizes


def encode_texts(texts: list[str], cache: Cache) -> list[np.ndarray]:
    """Ids (uint32) of each text."""
    out: list[np.ndarray] = []
    for part in chunks(texts):
        if len(part) == 1 and len(texts[part[0]]) > CHUNK:
            out.append(np.concatenate([np.zeros(0, np.uint32), *_long(texts[part[0]], cache)]))
        else:
            out += _together([texts[i] for i in part], cache)
    return out


def _together(texts: list[str], cache: Cache) -> list[np.ndarray]:
    joined = "\n".join([*texts, ""])
    ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    points = codepoints(joined)
    starts = piece_starts(points, ends)
    ids, counts = _pieces(joined, points, starts, ends, cache)
    # pieces of a text: those between the separators around it
    upto = np.concatenate([[0], np.cumsum(counts)])
    cuts = upto[np.searchsorted(starts, np.concatenate([[0], ends + 1]))]
    return [ids[a:b] for a, b in zip(cuts[:-1], cuts[1:])]


def _pieces(joined: str, points: np.ndarray, starts: np.ndarray, skip: np.ndarray, cache: Cache):
    """Ids of all pieces end to end, and how many each has; none for the separators in ``skip``."""
    data = np.frombuffer(joined.encode("utf-8", "surrogatepass"), np.uint8)
    at = np.append(starts, len(points))
    if len(data) != len(points):
        at = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))[at]  # where a code point's bytes start
    counts = np.zeros(len(starts), np.int64)
    real = np.ones(len(starts), bool)
    real[np.searchsorted(starts, skip)] = False  # a separator is a piece
    begin, end = at[:-1][real], at[1:][real]
    if not len(begin):
        return np.zeros(0, np.uint32), counts
    number, first = distinct(data, begin, end)
    flat, sizes = cache.of_slices(data, begin[first], end[first])
    each = sizes[number]
    counts[real] = each
    return flat[runs((np.cumsum(sizes) - sizes)[number], each)], counts


def _long(text: str, cache: Cache) -> Iterator[np.ndarray]:
    """A long text window by window. A window ends where a piece starts, far enough from its end
    for the look-ahead; from there the automaton starts fresh."""
    start, size = 0, CHUNK
    while start < len(text):
        window = text[start:start + size] + "\n"
        last = start + size >= len(text)
        points = codepoints(window)
        end = np.array([len(points) - 1])
        starts = piece_starts(points, end)
        if not last:
            inner = starts[starts < len(points) - 4]
            if len(inner) < 2:
                size *= 2
                continue
            window, points = window[:inner[-1]], points[:inner[-1]]
            starts, end = inner[:-1], np.zeros(0, np.int64)
        yield _pieces(window, points, starts, end, cache)[0]
        start, size = start + (size if last else len(window)), CHUNK


# --- ranks ----------------------------------------------------------------------------------------


@held("bpe")
@functools.lru_cache(maxsize=4)
def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a piece: the neighbours of lowest rank, the first of equals, merge until none has a rank."""
    if piece in ranks:
        return [ranks[piece]]
    n = len(piece)
    after, before, width = list(range(1, n + 1)), list(range(-1, n)), [1] * n

    def pair(i: int):
        j = after[i]
        return ranks.get(piece[i:j + width[j]]) if j < n else None

    heap = [(r, i, 2) for i in range(n - 1) if (r := pair(i)) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, size = heapq.heappop(heap)
        j = after[i] if width[i] else n
        if j >= n or width[i] + width[j] != size:
            continue  # one of the two has merged since
        width[i], width[j] = size, 0
        after[i] = k = after[j]
        if k < n:
            before[k] = i
        for left in (before[i], i):
            if left >= 0 and (r := pair(left)) is not None:
                heapq.heappush(heap, (r, left, width[left] + width[after[left]]))
    return [ranks[piece[i:i + w]] for i, w in enumerate(width) if w]


class Merger:
    """Ids of many pieces at once. Each round merges one pair in every piece that still has one."""

    LONGEST = 64  # longer pieces merge one by one
    NEVER = np.int64(1) << 30

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        keys = np.array(sorted(pairs), np.int64)
        self.keys = np.append(keys, np.iinfo(np.int64).max)
        self.of = np.append(np.array([pairs[k] for k in keys.tolist()], np.int64), self.NEVER)
        self.bytes = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.first = self._lookup(np.repeat(self.bytes, 256), np.tile(self.bytes, 256))

    def _lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.of[at], self.NEVER)

    def __call__(self, pieces: list[bytes]) -> list[bytes]:
        out: list = [None] * len(pieces)
        batch = []
        for i, piece in enumerate(pieces):
            rank = self.ranks.get(piece)
            if rank is not None:
                out[i] = rank.to_bytes(4, "little")
            elif len(piece) > self.LONGEST:
                out[i] = np.array(merge(piece, self.ranks), "<u4").tobytes()
            else:
                batch.append(i)
        if batch:
            self._rounds([pieces[i] for i in batch], np.array(batch), out)
        return out

    def _rounds(self, pieces: list[bytes], owner: np.ndarray, out: list) -> None:
        """``owner``: where in ``out`` the ids of each piece go."""
        data = np.frombuffer(b"".join(pieces), np.uint8)
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        ids = self.bytes[data]
        ranks = np.full(len(ids), self.NEVER)  # of the pair that starts here
        ranks[:-1] = self.first[data[:-1].astype(np.int64) << 8 | data[1:]]
        ranks[np.cumsum(sizes) - 1] = self.NEVER
        while len(owner):
            ends = np.cumsum(sizes)
            starts = ends - sizes
            best = np.minimum.reduceat(ranks << 32 | np.arange(len(ranks)), starts)
            going = best >> 32 < self.NEVER
            if not going.all():
                done = np.flatnonzero(~going)
                flat = ids[runs(starts[done], sizes[done])].astype("<u4").tobytes()
                stop = 0
                for where, size in zip(owner[done].tolist(), (4 * sizes[done]).tolist()):
                    out[where] = flat[stop:stop + size]
                    stop += size
            at = best[going] & 0xFFFFFFFF
            ids[at] = best[going] >> 32
            keep = np.repeat(going, sizes)
            keep[at + 1] = False
            last = np.isin(at + 2, ends[going], assume_unique=True)
            # the pairs on both sides of what has merged
            right = at[~last]
            ranks[at[last]] = self.NEVER
            ranks[right] = self._lookup(ids[right], ids[right + 2])
            left = at[at > starts[going]]
            ranks[left - 1] = self._lookup(ids[left - 1], ids[left])
            ids, ranks, owner, sizes = ids[keep], ranks[keep], owner[going], sizes[going] - 1


class Vocabulary:
    """Bytes of ids, as one array with offsets."""

    def __init__(self, ranks: dict[bytes, int]):
        size = max(ranks.values()) + 1
        of = [b""] * size
        for token, rank in ranks.items():
            of[rank] = token
        self.lengths = np.array([len(t) for t in of], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.data = np.frombuffer(b"".join(of), np.uint8)

    def decode(self, ids: np.ndarray) -> bytes:
        return self.data[runs(self.starts[ids], self.lengths[ids])].tobytes()

    def offsets(self, ids: np.ndarray) -> np.ndarray:
        """The byte after each id."""
        return np.cumsum(self.lengths[ids])


@held("bpe")
@functools.lru_cache(maxsize=2)
def codec(path: str) -> tuple[Cache, Vocabulary]:
    """One per Python worker, kept between tasks."""
    ranks = load_ranks(path)
    return Cache(Merger(ranks)), Vocabulary(ranks)


OUTPUTS = {"ids": T.BinaryType(), "ends": T.BinaryType(), "decoded": T.BinaryType()}


def encode(docs: DataFrame, ranks_path: str, keep: tuple[str, ...] = ("ids", "ends"), text: str = "text") -> DataFrame:
    """All columns of ``docs`` but the text, and the columns named in ``keep``.

    ``ids``: the ids as little-endian unsigned 32-bit integers; ``ends``: for each id the offset of
    the byte after it, as little-endian unsigned 64-bit integers; ``decoded``: the bytes that the ids
    decode to. A null text is an empty one and gives empty values. Other columns, nulls in them and
    repeated rows pass through; columns named like an output are replaced. ``ranks_path`` must be
    readable on every executor.
    """
    carried = [f for f in docs.schema.fields if f.name != text and f.name not in keep]
    schema = T.StructType([*carried, *(T.StructField(k, OUTPUTS[k]) for k in keep)])
    names = [f.name for f in carried]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only("bpe")
        cache, vocabulary = codec(ranks_path)
        for batch in batches:
            for part, texts in slices(batch.column(text)):
                found = encode_texts(texts, cache)
                made = {
                    "ids": lambda: [x.tobytes() for x in found],
                    "ends": lambda: [vocabulary.offsets(x).astype("<u8").tobytes() for x in found],
                    "decoded": lambda: [vocabulary.decode(x) for x in found],
                }
                rows = cut(batch, part)
                yield pa.RecordBatch.from_arrays(
                    [*(rows.column(c) for c in names), *(pa.array(made[k](), pa.binary()) for k in keep)],
                    names=[*names, *keep])
                del texts, found, made
            del batch
            give_back()

    return docs.select(text, *names).mapInArrow(run, schema)


def decode(encoded: DataFrame, ranks_path: str, ids: str = "ids") -> DataFrame:
    """All columns, and ``decoded``: the bytes of the ids (null ids: none). The inverse of ``encode``."""
    schema = T.StructType([*(f for f in encoded.schema.fields if f.name != "decoded"), T.StructField("decoded", T.BinaryType())])
    names = schema.names[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, vocabulary = codec(ranks_path)
        for batch in batches:
            texts = [vocabulary.decode(np.frombuffer(x or b"", "<u4")) for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(texts, pa.binary())], names=schema.names)

    return encoded.select(*names).mapInArrow(run, schema)
