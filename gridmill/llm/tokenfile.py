"""Token ids in files: each document compressed by itself with a shared zstandard dictionary.

A store is a folder with two Parquet tables. ``dictionary`` holds the dictionary, its SHA-256 and the
width of an id. ``shards`` holds records of neighbouring documents in id order: the dictionary's hash,
the ids and token counts of its documents, where it starts in its part of the id range, the offset of each compressed document, and the compressed
documents end to end. One document is read by finding its record (smallest and largest id are columns,
so Parquet skips the others) and decompressing its own few bytes.
"""

from __future__ import annotations

import functools
import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridmill.llm.arrays import cut, give_back, held, only, slices
from gridmill.llm.bpe import Cache, encode_texts
from gridmill.llm.steps import written

SAMPLE, SAMPLE_BYTES = 1024, 1 << 15  # documents to train on, and bytes of each, at most
DICTIONARY_BYTES = 1 << 16
LEVEL = 3
CALL, TEXTS = 1 << 6, 1 << 4  # pieces joined to a text for the library, and texts given to it at once
SEPARATOR = "\x00"
SLICE = 1 << 18  # bytes of text that are encoded at a time, about
RECORD_BYTES = 1 << 18  # compressed documents in a record, about
PART_TOKENS, MOST_PARTS = 1 << 23, 1 << 16  # ids in a part of the id range, about; parts at most, then they grow
LAST = 2**63 - 1  # where rows without an id stand in the order


@held("tokenfile")
@functools.lru_cache(maxsize=2)
def encoder(path: str) -> tuple[Cache, dict]:
    """Ids by the tokenizers library, and its added tokens (string: id, special). Its merges never cross the
    pieces that texts are cut into, so each distinct piece is encoded once by the library and kept. Added
    tokens are cut out of texts before that. One per Python worker.

    The library gets many pieces as one text, in which a separator is a piece of its own: what it returns
    for a text is far larger than the ids, and costs more than the merges of a piece.
    """
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer, pre_tokenizers

    library = Tokenizer.from_file(path)
    library.encode_special_tokens = True  # what comes here is ordinary text
    added = library.get_added_tokens_decoder()
    if any(t.single_word or t.lstrip or t.rstrip for t in added.values()):
        raise ValueError("added tokens that take their surroundings into account are not supported")
    if library.normalizer is not None or not str(library.pre_tokenizer).startswith("ByteLevel(add_prefix_space=False"):
        raise ValueError("only vocabularies over the bytes of unchanged texts are supported")
    library.pre_tokenizer = pre_tokenizers.Sequence([
        pre_tokenizers.Split(SEPARATOR, "isolated"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    between = library.encode(SEPARATOR, add_special_tokens=False).ids
    if len(between) != 1:
        raise ValueError("the separator is not one id")

    def joined(pieces: list[str]) -> list[bytes]:
        out = []
        texts = [SEPARATOR.join(pieces[i:i + CALL]) for i in range(0, len(pieces), CALL)]
        for i in range(0, len(texts), TEXTS):
            for found in library.encode_batch_fast(texts[i:i + TEXTS], add_special_tokens=False):
                ids = np.array(found.ids, "<u4")
                ends, raw = 4 * np.flatnonzero(ids == between[0]), ids.tobytes()
                out += [raw[a:b] for a, b in zip([0, *(ends + 4).tolist()], [*ends.tolist(), len(raw)])]
        return out

    @functools.cache
    def plain() -> Tokenizer:
        own = Tokenizer.from_file(path)
        own.encode_special_tokens = True
        return own

    def encode(pieces: list[bytes]) -> list[bytes]:
        texts = [p.decode("utf-8", "surrogatepass") for p in pieces]
        usual = [SEPARATOR not in t for t in texts]
        found = iter(joined([t for t, x in zip(texts, usual) if x]))
        return [next(found) if x else np.array(plain().encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t, x in zip(texts, usual)]

    return Cache(encode, most=1 << 20), {t.content: (i, t.special) for i, t in added.items()}


def encode_with(texts: list[str], cache: Cache, own: dict[str, int]) -> list[np.ndarray]:
    """Ids of each text, where the strings in ``own`` have ids of their own: the leftmost first, of those the longest."""
    found = re.compile("|".join(map(re.escape, sorted(own, key=len, reverse=True)))) if own else None
    marked = [i for i, t in enumerate(texts) if found and found.search(t)]
    if not marked:
        return encode_texts(texts, cache)
    cuts = {i: [(m.start(), m.end()) for m in found.finditer(texts[i])] for i in marked}
    between, of = [], []
    for i, text in enumerate(texts):
        for a, b in zip([0, *(e for _, e in cuts.get(i, []))], [*(s for s, _ in cuts.get(i, [])), len(text)]):
            between.append(text[a:b])
            of.append(i)
    out: list[list[np.ndarray]] = [[] for _ in texts]
    for i, ids in zip(of, encode_texts(between, cache)):
        if out[i]:
            a, b = cuts[i][len(out[i]) // 2]
            out[i].append(np.array([own[texts[i][a:b]]], np.uint32))
        out[i].append(ids)
    return [x[0] if len(x) == 1 else np.concatenate(x) for x in out]


def encoded(batches: Iterator[pa.RecordBatch], path: str, end: int, special: bool) -> Iterator[tuple[pa.Array, list[np.ndarray]]]:
    """(first column, ids of the texts in the second, each followed by ``end``), some rows at a time."""
    only("tokenfile")
    cache, added = encoder(path)
    own = {text: i for text, (i, is_special) in added.items() if special or not is_special}
    for batch in batches:
        for part, texts in slices(batch.column(1), SLICE):
            yield cut(batch, part).column(0), [np.append(x, np.uint32(end)) for x in encode_with(texts, cache, own)]
        del batch
        give_back()


def _ordered(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("ord"), "text")


def train(docs: DataFrame, path: str, end: int, special: bool) -> bytes:
    """A dictionary from a bounded sample of documents, the first by a hash of the id. If these are too few
    or too short to train on, it is empty, and documents are compressed without one."""
    chosen = docs.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE).distinct()
    some = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, ids in encoded(batches, path, end, special):
            yield pa.RecordBatch.from_arrays([pa.array([x.astype("<u2").tobytes()[:SAMPLE_BYTES] for x in ids], pa.binary())], names=["ids"])

    samples = sorted(bytes(r.ids) for r in _ordered(some).mapInArrow(run, "ids binary").collect())[:SAMPLE]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:  # too little to train on
        return b""


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if data else None


def write(docs: DataFrame, folder: str, path: str, end: int = 0, special: bool = False) -> None:
    """Write the token ids of every document to a new store in ``folder``, in ascending order of id.

    A null text is an empty one: its ids are just ``end``. Rows without an id come last; rows of one id
    stand next to each other, by their number of ids and a hash of what they hold. Ids must fit 16 bits,
    as those of the vocabulary do. ``path`` must be readable on every executor. With ``special``, the
    strings of special tokens in a text become their ids, as the library does unless told otherwise;
    else they are ordinary text.

    The compressed documents are a table before they are dealt out by range, so each text is encoded
    once, and a lost executor costs its own share only. Ranges are over id, size, hash and a random
    number that the table holds, so rows of one id, or without one, are split like any others. A record
    ends when it is full, so long documents do not make it grow.
    """
    spark = docs.sparkSession
    raw = train(docs, path, end, special)
    digest = hashlib.sha256(raw).hexdigest()
    spark.createDataFrame([(digest, bytearray(raw), 2)], "hash string, dictionary binary, width int").coalesce(1).write.parquet(f"{folder}/dictionary")

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(raw), write_content_size=True)
        for ords, ids in encoded(batches, path, end, special):
            if any(x.max() >= 1 << 16 for x in ids):
                raise ValueError("an id does not fit 16 bits")
            yield pa.RecordBatch.from_arrays(
                [ords, pa.array([len(x) for x in ids], pa.int64()),
                 pa.array([squeeze.compress(x.astype("<u2").tobytes()) for x in ids], pa.binary())], names=["ord", "tokens", "frame"])

    frames = written(spark, lambda: _ordered(docs).mapInArrow(compress, "ord long, tokens long, frame binary").withColumns(
        {"hash": F.xxhash64("frame"), "salt": F.rand(17)}))
    total = frames.agg(F.sum("tokens")).first()[0] or 0
    parts = min(MOST_PARTS, max(1, -(-total // PART_TOKENS)))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only()
        part, number, held_rows, size, start = TaskContext.get().partitionId(), 0, [], 0, 0

        def record() -> pa.RecordBatch:
            frames = [f for _, _, f in held_rows]
            ends = np.cumsum([len(f) for f in frames])
            return pa.RecordBatch.from_pylist([{
                "part": part, "record": number, "hash": digest, "low": held_rows[0][0], "high": held_rows[-1][0], "start": start,
                "total": sum(n for _, n, _ in held_rows), "ids": [i for i, _, _ in held_rows], "tokens": [n for _, n, _ in held_rows],
                "offsets": [0, *ends.tolist()], "data": b"".join(frames)}], schema)

        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                for i, n, frame in zip(*(batch.column(c).slice(at, 64).to_pylist() for c in range(3))):
                    if held_rows and size >= RECORD_BYTES:
                        yield record()
                        start += sum(n for _, n, _ in held_rows)
                        held_rows, size, number = [], 0, number + 1
                    held_rows.append((i, n, frame))
                    size += len(frame)
        if held_rows:
            yield record()

    schema = pa.schema([("part", pa.int32()), ("record", pa.int32()), ("hash", pa.string()), ("low", pa.int64()), ("high", pa.int64()), ("start", pa.int64()), ("total", pa.int64()),
                        ("ids", pa.list_(pa.int64())), ("tokens", pa.list_(pa.int64())), ("offsets", pa.list_(pa.int64())), ("data", pa.binary())])
    order = ("ord", "tokens", "hash", "salt")
    frames.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("ord", "tokens", "frame").mapInArrow(
        pack, "part int, record int, hash string, low long, high long, start long, total long, ids array<long>, tokens array<long>, offsets array<long>, data binary"
    ).write.parquet(f"{folder}/shards")


def _open(spark: SparkSession, folder: str) -> tuple[str, bytes]:
    row = spark.read.parquet(f"{folder}/dictionary").first()
    data = bytes(row.dictionary)
    if hashlib.sha256(data).hexdigest() != row.hash:
        raise ValueError("the dictionary is damaged")
    return row.hash, data


def _reader(digest: str, data: bytes):
    expand = zstandard.ZstdDecompressor(dict_data=_dictionary(data))

    def ids(frame: bytes, used: str) -> np.ndarray:
        if used != digest:
            raise ValueError("a record was written with another dictionary")
        return np.frombuffer(expand.decompress(frame), "<u2").astype("<u4")

    return ids


def read(spark: SparkSession, folder: str, ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, ids) of every document, from the files alone.

    ``start`` counts the ids of all documents before it; ``ids`` is little-endian, 32 bits each, and
    null if not asked for.
    """
    digest, data = _open(spark, folder)
    shards = spark.read.parquet(f"{folder}/shards")
    # a record knows its start inside its part; starts of parts come from one row per part, of which there
    # are MOST_PARTS at most (16 bytes each), so they are broadcast
    totals = shards.groupBy("part").agg(F.sum("total").alias("size"))
    before = totals.select(F.col("part").alias("p"), (F.sum("size").over(Window.orderBy("part")) - F.col("size")).alias("before"))
    rows = shards.join(F.broadcast(before), F.expr("part = p")).select(
        (F.col("before") + F.col("start")).alias("base"), "hash", "ids", "tokens", "offsets", "data")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only()  # a worker that has written before needs its pieces no more
        expand = _reader(digest, data)
        for batch in batches:
            for row in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):
                frames = [expand(row["data"][a:b], row["hash"]) for a, b in zip(row["offsets"], row["offsets"][1:])]
                tokens = np.array(row["tokens"], np.int64)
                if [len(f) for f in frames] != row["tokens"]:
                    raise ValueError("a record is damaged")
                raw = [f.tobytes() for f in frames]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([None if i == LAST else i for i in row["ids"]], pa.int64()), pa.array(row["base"] + np.cumsum(tokens) - tokens),
                     pa.array(tokens), pa.array([zlib.crc32(x) for x in raw], pa.int64()), pa.array(raw if ids else [None] * len(raw), pa.binary())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"])

    return rows.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary")


def fetch(spark: SparkSession, folder: str, doc_ids: list[int]) -> DataFrame:
    """(doc_id, ids) of some documents: only their records are read, only their bytes decompressed."""
    digest, data = _open(spark, folder)
    wanted = sorted(set(doc_ids))
    near = functools.reduce(lambda a, b: a | b, [(F.col("low") <= i) & (F.col("high") >= i) for i in wanted], F.lit(False))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand, some = _reader(digest, data), set(wanted)
        for batch in batches:
            for row in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):
                at = [i for i, d in enumerate(row["ids"]) if d in some]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["ids"][i] for i in at], pa.int64()),
                     pa.array([expand(row["data"][row["offsets"][i]:row["offsets"][i + 1]], row["hash"]).tobytes() for i in at], pa.binary())],
                    names=["doc_id", "ids"])

    return spark.read.parquet(f"{folder}/shards").where(near).select("ids", "offsets", "data", "hash").mapInArrow(run, "doc_id long, ids binary")
