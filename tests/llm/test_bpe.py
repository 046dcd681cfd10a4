"""Byte-level BPE against tiktoken, and round trips."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from gridmill.llm import bpe, queries

RANKS = bpe.load_ranks(queries.MULTI_RANKS)
THEIRS = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
BITS = ["'", "s", "t", "re", "ve", "ll", "d", "m", " ", "  ", "\n", "\t", "a", "Z", "é", "1", "²", "日本", "!", "...",
        "'s", "　", "\x1c", "​", "😀", "á", "\r\n", "S", "xxx", "\x00", "\x85", "﻿"]


def texts(n, longest, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(BITS) for _ in range(rng.randint(0, longest))) for _ in range(n)]


@pytest.mark.parametrize("alone", [True, False])
def test_ids_are_those_of_the_library(alone):
    many = texts(3000, 14, 1)
    cache, _ = bpe.codec(queries.MULTI_RANKS)
    found = [bpe.encode_texts([t], cache)[0] for t in many] if alone else bpe.encode_texts(many, cache)
    assert [x.tolist() for x in found] == [THEIRS.encode_ordinary(t) for t in many]


def test_windows_of_long_texts(monkeypatch):
    monkeypatch.setattr(bpe, "CHUNK", 50)
    many = [*texts(200, 400, 2), "a" * 3000, " " * 700 + "x", "x'" * 300]
    found = bpe.encode_texts(many, bpe.codec(queries.MULTI_RANKS)[0])
    assert [x.tolist() for x in found] == [THEIRS.encode_ordinary(t) for t in many]


def test_long_pieces_merge_alike():
    rng = random.Random(3)
    for n in (1, 2, 63, 64, 65, 500):
        piece = bytes(rng.choice(b"thenio\xc3\xa9") for _ in range(n))
        assert bpe.merge(piece, RANKS) == np.frombuffer(bpe.Merger(RANKS)([piece])[0], "<u4").tolist()


def test_equal_hashes_do_not_join_slices(monkeypatch):
    zero = np.zeros(256, np.uint64)
    monkeypatch.setattr(bpe, "_powers", lambda n: (zero, np.ones(n, np.uint64), np.ones(n, np.uint64)))
    data = np.frombuffer(b"abcabd", np.uint8)
    number, first = bpe.distinct(data, np.array([0, 3, 0]), np.array([3, 6, 3]))
    assert number.tolist() == [0, 1, 0] and first.tolist() == [0, 1]


def test_frame(spark):
    rows = [(1, "the cat's here", "x"), (2, None, None), (None, "", "y"), (1, "the cat's here", "x"), (3, "é" * 9, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = bpe.encode(docs, queries.MULTI_RANKS, keep=("ids", "ends", "decoded"))
    assert out.columns == ["doc_id", "ids", "ends", "decoded"]
    for (doc_id, text, _), r in zip(rows, out.collect()):
        assert (r.doc_id, bytes(r.decoded)) == (doc_id, (text or "").encode())
        ids, ends = np.frombuffer(r.ids, "<u4").tolist(), np.frombuffer(r.ends, "<u8").tolist()
        assert ids == THEIRS.encode_ordinary(text or "") and ends == np.cumsum([len(THEIRS.decode_single_token_bytes(i)) for i in ids]).tolist()
    back = bpe.decode(out.drop("decoded"), queries.MULTI_RANKS).collect()
    assert [bytes(r.decoded) for r in back] == [(t or "").encode() for _, t, _ in rows]
    assert bpe.encode(docs.limit(0), queries.MULTI_RANKS).count() == 0


def test_query(spark, data):
    want = {}
    for r in spark.read.parquet(f"{data}/documents.parquet").collect():
        ids = THEIRS.encode_ordinary(r.text or "")
        want[r.doc_id] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest())
    got = {r[0]: tuple(r)[1:] for r in queries.op1_byte_bpe(spark, data).collect()}
    assert got == want
