"""Token files against a tokenizers library that nothing is set on."""

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from tokenizers import Tokenizer

from gridmill.llm import queries

TEXTS = ["last <|endoftext|> x", "<|endoftext|>", "<|endoftext|><|endoftext|> a", "no <|endoftext| token", None, "", "end  <|endoftext|>\n\n  b"]


def test_query_with_special_tokens_in_texts(spark, tmp_path):
    library = Tokenizer.from_file(queries.BYTE_BPE)
    pq.write_table(pa.table({"doc_id": pa.array(range(len(TEXTS)), pa.int64()), "text": TEXTS}), tmp_path / "documents.parquet")
    ids = [np.array(library.encode(t or "", add_special_tokens=False).ids + [0], "<u4") for t in TEXTS]
    starts = np.cumsum([len(x) for x in ids]) - [len(x) for x in ids]
    assert 50256 in ids[0]
    got = sorted(map(tuple, queries.op6_token_file(spark, str(tmp_path)).collect()))
    assert got == [(i, int(s), len(x), zlib.crc32(x.tobytes())) for i, (s, x) in enumerate(zip(starts, ids))]
