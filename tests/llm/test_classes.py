"""Classes of code points are those of both libraries, and so are ids around each younger letter."""

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Regex, Tokenizer, pre_tokenizers

from gridmill.llm import bpe, queries, tokenfile
from gridmill.llm.arrays import BLANK, LETTER, LETTERS_16, NUMBER, NUMBERS_16, kinds

EVERY = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
CLASSES = [(r"\p{L}", LETTER), (r"\p{N}", NUMBER), (r"\s", BLANK)]


@pytest.mark.parametrize("pattern, kind", CLASSES)
def test_classes_of_tiktoken(pattern, kind):
    raw = tiktoken.Encoding("bytes", pat_str=pattern, mergeable_ranks={bytes([b]): b for b in range(256)}, special_tokens={})
    found = bytes(raw.encode_ordinary("".join(map(chr, EVERY)))).decode()
    assert sorted(map(ord, found)) == np.flatnonzero(kinds() == kind).tolist()


@pytest.mark.parametrize("pattern, kind", CLASSES)
def test_classes_of_tokenizers(pattern, kind):
    cut = pre_tokenizers.Split(Regex(pattern), "removed")
    left = {ord(c) for a in range(0, len(EVERY), 4096) for t, _ in cut.pre_tokenize_str("".join(map(chr, EVERY[a:a + 4096]))) for c in t}
    assert sorted(set(EVERY) - left) == np.flatnonzero(kinds() == kind).tolist()


def test_ids_around_younger_code_points():
    some = [chr(c) for a, b in (*LETTERS_16, *NUMBERS_16) for c in {a, (a + b) // 2, b}] + ["a", "1", "!", " ", " ", "\x00"]
    texts = [x + c + y for c in some for x in ("a", "1", "!", " ", "\U000135d8", "\x00") for y in ("b", "2", "?", "덄", " z", "'s")]
    ranks = bpe.load_ranks(queries.MULTI_RANKS)
    theirs = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert [x.tolist() for x in bpe.encode_texts(texts, bpe.codec(queries.MULTI_RANKS)[0])] == [theirs.encode_ordinary(t) for t in texts]
    library = Tokenizer.from_file(queries.BYTE_BPE)
    ours = tokenfile.encode_with(texts, *tokenfile.encoder(queries.BYTE_BPE))
    assert [x.tolist() for x in ours] == [library.encode(t, add_special_tokens=False).ids for t in texts]
