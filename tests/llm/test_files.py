"""Token files against the tokenizers library, and page text."""

import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from gridmill.llm import html, queries, tokenfile


@pytest.fixture(scope="module")
def library():
    found = Tokenizer.from_file(queries.BYTE_BPE)
    found.encode_special_tokens = True
    return found


def want(library, rows):
    ids = [np.array(library.encode(t or "", add_special_tokens=False).ids + [0], "<u4") for _, t in rows]
    starts = np.cumsum([len(x) for x in ids]) - [len(x) for x in ids]
    return [(d, int(s), len(x), zlib.crc32(x.tobytes())) for (d, _), s, x in zip(rows, starts, ids)]


def test_query(spark, data, library):
    rows = [tuple(r) for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()]
    got = sorted(map(tuple, queries.op6_token_file(spark, data).collect()))
    assert got == want(library, rows)


def test_parts_records_and_single_documents(spark, tmp_path, library, monkeypatch):
    monkeypatch.setattr(tokenfile, "PART_TOKENS", 60)
    rows = [(i, None if i == 3 else " word" * (i % 5) + f" n{i}" * i) for i in range(40)] + [(41, "same"), (41, "same")]
    docs = spark.createDataFrame([*rows[::-1], (None, "last <|endoftext|>")], "doc_id long, text string")
    tokenfile.write(docs, str(tmp_path / "s"), queries.BYTE_BPE)
    got = tokenfile.read(spark, str(tmp_path / "s")).drop("ids").orderBy("start").collect()
    assert [tuple(r) for r in got] == want(library, [*rows, (None, "last <|endoftext|>")])
    some = tokenfile.fetch(spark, str(tmp_path / "s"), [5, 20]).collect()
    assert {r.doc_id: zlib.crc32(r.ids) for r in some} == {d: c for d, _, _, c in want(library, rows) if d in (5, 20)}
    tokenfile.write(docs.limit(0), str(tmp_path / "e"), queries.BYTE_BPE)
    assert tokenfile.read(spark, str(tmp_path / "e")).count() == 0


PAGE = """<html><head><title>T</title><script>var a="</p>";</script></head><body class="has-sidebar"><header><a href=/>Home</a></header>
<div class="cookie-notice">We use cookies.</div><div class="wrap"><div class="post"><h1>A &amp; B</h1><p>First   words,
of a <b>long</b> story; it goes on, and on.<p>Second&nbsp;one, with more of it. It ends.</p><p>Short.</p><form>Name <input></form></div>
<div class="sidebar"><p>See also, and more of this.</p></div><ul><li><a href=x>One link</a></li><li><a href=y>Two links</a></li></ul></div>
<div id="comments"><p>I liked it, really, a lot. Thanks!</p></div><footer>(c)</footer></body></html>"""


@pytest.mark.parametrize("page, text", [
    (PAGE, "A & B\nFirst words, of a long story; it goes on, and on.\nSecond one, with more of it. It ends.\nShort."),
    ("<body><nav>Menu</nav><article><h1>T</h1><p><b>x.<br><p>y<!-- no --></article><aside>z</aside>", "T\nx.\ny"),
    ("<p>only &lt;text&gt;", "only <text>"), ("plain text", "plain text"), ("<script>x", ""), ("", ""), ("<", "<"), ("<nav>a</nav>", ""),
])
def test_main_text(page, text):
    assert html.main_text(page) == text


def test_pages(spark, data):
    out = html.extract(spark.createDataFrame([(1, None, "u"), (2, "<p>é</p>", None), (2, "<p>é</p>", None)], "page_id int, html string, text string"))
    assert [tuple(r) for r in out.collect()] == [(1, "", 0), (2, "é", 1), (2, "é", 1)]
    got = queries.op3_tag_path_text(spark, data).collect()
    assert len(got) == spark.read.parquet(f"{data}/pages.parquet").count() and all(len(r.text) == r.n_chars > 0 for r in got)
