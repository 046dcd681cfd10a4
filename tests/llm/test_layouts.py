"""Page layouts with their texts, written by hand."""

import pytest

from gridmill.llm import html

FIRST = "The river rose, slowly at first, and by noon it had reached the old bridge; nobody was surprised."
SECOND = "People moved their things upstairs, as they do, and waited. It fell again, by night."
STORY = f"<p>{FIRST}</p><p>{SECOND}</p>"
TEXT = f"{FIRST}\n{SECOND}"


@pytest.mark.parametrize("page, text", [
    (f"<main><div class=hint><p>Note this.</p></div><div class=story><h1>Flood</h1>{STORY}</div><div class=more><p>Soon: rain</p></div></main>", f"Flood\n{TEXT}"),
    (f"<main><ul><li><a href=x>One</a></li><li><a href=y>Two</a></li></ul><h1>Flood</h1>{STORY}</main>", f"Flood\n{TEXT}"),
    (f"<div role=main><h1>Flood</h1>{STORY}<div class=more><a href=x>One</a> <a href=y>Two</a></div></div>", f"Flood\n{TEXT}"),
    (f"<article><div class=a>{STORY}{STORY}</div><div class=b>{STORY}</div><ul><li>Milk</li><li>Eggs</li></ul></article>", f"{TEXT}\n{TEXT}\n{TEXT}\nMilk\nEggs"),
])
def test_ratios_count_in_articles(page, text):
    assert html.main_text(page) == text


@pytest.mark.parametrize("page, text", [
    (f"<div class=story>{STORY}</div><div id=comments><article><p>Nice, thanks.</p></article><article><p>I agree.</p></article></div>", TEXT),
    (f"<article><h1>Flood</h1>{STORY}</article><div class=related><article><p>Storm ahead.</p></article></div>", f"Flood\n{TEXT}"),
    (f"<div class=widget><article>{STORY}</article></div><p>Tel. 5</p>", TEXT),
    (f"<div class='layout has-sidebar'><h1>Flood</h1>{STORY}<div class=sidebar><p>See also.</p></div></div>", f"Flood\n{TEXT}"),
    (f"<div class='layout no-sidebar'>{STORY}</div>", TEXT),
    (f"<div class=search-results>{STORY}</div><div>Tel. 5</div>", TEXT),
    (f"<div class=story>{STORY}</div><div class=comments>{STORY * 9}</div>", TEXT),
    ("<div class=ad>Buy it, now, or later. Really.</div><article><p>Rain.</p></article>", "Rain."),
])
def test_names_lower_scores(page, text):
    assert html.main_text(page) == text


@pytest.mark.parametrize("bit, size", [
    ("<div>", 50_000), ("<div>a, b.", 25_000), ("<b>", 80_000), ("<b>x", 60_000), ("<!", 120_000), ('<a "', 60_000), ("<a x='", 40_000), ("<p><i>x", 35_000),
    ("<div class=comment>a.", 12_000), ("<article>a.", 22_000), ("<", 250_000), ("<a", 120_000), ("<!--", 60_000), ("</x>", 60_000)])
def test_time_grows_as_the_page_does(bit, size):
    """Four times the page takes about four times as long, not sixteen."""
    import time

    def seconds(n):
        started = time.process_time()
        html.main_text(f"{bit * n}<p>{FIRST}</p>")
        return time.process_time() - started

    seconds(100)
    assert seconds(size) < 8 * seconds(size // 4) + 0.5


def test_deep_pages_keep_their_text():
    deep = html.DEEPEST + 200
    assert html.main_text("<div>" * deep + STORY + "</div>" * deep) == TEXT
    assert html.main_text(f"<article>{'<b>' * deep}{FIRST}") == FIRST


def test_tags_without_an_end():
    assert html.main_text('a <b c="d <p>x') == 'a <b c="d\nx'
    assert html.main_text("<p>x <! y") == "x <! y"
    assert html.main_text("<p>x <!-- y") == "x"
