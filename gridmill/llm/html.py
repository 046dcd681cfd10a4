"""Main text of web pages by tag-path ratios.

A page is a sequence of text blocks, each with its root-to-leaf path of tags. Text length and
punctuation are summed per path and divided by the path's nodes; both ratios are smoothed along the
page, fused by their product, and paths above a threshold are content. Names of furniture (sidebar,
comments) lower a path's score. Content nodes vote for the element that holds the article, those in
article and main elements twice; every block in it is part of the text, however short, except lists of
links and boxes without a path above the threshold. Only furniture by tag, and what is hidden, is left
out before.
"""

from __future__ import annotations

import heapq
import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from gridmill.llm.arrays import cut, slices

TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/<>]*)((?:[^<>"']|"[^"]*"|'[^']*')*)>""")
PLAIN_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/<>]*)([^<>]*)>")
OPEN_QUOTES = 64  # tags that may end nowhere; then quotes hide no brackets any more, so that reading stays linear
NAMES = re.compile(r"""(class|id|role|style|aria-hidden|hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?(?=[\s/]|$)""", re.I)
SIGNS = re.compile(r"[.,;:!?…。，、！？]")

# Fixed values of HTML: elements by what they do to text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset("script style title noscript template svg math iframe object audio video canvas textarea select button datalist".split())
RAW = frozenset("script style title textarea iframe noscript template".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd label mark meter nobr "
                   "output progress q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "option": {"option"}}
SCOPES = frozenset("ul ol dl table body html article main section div".split())

FURNITURE_TAGS = frozenset("nav header footer aside form menu dialog".split())
FURNITURE_NAMES = frozenset(
    "nav navbar navigation menu menubar header masthead banner footer sidebar aside widget ad ads advert adverts advertisement "
    "sponsor sponsored promo promotion cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe signup "
    "breadcrumb breadcrumbs pagination pager share sharing social related recommended comment comments disqus respond reply "
    "discussion toolbar search login complementary contentinfo copyright legal skip".split())
ARTICLE_NAMES = frozenset("article main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
DEEPEST = 512  # elements in an element; what is opened deeper stands beside its parent, as browsers have it
WIDTH = 1  # neighbours on each side in smoothing
THRESHOLD = 0.3  # of the page's mean score
PENALTY = 0.03  # of a score, by names
PRIOR = 2  # votes of content in article and main elements
FEW = 0.03  # of the content: with less left, names are not believed
LAYOUT = frozenset("has no with without".split())  # has-sidebar tells of a page, not of a sidebar
BOXES = frozenset("div section article".split())


class Element:
    """``at`` counts elements of a page from the root, parents first; ``key`` numbers equal paths of tags and names."""

    __slots__ = ("tag", "parent", "by_name", "article", "depth", "at", "key", "inside", "dropped", "links", "hiding")

    def __init__(self, tag: str, attributes: str, parent: Element | None, at: int, keys: dict[tuple[int, str], int]):
        self.tag, self.parent, self.at = tag, parent, at
        self.depth = parent.depth + 1 if parent else 0
        names = {k.lower(): (v or "").strip("\"'").lower() for k, v in NAMES.findall(attributes)} if attributes.strip() else {}
        words = {w for k in ("class", "id", "role") if k in names for w in re.split(r"[\s_-]+", names[k])}
        label = tag + "".join(f".{w}" for w in sorted(words) if not w.isdigit())
        self.key = keys.setdefault((parent.key if parent else -1, label), len(keys))
        told = [re.split(r"[_-]+", w) for k in ("class", "id", "role") if k in names for w in names[k].split()]
        named = {w for own in told if own[0] not in LAYOUT for w in own}
        hidden = names.get("aria-hidden") == "true" or "hidden" in names or "display:none" in names.get("style", "").replace(" ", "")
        self.article = tag in ARTICLE_NAMES or names.get("role") in ARTICLE_NAMES
        held = parent is not None and parent.inside
        self.inside = held or self.article
        # an article's own header is its title, not the page's
        furniture = hidden or tag in FURNITURE_TAGS and not (tag == "header" and held)
        self.dropped = furniture or parent is not None and parent.dropped
        self.by_name = bool(named & FURNITURE_NAMES) and tag not in ("html", "body") and not (tag in HEADINGS or tag == "header" and held)
        self.links = (parent.links if parent else 0) + (tag == "a")
        self.hiding = (parent.hiding if parent else 0) + (tag in UNSEEN)


def blocks(page: str) -> tuple[list[tuple[Element, str, int]], list[Element]]:
    """(element, text, length of it in links) of each text block in page order, and all elements."""
    keys: dict[tuple[int, str], int] = {}
    root = Element("", "", None, 0, keys)
    top, out, elements = root, [], [root]
    pieces: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(pieces)).split())
        if text:
            out.append((owner, text, linked))
        pieces.clear()
        linked = 0

    owner, at, open_quotes, start = root, 0, 0, 0

    def say(text: str) -> None:
        nonlocal linked, owner
        if not text or top.hiding:
            return
        if not pieces and not text.isspace():
            owner = top
        if pieces or not text.isspace():
            pieces.append(text)
        if top.links:
            linked += len(text)

    while True:
        # ``at``: from where on text is unsaid; ``start``: from where on to look for a tag
        start = page.find("<", start)
        if start < 0:
            say(page[at:])
            break
        if page.startswith("<!--", start):
            end = page.find("-->", start + 4)
            say(page[at:start])
            at = start = end + 3 if end >= 0 else len(page)
            continue
        if page[start + 1:start + 2] in ("!", "?"):
            end = page.find(">", start)
            if end < 0:  # no tag ends any more
                say(page[at:])
                break
            say(page[at:start])
            at = start = end + 1
            continue
        m = (TAG if open_quotes < OPEN_QUOTES else PLAIN_TAG).match(page, start)
        if m is None:
            start += 1
            open_quotes += page[start:start + 1].isalpha()
            continue
        say(page[at:start])
        at = start = m.end()
        tag, closing, attributes = m.group(2).lower(), bool(m.group(1)), m.group(3)
        if tag not in INLINE:
            flush()
        if tag == "br":
            say(" ")
        if tag in VOID:
            continue
        if not closing:
            if tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(page, at)
                close = page.find(">", end.end()) if end else -1
                at = start = close + 1 if close >= 0 else len(page)
                continue
            if attributes.rstrip().endswith("/") and tag not in INLINE and tag in ("svg", "math"):
                continue
            ends = CLOSES.get(tag)
            if ends is None and tag not in INLINE:
                ends = {"p"}
            if ends:
                look = top
                while look.parent is not None and look.tag not in SCOPES and look.tag not in ends:
                    look = look.parent
                while look.tag in ends:
                    look = look.parent
                    top = look
            if top.depth >= DEEPEST:
                top = top.parent
            top = Element(tag, attributes, top, len(elements), keys)
            elements.append(top)
        else:
            look = top
            while look.parent is not None and look.tag != tag:
                look = look.parent
            if look.parent is not None:
                top = look.parent
    flush()
    return out, elements


def _upwards(elements: list[Element], own: np.ndarray) -> np.ndarray:
    """What each element and all in it have together."""
    total = own.copy()
    for e in reversed(elements[1:]):
        total[e.parent.at] += total[e.at]
    return total


def _downwards(elements: list[Element], own: list) -> list:
    """Of each element, whether it or one around it has it."""
    out = list(own)
    for e in elements[1:]:
        out[e.at] = out[e.parent.at] or out[e.at]
    return out


def _smooth(values: np.ndarray) -> np.ndarray:
    kernel = np.array([0.25, 0.5, 0.25])
    padded = np.pad(values, WIDTH, mode="edge")
    return np.convolve(padded, kernel, mode="valid")


def _trust(found: list[tuple[Element, str, int]], elements: list[Element], sizes: np.ndarray, content: np.ndarray) -> None:
    """Clear names that content speaks against: those around an article, main or page with its h1 that
    holds most of the content, and, while the names would leave next to none and no article, the outermost ones."""
    titled = _downwards(elements, [e.tag == "h1" for e in elements])
    places = np.array([e.at for e, _, _ in found])
    held = _upwards(elements, np.bincount(places, sizes * content, len(elements)))
    headed = _upwards(elements, np.bincount(places, [titled[i] for i in places.tolist()], len(elements)))
    total = float((sizes * content).sum())
    around = np.zeros(len(elements), bool)  # holds an article with most of the content
    for e in reversed(elements):
        most = 2 * held[e.at] > total
        if around[e.at] or most and not e.article and headed[e.at]:
            e.by_name = False
        if e.parent is not None and (around[e.at] or most and e.article):
            around[e.parent.at] = True
    # named elements as a tree: of each element the innermost name around it
    inner: list[Element | None] = [None] * len(elements)
    below: dict[Element | None, list[Element]] = {}
    for e in elements:
        over = inner[e.parent.at] if e.parent else None
        inner[e.at] = e if e.by_name else over
        if e.by_name and held[e.at] > 0:
            below.setdefault(over, []).append(e)
    free: dict[Element | None, float] = {}
    told: set[Element | None] = set()  # names that are the last around text in an article
    for (e, _, _), n, ok in zip(found, sizes.tolist(), content.tolist()):
        free[inner[e.at]] = free.get(inner[e.at], 0.0) + n * ok
        if e.inside:
            told.add(inner[e.at])
    left, cleared, outermost = 0.0, None, []
    while True:
        left += free.get(cleared, 0.0)
        for e in below.get(cleared, ()):
            heapq.heappush(outermost, (-held[e.at], e.depth, e.at))
        if cleared in told or not outermost or left > FEW * total:
            return
        cleared = elements[heapq.heappop(outermost)[2]]
        cleared.by_name = False


def main_text(page: str) -> str:
    """Blocks of the main text, one a line; an empty text if the page has none. Time grows as the page does."""
    found, elements = blocks(page)
    found = [x for x in found if not x[0].dropped]
    if not found:
        return ""
    sums: dict[int, list[float]] = {}
    for e, text, linked in found:
        own = sums.setdefault(e.key, [0, 0, 0, 0])
        own[0] += len(text)
        own[1] += len(SIGNS.findall(text))
        own[2] += min(linked, len(text))
        own[3] += 1
    sizes = np.array([len(text) for _, text, _ in found], float)
    places = np.array([e.at for e, _, _ in found])
    of = [sums[e.key] for e, _, _ in found]
    ratio = np.array([(x[0] - x[2]) / x[3] for x in of], float)
    signs = np.array([1 + x[1] / x[3] for x in of], float)
    alone = ratio * signs
    _trust(found, elements, sizes, alone >= THRESHOLD * alone.mean())
    named = _downwards(elements, [e.by_name for e in elements])
    weight = np.array([PENALTY if named[i] else 1 for i in places.tolist()])
    score = _smooth(ratio) * _smooth(signs) * weight
    least = THRESHOLD * np.average(score, weights=weight)
    # the deepest element with most of the content's text holds the article
    inside = np.array([e.inside for e, _, _ in found])
    own_votes = np.where(score >= least, weight * sizes * np.where(inside, PRIOR, 1), 0)
    votes, total = _upwards(elements, np.bincount(places, own_votes, len(elements))), float(own_votes.sum())
    voted = _upwards(elements, np.bincount(places, score >= least, len(elements)))
    holder = max((e for e in elements if voted[e.at] and votes[e.at] >= 0.7 * total and e.tag not in INLINE and e.tag != "p" and e.tag not in HEADINGS),
                 key=lambda e: (e.depth, -e.at), default=elements[0])
    # all sections of an article belong to it
    look = holder
    while look.parent is not None and not look.article:
        look = look.parent
    holder = look if look.article else holder
    # a box is judged by its own paths, not by neighbours that smoothing lends it
    full = _upwards(elements, np.bincount(places, alone * weight >= least, len(elements)))
    # of elements below the holder, what is between
    below = [False] * len(elements)
    box: list[Element | None] = [None] * len(elements)
    title, heading, called = list(below), list(below), list(below)
    for e in elements[holder.at + 1:]:
        up = e.parent.at
        if e.parent is holder or below[up]:
            below[e.at] = True
            box[e.at] = e if e.tag in BOXES else box[up]
            title[e.at], heading[e.at], called[e.at] = title[up] or e.tag == "h1", heading[up] or e.tag in HEADINGS, called[up] or e.by_name
    out = []
    for (e, text, _), s, x in zip(found, score, of):
        if e is not holder and not below[e.at]:
            continue
        own = box[e.at]
        # lists of links are menus, whatever they are called
        menu = x[2] > 0.6 * x[0] and len(text) < 80 and not heading[e.at]
        if title[e.at] or not menu and not (s < least and called[e.at]) and (own is None or full[own.at]):
            out.append(text)
    return "\n".join(out)


def extract(pages: DataFrame, column: str = "html") -> DataFrame:
    """All columns but the html, with text and n_chars (code points).

    A null or empty page has an empty text; broken markup is read as far as it goes. Other columns,
    nulls in them and repeated rows pass through; columns named text or n_chars are replaced.
    """
    schema = T.StructType([*(f for f in pages.schema.fields if f.name not in (column, "text", "n_chars")),
                           T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    carried = schema.names[:-2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, found in slices(batch.column(column)):
                texts, rows = [main_text(page) if page else "" for page in found], cut(batch, part)
                yield pa.RecordBatch.from_arrays(
                    [*(rows.column(c) for c in carried), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=schema.names)

    return pages.select(column, *carried).mapInArrow(run, schema)
