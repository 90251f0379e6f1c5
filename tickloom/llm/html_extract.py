"""Main text of web pages: flat text blocks classified by a small decision tree.

A page is cut into blocks of text at block-level tags. A block is described by its
words and link density, those of its neighbours, and where it stands (inside the
page's article, outside of one that the page has, inside a navigation, form, sidebar
and the like). Article and main elements are the page's article if they hold most of
its words, or if no text is found outside. A decision tree, grown from the labelled table below, tells
text from boilerplate; the kept blocks are joined in page order.

Rows: a null page, an empty page and one without text give an empty text; rows are
kept one for one, repeats and null ids included; columns other than page_id, url and
html are left out. A page of any length is one row of a map; nothing is shuffled.
Markup that is never closed ends with its parent or with the page.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from html import unescape
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tickloom.llm.common import map_batches


class Block(NamedTuple):
    text: str
    words: int
    linked: int  # words inside links
    barred: bool  # inside navigation, forms, adverts, comments and the like
    inside: bool  # inside an article or main element
    heading: bool


INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark meter nobr output q rp rt ruby s "
    "samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Their content is not markup, so it is skipped up to the closing tag.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BARRED = frozenset(
    "nav footer aside form noscript template svg math select button fieldset dialog menu canvas audio video object datalist".split())
MAIN = frozenset({"article", "main"})
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
# Words of class and id names that mark what is not the article.
HINTS = frozenset(
    "ad ads advert adverts advertisement advertising adbox adsense banner breadcrumb breadcrumbs byline comment comments commentlist consent "
    "cookie cookies copyright disclaimer disqus footer gdpr legal login menu modal nav navbar navigation newsletter notice notices pager "
    "pagination paywall popup promo promoted promotion recommended related reply replies respond responses search share sharing sidebar "
    "signup skip social sponsor sponsored subscribe subscription tags teaser toolbar widget".split())
HEADER_HINTS = frozenset({"header", "masthead", "topbar"})
# Those of other texts, which may be longer than the article, and of what an article element can be instead.
OTHERS = frozenset(
    "ad ads advert adverts advertisement advertising adbox adsense comment comments commentlist consent cookie cookies disqus gdpr "
    "recommended related reply replies respond responses".split())
CARDS = OTHERS | frozenset("promo promoted promotion sponsor sponsored teaser".split())
# With hints these make a name as a whole a hint (share-bar, comment-body); any other word (with-sidebar, category-legal) makes it none.
PARTS = frozenset(
    "a and area bar block body bottom box button buttons card cards column container content form global group holder icons inner item items left "
    "line link links list main meta module news outer overlay page panel post posts primary right row secondary section site slot stories story "
    "text top unit us wrap wrapper".split())
ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
TAG = re.compile(r"""</?([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'">])*+)>""")
LOOSE_TAG = re.compile(r"</?([a-zA-Z][^\s/>]*)([^>]*)>")
NAME_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")


@lru_cache(maxsize=4096)
def attributes(raw: str) -> tuple[bool, frozenset[str], bool]:
    """Whether attributes bar an element, the hints in its names, whether it can be a link."""
    found = {}
    for m in ATTRIBUTE.finditer(raw):
        found.setdefault(m[1].lower(), next((v for v in m.groups()[1:] if v is not None), ""))
    hints: set[str] = set()
    for name in (found.get("class", "") + " " + found.get("id", "")).split():
        words = {w.lower() for w in NAME_WORDS.findall(name)}
        own = words & (HINTS | HEADER_HINTS)
        if own and words - own <= PARTS | {w for w in words if w.isdigit()}:
            hints |= own
    style = found.get("style", "").replace(" ", "").lower()
    barred = found.get("role", "").lower() in ROLES or "hidden" in found or "display:none" in style
    return barred, frozenset(hints), "href" in found


class Named(NamedTuple):
    """An element that its name may bar."""
    above: int  # the next one that it stands in, or -1
    inside: bool
    other: bool  # named as a text of its own beside the article


def barring(named: list[Named], mains: set[int], blocks: list[tuple[Block, int]]) -> list[bool]:
    """Whether each named element bars what stands in it.

    A name bars neither what holds a main element nor what holds most of the page's
    unlinked words and twice those that stand free, unless it stands beside an article
    with words; names of other texts (comments, consent) and what stands in them bar if
    anything else has words.
    """
    within: list[bool] = []  # in one with the name of another text
    for e in named:
        within.append(e.other or (e.above >= 0 and within[e.above]))
    held, main = [0] * len(named), [k in mains for k in range(len(named))]
    free = usual = others = article = 0
    for b, k in blocks:
        words = 0 if b.barred else b.words - b.linked
        if k < 0:
            free += 0 if b.heading else words
            article += words if b.inside else 0
        else:
            held[k] += words
        if k >= 0 and within[k]:
            others += words
        else:
            usual += words
    for k in range(len(named) - 1, -1, -1):
        above = named[k].above
        # The words of other texts do not speak for what they stand in.
        if above >= 0:
            main[above] |= main[k]
            held[above] += held[k] if within[k] == within[above] else 0
    out: list[bool] = []
    for k, e in enumerate(named):
        most = 2 * held[k] > others and not usual if within[k] else 2 * held[k] > usual and held[k] > 2 * free and (e.inside or not article)
        out.append(not (main[k] or most) or (e.above >= 0 and out[e.above]))
    return out


def blocks_of(html: str) -> list[Block]:
    """The text blocks of a page in page order."""
    out: list[tuple[Block, int]] = []
    named: list[Named] = []
    mains: set[int] = set()
    stack: list[tuple[str, bool, bool, bool, int]] = []  # name, barred, inside, link, last in named, each with what stands above
    open_: Counter[str] = Counter()  # of each name, how many stand in the stack
    parts: list[str] = []
    linked: list[str] = []
    heading = False

    def flush() -> None:
        nonlocal heading
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            if text:
                _, barred, inside, _, last = stack[-1] if stack else ("", False, False, False, -1)
                out.append((Block(text, text.count(" ") + 1, len(unescape("".join(linked)).split()), barred, inside, heading), last))
            parts.clear()
            linked.clear()
        heading = False

    at, end = 0, len(html)
    while at < end:
        cut = html.find("<", at)
        if cut < 0:
            cut = end
        if cut > at:
            parts.append(html[at:cut])
            if stack and stack[-1][3]:
                linked.append(html[at:cut])
        if cut == end:
            break
        if html.startswith("<!--", cut):
            # The shortest forms close at once; an open comment takes the rest.
            close = cut + 5 if html.startswith(">", cut + 4) else html.find("-->", cut + 2) + 3
            at = close if close > cut + 2 else end
            continue
        m = TAG.match(html, cut) or LOOSE_TAG.match(html, cut)
        if m is None:
            if html.startswith(("<!", "<?", "</"), cut):
                close = html.find(">", cut)
                at = close + 1 if close >= 0 else end
            elif cut + 1 < end and html[cut + 1].isascii() and html[cut + 1].isalpha():
                at = end  # a tag cut off by the end of the page
            else:
                parts.append("<")
                at = cut + 1
            continue
        name, at = m[1].lower(), m.end()
        closing = html[cut + 1] == "/"
        if name not in INLINE:
            flush()
        elif name in ("br", "img"):
            parts.append(" ")
        if closing:
            if open_[name]:
                while True:
                    last_name = stack.pop()[0]
                    open_[last_name] -= 1
                    if last_name == name:
                        break
            continue
        if name in RAW:
            close = re.compile(rf"</{name}\b[^>]*>?", re.I).search(html, at)
            at = close.end() if close else end
            continue
        if name in VOID:
            continue
        if name in ("p", "li", "a", "dt", "dd", "tr", "td", "th", "option") and any(x[0] == name for x in stack[-3:]):
            # Elements that end where the next of their kind begins, inline ones inside them too.
            k = next(k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == name)
            if all(x[0] in INLINE for x in stack[k + 1:]):
                open_.subtract(x[0] for x in stack[k:])
                del stack[k:]
        _, barred, inside, link, last = stack[-1] if stack else ("", False, False, False, -1)
        by_attribute, hints, href = attributes(m[2]) if m[2] else (False, frozenset(), False)
        if name not in ("html", "body"):
            # A header or a header-like name inside an article holds its title.
            barred = barred or name in BARRED or by_attribute or (not inside and name == "header")
            if hints and name != "main":
                hints &= CARDS if name == "article" else HINTS if inside else HINTS | HEADER_HINTS
                if hints:
                    named.append(Named(last, inside, bool(hints & OTHERS)))
                    last = len(named) - 1
            if name == "main" and not barred and last >= 0:
                mains.add(last)
        heading = heading or name in HEADINGS
        open_[name] += 1
        stack.append((name, barred, inside or name in MAIN, link or (name == "a" and href), last))
    flush()
    bars = barring(named, mains, out)
    return [b._replace(barred=True) if k >= 0 and bars[k] else b for b, k in out]


# --- The classifier -----------------------------------------------------------

FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "barred", "inside", "outside", "heading")

# One labelled block a row, in the order of FEATURES, then 1 for text and 0 for boilerplate.
# Links are densities; inside and outside tell where the block stands if the page has an article.
LABELLED = (
    # Articles: any length, linked words among others, headings, one-word paragraphs, neighbours of any kind.
    (1, 0, 0, 0, 40, 0, 0, 1, 0, 1, 1), (9, 0, 0, 0, 60, 0.02, 0, 1, 0, 1, 1), (6, 0, 6, 1, 2, 0, 0, 1, 0, 1, 1),
    (1, 0, 30, 0, 1, 0, 0, 1, 0, 0, 1), (2, 0, 1, 0, 1, 0, 0, 1, 0, 0, 1), (14, 0, 80, 0, 9, 0.1, 0, 1, 0, 0, 1),
    (55, 0.05, 9, 0, 70, 0, 0, 1, 0, 0, 1), (120, 0, 40, 0, 8, 0, 0, 1, 0, 0, 1), (30, 0.4, 60, 0, 25, 0.1, 0, 1, 0, 0, 1),
    (18, 0.2, 3, 1, 3, 1, 0, 1, 0, 0, 1), (5, 1, 50, 0, 45, 0, 0, 1, 0, 0, 1), (3, 0, 1, 0, 10, 1, 0, 1, 0, 0, 1),
    (7, 0.3, 7, 0.3, 7, 0.3, 0, 1, 0, 0, 1), (400, 0.01, 5, 0, 3, 1, 0, 1, 0, 0, 1), (80, 0.6, 60, 0, 50, 0, 0, 1, 0, 0, 1),
    (4, 0, 0, 0, 0, 0, 0, 1, 0, 0, 1), (1, 0, 1, 1, 1, 1, 0, 1, 0, 0, 1), (12, 0, 12, 0, 1, 1, 0, 1, 0, 1, 1),
    # Barred elements, inside articles and outside, whatever they hold.
    (1, 1, 1, 1, 1, 1, 1, 0, 1, 0, 0), (1, 1, 0, 0, 1, 1, 1, 0, 0, 0, 0), (9, 0, 1, 1, 9, 0, 1, 0, 1, 0, 0),
    (14, 0, 60, 0, 0, 0, 1, 0, 1, 0, 0), (45, 0, 80, 0, 30, 0, 1, 1, 0, 0, 0), (25, 0.1, 90, 0, 25, 0, 1, 1, 0, 0, 0),
    (6, 0, 25, 0, 6, 0, 1, 1, 0, 1, 0), (3, 0, 40, 0, 2, 0, 1, 1, 0, 0, 0), (70, 0, 40, 0, 60, 0, 1, 0, 0, 0, 0),
    (120, 0, 3, 0, 90, 0, 1, 0, 1, 0, 0), (2, 0, 2, 0, 2, 0, 1, 0, 0, 0, 0), (16, 0, 1, 0, 20, 0, 1, 0, 0, 1, 0),
    (200, 0.02, 60, 0, 200, 0, 1, 1, 0, 0, 0), (33, 0, 12, 0, 400, 0, 1, 0, 1, 0, 0),
    # Comments and teasers on pages whose text stands in no article.
    (45, 0, 80, 0, 30, 0, 1, 0, 0, 0, 0), (150, 0, 90, 0, 3, 0, 1, 0, 0, 0, 0), (20, 0.1, 40, 0, 60, 0, 1, 0, 0, 1, 0),
    # Beside an article.
    (3, 0, 0, 0, 1, 1, 0, 0, 1, 0, 0), (8, 0, 1, 1, 9, 0, 0, 0, 1, 0, 0), (30, 0, 1, 1, 60, 0, 0, 0, 1, 0, 0),
    (60, 0, 70, 0, 0, 0, 0, 0, 1, 0, 0), (6, 1, 6, 1, 6, 1, 0, 0, 1, 0, 0), (12, 0, 90, 0, 0, 0, 0, 0, 1, 1, 0),
    (110, 0.1, 10, 0, 20, 0, 0, 0, 1, 0, 0), (1, 0, 40, 0, 0, 0, 0, 0, 1, 0, 0),
    # Pages without such elements: long texts, and short ones among them.
    (60, 0, 9, 0, 80, 0, 0, 0, 0, 0, 1), (35, 0.05, 1, 1, 45, 0, 0, 0, 0, 0, 1), (120, 0.1, 60, 0, 3, 1, 0, 0, 0, 0, 1),
    (25, 0, 30, 0, 40, 0.1, 0, 0, 0, 0, 1), (22, 0.2, 2, 1, 2, 1, 0, 0, 0, 0, 1), (20, 0, 0, 0, 0, 0, 0, 0, 0, 0, 1),
    (12, 0, 70, 0, 55, 0, 0, 0, 0, 0, 1), (4, 0, 45, 0, 60, 0, 0, 0, 0, 0, 1), (8, 0, 3, 1, 70, 0, 0, 0, 0, 1, 1),
    (6, 0, 0, 0, 50, 0, 0, 0, 0, 1, 1), (7, 0, 40, 0, 35, 0, 0, 0, 0, 1, 1), (14, 0.1, 50, 0, 30, 0, 0, 0, 0, 0, 1),
    (3, 0, 30, 0, 28, 0, 0, 0, 0, 0, 1), (11, 0, 6, 0, 44, 0, 0, 0, 0, 0, 1), (10, 0, 60, 0, 1, 0, 0, 0, 0, 0, 1),
    (1, 0, 22, 0, 24, 0, 0, 0, 0, 0, 1), (2, 0, 18, 0, 20, 0, 0, 0, 0, 0, 1), (6, 0, 24, 0, 16, 0, 0, 0, 0, 0, 1), (3, 0, 16, 0, 18, 0, 0, 0, 0, 0, 1),
    # And their menus, lists of links, short lines at the ends.
    (1, 1, 1, 1, 1, 1, 0, 0, 0, 0, 0), (2, 1, 0, 0, 2, 1, 0, 0, 0, 0, 0), (5, 1, 5, 1, 40, 0, 0, 0, 0, 0, 0),
    (12, 0.9, 50, 0, 12, 0.9, 0, 0, 0, 0, 0), (40, 0.8, 60, 0, 30, 0.9, 0, 0, 0, 0, 0), (3, 0, 2, 1, 2, 1, 0, 0, 0, 0, 0),
    (4, 0, 1, 1, 3, 0, 0, 0, 0, 0, 0), (2, 0, 3, 0, 1, 0, 0, 0, 0, 0, 0), (6, 0.5, 60, 0, 0, 0, 0, 0, 0, 0, 0),
    (7, 0.4, 3, 1, 5, 0.5, 0, 0, 0, 0, 0), (8, 0, 4, 1, 2, 0, 0, 0, 0, 0, 0), (30, 0.7, 4, 1, 6, 1, 0, 0, 0, 0, 0),
    (5, 0, 2, 0, 0, 0, 0, 0, 0, 0, 0), (3, 0, 1, 0, 2, 1, 0, 0, 0, 1, 0), (9, 0.6, 2, 0, 60, 0, 0, 0, 0, 0, 0),
)

Tree = tuple | int


def grow(rows: list[tuple], least: int = 1) -> Tree:
    """A tree of (feature, bound, low, high); leaves are classes. Splits lower the Gini impurity most."""
    good = sum(r[-1] for r in rows)
    if good in (0, len(rows)):
        return int(good > 0)

    def impurity(part: list[tuple]) -> float:
        share = sum(r[-1] for r in part) / len(part)
        return len(part) * share * (1 - share)

    best = None
    for k in range(len(FEATURES)):
        values = sorted({r[k] for r in rows})
        for a, b in zip(values, values[1:]):
            low, high = [r for r in rows if r[k] <= a], [r for r in rows if r[k] > a]
            if min(len(low), len(high)) >= least:
                loss = impurity(low) + impurity(high)
                if best is None or loss < best[0] - 1e-12:
                    best = (loss, k, (a + b) / 2, low, high)
    if best is None:
        return int(2 * good > len(rows))
    _, k, bound, low, high = best
    return k, bound, grow(low, least), grow(high, least)


def decide(tree: Tree, features: tuple) -> int:
    while not isinstance(tree, int):
        k, bound, low, high = tree
        tree = low if features[k] <= bound else high
    return tree


def features_of(blocks: list[Block], article: bool) -> list[tuple]:
    """article: whether what stands inside article or main elements is the page's article."""
    size = [(b.words, b.linked / b.words) for b in blocks]
    ends = [(0, 0.0), *size, (0, 0.0)]
    return [
        (*ends[k + 1], *ends[k], *ends[k + 2], b.barred, article and b.inside, article and not b.inside, b.heading)
        for k, b in enumerate(blocks)
    ]


def kept_blocks(blocks: list[Block], tree: Tree) -> list[Block]:
    """The blocks that are text.

    Blocks inside that are not barred are the page's article if they hold most of the
    unlinked words that are not barred. With fewer they may be cards or comments: then
    they are the article only if no text is found outside.
    """
    def kept(article: bool) -> list[Block]:
        return [b for b, f in zip(blocks, features_of(blocks, article)) if decide(tree, f)]

    free = [b for b in blocks if not b.barred]
    if not any(b.inside for b in free):
        return kept(False)
    if 2 * sum(b.words - b.linked for b in free if b.inside) <= sum(b.words - b.linked for b in free):
        plain = kept(False)
        if not all(b.inside for b in plain):
            return plain
    return kept(True)


def main_text(html: str, tree: Tree) -> str:
    return " ".join(b.text for b in kept_blocks(blocks_of(html), tree))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url and the main text of every page."""
    tree = grow(list(LABELLED))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h, tree) if h else "" for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, type=pa.string())], ["page_id", "url", "text"])

    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    return map_batches(rows, step, "page_id bigint, url string, text string")
