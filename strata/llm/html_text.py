"""HTML extraction: flat text blocks classified by a small decision tree.

A page is read once into flat blocks: block-level tags end a block, inline
tags and line breaks do not, and scripts, styles, templates and comments hold
no text.  A block's features are the word count and link density of itself and
of its two neighbours, whether it is a heading, and whether it stands inside
containers that by tag, role, class or id announce an article or something
around it.  A decision tree (Gini, at most ``DEPTH`` levels) is trained on the
blocks of the small labelled pages below, in the driver, and sent to the
tasks; the main text is the blocks it accepts, in page order.  No shuffle.

Null and empty pages give an empty text.  Character references are decoded,
white space inside a block becomes one space, and unclosed or stray tags are
tolerated; an unterminated tag is text, an unterminated script or style runs
to the end, another element without text that is not closed hides only its tag.  Repeated rows are read row by row.  A null url stays null.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import slices

# Tags that end a block.
BLOCK_TAGS = frozenset("""address article aside blockquote body button caption center dd details dialog dir div dl dt
 fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hr html iframe legend li main menu nav
 ol optgroup option p pre section select summary table tbody td tfoot th thead title tr ul""".split())
# Containers whose beginning and end are tracked.
CONTAINERS = frozenset("""article aside body button details dialog div dl fieldset figure footer form head header html
 iframe main menu nav ol section select table title ul""".split())
# Elements whose content is not text.
RAW = "script|style|noscript|template|textarea|svg|iframe|object|canvas"
RAW_END = {name: re.compile(rf"</{name}\s*>", re.IGNORECASE) for name in RAW.split("|")}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
AROUND_TAGS = frozenset("nav aside footer form head header menu button select dialog fieldset title".split())
ARTICLE_TAGS = frozenset("article main".split())
# Words of class, id and role names.
AROUND_WORDS = frozenset("""ad ads advert advertisement advertising alert banner breadcrumb breadcrumbs comment comments
 complementary consent contentinfo cookie cookies dialog disqus disclaimer footer form gdpr header login masthead menu
 menubar modal nav navbar navigation newsletter notice notification popup promo promoted promotion recommended related
 replies reply respond search share sharing sidebar signup social sponsor sponsored subscribe subscription teaser
 toolbar widget""".split())
# Those of a page's layout, which also name what is around all of it.
LAYOUT_WORDS = frozenset("""alert banner breadcrumb breadcrumbs footer header login masthead menu menubar nav navbar
 navigation notice search share sharing sidebar social toolbar widget""".split())
ARTICLE_WORDS = frozenset("article articlebody body content entry main post story text".split())

# A start tag: quotes count only after an equals sign.
START = re.compile(r"<(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:=\s*+(?:\"[^\"]*+\"|'[^']*+')|[^>])*+)>")
TAG_NAME = re.compile(r"[a-zA-Z][a-zA-Z0-9:-]*")
# Block elements whose end tag may be missing, and which next
# ones end them.
IMPLIED = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}
TRACKED = CONTAINERS | frozenset("p li dt dd tr td th blockquote center pre summary dir address figcaption caption h1 h2 h3 h4 h5 h6".split())
NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.IGNORECASE)
WORDS = re.compile(r"[^\W_]+")


@dataclass
class Block:
    text: str
    words: int
    linked: int
    heading: bool
    around: bool
    article: bool


class Tags:
    """The tags and comments of a page, one after another."""

    def __init__(self, page: str) -> None:
        self.page, self.at, self.quotes, self.last = page, 0, True, page.rfind(">")

    def next(self) -> tuple[int, str, bool, str] | None:
        """(start, tag, closing, attributes), with ``at`` moved behind it; a
        comment or declaration has no tag.  A page is read once: where a tag's
        quotes leave it without an end, quotes no longer count on that page,
        and where no ``>`` follows, the rest is text."""
        page, start = self.page, self.at
        while (start := page.find("<", start)) >= 0:
            if page.startswith("<!--", start):
                end = page.find("-->", start + 4)
                self.at = end + 3 if end >= 0 else len(page)
                return start, "", False, ""
            if start < self.last:
                after = page[start + 1]
                if after in "!?/":
                    self.at = page.index(">", start) + 1
                    name = TAG_NAME.match(page, start + 2) if after == "/" else None
                    return start, name[0].lower() if name else "", bool(name), ""
                if name := TAG_NAME.match(page, start + 1):
                    m = START.match(page, start) if self.quotes else None
                    self.quotes = m is not None
                    self.at = m.end() if m else page.index(">", start) + 1
                    return start, name[0].lower(), False, page[name.end():self.at - 1]
            start += 1
        return None


def signs(tag: str, attrs: str) -> tuple[int, bool]:
    """How surely a container announces something around an article (0 not, 1
    by a name of the layout, 2 by another name or as a form, 3 by its tag or
    as hidden), and whether it announces an article."""
    if tag in ("html", "body"):
        return 0, False  # their classes describe the whole page
    # Names in words: split at signs and at changes of case.
    spoken = [[w for w in re.split(r"[^a-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", " ", name).lower()) if w]
              for m in NAMES.finditer(attrs) for name in (m[1] or m[2] or m[3] or "").split()] if attrs else []
    names = {w for name in spoken for w in name}
    if any(name and set(name) <= ARTICLE_WORDS for name in spoken) and tag in CONTAINERS:
        # Beside a name that is all the article's, others count by their last
        # word: "search-result" is no search form, "content-footer" a footer.
        names = {name[-1] for name in spoken if name}
    around = max(3 * (tag in AROUND_TAGS and tag != "form"), 3 * bool(attrs and HIDDEN.search(attrs)),
                 2 * (tag == "form" or bool(names & AROUND_WORDS - LAYOUT_WORDS)), int(bool(names & LAYOUT_WORDS)))
    return around, tag in ARTICLE_TAGS or (not around and tag in CONTAINERS and bool(names & ARTICLE_WORDS))


def blocks(page: str) -> list[Block]:
    """The non-empty text blocks of a page, in order."""
    found: list[Block] = []
    parts: list[tuple[str, bool]] = []
    stack: list[tuple[str, int, bool]] = []  # tag, around, article: with all above
    unclosed: set[str] = set()  # raw elements without a further end tag
    opened: Counter[str] = Counter()  # tags on the stack
    heading, links, at = "", 0, 0

    def pop() -> str:
        tag = stack.pop()[0]
        opened[tag] -= 1
        return tag

    def end() -> None:
        text = " ".join("".join(p for p, _ in parts).split())
        if text:
            linked = sum(len(p.split()) for p, a in parts if a)
            around, article = stack[-1][1:] if stack else (0, False)
            found.append(Block(text, len(text.split()), linked, bool(heading), around > 0, article))
        parts.clear()

    tags = Tags(page)
    while token := tags.next():
        start, tag, closing, attrs = token
        if start > at:
            parts.append((html.unescape(page[at:start]), links > 0))
        at = tags.at
        if not tag:
            continue
        if tag in RAW_END and not closing:
            if not (tag == "svg" and attrs.endswith("/")) and tag not in unclosed:
                stop = RAW_END[tag].search(page, at)
                if stop:
                    at = tags.at = stop.end()
                elif tag in ("script", "style"):
                    at = tags.at = len(page)
                else:
                    unclosed.add(tag)
            continue
        if tag in BLOCK_TAGS:
            end()
            links = 0  # an unclosed link ends with its block
            if tag in HEADINGS:
                heading = "" if closing else tag
            if tag in CONTAINERS:
                heading = ""
            if not closing:
                if stack and stack[-1][0] == "p":
                    pop()  # a paragraph ends where another block begins
                while stack and stack[-1][0] in IMPLIED.get(tag, ()):
                    pop()
            if tag in TRACKED:
                if not closing:
                    around, article = signs(tag, attrs)
                    above = stack[-1] if stack else ("", 0, False)
                    if tag == "header" and above[2]:
                        around = above[1]  # an article's own header holds its title
                    # The one main element of a page stands above wrappers'
                    # names and tags, an article element above their names, an
                    # article's name above names of the layout.
                    ends = 4 if tag == "main" else 0 if above[2] or not article else 3 if tag == "article" else 2
                    stack.append((tag, max(around, above[1] if above[1] >= ends else 0), article or above[2]))
                    opened[tag] += 1
                elif opened[tag]:
                    while pop() != tag:
                        pass
        elif tag == "a":
            links = 0 if closing else 1
        elif tag == "br":
            parts.append((" ", False))
    if at < len(page):
        parts.append((html.unescape(page[at:]), links > 0))
    end()
    return found


def features(page: list[Block]) -> np.ndarray:
    """One row per block: words and link density of the block before, the
    block and the block after, heading, around, article."""
    if not page:
        return np.zeros((0, 9))
    words = np.array([0, *(b.words for b in page), 0], float)
    linked = np.array([0, *(b.linked for b in page), 0], float)
    density = linked / np.maximum(words, 1)
    # 1 inside an article, -1 outside where the page has one, 0 without any.
    some = any(b.article for b in page)
    flags = np.array([(b.heading, b.around, b.article - (some and not b.article)) for b in page], float)
    return np.column_stack([words[:-2], density[:-2], words[1:-1], density[1:-1], words[2:], density[2:], flags])


# The labelled table: pages whose blocks are marked with a leading "+" (main
# text) or "-" (not).  Own sentences, written for this purpose.
LABELLED = (
    """<html><head><title>-Site news</title></head><body><nav><ul><li><a href="/">-Home</a></li><li><a href="/a">-About us</a>
    </li><li><a href="/b">-All stories</a></li></ul></nav><article><h1>+A harbour wakes up</h1><p>+The first boats leave before
    dawn, and the quay is loud with crates and ropes until the sun is over the breakwater.</p><p>+Then it is quiet.</p><h2>+Noon</h2>
    <p>+By noon only <a href="/gulls">the gulls</a> are left, and two men who mend the same net every day of the year.</p></article>
    <div><p>-More than forty readers wrote to us about the last issue, and the editors thank every one of them.</p></div>
    <aside><p>-Read next: ten walks along the coast that you should not miss this summer, with maps and times.</p></aside>
    <footer>-Copyright of the publisher, all pages</footer></body></html>""",
    """<body><div class="header"><a href="/">-The Daily Sample</a></div><div id="cookie-notice">-We use cookies to make this page work
    and to count our visitors; by reading on you agree to that.<button>-Accept</button></div><div class="content"><h1>+Bread
    without haste</h1><p>+Flour, water, salt and a night of waiting are all that a loaf needs, says the baker of our street.</p>
    <ul><li>+Weigh the flour.</li><li>+Add water slowly.</li></ul><blockquote>+Never hurry it.</blockquote></div>
    <div class="comments"><p>-Great article, I tried it yesterday and the whole family liked the bread very much indeed!</p><p>-Me too.</p>
    </div><form><p>-Write a comment</p></form><div class="ad">-Buy a new oven now and pay nothing until the end of next year.</div></body>""",
    """<body><table><tr><td><a href="/1">-One</a> <a href="/2">-Two</a> <a href="/3">Three</a></td></tr></table><p>+On the old road over
    the pass the snow lies until May, and the mail comes by sledge as it did a hundred years ago.</p><p>+The carrier is called
    Anna, and she knows each house, each dog and each drift between the bridge and the last farm in the valley.</p>
    <p>+She has never missed a day of work in all her thirty years on the road.</p><p><a href="/x">-More from this valley</a></p>
    <p><a href="/y">-Imprint</a> | <a href="/z">privacy</a></p></body>""",
    """<body><header><h1>-Portal</h1></header><div class="sidebar"><p>-Weather: it will rain on most days of the week, so take a coat
    and a good pair of boots with you.</p></div><main><header><h1>+What the clocks say</h1></header><p>+Yes.</p><p>+The tower
    clock is slow by four minutes, and nobody in town would have it any other way, for the train is late as well.</p>
    <div class="ad">-Watches for half the price</div><p>+It was always so.</p></main><div class="newsletter">-Get our letter every
    week in your inbox</div><div role="contentinfo">-About, terms, contact</div></body>""",
    """<body><p><a href="/h">-Home</a></p><div><h1>+Salt</h1><p>+Salt was money once, and the roads it took are still on the maps of
    three countries if you know where to look for them.</p><p>+The word salary keeps a trace of it, though scholars now
    doubt the story that soldiers were paid in it.</p></div><div><a href="/p">-Previous page</a> <a href="/n">Next page</a></div>
    <p>-Share</p><p><a href="/t">-Top of page</a></p></body>""",
    """<body><div id="menu"><ul><li><a href="/s">-Sport</a></li><li>-Culture</li></ul></div><article><p>+Short.</p><p>+<a href="/k">A
    linked line</a></p><p>+<a href="/k2">Sources and further reading of this piece</a></p><section class="related"><p>-Seven more texts
    on the same matter that our readers have liked, collected by the editors.</p></section><section id="comments"><p>-I do not
    agree with the author at all, and here is why: the whole thing was told quite differently in my time.</p></section></article>
    <div class="alert notice">-This page was moved; please change your bookmarks to the new address.</div></body>""",
    """<body><div class="wrapper has-sidebar"><article><h1>+The ferry</h1><p>+It crosses the river eleven times a day, and the ferryman
    knows by the hour who will be waiting on the other bank.</p><p>+He is never late.</p></article><div class="sidebar"><p>-Timetables,
    prices and a map of all the landings on the river can be found at the town office.</p></div></div></body>""",
    """<body><div class="page with-toolbar"><p><a href="/">-Start</a></p><div class="content"><h1>+Wool</h1><p>+A fleece is washed three
    times <svg class="i"/>before it is spun, and the water is never hotter than a hand can bear.</p><svg-icon></svg-icon><p>+Then it
    dries.</p></div><div class="comments"><div class="text">-My grandmother did it in the same way, and her wool was the best of
    all the valley.</div></div></div></body>""",
)
DEPTH = 6


def labelled_rows() -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the labelled pages' blocks."""
    xs, ys = [], []
    for page in LABELLED:
        found = blocks(page)
        xs.append(features(found))
        ys += [b.text[0] == "+" for b in found]
    return np.concatenate(xs), np.array(ys)


def grow(x: np.ndarray, y: np.ndarray, depth: int = DEPTH) -> tuple:
    """A decision tree: (label,) or (feature, cut, below, above), split where
    the Gini impurity falls most; ties go to the first feature and cut from
    the flags backwards."""
    rate = y.mean()
    if depth == 0 or rate in (0, 1):
        return (bool(rate >= 0.5),)
    best = None
    for f in reversed(range(x.shape[1])):
        values = np.unique(x[:, f])
        for cut in (values[:-1] + values[1:]) / 2:
            below = x[:, f] <= cut
            gini = sum(side.sum() * y[side].mean() * (1 - y[side].mean()) for side in (below, ~below))
            if best is None or gini < best[0] - 1e-12:
                best = (gini, f, float(cut))
    if best is None:
        return (bool(rate >= 0.5),)
    below = x[:, best[1]] <= best[2]
    return best[1], best[2], grow(x[below], y[below], depth - 1), grow(x[~below], y[~below], depth - 1)


def train() -> tuple:
    return grow(*labelled_rows())


def accepts(tree: tuple, row: np.ndarray) -> bool:
    while len(tree) > 1:
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree[0]


def main_text(page: str, tree: tuple) -> str:
    found = blocks(page)
    return "\n".join(b.text for b, row in zip(found, features(found), strict=True) if accepts(tree, row))


def extract(pages: DataFrame, tree: tuple | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    tree = tree or train()
    pages = pages.select("page_id", "url", "html")
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, _, _ in slices(batch, "html"):
                texts = [main_text(page or "", tree) for page in rows.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                    names=["page_id", "url", "text", "n_chars"])

    return pages.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars bigint")
