"""Main text of web pages by tag-path ratios."""

from __future__ import annotations

import html as references
import re
from collections import Counter
from heapq import heapify, heappop, heappush
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ledgerlens.llm.common import computed, table

# quotes count after an equals sign only; whatever is not closed runs to the end, so no place is looked at twice
TAG = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)"
    r"""(?P<rest>(?:[^>=]++|=\s*+"[^"]*+(?:"|\Z)|=\s*+'[^']*+(?:'|\Z)|=)*+)(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)""",
    re.S,
)
NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
HIDDEN = re.compile(r"""(?:^|\s)hidden(?=[\s=/]|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)

#: Fixed values of the markup language.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title iframe noembed noframes xmp".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr output q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
BLOCKS = set("p h1 h2 h3 h4 h5 h6 li dt dd td th caption figcaption pre blockquote address summary legend".split())
CLOSES = {"li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr", "table"), "td": ("td th", "table tr"), "th": ("td th", "table tr"), "option": ("option", "select")}
CLOSES = {k: (set(a.split()), set(b.split())) for k, (a, b) in CLOSES.items()}
#: elements that never hold the article; forms, and words in the class, id or role of elements, that say they do not
ASIDE_TAGS = set("head nav footer aside noscript template svg math canvas object select button dialog menu datalist audio video map".split())
ASIDE_WORDS = set(
    """ad ads adbox adslot advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs byline-share colophon comment comments
    commentlist complementary consent contentinfo cookie cookies cookiebar copyright dialog disqus footer footnav gdpr hidden masthead menu menubar
    modal nav navbar navigation newsletter notice notices notification pager pagination popup promo promoted promotion recommended
    related reply replies respond search share sharing sidebar sidenav signup skip social sponsor sponsored subscribe subscription tabs teaser
    toolbar topbar widget widgets""".split()
)
MAIN_WORDS = {"main"}
PUNCTUATION = re.compile(r"[.,;:!?…。，、؟]")


class Node(NamedTuple):
    """A piece of text: its path of tags from the root, the element around it, the list item and the element with a
    name that speaks against it around it by number (0 for none), and if a block starts with it."""

    text: str
    path: int
    element: int
    aside: bool
    linked: bool
    item: int
    doubt: int
    breaks: bool


class Element(NamedTuple):
    """An open element; `holder` is the innermost one that may hold blocks, itself included."""

    tag: str
    path: int
    holder: int
    aside: bool
    item: int
    doubt: int


class Page:
    """The texts of a page in order. Elements that may hold blocks are numbered as they open, 0 for the page itself."""

    def __init__(self, page: str) -> None:
        self.nodes: list[Node] = []
        self.parents = [0]
        self.landmarks: set[int] = set()
        self._paths: dict[tuple[int, str], int] = {}
        self._stack = [Element("", 0, 0, False, 0, 0)]
        self._open: Counter[str] = Counter()
        self._landmarks_open: list[int] = []
        self._breaks = True
        self._items = 0
        self.doubts = [0]  # of each element whose name speaks against it: the next such one around it
        self.articles: dict[int, int] = {}  # of each landmark: the doubt about it
        self._read(page)

    def _text(self, raw: str) -> None:
        if raw:
            top = self._stack[-1]
            text = references.unescape(raw) if "&" in raw else raw
            self.nodes.append(Node(text, top.path, top.holder, top.aside, self._open["a"] > 0, top.item, top.doubt, self._breaks))
            if not raw.isspace():
                self._breaks = False

    def _close(self, depth: int) -> None:
        for e in self._stack[depth:]:
            self._open[e.tag] -= 1
            if self._landmarks_open and self._landmarks_open[-1] == e.holder and e.tag not in INLINE and e.tag not in BLOCKS:
                self._landmarks_open.pop()
        del self._stack[depth:]

    def _close_up_to(self, names: set[str], stop: set[str]) -> None:
        if any(self._open[n] for n in names):
            for i in range(len(self._stack) - 1, 0, -1):
                if self._stack[i].tag in names:
                    return self._close(i)
                if self._stack[i].tag in stop:
                    return None
        return None

    def _close_paragraph(self) -> None:
        i = len(self._stack) - 1
        while i > 0 and self._stack[i].tag in INLINE:
            i -= 1
        if self._stack[i].tag == "p":
            self._close(i)

    def _start(self, name: str, rest: str) -> None:
        if name in CLOSES:
            self._close_up_to(*CLOSES[name])
        elif name not in INLINE:
            self._close_paragraph()
        if rest.endswith("/") and name in ("svg", "math"):
            return
        top = self._stack[-1]
        words = {w for v in NAMED.findall(rest) for w in re.split(r"[\s_-]+", "".join(v).lower())} if rest else set()
        aside = top.aside or name in ASIDE_TAGS or (name == "header" and not self._landmarks_open)
        aside = aside or bool(rest and HIDDEN.search(rest))
        doubt = top.doubt
        named = name not in ("html", "body") and bool(words & ASIDE_WORDS)
        if not aside and (name == "form" or named):
            doubt = len(self.doubts)
            self.doubts.append(top.doubt)
        holder = top.holder
        if name not in INLINE and name not in BLOCKS:
            holder = len(self.parents)
            self.parents.append(top.holder)
            if not aside and (name in ("article", "main") or (name in ("div", "section") and words & MAIN_WORDS)):
                self.landmarks.add(holder)
                if name == "main" or not named:
                    self.articles[holder] = doubt
                self._landmarks_open.append(holder)
        path = self._paths.setdefault((top.path, name), len(self._paths) + 1)
        self._items += name == "li"
        self._stack.append(Element(name, path, holder, aside, self._items if name == "li" else top.item, doubt))
        self._open[name] += 1

    def _read(self, page: str) -> None:
        at = 0
        for m in iter(lambda: TAG.search(page, at), None):
            self._text(page[at : m.start()])
            at = m.end()
            if m["cdata"]:
                self._text(m["cdata"])
            if not m["name"]:
                continue
            name = m["name"].lower()
            self._breaks |= name not in INLINE
            if m["end"]:
                if self._open[name]:
                    depth = len(self._stack) - 1
                    while self._stack[depth].tag != name:
                        depth -= 1
                    self._close(depth)
            elif name in RAW and not m["rest"].endswith("/"):
                end = re.compile(rf"</{name}(?=[\s/>])", re.I).search(page, at)
                at = end.start() if end else len(page)
            elif name not in VOID and name not in RAW:
                self._start(name, m["rest"])
        self._text(page[at:])


def ratios(found: list[Node], strength: float, radius: int = 2) -> np.ndarray:
    """A score for each node: how much text, and how much of it punctuated, a node of its path has on average, fused
    with the same smoothed over the nodes around it. Nodes beside the article score nothing. Sure are those that score
    `strength` standard deviations or more."""
    lengths = np.array([0 if n.aside else len(n.text.strip()) for n in found], float)
    marks = np.array([0 if n.aside else len(PUNCTUATION.findall(n.text)) for n in found], float)
    _, of = np.unique([n.path for n in found], return_inverse=True)
    times = np.maximum(1, np.bincount(of, lengths > 0))
    text, punctuation = np.bincount(of, lengths) / times, np.bincount(of, marks) / times
    own = (text * (1 + punctuation))[of] * (lengths > 0)
    kernel = np.exp(-(np.arange(-radius, radius + 1) ** 2) / 2)
    smooth = np.convolve(own, kernel / kernel.sum(), "full")[radius : radius + len(own)]
    scores = np.sqrt(own * smooth)
    return (scores >= min(strength * scores.std(), scores.max())) & (scores > 0)


def settled(read: Page) -> list[Node]:
    """The nodes, those aside that lie in a form or an element whose name speaks against it.

    Text outside links is shared out over the page. Names are not heeded where they would leave no article: those around
    the article or main element that holds most text, if there is none without such a name; and, largest first, while
    less than half of the text is left, those of elements that hold half, or of any if not a fifth is left. Once article
    and main elements hold a fifth of it, names are heeded.
    """
    found = read.nodes
    if len(read.doubts) == 1:
        return found
    size, direct, mass = [0] * len(read.parents), [0] * len(read.doubts), 0
    free = [0] * len(read.doubts)  # of each doubt: text in landmarks that no further one is about
    inside = marked(read, set(read.articles))
    for n in found:
        if not n.aside and not n.linked:
            length = len(n.text.strip())
            mass += length
            size[n.element] += length
            direct[n.doubt] += length
            free[n.doubt] += length * inside[n.element]
    for e in range(len(size) - 1, 0, -1):
        size[read.parents[e]] += size[e]
    whole = direct[:]
    for d in range(len(whole) - 1, 0, -1):
        whole[read.doubts[d]] += whole[d]
    heeded = [d > 0 for d in range(len(whole))]
    if read.articles and not free[0]:
        best = max(read.articles, key=lambda e: (size[e], -e))
        d = read.articles[best] if size[best] * 5 >= mass else 0
        while d:
            heeded[d] = False
            d = read.doubts[d]
    inner: list[list[int]] = [[] for _ in whole]
    for d in range(1, len(whole)):
        inner[read.doubts[d]].append(d)
    left = sum(m for m, h in zip(direct, heeded) if not h)
    article = sum(m for m, h in zip(free, heeded) if not h)
    at_hand = [(-whole[c], c) for d, h in enumerate(heeded) if not h for c in inner[d] if heeded[c]]
    heapify(at_hand)
    while at_hand and left * 2 < mass and article * 5 < mass and (left * 5 < mass or at_hand[0][0] * -2 >= mass):
        d = heappop(at_hand)[1]
        heeded[d] = False
        left, article = left + direct[d], article + free[d]
        for c in inner[d]:
            heappush(at_hand, (-whole[c], c))
    return [n._replace(aside=True) if heeded[n.doubt] else n for n in found]


def marked(read: Page, roots: set[int]) -> list[bool]:
    """For each element if it is one of these or lies in one."""
    inside = [e in roots for e in range(len(read.parents))]
    for e in range(1, len(inside)):
        inside[e] |= inside[read.parents[e]]
    return inside


def main_text(page: str, strength: float = 0.8) -> str:
    """The article's text: blocks in page order joined by one space, white space within them collapsed.

    Nodes that score `strength` standard deviations or more are surely content: their blocks are kept wherever they are.
    Short blocks are kept around them: all in article and main elements, if these hold half of the sure text, else in the
    deepest element with three fifths; and, of the deepest that holds nearly all of it, those that come between sure
    nodes or share an inner element with one. What lies in menus, adverts, forms and the like is left out (`settled`), as are, without
    a named element, list items of nothing but links.
    """
    read = Page(page)
    found = settled(read)
    beside = [n.aside for n in found]
    if not any(n.text.strip() and not n.aside for n in found):
        return ""
    sure = ratios(found, strength)
    named = marked(read, read.landmarks)
    total = sum(len(n.text) for n, s in zip(found, sure) if s)
    if sum(len(n.text) for n, s in zip(found, sure) if s and named[n.element]) * 2 < total:
        named = []
        plain = {n.item for n, b in zip(found, beside) if not b and not n.linked and not n.text.isspace()}
        beside = [b or (n.item > 0 and n.linked and n.item not in plain) for n, b in zip(found, beside)]
        sure = [s and not b for s, b in zip(sure, beside)]
    mass = [0] * len(read.parents)
    for n, s in zip(found, sure):
        if s:
            mass[n.element] += len(n.text)
    for e in range(len(mass) - 1, 0, -1):
        mass[read.parents[e]] += mass[e]
    if not mass[0]:
        return ""
    widest = max(e for e, m in enumerate(mass) if m * 100 >= mass[0] * 95)
    deepest = max(e for e, m in enumerate(mass) if m * 5 >= mass[0] * 3)
    core = marked(read, {e for e in read.landmarks if mass[e]} if named else {deepest})
    wide = marked(read, {widest})
    within = [w and i != widest and mass[i] > 0 for i, w in enumerate(wide)]
    at = [i for i, s in enumerate(sure) if s and wide[found[i].element]]
    blocks = np.cumsum([n.breaks and not n.text.isspace() for n in found])
    of_sure = set(blocks[np.flatnonzero(sure)])
    pieces = []
    broken = True
    for i, n in enumerate(found):
        broken |= n.breaks
        near = core[n.element] or within[n.element] or (wide[n.element] and at[0] < i < at[-1]) or blocks[i] in of_sure
        if beside[i] or not near:
            broken |= not n.text.isspace()
            continue
        pieces.append(" " + n.text if broken else n.text)
        broken = False
    return " ".join("".join(pieces).split())


def extract(pages: DataFrame, columns: tuple[str, ...] | None = None) -> DataFrame:
    """`text`, the article, and `n_chars`, its code points, added to these columns of every page.

    Null, empty or unreadable html, or a page without article: empty text. Whole pages are read, of any length. Input
    columns named text or n_chars are replaced; equal rows get equal texts.
    """

    def extracted(htmls: list[str | None]) -> list[pa.Array]:
        texts = [main_text(h) if h else "" for h in htmls]
        return [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]

    return computed(pages, columns, "html", T.StructType().add("text", "string").add("n_chars", "long"), lambda: extracted)


def op4_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"), ("page_id", "url"))
