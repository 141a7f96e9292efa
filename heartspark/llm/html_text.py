"""Main text of HTML pages by minimum-cut labelling.

A page is cut into blocks of text where its elements break lines. A linear classifier gives each
block log-odds of being content; these become terminal capacities. Blocks that follow each other,
and blocks that follow each other under the same parent, are joined by smoothness edges whose
capacity falls with their distance in the DOM. The minimum cut, from a maximum flow, is the
labelling with the least sum of classifier costs and broken edges; blocks on the source's side are
content.

Tokens are scanned as browsers do in the main: comments, scripts, styles and other raw elements
have no text; quotes may hold ``>``; ``p``, ``li`` and the like close themselves.

Results by definition: null and empty pages have the text ''; pages of any length are read whole;
each row has a result row; an empty table gives an empty result; further columns are left out.
"""

from __future__ import annotations

import html
import re
from collections import deque
from math import log2

import pyarrow as pa
from pyspark.sql import DataFrame

from .rows import map_texts, pick

TAG_TOKEN = re.compile(r"<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*)>", re.S)
#: Elements without text to read.
RAW = frozenset("script style noscript template textarea title svg math iframe object select option button head".split())
#: Of these, the content is no markup: only the end tag ends it.
UNPARSED = frozenset("script style noscript template textarea title iframe".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that don't break a block.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr".split())
#: Elements that an element of the same group ends, up to the nearest container.
CLOSES = {x: group for group in (frozenset({"li"}), frozenset({"dt", "dd"}), frozenset({"tr"}), frozenset({"td", "th"})) for x in group}
CONTAINERS = frozenset("article aside body div dl footer form header html main nav ol section table tbody ul".split())
ATTRIBUTE = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
WORDS = re.compile(r"[a-z]+")

#: Log-odds of content, set by hand: of an ancestor's tag, and of a word in its class, id or role.
TAG = {"article": 4.0, "main": 3.0, "nav": -14.0, "footer": -14.0, "aside": -14.0, "form": -14.0, "menu": -14.0, "dialog": -14.0,
       "header": -9.0, "address": -4.0, "fieldset": -8.0}
NAMED = dict.fromkeys("article content post entry story main body text prose".split(), 2.0) | dict.fromkeys(
    "ad ads advert advertisement adverts advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices "
    "alert popup modal overlay sidebar menu nav navigation navbar breadcrumb breadcrumbs footer comment comments commentlist disqus "
    "respond replies reply share sharing social related recommended newsletter subscribe subscription signup login search pagination "
    "pager toolbar widget skip copyright contentinfo complementary teaser".split(), -14.0)
HEADING = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))


STOPS = CONTAINERS | {"td", "th", "li"}


class Block:
    """``depth`` is that of the element that the block is directly in, not counting inline ones, ``parent`` the element around that (0: none); ``common``
    is the depth of the nearest element that holds both this block and the one before."""
    __slots__ = ("parts", "parent", "depth", "common", "odds", "linked", "text")

    def __init__(self, parent: int, depth: int, common: int, odds: float):
        self.parts: list[str] = []
        self.parent, self.depth, self.common, self.odds, self.linked, self.text = parent, depth, common, odds, 0, ""


class Open:
    """Open elements, and where in the stack each tag's, the block elements and those that stop an implied end are: what a tag does takes
    constant time and that of the elements that it ends, however deep the page is."""

    def __init__(self):
        self.stack: list[tuple[str, int, float]] = []  # tag, element id, log-odds of it and its ancestors
        self.of: dict[str, list[int]] = {}
        self.blocks: list[int] = []
        self.stops: list[int] = []
        self.raw = self.links = 0
        self.low = 0  # the fewest open block elements since the last block of text began

    def top(self, tag: str) -> int:
        """The place of the innermost open element of this tag, or -1."""
        places = self.of.get(tag)
        return places[-1] if places else -1

    def push(self, tag: str, element: int, odds: float) -> None:
        at = len(self.stack)
        self.stack.append((tag, element, odds))
        self.of.setdefault(tag, []).append(at)
        if tag not in INLINE:
            self.blocks.append(at)
        if tag in STOPS:
            self.stops.append(at)
        self.raw += tag in RAW
        self.links += tag == "a"

    def pop(self, to: int) -> bool:
        """Ends the elements from a place on; whether a block element is among them."""
        broke = False
        while len(self.stack) > to:
            tag, _, _ = self.stack.pop()
            self.of[tag].pop()
            if tag not in INLINE:
                self.blocks.pop()
                broke = True
            if tag in STOPS:
                self.stops.pop()
            self.raw -= tag in RAW
            self.links -= tag == "a"
        self.low = min(self.low, len(self.blocks))
        return broke


def next_token(page: str, at: int, last: int, last_data: int) -> tuple[int, int, re.Match | None] | None:
    """(start, end, tag) of the first markup from a place on; comments and the like have no tag. What doesn't end is text. ``last`` and
    ``last_data`` are the places of the last ``>`` and ``]]>``: where no closing mark is left, none is looked for."""
    while (i := page.find("<", at)) >= 0:
        if page.startswith("<!--", i):
            end = page.find("-->", i + 4)
            return i, len(page) if end < 0 else end + 3, None
        if i > last:
            return None
        if page.startswith("<![CDATA[", i) and i < last_data:
            return i, page.find("]]>", i) + 3, None
        if page.startswith(("<!", "<?"), i):
            return i, page.find(">", i) + 1, None
        if m := TAG_TOKEN.match(page, i):
            return i, m.end(), m
        at = i + 1
    return None


def blocks_of(page: str) -> list[Block]:
    """Blocks with their text, in page order."""
    out: list[Block] = []
    open_ = Open()
    n, at, current = 0, 0, None

    def said(text: str) -> None:
        nonlocal current
        if not text or open_.raw:
            return
        if current is None:
            if not text.strip():
                return
            blocks, stack = open_.blocks, open_.stack
            current = Block(stack[blocks[-2]][1] if len(blocks) > 1 else 0, len(blocks), open_.low, stack[-1][2] if stack else 0.0)
            open_.low = len(blocks)
            out.append(current)
        current.parts.append(text)
        if open_.links:
            current.linked += len(text)

    size, last, last_data = len(page), page.rfind(">"), page.rfind("]]>")
    while step := next_token(page, at, last, last_data):
        start, end, m = step
        if start > at:
            said(page[at:start])
        at = end
        if m is not None:
            tag = m["tag"].lower()
            if m["end"]:
                k = open_.top(tag)
                # An inline end doesn't reach beyond a block element.
                if k >= 0 and not (tag in INLINE and open_.blocks and open_.blocks[-1] > k) and open_.pop(k):
                    current = None
            elif tag == "br":
                said(" ")
            else:
                if tag not in INLINE:
                    current = None
                    k = max(open_.top(x) for x in ("p", *CLOSES.get(tag, ())))
                    if k >= 0 and k >= (open_.stops[-1] if open_.stops else -1):
                        open_.pop(k)
                    if tag == "body" and open_.of.get("head"):
                        open_.pop(open_.of["head"][0])
                if tag not in VOID and not (m["attrs"].endswith("/") and tag in ("svg", "math")):
                    odds = (open_.stack[-1][2] if open_.stack else 0.0) + TAG.get(tag, 0.0)
                    if m["attrs"]:
                        names = {w for said_ in ATTRIBUTE.findall(m["attrs"]) for w in WORDS.findall("".join(said_).lower())}
                        said_by = [NAMED[w] for w in names if w in NAMED]
                        if said_by:  # one word against content outweighs those for it
                            odds += min(said_by)
                    n += 1
                    open_.push(tag, n, odds)
                    if tag in UNPARSED:
                        close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(page, at)
                        at = close.start() if close else size
    said(page[at:])
    done = []
    common = None
    for b in out:
        raw = "".join(b.parts)
        b.text = " ".join(html.unescape(raw).split())
        common = b.common if common is None else min(common, b.common)
        if b.text:
            b.linked, b.common, common = min(1.0, b.linked / max(1, len(raw))), common, None
            done.append(b)
    return done


def log_odds(text: str, odds: float, linked: float) -> float:
    """Of a block being content: what its ancestors say, its length, its sentences, its links."""
    ends = text.count(".") + text.count("!") + text.count("?") + text.count("。")
    return odds + min(3.0, log2(1 + len(text)) / 3 - 1.0) + min(1.0, 0.5 * ends) - 4.0 * linked


def edges_of(blocks: list[Block], smooth: float) -> list[tuple[int, int, float]]:
    """Smoothness edges (i, j, capacity): neighbours in the page, by the DOM's edges between them, and next ones under the same parent."""
    out, last = [], {}
    for i, b in enumerate(blocks):
        if i:
            between = blocks[i - 1].depth + b.depth - 2 * b.common
            out.append((i - 1, i, smooth * 2.0 ** -min(1000, max(0, between - 2))))
        if (j := last.get(b.parent)) is not None and j != i - 1:
            out.append((j, i, smooth / 2))
        last[b.parent] = i
    return out


def min_cut(odds: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Whether each node is on the source's side of a minimum cut.

    A node with positive odds hangs on the source, one with negative odds on the sink. Dinic's
    method: breadth-first levels, then blocking flows along them.
    """
    n = len(odds)
    source, sink = n, n + 1
    to: list[int] = []
    room: list[float] = []
    out: list[list[int]] = [[] for _ in range(n + 2)]

    def join(a: int, b: int, there: float, back: float) -> None:
        out[a].append(len(to))
        to.append(b)
        room.append(there)
        out[b].append(len(to))
        to.append(a)
        room.append(back)

    for i, z in enumerate(odds):
        if z > 0:
            join(source, i, z, 0.0)
        elif z < 0:
            join(i, sink, -z, 0.0)
    for a, b, w in edges:
        join(a, b, w, w)
    tiny = 1e-9
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in out[a]:
                if room[e] > tiny and level[b := to[e]] < 0:
                    level[b] = level[a] + 1
                    queue.append(b)
        if level[sink] < 0:
            return [level[i] >= 0 for i in range(n)]
        tried = [0] * (n + 2)
        path: list[int] = []
        a = source
        while True:
            if a == sink:
                flow = min(room[e] for e in path)
                for k, e in enumerate(path):
                    room[e] -= flow
                    room[e ^ 1] += flow
                k = next(k for k, e in enumerate(path) if room[e] <= tiny)
                a = to[path[k] ^ 1]
                del path[k:]
                continue
            edges_a = out[a]
            while tried[a] < len(edges_a):
                e = edges_a[tried[a]]
                if room[e] > tiny and level[to[e]] == level[a] + 1:
                    break
                tried[a] += 1
            if tried[a] < len(edges_a):
                path.append(e)
                a = to[e]
            elif path:
                e = path.pop()
                a = to[e ^ 1]
                tried[a] += 1
            else:
                break


def main_text(page: str, smooth: float = 2.0) -> str:
    blocks = blocks_of(page)
    if not blocks:
        return ""
    kept = min_cut([log_odds(b.text, b.odds, b.linked) for b in blocks], edges_of(blocks, smooth))
    return " ".join(b.text for b, keep in zip(blocks, kept) if keep)


def extract(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", smooth: float = 2.0) -> DataFrame:
    """(id, url, text, n_chars) of every page; ``smooth`` is the capacity between direct neighbours."""
    def one(page: str) -> tuple[str, int]:
        text = main_text(page, smooth)
        return text, len(text)

    out = map_texts(pick(df, id=id_col, url=url_col, html=html_col),
                    [("text", "string", pa.string()), ("n_chars", "long", pa.int64())], lambda: one)
    return out.withColumnsRenamed({"id": id_col, "url": url_col})
