"""HTML extraction by minimum cut.

A page is cut into blocks of text.  A classifier gives each block a cost for
calling it content and one for calling it boilerplate; these are its capacities
to the two terminals.  Blocks that follow each other, and blocks that share a
parent in the DOM, are joined by edges that make it dear to part them, the
nearer the dearer.  The minimum cut is the cheapest labelling of all blocks
together; max-flow finds it.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .spill import tune

_TOKEN = re.compile(r"""<!--(?:.*?-->|.*)|<[!?][^<>]*>|<(/?)([a-zA-Z][^\s/<>]*)((?:[^<>"']+|"[^"<]*"|'[^'<]*')*+|[^<>]*)>""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")
_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "xmp"}
_VOID = {"br", "hr", "img", "input", "meta", "link", "wbr", "area", "base", "col", "embed", "source", "track", "param"}
_INLINE = set("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr img".split())
_CLOSES_P = set("address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
_SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_SCOPE = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}
# Elements that hold no prose, and those that seldom do.
_NEVER = {"form", "button", "select", "head", "object", "canvas"}
_SELDOM = {"nav", "footer", "aside", "menu", "dialog"}
_ARTICLE = {"article", "main"}
# An id names what an element is for on these only; on headings and paragraphs it is the place that a link leads to.
_BOX = {"div", "section", "ul", "ol", "dl", "table", "aside", "nav", "header", "footer", "main", "article", "fieldset", "center"}
_BAD = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar menu nav navbar navigation breadcrumb breadcrumbs footer masthead cookie "
    "cookies consent gdpr notice notices alert popup modal overlay share sharing social related recommended comment comments disqus reply replies respond newsletter subscribe "
    "signup login widget widgets pagination pager toolbar skip copyright legal complementary contentinfo search".split()
)
_GOOD = set("article articlebody content post entry story main maincontent body text prose".split())
_ABOUT = {"has", "no", "with", "without", "not", "hide", "show", "toggle"}  # a name of these says what is beside it, not in it
HIDDEN = "hidden"
BIG = 1 << 30
# Costs of calling a block content: in a box that boilerplate stands in; in or on one that has an article of its own inside; on a wrapper of the page.
BOILERPLATE, BOXED, WRAPPED = 9.0, 6.0, 0.2


class Node:
    """An element that holds blocks. ``words``: unlinked words in it, all depths."""

    __slots__ = ("parent", "tag", "names", "depth", "words", "first", "inside", "above", "below", "never", "headers")

    def __init__(self, parent: Node | None, tag: str, names: frozenset):
        self.parent, self.tag, self.names = parent, tag, names
        self.depth = parent.depth + 1 if parent else 0
        self.words, self.first = 0, False


class Block:
    """A run of text. ``meet``: how deep the elements are that it shares with the block before."""

    __slots__ = ("text", "linked", "node", "meet", "score")

    def __init__(self, text: str, linked: int, node: Node, meet: int):
        self.text, self.linked, self.node, self.meet = text, linked, node, meet


def names_of(tag: str, attributes: str) -> frozenset:
    """What an element's class, role and (on boxes) id call it, as words in lower case, and HIDDEN."""
    out = set()
    seen = set()
    for name, *value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(value)
        if name in seen:
            continue
        seen.add(name)
        if name in ("class", "role") or (name == "id" and tag in _BOX):
            for token in value.split():
                parts = {x.lower() for x in _PART.findall(token)}
                out |= parts - _BAD if parts & _ABOUT else parts
        elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true") or (name == "style" and _UNSEEN.search(value)):
            out.add(HIDDEN)
    return frozenset(out)


def blocks_of(html: str) -> tuple[list[Block], list[Node]]:
    """The page's blocks of visible text in order, and its elements, outer before inner. Linear in the page, however deep it nests."""
    out: list[Block] = []
    nodes = [Node(None, "", frozenset())]
    stack = nodes[:]
    open_: dict[str, int] = {}
    parts: list[tuple[str, bool]] = []
    links, at, low = 0, 0, 0

    def flush() -> None:
        nonlocal parts, low
        if parts:
            text = " ".join("".join(p for p, _ in parts).split())
            if text:
                out.append(Block(text, sum(len(p) for p, a in parts if a), stack[-1], low))
                low = len(stack) - 1
            parts = []

    def close(names: set, stops: set) -> None:
        nonlocal low
        if not any(open_.get(x) for x in names):
            return
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in names:
                for node in stack[k:]:
                    open_[node.tag] -= 1
                del stack[k:]
                low = min(low, k - 1)
                return
            if stack[k].tag in stops:
                return

    while at < len(html):
        m = _TOKEN.search(html, at)
        text = html[at : m.start() if m else len(html)]
        if text:
            parts.append((unescape(text) if "&" in text else text, links > 0))
        if not m:
            break
        at = m.end()
        tag = m[2]
        if not tag:
            continue
        tag = tag.lower()
        if m[1]:
            if tag == "a":
                links = max(0, links - 1)
            elif tag not in _INLINE:
                flush()
                close({tag}, set())
                links = 0
            continue
        if tag in _RAW:
            end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(html, at)
            at = end.end() if end else len(html)
            continue
        if tag == "a":
            links += 1
        if tag in _INLINE:
            continue
        flush()
        if tag in _VOID:
            continue
        links = 0
        if tag in _CLOSES_P:
            close({"p"}, {"td", "th", "button", "object", "table"})
        if tag in _SAME:
            close(_SAME[tag], _SCOPE[tag])
        node = Node(stack[-1], tag, names_of(tag, m[3]) if m[3].strip() else frozenset())
        open_[tag] = open_.get(tag, 0) + 1
        nodes.append(node)
        stack.append(node)
    flush()
    return out, nodes


def frame(blocks: list[Block], nodes: list[Node]) -> bool:
    """Tell each element what surrounds it; whether a block of the page stands in an article or main element.

    Wrappers are elements around the page's text whatever their names say: they
    hold half of its unlinked words and its first article or main element, or,
    where there is none, four fifths of the words.
    """
    for b in blocks:
        b.node.words += round((b.text.count(" ") + 1) * (1 - b.linked / max(len(b.text), 1)))
    for node in reversed(nodes[1:]):
        node.parent.words += node.words
    total, framed = nodes[0].words, False
    holds: set[int] = set()
    for node in nodes:
        if node.tag in _ARTICLE or (node.parent and id(node.parent) in holds):
            holds.add(id(node))
    for b in blocks:
        if id(b.node) in holds:
            framed = True
            up = b.node
            while up:
                up.first, up = True, up.parent
            break
    root = nodes[0]
    root.inside, root.above, root.below, root.never, root.headers = False, 0.0, 0.0, False, 0
    for n in nodes[1:]:
        up = n.parent
        wraps = 2 * n.words >= total and n.first if framed else 5 * n.words >= 4 * total
        bad = bool(n.names & _BAD) and n.tag not in ("html", "body")
        n.never = up.never or n.tag in _NEVER or HIDDEN in n.names
        n.inside, n.above, n.below, n.headers = up.inside, up.above, up.below, up.headers
        if n.tag in _ARTICLE or (n.names & _GOOD and not bad):
            # What was a box of boilerplate so far has an article inside.
            n.inside, n.below = True, 0.0
            n.above = max(n.above, BOXED if up.below else 0.0, (WRAPPED if wraps else BOXED) if bad else 0.0)
            n.above += float(n.headers)
            n.headers = 0
        elif bad and wraps and not n.inside:
            n.above = max(n.above, WRAPPED)
        elif bad and wraps and n.first:
            n.above = max(n.above, WRAPPED)
        elif bad or n.tag in _SELDOM:
            n.below = BOILERPLATE
        elif n.tag == "header" and not n.inside:
            n.below, n.headers = BOILERPLATE, 1
    return framed


def score_of(block: Block, framed: bool) -> float:
    """What speaks for content (over 0) or boilerplate; framed: the page has an article or main element.

    Every cost is finite, so that neighbours can outvote it, but in elements that
    hold no prose and hidden ones.
    """
    n = block.node
    if n.never:
        return -BIG
    words = block.text.count(" ") + 1
    density = block.linked / max(len(block.text), 1)
    score = 3.0 if n.inside else -3.0 if framed else 0.0
    score += min(2.0, 0.12 * words) - 0.7 - 4.0 * min(1.0, density)
    if n.tag in ("p", "blockquote", "pre"):
        score += 0.6
    if block.text[-1] in ".!?…。！？”\"":
        score += 0.3
    return score - n.below - n.above


class Flow:
    """Max-flow by Dinic's algorithm, without recursion."""

    def __init__(self, n: int):
        self.to: list[int] = []
        self.room: list[int] = []
        self.out: list[list[int]] = [[] for _ in range(n)]

    def edge(self, a: int, b: int, there: int, back: int = 0) -> None:
        self.out[a].append(len(self.to))
        self.to.append(b)
        self.room.append(there)
        self.out[b].append(len(self.to))
        self.to.append(a)
        self.room.append(back)

    def reach(self, s: int) -> list[int]:
        level = [-1] * len(self.out)
        level[s] = 0
        queue = deque([s])
        while queue:
            x = queue.popleft()
            for e in self.out[x]:
                if self.room[e] > 0 and level[self.to[e]] < 0:
                    level[self.to[e]] = level[x] + 1
                    queue.append(self.to[e])
        return level

    def cut(self, s: int, t: int) -> list[bool]:
        """Whether each node is on the side of s in a minimum cut."""
        while (level := self.reach(s))[t] >= 0:
            next_edge = [0] * len(self.out)
            path: list[int] = []
            x = s
            while True:
                if x == t:
                    least = min(self.room[e] for e in path)
                    for e in path:
                        self.room[e] -= least
                        self.room[e ^ 1] += least
                    k = next(k for k, e in enumerate(path) if not self.room[e])
                    x = self.to[path[k] ^ 1]
                    del path[k:]
                    continue
                while next_edge[x] < len(self.out[x]):
                    e = self.out[x][next_edge[x]]
                    if self.room[e] > 0 and level[self.to[e]] == level[x] + 1:
                        break
                    next_edge[x] += 1
                if next_edge[x] < len(self.out[x]):
                    path.append(e)
                    x = self.to[e]
                elif not path:
                    break
                else:
                    x = self.to[path.pop() ^ 1]
                    next_edge[x] += 1
        return [v >= 0 for v in level]


def edges_of(blocks: list[Block], smooth: float) -> list[tuple[int, int, int]]:
    """(block, later block, weight): neighbours in the page, and blocks whose elements are next under one parent; halved for each element to leave or enter."""
    out, last = [], {}
    for k, b in enumerate(blocks):
        parent = id(b.node.parent)
        if k:
            steps = max(0, blocks[k - 1].node.depth - 1 - b.meet) + max(0, b.node.depth - 1 - b.meet)
            out.append((k - 1, k, round(0.5 ** min(steps, 60) * smooth * 1000)))
        if parent in last and last[parent] != k - 1:
            out.append((last[parent], k, round(smooth * 1000)))
        last[parent] = k
    return [e for e in out if e[2] > 0]


def label(blocks: list[Block], nodes: list[Node], smooth: float = 0.8) -> list[bool]:
    """Which blocks are content, by the minimum cut."""
    framed = frame(blocks, nodes)
    n = len(blocks)
    flow = Flow(n + 2)
    for k, b in enumerate(blocks):
        b.score = score_of(b, framed)
        flow.edge(*((n, k) if b.score > 0 else (k, n + 1)), min(BIG, round(abs(b.score) * 1000)))
    for j, k, w in edges_of(blocks, smooth):
        flow.edge(j, k, w, w)
    return flow.cut(n, n + 1)[:n]


def main_text(html: str | None) -> str:
    blocks, nodes = blocks_of(html or "")
    return "\n".join(b.text for b, keep in zip(blocks, label(blocks, nodes)) if keep)


def html_extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    r"""pages with ``text``: each page's main text, from its whole html, blocks in page order joined by one \n.

    A null or empty html, or one without content, has the empty text.  Character
    references are decoded, white space inside a block becomes one space; broken
    markup is read as far as it goes (an unclosed comment or script hides the
    rest).  Repeated rows and other columns pass through; a column ``text`` is
    replaced.  Work and memory follow the largest page; no shuffle.
    """
    tune(pages.sparkSession)
    rest = [c for c in pages.columns if c not in ("text", html_col)]
    row = pages.select(F.struct(*rest).alias("row") if rest else F.lit(0).alias("row"), F.col(html_col).alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h.as_py()) for h in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["row", "text"])

    out = row.mapInArrow(run, f"row {row.schema['row'].dataType.simpleString()}, text string")
    return out.select(*([F.col("row")[c].alias(c) for c in rest] if rest else []), "text")
