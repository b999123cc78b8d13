"""Main-text extraction from web pages by minimum-cut labelling.

A page is read into blocks of text, one for each run between block-level tags. A
linear classifier over a block's tags, class words, length and link share gives the cost of
calling it content or boilerplate; these are the capacities to the two terminals.
Smoothness edges join neighbours in page order and successive blocks of the
same parent, the stronger the more ancestors they share. A maximum flow separates
content from boilerplate; the blocks on the source's side are the text.

Pages are independent: one pass, no shuffle, memory bounded by one page.

Rows: a NULL or empty html has the empty text; repeated pages each get a row; broken markup
(tags that never close, stray end tags, cut pages) is read as browsers do in outline.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

_SCHEMA = "page_id long, url string, text string, n_chars long"

# HTML element names by role.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span"
    " strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose text is never read.
SILENT = frozenset("applet audio canvas datalist head iframe map math noframes noscript object svg template title video".split())
#: Elements whose inside is not markup.
RAW = ("script", "style", "textarea", "xmp", "noembed", "title")
#: A start tag closes an open element of its set, up to the border element.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
#: Start tags that close an open paragraph.
ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5"
    " h6 header hr main menu nav ol p pre section table ul".split()
)
BOILERPLATE_TAGS = frozenset("nav aside footer form menu button select textarea label dialog fieldset input".split())
CONTENT_TAGS = frozenset("article main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Class, id and role words that mark boilerplate.
BOILERPLATE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs byline comment comments commentlist"
    " complementary consent contentinfo cookie cookies copyright dialog disclaimer disqus footer gdpr legal login menu"
    " modal nav navbar navigation newsletter notice notices notification overlay pager pagination popup promo promoted"
    " promotion recommended related replies reply respond search share sharing sidebar signup social sponsor sponsored"
    " subscribe subscription tags toc toolbar topbar widget widgets alert".split()
)
#: With one of these a class says what its element lacks or stands beside.
QUALIFIERS = frozenset("no not has with without".split())
CONTENT_WORDS = frozenset("article articlebody body content entry main post story text".split())

# Classifier weights, in nats; positive speaks for content.
W_BIAS = -0.6
W_CONTENT_TAG = 3.0
W_CONTENT_WORD = 1.2
W_BOILERPLATE_TAG = -9.0
W_BOILERPLATE_WORD = -9.0
W_HEADER = -6.0
W_PARAGRAPH = 0.8
W_HEADING = 0.8
W_WORD = 0.04
MOST_FROM_WORDS = 2.0
W_LINKS = -4.0
# Smoothness of neighbours that share all ancestors, and of successive blocks of one parent.
S_NEXT = 0.8
S_SIBLING = 0.4
#: Capacities are integers in units of 1 / SCALE.
SCALE = 1000

_TOKEN = re.compile(
    # possessive, and a tag ends at the next "<" outside quotes at the latest: a page of broken tags is read in linear time
    r"<!--.*?(?:-->|\Z)|<(?:(?P<end>/)?(?P<name>[a-zA-Z][^\s/<>]*+)(?P<attrs>(?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|[!?/][^>]*(?:>|\Z))",
    re.S,
)
_BROKEN = re.compile(r"</?[a-zA-Z][^<>]*(?:>|(?=<)|\Z)")
_NAMING = re.compile(r"""(?:^|\s)(class|id|role|hidden|style|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_SPLIT = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_RAW_END = {x: re.compile(rf"</{x}(?=[\s/>])[^>]*(?:>|\Z)", re.I) for x in RAW}


@dataclass
class Node:
    """An open element: its depth, and what it and its ancestors say of their text."""

    tag: str
    depth: int
    silent: bool
    content: bool
    content_word: bool
    boiler: bool
    header: bool
    link: bool
    serial: int
    parent: "Node | None"


@dataclass
class Block:
    text: str
    node: Node
    links: float


def _named(attrs: str) -> tuple[set[str], bool]:
    """The words of class, id and role; whether the element is hidden."""
    words, hidden = set(), False
    for name, value in _NAMING.findall(attrs):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none", value):
            hidden = True
        elif name in ("class", "id", "role"):
            for part in value.split():
                said = {x.lower() for x in _SPLIT.findall(part)}
                words |= said if QUALIFIERS.isdisjoint(said) else set()
    return words, hidden


def _opened(tag: str, attrs: str, parent: Node, serial: int) -> Node:
    words, hidden = _named(attrs) if attrs else (set(), False)
    return Node(
        tag,
        parent.depth + (tag not in INLINE),
        parent.silent or hidden or tag in SILENT,
        parent.content or tag in CONTENT_TAGS,
        parent.content_word or not CONTENT_WORDS.isdisjoint(words),
        # the document's outermost elements name the page's kind, not a part of it
        parent.boiler or tag in BOILERPLATE_TAGS or tag not in ("html", "body", "article", "main") and not BOILERPLATE_WORDS.isdisjoint(words),
        parent.header or tag == "header" or "header" in words,
        parent.link or tag == "a",
        serial,
        parent,
    )


def blocks(html: str) -> list[Block]:
    """The page's blocks of text in order."""
    root = Node("", 0, False, False, False, False, False, False, 0, None)
    stack, found, run, at, serial = [root], [], [], 0, 0
    opened: Counter = Counter()  # elements on the stack by tag, so that it is searched only for what it holds

    def shut_from(k: int) -> None:
        opened.subtract(x.tag for x in stack[k:])
        del stack[k:]

    def holder() -> Node:
        k = len(stack) - 1
        while stack[k].tag in INLINE:
            k -= 1
        return stack[k]

    def text(raw: str) -> None:
        if raw and not stack[-1].silent:
            run.append((unescape(raw) if "&" in raw else raw, stack[-1].link))

    def close() -> None:
        if run:
            whole = " ".join("".join(x for x, _ in run).split())
            if whole:
                linked = sum(len(x) for x, link in run if link)
                found.append(Block(whole, holder(), min(1.0, linked / len(whole))))
            run.clear()

    while at < len(html):
        lt = html.find("<", at)
        if lt < 0:
            text(html[at:])
            break
        m = _TOKEN.match(html, lt) or _BROKEN.match(html, lt)
        if not m:  # a bare sign
            text(html[at : lt + 1])
            at = lt + 1
            continue
        text(html[at:lt])
        at = m.end()
        name = m["name"] if m.re is _TOKEN else None
        if not name:
            continue
        tag, end = name.lower(), m["end"]
        if tag == "br":
            run.append((" ", False))
            continue
        if tag not in INLINE:
            close()
        if end:
            for k in range(len(stack) - 1, 0, -1) if opened[tag] > 0 else ():
                if stack[k].tag == tag:
                    shut_from(k)
                    break
                # an inline end tag reaches no further than its block
                if tag in INLINE and stack[k].tag not in INLINE:
                    break
            continue
        if tag in ENDS_P or tag in CLOSES:
            shut, border = CLOSES.get(tag, ({"p"}, {"button", "table", "td", "th"}))
            for k in range(len(stack) - 1, 0, -1) if any(opened[x] > 0 for x in shut) else ():
                if stack[k].tag in border:
                    break
                if stack[k].tag in shut:
                    shut_from(k)
                    break
        if tag in RAW and not m["attrs"].endswith("/"):
            stop = _RAW_END[tag].search(html, at)
            at = stop.end() if stop else len(html)
            continue
        if tag in VOID or m["attrs"].endswith("/"):
            continue
        serial += 1
        stack.append(_opened(tag, m["attrs"], stack[-1], serial))
        opened[tag] += 1
    close()
    return found


def score(b: Block) -> float:
    """The classifier: log odds of content."""
    n = b.node
    s = W_BIAS + min(MOST_FROM_WORDS, W_WORD * (b.text.count(" ") + 1)) + W_LINKS * b.links
    s += W_CONTENT_TAG * n.content + W_CONTENT_WORD * n.content_word + W_BOILERPLATE_TAG * n.boiler
    s += W_HEADER * (n.header and not (n.content and n.tag in HEADINGS))
    return s + W_PARAGRAPH * (n.tag in ("p", "blockquote", "pre")) + W_HEADING * (n.tag in HEADINGS)


def _shared(a: Node, b: Node) -> float:
    """The share of ancestors that two holders have in common."""
    deepest = max(a.depth, b.depth, 1)
    while a is not b:
        if a.depth < b.depth or a.depth == b.depth and a.serial < b.serial:
            a, b = b, a
        a = a.parent
    return a.depth / deepest


def smoothness(found: list[Block]) -> list[tuple[int, int, int]]:
    """Edges (block, later block, capacity): page neighbours, and successive blocks of a parent."""
    edges, last = [], {}
    for i, b in enumerate(found):
        if i:
            edges.append((i - 1, i, int(SCALE * S_NEXT * _shared(found[i - 1].node, b.node))))
        key = b.node.parent.serial if b.node.parent else -1
        if key in last and last[key] != i - 1:
            edges.append((last[key], i, int(SCALE * S_SIBLING)))
        last[key] = i
    return [e for e in edges if e[2]]


def min_cut(unary: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """Which nodes stay with the source; ``unary`` above 0 is capacity from it, below 0 to the sink. Dinic's maximum flow."""
    n = len(unary)
    source, sink = n, n + 1
    out: list[list[int]] = [[] for _ in range(n + 2)]
    to: list[int] = []
    cap: list[int] = []

    def link(a: int, b: int, forth: int, back: int) -> None:
        out[a].append(len(to))
        to.append(b)
        cap.append(forth)
        out[b].append(len(to))
        to.append(a)
        cap.append(back)

    for i, u in enumerate(unary):
        if u > 0:
            link(source, i, u, 0)
        elif u < 0:
            link(i, sink, -u, 0)
    for a, b, c in edges:
        link(a, b, c, c)
    while True:
        level = [-1] * (n + 2)
        level[source], queue = 0, [source]
        for a in queue:
            for e in out[a]:
                if cap[e] and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [x >= 0 for x in level[:n]]
        turn, path, a = [0] * (n + 2), [], source
        while True:
            if a == sink:
                flow = min(cap[e] for e in path)
                for e in path:
                    cap[e] -= flow
                    cap[e ^ 1] += flow
                k = next(k for k, e in enumerate(path) if not cap[e])
                a = to[path[k] ^ 1]
                del path[k:]
                continue
            while turn[a] < len(out[a]):
                e = out[a][turn[a]]
                if cap[e] and level[to[e]] == level[a] + 1:
                    path.append(e)
                    a = to[e]
                    break
                turn[a] += 1
            else:
                if a == source:
                    break
                a = to[path.pop() ^ 1]
                turn[a] += 1


def main_text(html: str | None) -> str:
    """The article's blocks, joined by an empty line."""
    found = blocks(html or "")
    if not found:
        return ""
    keep = min_cut([round(SCALE * score(b)) for b in found], smoothness(found))
    return "\n\n".join(b.text for b, k in zip(found, keep) if k)


def extract_text(pages: DataFrame) -> DataFrame:
    """The main text of every page."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column(2)]
            columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(read, _SCHEMA)
