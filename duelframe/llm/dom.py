"""A small tolerant reader of HTML into block nodes, and the features of those nodes."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field
from html import unescape

# Fixed values of the HTML standard: elements without end tag, with raw text, and with phrasing content.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = "script|style|textarea|title|noscript|template|iframe"
#: Elements in these are read as part of them and may close themselves; a tag of ``TAGS`` ends them, closed or not.
FOREIGN = frozenset("svg math".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var".split())
#: A new one of these ends an open one of the same set that no other element of ``SCOPE`` shields.
SAME = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "svg": (), "math": (), "object": (), "select": ()}
SCOPE = frozenset("html body table ul ol dl button".split())

TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({RAW})\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</\1\s*>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)|([^<]+|<)",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"\b(class|id|role|itemprop|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

# Beginnings of attribute tokens by what they tell about a node.
HINTS = {
    "main": "article content main post entry story body text prose blog page",
    "menu": "nav menu breadcrumb toc tab pager pagination dropdown skip",
    "side": "side aside rail widget related recommend more trending popular tags",
    "ad": "ad ads advert advertisement banner promo sponsor sponsored dfp outbrain taboola",
    "edge": "foot footer header masthead head top bottom copyright legal site logo brand",
    "notice": "cookie consent notice alert gdpr modal popup overlay newsletter subscribe signup paywall toast",
    "reply": "comment comments reply replies disqus discussion respond reader review",
    "form": "form search login register input button share social follow",
}
_HINTS = [frozenset(words.split()) for words in HINTS.values()]
TAGS = ("article", "main", "section", "div", "p", "h", "nav", "header", "footer", "aside", "form", "li", "ul", "td", "body", "blockquote", "pre", "figure")
_TAG = {t: i for i, t in enumerate(TAGS)} | {f"h{k}": TAGS.index("h") for k in range(1, 7)} | {"ol": TAGS.index("ul"), "dd": TAGS.index("li"), "dt": TAGS.index("li"), "th": TAGS.index("td")}


@dataclass(slots=True)
class Node:
    """A block element; ``text`` holds its own pieces and the numbers of its child nodes in page order.

    ``number`` counts the children of ``parent`` that come before it.
    """

    parent: int
    tag: str
    hints: int
    depth: int
    place: int
    number: int = 0
    text: list = field(default_factory=list)
    children: list = field(default_factory=list)
    chars: int = 0
    linked: int = 0
    stops: int = 0


def _hints(attributes: str) -> int:
    found = 0
    for _, a, b, c in ATTRIBUTE.findall(attributes):
        for word in WORD.findall(a or b or c):
            word = word.lower()
            for k, words in enumerate(_HINTS):
                if word in words:
                    found |= 1 << k
    return found


def read(page: str) -> list[Node]:
    """Block nodes of a page in document order, the root first; unclosed and stray tags are tolerated."""
    nodes = [Node(-1, "html", 0, 0, 0)]
    open_: list[tuple[str, int]] = [("html", 0)]
    links = 0
    for m in TOKEN.finditer(page):
        if m.group(5) is not None:
            text = m.group(5)
            if "&" in text:
                text = unescape(text)
            own = nodes[open_[-1][1]]
            own.text.append(text)
            n = len(text) - text.count(" ")
            own.chars += n
            own.stops += text.count(".") + text.count(",")
            if links:
                own.linked += n
            continue
        if m.group(1):
            continue
        tag = m.group(3)
        if not tag:
            continue
        tag = tag.lower()
        if m.group(2):
            for k in range(len(open_) - 1, 0, -1):
                if open_[k][0] == tag:
                    links -= sum(t == "a" for t, _ in open_[k:])
                    del open_[k:]
                    break
            continue
        if tag in VOID:
            nodes[open_[-1][1]].text.append("\n")
            continue
        if tag in ("html", "head") or (tag == "body" and len(open_) == 1 and not nodes[0].children):
            if tag == "body":
                nodes[0].hints |= _hints(m.group(4))
            continue
        closed = (m.group(4) or "").endswith("/")
        if nodes[open_[-1][1]].tag in FOREIGN:
            if tag in _TAG:
                k = next(k for k, (t, _) in enumerate(open_) if t in FOREIGN)
                links -= sum(t == "a" for t, _ in open_[k:])
                del open_[k:]
            elif closed:
                continue
        if tag in INLINE or nodes[open_[-1][1]].tag in FOREIGN:
            open_.append((tag, open_[-1][1]))
            links += tag == "a"
            continue
        ends = SAME.get(tag, ("p",))
        for k in range(len(open_) - 1, 0, -1):
            if open_[k][0] in ends:
                links -= sum(t == "a" for t, _ in open_[k:])
                del open_[k:]
                break
            if open_[k][0] in SCOPE or (open_[k][0] not in INLINE and ends == ("p",)):
                break
        if closed and tag not in _TAG:
            continue
        up = open_[-1][1]
        nodes.append(Node(up, tag, _hints(m.group(4) or ""), nodes[up].depth + 1, m.start(), len(nodes[up].children)))
        nodes[up].text.append(len(nodes) - 1)
        nodes[up].children.append(len(nodes) - 1)
        open_.append((tag, len(nodes) - 1))
    return nodes


NAMES = ["chars", "share", "link_share", "stops", "per_node", "nodes", "depth", "place", "siblings", "before", "alike", "own_share", *HINTS, *(f"in_{h}" for h in HINTS), *TAGS]


def features(nodes: list[Node], length: int) -> list[list[float]]:
    """One row for each node, in the order of ``NAMES``: subtree density, attributes, tags, depth and siblings."""
    n = len(nodes)
    chars, linked, stops, size = [x.chars for x in nodes], [x.linked for x in nodes], [x.stops for x in nodes], [1] * n
    above = [0] * n
    for i, x in enumerate(nodes):
        if i:
            above[i] = above[x.parent] | nodes[x.parent].hints
    for i in range(n - 1, 0, -1):
        p = nodes[i].parent
        chars[p] += chars[i]
        linked[p] += linked[i]
        stops[p] += stops[i]
        size[p] += size[i]
    alike = [Counter(nodes[k].tag for k in x.children) for x in nodes]
    total, rows = max(chars[0], 1), []
    for i, x in enumerate(nodes):
        c = chars[i]
        kin = len(nodes[x.parent].children) if i else 1
        row = [float(c.bit_length()), c / total, linked[i] / c if c else 0.0, 100 * stops[i] / c if c else 0.0, c / size[i], float(size[i].bit_length())]
        row += [float(x.depth), x.place / max(length, 1), float(kin), x.number / kin, alike[x.parent][x.tag] / kin if i else 1.0, x.chars / c if c else 0.0]
        row += [float(x.hints >> k & 1) for k in range(len(HINTS))] + [float(above[i] >> k & 1) for k in range(len(HINTS))]
        tag = [0.0] * len(TAGS)
        if x.tag in _TAG:
            tag[_TAG[x.tag]] = 1.0
        rows.append(row + tag)
    return rows


def blocks(nodes: list[Node], kept: list[bool]) -> str:
    """The text of kept nodes in page order; white space as one space, blocks joined by one space."""
    out, todo = [], [(0, 0)]
    piece: list[str] = []
    while todo:
        i, k = todo.pop()
        text = nodes[i].text
        while k < len(text):
            x = text[k]
            k += 1
            if isinstance(x, int):
                out.append("".join(piece))
                piece = []
                todo += [(i, k), (x, 0)]
                break
            if kept[i]:
                piece.append(x)
        else:
            out.append("".join(piece))
            piece = []
    return " ".join(" ".join(out).split())
