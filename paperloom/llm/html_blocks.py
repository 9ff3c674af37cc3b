"""Leaf blocks of an HTML page: runs of text between block-level tags, with the open tags around them."""

from __future__ import annotations

import html
import re
from collections.abc import Iterable
from dataclasses import dataclass

MARKUP = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|$)",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
NAME_PARTS = re.compile(r"[a-z]+|[A-Z][a-z]*")
#: Fixed values of the HTML standard: elements without end tag, of raw text, not shown, of other languages, with
#: fallback content, within a line, those that end an svg or math left open, and which open element a start tag closes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe xmp noembed noframes".split())
HIDDEN = frozenset(["noscript", "template"])
FOREIGN = frozenset(["svg", "math"])
FALLBACK = frozenset("select object canvas audio video".split())
BREAKOUT = frozenset("article aside b big blockquote body br center code dd div dl dt em embed figure footer form h1 h2 h3 h4 h5 h6 head header hr i img li main menu meta nav ol p pre ruby s section small span strong strike sub sup table tt u ul var".split())
SELF_CLOSED = re.compile(r"(?:^|[\s\"']|(?:^|\s)[^\s=]+)/$")
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark meter output progress q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table", "tbody", "thead", "tfoot"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}
RAW_END = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in RAW | HIDDEN}
HEADINGS = frozenset(f"h{n}" for n in range(1, 7))


class Node:
    """An open element: its parent, tag and the words of the attributes that name it.  ``memo`` is a reader's own."""

    __slots__ = ("memo", "parent", "tag", "words")

    def __init__(self, parent: Node | None, tag: str, words: tuple[str, ...]):
        self.parent, self.tag, self.words, self.memo = parent, tag, words, None


@dataclass
class Block:
    """A leaf block: its text, the innermost open element (which leads to all others) and its links."""

    text: str
    node: Node | None
    link_chars: int
    links: int

    @property
    def path(self) -> list[tuple[str, tuple[str, ...]]]:
        """The open elements from the outermost on, as (tag, words)."""
        out, node = [], self.node
        while node is not None:
            out.append((node.tag, node.words))
            node = node.parent
        return out[::-1]


class OpenElements:
    """The stack of open elements, with the places of each tag, so that no step looks through the whole stack."""

    def __init__(self):
        self.nodes: list[Node] = []
        self.places: dict[str, list[int]] = {}

    def push(self, tag: str, words: tuple[str, ...] = ()) -> None:
        self.places.setdefault(tag, []).append(len(self.nodes))
        self.nodes.append(Node(self.top(), tag, words))

    def top(self) -> Node | None:
        return self.nodes[-1] if self.nodes else None

    def last(self, tags: Iterable[str]) -> int:
        """The place of the innermost element of some tags, -1 if none is open."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=-1)

    def cut(self, place: int) -> None:
        """Closes the element at a place and all within it."""
        while len(self.nodes) > place:
            self.places[self.nodes.pop().tag].pop()


def name_words(attributes: str) -> tuple[str, ...]:
    """The words of the attributes that name an element."""
    out: list[str] = []
    for m in ATTRIBUTE.finditer(attributes):
        key = m[1].lower()
        if key in ("class", "id", "role", "itemprop", "aria-label"):
            out += [w.lower() for w in NAME_PARTS.findall(m[2] or m[3] or m[4] or "")]
        elif key in ("hidden",):
            out.append("hidden")
    return tuple(out)


def blocks_of(page: str | None) -> list[Block]:
    """The page's leaf blocks that have text, in order; the head, raw text elements and comments have none.

    ``noscript`` and ``template`` have none up to their end tags.  An element left open hides nothing after
    it but for raw text, which runs to the end of the page, as in the HTML standard.  Character references
    are decoded between tags, never across one.  Time and memory grow with the page's length, however deep
    its elements are nested.
    """
    out: list[Block] = []
    here = OpenElements()
    inline: list[tuple[str, ...]] = []
    parts: list[str] = []
    linked = [0, 0]
    in_link = 0
    endless: set[str] = set()  # raw or hidden tags without an end tag from here on
    foreign, depth = "", 0  # the svg or math that is open, and how deep in its own kind
    page = page or ""

    def flush() -> None:
        nonlocal parts
        text = " ".join("".join(parts).split())
        if text and not here.places.get("head"):
            node = here.top()
            for words in inline:
                node = Node(node, "span", words)
            out.append(Block(text, node, linked[0], linked[1]))
        parts, linked[0], linked[1] = [], 0, 0

    def say(raw: str) -> None:
        if raw:
            said = html.unescape(raw) if "&" in raw else raw
            parts.append(said)
            if in_link:
                linked[0] += len(said.strip())

    at = 0
    while at < len(page):
        m = MARKUP.search(page, at)
        if m is None:
            say(page[at:])
            break
        say(page[at : m.start()])
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        closing, attributes = bool(m[1] or m[4]), m[3] or m[6] or ""
        if foreign and (tag in BREAKOUT or closing and tag != foreign and here.places.get(tag)):
            foreign = ""
        if (tag in RAW or tag in HIDDEN) and not closing and not (foreign and (tag == "title" or SELF_CLOSED.search(attributes))):
            end = None if tag in endless else RAW_END[tag].search(page, at)
            if end is None:
                endless.add(tag)
            at = end.end() if end else at if foreign or tag in HIDDEN else len(page)
            continue
        if foreign or tag in FOREIGN:
            parts.append(" ")
            if tag in FOREIGN and tag == (foreign or tag):
                if not closing and not SELF_CLOSED.search(attributes):
                    foreign, depth = tag, depth + 1 if foreign else 1
                elif closing and foreign:
                    depth -= 1
                    foreign = foreign if depth else ""
            continue
        if tag in HIDDEN:
            continue
        if tag in ("html", "body") and closing:
            continue
        if tag in INLINE or tag in ("input", "button"):
            if tag == "br":
                parts.append(" ")
            elif tag == "button":
                flush()
                if not closing:
                    here.push("button")
                elif here.places.get("button"):
                    here.cut(here.last(("button",)))
            elif tag == "a":
                in_link = 0 if closing else 1
                linked[1] += not closing
            elif tag == "span" and not closing:
                inline.append(name_words(attributes))
            elif tag == "span" and inline:
                inline.pop()
            continue
        flush()
        inline.clear()
        if closing:
            place = here.last(HEADINGS if tag in HEADINGS else (tag,))
            if place >= 0:
                here.cut(place)
            continue
        if tag in VOID:
            continue
        if here.nodes and here.nodes[-1].tag == "p" and tag not in FALLBACK:
            here.cut(len(here.nodes) - 1)
        if tag in CLOSES:
            scope = here.last(SCOPES[tag])
            here.cut(min((k for t in CLOSES[tag] if (k := here.last((t,))) > scope), default=len(here.nodes)))
        if here.nodes and here.nodes[-1].tag == "head" and tag != "head":
            here.cut(len(here.nodes) - 1)
        here.push(tag, name_words(attributes))
    flush()
    return out
