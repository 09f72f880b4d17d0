"""A small HTML tree over the standard parser, made in one pass over its events; runs inside Python workers only."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from html.parser import HTMLParser

VOID = {"area", "base", "br", "col", "hr", "img", "input", "link", "meta", "wbr"}
#: An opening tag ends open elements of these kinds, up to the nearest border.
ENDS = {"p": {"p"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "li": {"li", "p"}, "div": {"p"}, "table": {"p"}, "option": {"option"}}
BORDERS = {"tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "li": {"ul", "ol"}, "p": {"td", "th", "div", "table"}, "div": {"td", "th", "table"}, "table": {"td", "th"}}


class Node:
    """An element: its place among the document's elements and pieces of text, which are kept in one list each.

    An element's descendants, and its text, are ranges of these lists, so that finding what is in an element takes a binary search
    and no walk; table and row are the nearest enclosing ones, rows and cells what belongs to it as a table or row.
    """

    __slots__ = ("at", "attrs", "cells", "document", "end", "pieces", "row", "rows", "said", "table", "tag")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None, document: Document):
        self.tag, self.attrs, self.document = tag, attrs, document
        self.at, self.end, self.pieces = len(document.nodes), None, [len(document.pieces), None]
        self.rows, self.cells, self.said = [], [], []  # said: pieces of text that are children
        if parent is not None:
            self.table = parent if parent.tag == "table" else parent.table
            self.row = parent if parent.tag == "tr" else None if parent.tag == "table" else parent.row
        else:
            self.table = self.row = None
        if tag == "tr" and self.table is not None:
            self.table.rows.append(self)
        if tag in ("td", "th") and self.row is not None:
            self.row.cells.append(self)

    def walk(self):
        return iter(self.document.nodes[self.at : self.end])

    def _range(self, tag: str) -> list[int]:
        places = self.document.by_tag.get(tag, [])
        return places[bisect_right(places, self.at) : bisect_left(places, self.end)]

    def find(self, *tags: str) -> list[Node]:
        found = self._range(tags[0]) if len(tags) == 1 else sorted(i for t in tags for i in self._range(t))
        return [self.document.nodes[i] for i in found]

    def with_attr(self, name: str, value: str) -> list[Node]:
        return [n for n in self.walk() if value in n.attrs.get(name, "").split()]

    def has(self, tag: str) -> bool:
        places = self.document.by_tag.get(tag, [])
        k = bisect_right(places, self.at)
        return k < len(places) and places[k] < self.end

    def text(self, breaks: str = "") -> str:
        first, last = self.pieces
        return "".join(breaks if x is None else x for x in self.document.pieces[first:last]).replace("\xa0", " ")

    def trimmed(self) -> str:
        return " ".join(self.text(" ").split())


class Document:
    """All elements in the order of their opening tags, their places by tag, and all pieces of text; None is a line break."""

    def __init__(self):
        self.nodes: list[Node] = []
        self.by_tag: dict[str, list[int]] = {}
        self.pieces: list[str | None] = []

    def add(self, tag: str, attrs: dict[str, str], parent: Node | None) -> Node:
        node = Node(tag, attrs, parent, self)
        self.nodes.append(node)
        self.by_tag.setdefault(tag, []).append(node.at)
        return node

    def close(self, node: Node) -> None:
        node.end, node.pieces[1] = len(self.nodes), len(self.pieces)


class _Builder(HTMLParser):
    """Open elements form a stack; the depths at which each tag is open tell what a tag ends without looking through the stack."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.document = Document()
        self.open = [self.document.add("", {}, None)]
        self.depths: dict[str, list[int]] = {}
        self.hidden = 0  # open scripts and styles

    def _close_to(self, depth: int) -> None:
        while len(self.open) > depth:
            node = self.open.pop()
            if node.tag in self.depths and self.depths[node.tag]:
                self.depths[node.tag].pop()
            self.hidden -= node.tag in ("script", "style")
            self.document.close(node)

    def _deepest(self, tag: str) -> int:
        return self.depths[tag][-1] if self.depths.get(tag) else 0

    def handle_starttag(self, tag, attrs):
        if tag in ENDS:
            border = max((self._deepest(t) for t in BORDERS.get(tag, ())), default=0)
            ended = [d[k] for t in ENDS[tag] if (d := self.depths.get(t)) and (k := bisect_right(d, border)) < len(d)]
            if ended:
                self._close_to(min(ended))
        node = self.document.add(tag, {k: v or "" for k, v in attrs}, self.open[-1])
        if tag in VOID:
            self._alone(node)
        else:
            self.depths.setdefault(tag, []).append(len(self.open))
            self.open.append(node)
            self.hidden += tag in ("script", "style")

    def _alone(self, node: Node) -> None:
        if node.tag == "br" and not self.hidden:
            self.document.pieces.append(None)
        self.document.close(node)

    def handle_startendtag(self, tag, attrs):
        self._alone(self.document.add(tag, {k: v or "" for k, v in attrs}, self.open[-1]))

    def handle_endtag(self, tag):
        depth = self._deepest(tag)
        if depth:
            self._close_to(depth)

    def handle_data(self, data):
        if not self.hidden:
            self.document.pieces.append(data)
            self.open[-1].said.append(data)


def parse(html: str) -> Node:
    """The root of a document's tree; malformed markup never fails, unclosed elements end where they must."""
    builder = _Builder()
    builder.feed(html)
    builder.close()
    builder._close_to(0)
    return builder.document.nodes[0]
