"""A small page tree on the standard parser: elements with attributes, their children in order, visible text."""

from __future__ import annotations

import json
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: An opening tag that ends the open elements of the same kind, up to the container that holds them.
ENDS = {"li": ({"li"}, {"ul", "ol"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"table"}), "th": ({"td", "th"}, {"table"}), "p": ({"p"}, {"div", "td", "li", "section", "body"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"})}
HIDDEN = frozenset(("script", "style", "noscript", "template"))


class Node:
    """An element; text children are plain strings."""

    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None) -> None:
        self.tag, self.attrs, self.children, self.parent = tag, attrs, [], parent

    def walk(self) -> Iterator[Node]:
        stack = [iter(self.children)]
        while stack:
            for child in stack[-1]:
                if isinstance(child, Node):
                    yield child
                    stack.append(iter(child.children))
                    break
            else:
                stack.pop()

    def all(self, tag: str | None = None, cls: str | None = None, **attrs: str | bool) -> list[Node]:
        """Descendants by tag, class and attributes (`_` stands for `-`; True: present), in the order of the page."""
        return [n for n in self.walk() if n.fits(tag, cls, **attrs)]

    def first(self, tag: str | None = None, cls: str | None = None, **attrs: str | bool) -> Node | None:
        return next((n for n in self.walk() if n.fits(tag, cls, **attrs)), None)

    def fits(self, tag: str | None = None, cls: str | None = None, **attrs: str | bool) -> bool:
        if tag and self.tag != tag or cls and cls not in self.attrs.get("class", "").split():
            return False
        own = {k.rstrip("_").replace("_", "-"): v for k, v in attrs.items()}
        return all(k in self.attrs if v is True else self.attrs.get(k) == v for k, v in own.items())

    def own(self, tag: str | None = None) -> list[Node]:
        return [c for c in self.children if isinstance(c, Node) and (not tag or c.tag == tag)]

    def following(self) -> list[Node]:
        """The elements after this one below the same parent."""
        own = self.parent.own() if self.parent else []
        return own[next((i for i, n in enumerate(own) if n is self), len(own)) + 1 :]

    def pieces(self) -> Iterator[str]:
        stack: list = [self]
        while stack:
            n = stack.pop()
            if isinstance(n, str):
                if n.strip():
                    yield n.strip()
            elif n.tag not in HIDDEN or n is self:
                stack.extend(reversed(n.children))

    def text(self) -> str:
        """Visible text, pieces joined by single spaces, white space squeezed."""
        return " ".join(" ".join(self.pieces()).split())


class _Tree(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.open = Node("", {}, None)

    def handle_starttag(self, tag, attrs):
        kinds, stops = ENDS.get(tag, (set(), set()))
        at, last = self.open, None
        while kinds and at.parent and at.tag not in stops:
            if at.tag in kinds:
                last = at
            at = at.parent
        if last:
            self.open = last.parent
        node = Node(tag, {k: v or "" for k, v in attrs}, self.open)
        self.open.children.append(node)
        if tag not in VOID:
            self.open = node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        at = self.open
        while at.parent and at.tag != tag:
            at = at.parent
        if at.parent:
            self.open = at.parent

    def handle_data(self, data):
        self.open.children.append(data)


def tree(page: str | None) -> Node:
    """The root of a page; unclosed and stray tags are mended, an empty page has no elements."""
    parser = _Tree()
    parser.feed(page or "")
    parser.close()
    return parser.root


def direct_rows(table: Node) -> list[list[Node]]:
    """Cells of the rows a table owns itself, not of tables nested in it."""
    groups = [table, *[g for g in table.own() if g.tag in ("tbody", "thead", "tfoot")]]
    return [row.own("td") for g in groups for row in g.own("tr")]


def section(root: Node, heading: str) -> Node | None:
    """The content block right behind a named heading of a catalog page."""
    places = [h for box in root.all("div", "summary") for h in box.all() if h.tag in ("h2", "h3")]
    places += [h for box in root.all("div", id="book-detail-extras") for h in box.all("h3")]
    for h in places:
        after = h.following()[:1]
        if h.text().casefold() == heading.casefold() and after and after[0].fits("div", "content"):
            return after[0]
    return None


def structured(root: Node, kind: str = "Book") -> list[dict]:
    """Objects of one type in the JSON-LD scripts of a page; broken scripts are passed over."""
    found = []
    for script in root.all("script", type="application/ld+json"):
        try:
            value = json.loads("".join(c for c in script.children if isinstance(c, str)))
        except ValueError:
            continue
        for item in value if isinstance(value, list) else [value]:
            types = item.get("@type") if isinstance(item, dict) else None
            if kind in (types if isinstance(types, list) else [types]):
                found.append(item)
    return found


def element_counts(html: Column, tags: tuple[str, ...]) -> Column:
    """How many elements of each tag a page has, in the order of the tags; an absent page has none."""

    @F.pandas_udf("array<int>")
    def run(pages: pd.Series) -> pd.Series:
        roots = [tree(p if isinstance(p, str) else None) for p in pages]
        return pd.Series([[len(r.all(t)) for t in tags] for r in roots])

    return run(html)
