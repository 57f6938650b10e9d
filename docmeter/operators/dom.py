"""A small document tree over the standard library's HTML parser, for element and link tables."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
RAW = {"script", "style"}
#: An open element that a new tag ends.
CLOSED_BY = {
    "li": {"li"}, "p": {"p", "div", "ul", "ol", "table", "h1", "h2", "h3", "h4", "h5", "h6", "section", "article", "nav", "form"},
    "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "tr": {"tr", "tbody", "tfoot"}, "option": {"option"},
}


class Node:
    """tag None: text; ``#doc``: the root; ``#raw``: a declaration or comment kept as it is."""

    __slots__ = ("tag", "attrs", "children", "parent", "text")

    def __init__(self, tag: str | None, attrs: dict[str, str | None] | None = None, text: str = ""):
        self.tag, self.attrs, self.text = tag, attrs if attrs is not None else {}, text
        self.children: list[Node] = []
        self.parent: Node | None = None

    def add(self, child: Node, at: int | None = None) -> Node:
        child.parent = self
        self.children.insert(len(self.children) if at is None else at, child)
        return child

    def walk(self) -> Iterator[Node]:
        stack = list(reversed(self.children))
        while stack:
            n = stack.pop()
            yield n
            stack.extend(reversed(n.children))

    def all(self, *tags: str) -> list[Node]:
        return [n for n in self.walk() if n.tag in tags]

    def inner_text(self) -> str:
        return " ".join("".join(n.text for n in self.walk() if n.tag is None and (n.parent is None or n.parent.tag not in RAW)).split())

    def get(self, name: str) -> str:
        return self.attrs.get(name) or ""


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("#doc")

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in CLOSED_BY.get(self.at.tag or "", ()):
            self.at = self.at.parent
        node = self.at.add(Node(tag, dict(attrs)))
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.at.add(Node(tag, dict(attrs)))

    def handle_endtag(self, tag: str) -> None:
        n = self.at
        while n is not None and n.tag != tag:
            n = n.parent
        if n is not None and n.parent is not None:
            self.at = n.parent

    def handle_data(self, data: str) -> None:
        self.at.add(Node(None, text=data))

    def handle_decl(self, decl: str) -> None:
        self.at.add(Node("#raw", text=f"<!{decl}>"))

    def handle_comment(self, data: str) -> None:
        self.at.add(Node("#raw", text=f"<!--{data}-->"))


def parse(html: str) -> Node:
    b = _Builder()
    b.feed(html)
    b.close()
    return b.root


def links(html: str) -> list[tuple[int, str, str]]:
    """(index, text, target) of each a with href in order. A link without text goes by its aria-label, its images' alt or its title; a link left open ends at the next."""
    out = []
    for a in parse(html).all("a"):
        if "href" not in a.attrs:
            continue
        parts, alts, stack = [], [], list(reversed(a.children))
        while stack:
            n = stack.pop()
            if n.tag is None:
                parts.append(n.text)
            elif n.tag == "img":
                alts.append(n.get("alt"))
            if n.tag != "a" and n.tag not in RAW:
                stack.extend(reversed(n.children))
        names = ("".join(parts), a.get("aria-label"), " ".join(alts), a.get("title"))
        out.append((len(out), next((t for t in (" ".join(x.split()) for x in names) if t), ""), a.get("href")))
    return out


def tokens(html: str) -> list[tuple[int, int, str, dict[str, str], str]]:
    """(seq, depth, tag, attributes, text below) of each element in order."""
    out, stack = [], [(c, 0) for c in reversed(parse(html).children)]
    while stack:
        n, depth = stack.pop()
        if n.tag and n.tag[0] != "#":
            out.append((len(out), depth, n.tag, {k: v or "" for k, v in n.attrs.items()}, n.inner_text()))
        stack.extend((c, depth + 1) for c in reversed(n.children))
    return out
