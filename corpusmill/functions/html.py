"""HTML trees on the standard library's parser, and pure functions over them.

Void elements never nest, an end tag closes up to its nearest open element (and is ignored without one), script and style
hold raw text. Serialisation is our own canonical form: attributes in order, double quotes, no added white space; text keeps
the character references that it was written with.
"""

from __future__ import annotations

import html
import re
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset(("script", "style"))
#: The end of a text that could become a tag or a character reference with the text after it.
_OPEN = re.compile(r"<$|&[^\s;<>&]*$")


class Node:
    """An element, or text (tag None; ``written``: as the source has it), a comment or declaration (tag ``!``)."""

    __slots__ = ("attrs", "children", "parent", "tag", "text", "written")

    def __init__(self, tag: str | None, attrs: dict[str, str | None] | None = None, text: str = "", written: str | None = None):
        self.tag, self.attrs, self.text, self.written = tag, attrs or {}, text, written
        self.children: list[Node] = []
        self.parent: Node | None = None

    def append(self, child: Node | str) -> Node:
        child = Node(None, text=child) if isinstance(child, str) else child
        child.parent = self
        self.children.append(child)
        return self

    def remove(self) -> None:
        if self.parent is not None:
            self.parent.children.remove(self)
            self.parent = None

    def replace(self, other: Node) -> None:
        at = self.parent.children.index(self)
        other.parent, self.parent.children[at] = self.parent, other
        self.parent = None

    def walk(self) -> Iterator[Node]:
        """Elements below this one in document order, without recursion."""
        stack = self.children[::-1]
        while stack:
            node = stack.pop()
            if node.tag not in (None, "!"):
                yield node
                stack.extend(node.children[::-1])

    def find(self, test: str | Callable[[Node], bool]) -> Node | None:
        return next(self.find_all(test), None)

    def find_all(self, test: str | Callable[[Node], bool]) -> Iterator[Node]:
        match = (lambda n: n.tag == test) if isinstance(test, str) else test
        return (n for n in self.walk() if match(n))

    @property
    def classes(self) -> list[str]:
        return (self.attrs.get("class") or "").split()

    def texts(self) -> Iterator[Node]:
        """Texts below this one in document order."""
        stack = [self]
        while stack:
            node = stack.pop()
            if node.tag is None:
                yield node
            stack.extend(node.children[::-1])

    def all_text(self) -> str:
        return "".join(n.text for n in self.texts())

    def serialise(self) -> str:
        out: list[str] = []
        stack: list[Node | str] = [self]
        before = None  # the text just written
        while stack:
            node = stack.pop()
            if isinstance(node, Node) and node.tag is None:
                if node.parent is not None and node.parent.tag in RAW:
                    out.append(node.text)
                else:
                    if before is not None and _OPEN.search(out[-1]):  # what stood between is gone
                        out[-1] = html.escape(before.text, quote=False)
                    out.append(html.escape(node.text, quote=False) if node.written is None else node.written)
                    before = node
                continue
            before = None
            if isinstance(node, str):
                out.append(node)
            elif node.tag == "!":
                out.append(node.text)
            else:
                if node.tag:
                    out.append("<" + node.tag + "".join(f" {k}" if v is None else f' {k}="{html.escape(v)}"' for k, v in node.attrs.items()) + ">")
                    if node.tag not in VOID:
                        stack.append(f"</{node.tag}>")
                stack.extend(node.children[::-1])
        return "".join(out)


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("")
        self.open = [self.root]
        self.last: tuple[Node, int, list[str]] | None = None  # the text that is being read, where it begins, its parts

    def read(self, source: str) -> Node:
        self.source, self.lines = source, [0, *(m.end() for m in re.finditer("\n", source))]
        self.feed(source)
        self.close()
        self._text_ends(len(source))
        return self.root

    def _at(self) -> int:
        line, offset = self.getpos()
        return self.lines[line - 1] + offset

    def _text_ends(self, at: int | None = None) -> None:
        if self.last is not None:
            node, begin, parts = self.last
            node.text = "".join(parts)
            written = self.source[begin : self._at() if at is None else at]
            if html.unescape(written) == node.text:  # else it holds more than text
                node.written = written
            self.last = None

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self._text_ends()
        node = Node(tag, dict(attrs))
        self.open[-1].append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self._text_ends()
        self.open[-1].append(Node(tag, dict(attrs)))

    def handle_endtag(self, tag: str) -> None:
        self._text_ends()
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                return

    def handle_data(self, data: str) -> None:
        if self.last is not None:
            self.last[2].append(data)
        else:
            self.last = Node(None), self._at(), [data]
            self.open[-1].append(self.last[0])

    def handle_comment(self, data: str) -> None:
        self._text_ends()
        self.open[-1].append(Node("!", text=f"<!--{data}-->"))

    def handle_decl(self, decl: str) -> None:
        self._text_ends()
        self.open[-1].append(Node("!", text=f"<!{decl}>"))

    def handle_pi(self, data: str) -> None:
        self._text_ends()

    def unknown_decl(self, data: str) -> None:
        self._text_ends()


def parse(text: str | None) -> Node:
    """The tree of a document; a null text is empty. Parsing never fails."""
    return _Builder().read(text or "")


@F.pandas_udf(T.StringType())
def _unescape(text: pd.Series) -> pd.Series:
    return text.map(lambda t: None if t is None else html.unescape(t))


def unescaped(text: Column) -> Column:
    """Text with character references resolved, as the parser does in attribute values."""
    return F.when(text.contains("&"), _unescape(text)).otherwise(text)


def element(tag: str, attrs: dict[str, str | None] | None = None, *children: Node | str) -> Node:
    node = Node(tag, attrs)
    for child in children:
        node.append(child)
    return node


def drop(root: Node, test: Callable[[Node], bool]) -> Node:
    for node in list(root.find_all(test)):
        node.remove()
    return root


def drop_code(root: Node) -> Node:
    """Scripts and style sheets, inline or linked."""
    return drop(root, lambda n: n.tag in RAW or n.tag == "link" and "stylesheet" in (n.attrs.get("rel") or "").lower())


def links(root: Node, tags: tuple[str, ...] | None = ("a",), attrs: tuple[str, ...] = ("href",)) -> list[tuple[int, str, str, str]]:
    """(ordinal, tag, attribute, url) of non-empty urls in document order, repeats included; tags None: any."""
    found = [(n.tag, a, n.attrs[a]) for n in root.walk() if tags is None or n.tag in tags for a in attrs if n.attrs.get(a)]
    return [(i, *x) for i, x in enumerate(found)]
