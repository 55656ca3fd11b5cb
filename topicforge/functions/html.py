"""Per-page HTML helpers used inside ``mapInPandas``.

Spark has no HTML parser, so each task parses its own pages with the
standard library's ``html.parser`` into a light element tree and matches the
small selector grammar the site configuration uses: ``tag``, ``.class``,
``#id``, compounds such as ``tag.class``, descendant combinators (space) and
comma lists.

Parsing choices (the reference parser's): ``<script>``/``<style>`` text and
comments are not text; no tag is closed implicitly, so an unclosed ``<p>`` or
``<li>`` holds what follows; stray end tags are ignored.  A text node runs up
to the next tag or comment.  Text of an element is its text nodes, each
stripped, empty ones dropped, concatenated with ``separator`` (default:
nothing, which glues words across inline tags).  Trees of any depth are walked
without recursion.
"""

from __future__ import annotations

import re
from collections import Counter
from html.parser import HTMLParser
from urllib.parse import urljoin

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_SKIP_TEXT = frozenset(("script", "style", "template"))


class Node:
    __slots__ = ("tag", "attrs", "classes", "children", "parent")

    def __init__(self, tag, attrs, parent):
        self.tag = tag
        self.attrs = attrs
        self.classes = attrs.get("class", "").split() if attrs.get("class") else []
        self.children = []
        self.parent = parent

    def iter(self):
        """Elements below this one, document order."""
        todo = self.children[::-1]
        while todo:
            c = todo.pop()
            if isinstance(c, Node):
                yield c
                todo.extend(reversed(c.children))

    def strings(self):
        todo = self.children[::-1]
        while todo:
            c = todo.pop()
            if not isinstance(c, Node):
                yield c
            elif c.tag not in _SKIP_TEXT:
                todo.extend(reversed(c.children))

    def text(self, separator: str = "", strip: bool = True) -> str:
        parts = (s.strip() for s in self.strings()) if strip else self.strings()
        return separator.join(p for p in parts if p)


class _TreeBuilder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("[document]", {}, None)
        self.stack = [self.root]
        self.open_tags = Counter()
        self.text_parts = []

    def _end_text(self, *_):
        if self.text_parts:
            self.stack[-1].children.append("".join(self.text_parts))
            self.text_parts = []

    handle_comment = handle_decl = handle_pi = unknown_decl = _end_text

    def _add(self, tag, attrs):
        self._end_text()
        node = Node(tag, {k: ("" if v is None else v) for k, v in attrs}, self.stack[-1])
        self.stack[-1].children.append(node)
        return node

    def handle_starttag(self, tag, attrs):
        node = self._add(tag, attrs)
        if tag not in _VOID:
            self.stack.append(node)
            self.open_tags[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self._add(tag, attrs)

    def handle_endtag(self, tag):
        self._end_text()
        if self.open_tags[tag]:
            while True:
                closed = self.stack.pop().tag
                self.open_tags[closed] -= 1
                if closed == tag:
                    return

    def handle_data(self, data):
        self.text_parts.append(data)

    def close(self):
        super().close()
        self._end_text()


def parse(html: str | None) -> Node:
    b = _TreeBuilder()
    b.feed(html or "")
    b.close()
    return b.root


_COMPOUND = re.compile(r"([A-Za-z][A-Za-z0-9-]*|\*)?((?:[.#][A-Za-z0-9_-]+)*)$")


def _compound(sel: str):
    m = _COMPOUND.match(sel)
    if not m:
        raise ValueError(f"unsupported selector part: {sel!r}")
    tag = m.group(1)
    classes, ident = [], None
    for kind, name in re.findall(r"([.#])([A-Za-z0-9_-]+)", m.group(2) or ""):
        if kind == ".":
            classes.append(name)
        else:
            ident = name
    return (None if tag in (None, "*") else tag.lower(), tuple(classes), ident)


def _matches_one(node: Node, comp) -> bool:
    tag, classes, ident = comp
    if tag is not None and node.tag != tag:
        return False
    if ident is not None and node.attrs.get("id") != ident:
        return False
    return all(c in node.classes for c in classes)


def _matches_chain(node: Node, chain) -> bool:
    if not _matches_one(node, chain[-1]):
        return False
    anc = node.parent
    for comp in reversed(chain[:-1]):
        while anc is not None and anc.tag != "[document]" and not _matches_one(anc, comp):
            anc = anc.parent
        if anc is None or anc.tag == "[document]":
            return False
        anc = anc.parent
    return True


def compile_selector(selector: str):
    """Comma list of descendant chains of compound selectors."""
    return [tuple(_compound(p) for p in part.split()) for part in selector.split(",") if part.strip()]


def select(root: Node, selector: str) -> list[Node]:
    """Every matching element in document order (each once)."""
    chains = compile_selector(selector)
    return [n for n in root.iter() if any(_matches_chain(n, c) for c in chains)]


def select_one(root: Node, selector: str) -> Node | None:
    chains = compile_selector(selector)
    for n in root.iter():
        if any(_matches_chain(n, c) for c in chains):
            return n
    return None


def article_links(root: Node, page_url: str, selectors: list[str]):
    """``(selector_ix, pos, href, link)`` for every matching tag with
    an ``href``, selectors in list order, document order within each; ``link``
    is the href resolved against the page URL."""
    out = []
    for si, sel in enumerate(selectors):
        pos = 0
        for n in select(root, sel):
            if "href" in n.attrs:
                href = n.attrs["href"]
                out.append((si, pos, href, urljoin(page_url, href)))
                pos += 1
    return out


def article_fields(root: Node, title_sel: str, desc_sel: str, content_sel: str,
                   missing_title: str, separator: str = ""):
    """(title, description, content); content joins every matching
    element's text with a newline (an empty paragraph still adds a line)."""
    t = select_one(root, title_sel)
    d = select_one(root, desc_sel)
    title = t.text(separator) if t is not None else missing_title
    desc = d.text(separator) if d is not None else ""
    content = "\n".join(n.text(separator) for n in select(root, content_sel))
    return title, desc, content
