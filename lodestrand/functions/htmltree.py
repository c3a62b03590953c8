"""A tolerant HTML tree and the CSS selectors that source configurations use, in plain Python.

The tree follows the HTML5 rules that matter for extraction: void elements, implied end tags, raw text of scripts, and
end tags without a start. It never fails on malformed input.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from html import unescape
from html.parser import HTMLParser

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_CLOSES_P = {
    "address", "article", "aside", "blockquote", "center", "details", "dialog", "dir", "div", "dl", "fieldset", "figcaption", "figure",
    "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "main", "menu", "nav", "ol", "p", "pre", "search",
    "section", "summary", "table", "ul",
}
#: A start tag ends open elements of these names, up to a border.
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "tbody": {"tbody", "thead", "tfoot", "tr", "td", "th"}, "tfoot": {"tbody", "thead", "tr", "td", "th"}}
_BORDER = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "option": {"select"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "tbody": {"table"}, "tfoot": {"table"}}
_SCOPE = {"html", "body", "table", "td", "th", "caption", "button", "object"}
#: End tags of the names in _LIMITED close nothing beyond a table.
_LIMITED, _LOOSE, _NOTHING = {"a", "b", "i", "span", "em", "strong", "li", "div"}, {"table"}, set()
#: Names whose content is no markup.
_RAW = {"script", "style", "title", "textarea", "xmp", "iframe", "noembed", "noframes", "noscript", "plaintext"}
#: A tag as pages mostly have it: attributes quoted, no references in them. Split by it, a page gives text, stroke, name, attributes, text, ...
_TAG = re.compile(r"""<(/?)([a-zA-Z][a-zA-Z0-9]*)((?:[ \t\r\n\f]+[a-zA-Z][a-zA-Z0-9_-]*(?:=(?:"[^"<>&]*"|'[^'<>&]*'))?)*)[ \t\r\n\f]*/?>""")
_ATTR = re.compile(r"""([a-zA-Z][a-zA-Z0-9_-]*)(?:=("[^"]*"|'[^']*'))?""")


class Node:
    __slots__ = ("attrs", "children", "name", "parent")

    def __init__(self, name: str, attrs: dict[str, str], parent: Node | None):
        self.name, self.attrs, self.parent = name, attrs, parent
        self.children: list[Node | str] = []

    def walk(self) -> Iterator[Node]:
        """The elements below, in document order."""
        stack = self.children[::-1]
        while stack:
            node = stack.pop()
            if node.__class__ is Node:
                yield node
                stack += node.children[::-1]

    @property
    def text(self) -> str:
        """All text below, that of scripts and styles included."""
        out, stack = [], self.children[::-1]
        while stack:
            node = stack.pop()
            if node.__class__ is str:
                out.append(node)
            else:
                stack += node.children[::-1]
        return "".join(out)

    def all(self, selector: str) -> list[Node]:
        test = compiled(selector)
        return [x for x in self.walk() if test(x)]

    def one(self, selector: str) -> Node | None:
        test = compiled(selector)
        return next((x for x in self.walk() if test(x)), None)

    def after(self) -> Iterator[Node]:
        """The element siblings that follow."""
        beside = self.parent.children if self.parent else [self]
        for i in range(beside.index(self) + 1, len(beside)):
            if beside[i].__class__ is Node:
                yield beside[i]


class _Tree:
    """The tree of the tags and texts that come in order."""

    def __init__(self):
        self.root = Node("#root", {}, None)
        self.at = self.root

    def start(self, tag: str, attrs: list) -> None:
        if tag in _CLOSES_P:
            self._close("p", _SCOPE)
        if tag in _ENDS:
            self._end(_ENDS[tag], _BORDER[tag])
        node = Node(tag, {k: v or "" for k, v in reversed(attrs)}, self.at)
        self.at.children.append(node)
        if tag not in _VOID:
            self.at = node

    def end(self, tag: str) -> None:
        if tag in _VOID:
            return
        if tag == "p" and not self._close("p", _SCOPE):
            self.at.children.append(Node("p", {}, self.at))
        elif tag != "p":
            self._close(tag, _LOOSE if tag in _LIMITED else _NOTHING)

    def _close(self, tag: str, borders: set[str]) -> bool:
        node = self.at
        while node is not self.root:
            if node.name == tag:
                self.at = node.parent
                return True
            if node.name in borders:
                return False
            node = node.parent
        return False

    def _end(self, names: set[str], borders: set[str]) -> None:
        node, last = self.at, None
        while node is not self.root and node.name not in borders:
            if node.name in names:
                last = node
            node = node.parent
        if last is not None:
            self.at = last.parent


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.tree = _Tree()

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self.tree.start(tag, attrs)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.tree.start(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        self.tree.end(tag)

    def handle_data(self, data: str) -> None:
        self.tree.at.children.append(data)

    def unknown_decl(self, data: str) -> None:
        return


def _plain(html: str) -> Node | None:
    """The tree of a page whose every ``<`` opens a plain tag; null of any other page, which is for the whole parser."""
    bits = _TAG.split(html)
    if html.count("<") != len(bits) // 4:
        return None
    tree = _Tree()
    if bits[0]:
        tree.root.children.append(unescape(bits[0]))
    for i in range(1, len(bits), 4):
        name, attrs, text = bits[i + 1].lower(), bits[i + 2], bits[i + 3]
        if name in _RAW or bits[i] and attrs:
            return None
        if bits[i]:
            tree.end(name)
        else:
            tree.start(name, [(k.lower(), v[1:-1]) for k, v in _ATTR.findall(attrs)] if attrs else ())
        if text:
            tree.at.children.append(unescape(text) if "&" in text else text)
    return tree.root


def parse(html: str | None) -> Node:
    root = _plain(html or "")
    if root is None:
        builder = _Builder()
        builder.feed(html)
        builder.close()
        root = builder.tree.root
    return root


def squeezed(text: str) -> str:
    return " ".join(text.split())


def fragment_text(html: str | None) -> str | None:
    """The text of a fragment: tags gone, entities decoded."""
    if html is None or ("<" not in html and "&" not in html):
        return html
    return parse(html).text


_SIMPLE = re.compile(r"""\s*(?:(>)\s*)?((?:[\w-]+|\*)?(?:[.#][\w-]+|\[[^\]]+\])*)""")
_PART = re.compile(r"""([.#])([\w-]+)|\[\s*([\w-]+)\s*(?:([~^$*|]?=)\s*(?:"([^"]*)"|'([^']*)'|([^\]\s]*)))?\s*\]""")


@lru_cache(maxsize=1024)
def compiled(selector: str):
    """A test of one node for a selector list: names, classes, ids, attribute tests, descendants and children."""
    tests = [_test(_chain(x)) for x in selector.split(",") if x.strip()]
    return tests[0] if len(tests) == 1 else lambda node: any(t(node) for t in tests)


def _test(chain: list):
    _, name, parts = chain[-1]
    if len(chain) == 1 and not parts:
        return lambda node: not name or node.name == name
    if len(chain) == 1 and not name and len(parts) == 1 and parts[0][0] == ".":
        word = parts[0][1]
        return lambda node: "class" in node.attrs and word in node.attrs["class"].split()
    return lambda node: _matches(node, chain)


def _chain(selector: str) -> list[tuple[bool, str, list]]:
    out, at, selector = [], 0, selector.strip()
    while at < len(selector):
        m = _SIMPLE.match(selector, at)
        if not m or not m[2]:
            raise ValueError(f"unknown selector {selector!r}")
        name = re.match(r"[\w-]+|\*", m[2])
        rest = m[2][name.end() :] if name else m[2]
        out.append((bool(m[1]), name[0].lower() if name and name[0] != "*" else "", [p.groups() for p in _PART.finditer(rest)]))
        at = m.end()
        while at < len(selector) and selector[at].isspace():
            at += 1
    return out


def _fits(node: Node, name: str, parts: list) -> bool:
    if name and node.name != name:
        return False
    for mark, word, attr, op, *values in parts:
        if mark == ".":
            ok = word in node.attrs.get("class", "").split()
        elif mark == "#":
            ok = node.attrs.get("id") == word
        else:
            own, want = node.attrs.get(attr.lower()), next((v for v in values if v is not None), "")
            ok = own is not None and _compared(op, own, want)
        if not ok:
            return False
    return True


def _compared(op: str | None, own: str, want: str) -> bool:
    match op:
        case None:
            return True
        case "=":
            return own == want
        case "^=":
            return bool(want) and own.startswith(want)
        case "$=":
            return bool(want) and own.endswith(want)
        case "*=":
            return bool(want) and want in own
        case "~=":
            return want in own.split()
    return own == want or own.startswith(want + "-")


def _matches(node: Node, chain: list) -> bool:
    if not _fits(node, *chain[-1][1:]):
        return False
    return len(chain) == 1 or _above(node, chain[:-1], chain[-1][0])


def _above(node: Node, chain: list, child: bool) -> bool:
    up = node.parent
    while up is not None and up.name != "#root":
        if _matches(up, chain):
            return True
        if child:
            return False
        up = up.parent
    return False
