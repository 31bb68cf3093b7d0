"""A small tolerant reader of HTML: elements in page order with their text."""

from __future__ import annotations

import re
from html import unescape

#: Fixed values of the HTML language.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("script style template noscript head title svg math iframe object button select textarea option optgroup datalist audio video canvas".split())
RAW = frozenset("script style textarea title noscript iframe template svg math".split())
INLINE = frozenset("a abbr b bdi bdo cite code data del dfn em font i img input ins kbd label mark q s samp small span strong sub sup time tt u var wbr button select option textarea".split())
CLOSED_BY = {
    "p": frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split()),
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "option": frozenset(["option"]),
    "tr": frozenset(["tr", "tbody", "tfoot"]), "td": frozenset(["td", "th", "tr", "tbody", "tfoot"]), "th": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "head": frozenset(["body"]),
}
_WALL = frozenset(["table", "ul", "ol", "div", "section", "article", "td", "body"])
#: A quoted value ends at a quote that blank, slash or the end of the tag follows; a quote that is never closed so is a character like others.
_TAG = re.compile(r"<!--.*?(?:-->|$)|<(?:[!?][^>]*(?:>|$))|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"(?=[\s/>]|$)|'[^']*'(?=[\s/>]|$)|[\"'])*+)(?:>|$)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"'<>]+)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)")
_TOKEN = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]*")
_NAMED = frozenset(["class", "id", "role", "itemprop", "aria-label"])


class Node:
    """An element. ``items``: its texts (str) and child elements in order. ``outer``: the nearest element that is not inline, ``wall`` and ``table``: depth of the nearest of those, itself included."""

    __slots__ = ("tag", "tokens", "parent", "items", "depth", "outer", "wall", "table")

    def __init__(self, tag: str, tokens: list[str], parent: Node | None):
        self.tag, self.tokens, self.parent, self.items = tag, tokens, parent, []
        self.depth = parent.depth + 1 if parent else 0
        self.outer = parent.outer if parent and tag in INLINE else self
        self.wall = self.depth if tag in _WALL else parent.wall if parent else -1
        self.table = self.depth if tag == "table" else parent.table if parent else -1


def _tokens(attributes: str) -> list[str]:
    out = []
    for name, value in _ATTRIBUTE.findall(attributes):
        if name.lower() in _NAMED:
            out += [t.lower() for t in _TOKEN.findall(value)]
    return out


def parse(html: str | None) -> Node:
    """The page's tree. Unclosed and stray tags are tolerated, a slash closes nothing; comments, scripts and the like leave no text.

    Each element is opened and left once, and no tag walks over what stays open, so time grows with the page.
    """
    root = at = Node("#page", [], None)
    opened: dict[str, list[Node]] = {}

    def leave(node: Node) -> Node:
        """Close all that is open in ``node`` and itself."""
        inner = at
        while inner is not node.parent:
            opened[inner.tag].pop()
            inner = inner.parent
        return node.parent

    pos, text, n = 0, html or "", len(html or "")
    while pos < n:
        m = _TAG.search(text, pos)
        if m is None:
            at.items.append(unescape(text[pos:]))
            break
        if m.start() > pos:
            at.items.append(unescape(text[pos : m.start()]))
        pos = max(m.end(), pos + 1)
        if m.group(2) is None:
            continue
        tag = m.group(2).lower()
        if m.group(1):
            node = opened[tag][-1] if opened.get(tag) else None
            if node and not (tag in INLINE and at.wall > node.depth or tag in ("p", "div", "li") and at.table > node.depth):
                at = leave(node)
            continue
        if tag not in INLINE:
            node = at.outer
            while tag in CLOSED_BY.get(node.tag, ()):
                at = leave(node)
                node = at.outer
        child = Node(tag, _tokens(m.group(3) or ""), at)
        at.items.append(child)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(text, pos)
            stop = end.start() if end else n
            if tag not in HIDDEN:
                child.items.append(unescape(text[pos:stop]))
            pos = end.end() if end else n
        elif tag not in VOID:
            opened.setdefault(tag, []).append(child)
            at = child
    return root
