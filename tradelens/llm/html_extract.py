"""Main text of web pages: boosted trees over DOM-node features with hierarchical decoding."""

from __future__ import annotations

import re
from functools import cache
from itertools import groupby

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelens.llm.boosting import BoostedTrees
from tradelens.llm.common import slices
from tradelens.llm.html_tree import HIDDEN, INLINE, Node, parse

#: Pages that are composed for training.
LAYOUTS = 900
#: Log odds that a node with text of both kinds costs against deciding it as a whole.
MIXED_COST = 1.0
_BLANK = re.compile(r"\s+")
_TAGS = ("p", "li", "a", "nav", "footer", "header", "aside", "article", "main", "form", "section", "h1", "h2", "h3", "ul", "td", "figure", "blockquote", "pre", "span")


def _is_block(item) -> bool:
    return isinstance(item, Node) and item.tag not in INLINE and item.tag not in HIDDEN and item.tag != "br"


class Page:
    """Elements of a page with their own runs of text and the features of their subtrees.

    Elements are blocks, and inline elements that carry a class, an id or the like: those can be decided
    apart from the text around them, but do not divide its block.
    """

    def __init__(self, html: str | None):
        self.nodes: list[Node] = []
        self.parent: list[int] = []
        self.inline: list[bool] = []
        self.own_links: list[int] = []
        self.runs: list[tuple[int, str, int]] = []  # (element, its text, number of the block) in page order
        self._walk(parse(html))

    def _add(self, node: Node, parent: int, inline: bool) -> int:
        self.nodes.append(node), self.parent.append(parent), self.inline.append(inline), self.own_links.append(0)
        return len(self.nodes) - 1

    def _parts(self, node: Node, own: int) -> list[tuple]:
        """(element, text) runs and (element, block below it) in page order."""
        parts, stack = [], [(c, own, False) for c in reversed(node.items)]
        while stack:
            item, at, link = stack.pop()
            if isinstance(item, str):
                parts.append((at, item))
                if link:
                    self.own_links[at] += len(" ".join(item.split()))
            elif item.tag == "br":
                parts.append((at, " "))
            elif item.tag in HIDDEN:
                continue
            elif item.tag in INLINE and not any(map(_is_block, item.items)):
                inner = self._add(item, at, True) if item.tokens and item.items else at
                stack += [(c, inner, link or item.tag in ("a", "label")) for c in reversed(item.items)]
            else:
                parts.append((at, item))  # an inline element around blocks counts as a block
        return parts

    def _walk(self, root: Node) -> None:
        # one frame per element: its parts, and how far they are read
        def enter(node: Node, parent: int):
            return [self._parts(node, self._add(node, parent, False)), 0]

        stack, block = [enter(root, -1)], 0
        while stack:
            parts, at = stack[-1]
            start = at
            while at < len(parts) and isinstance(parts[at][1], str):
                at += 1
            if any(not t.isspace() and t for _, t in parts[start:at]):
                for own, group in groupby(parts[start:at], key=lambda p: p[0]):
                    self.runs.append((own, _BLANK.sub(" ", "".join(t for _, t in group)), block))
                block += 1
            if at < len(parts):
                stack[-1][1] = at + 1
                stack.append(enter(parts[at][1], parts[at][0]))
            else:
                stack.pop()

    def features(self, evidence: dict[str, float]) -> np.ndarray:
        n = len(self.nodes)
        own_text, own_words, own_blocks, own_stops = np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n)
        first = np.full(n, -1.0)
        total = 0
        for k, text, _ in self.runs:
            own_text[k] += len(text)
            own_words[k] += text.count(" ") + 1
            own_blocks[k] += 1
            own_stops[k] += text.count(".") + text.count(",")
            if first[k] < 0:
                first[k] = total
            total += len(text)
        parent = np.array(self.parent)
        sub = np.stack([own_text, own_words, own_blocks, own_stops, np.array(self.own_links, float), np.ones(n)], axis=1)
        start = np.where(first < 0, np.inf, first)
        children, same = np.zeros(n), np.zeros(n)
        for k in range(n - 1, 0, -1):
            sub[parent[k]] += sub[k]
            start[parent[k]] = min(start[parent[k]], start[k])
            children[parent[k]] += 1
        index = np.zeros(n)
        seen: dict = {}
        for k in range(1, n):
            index[k] = seen.get(parent[k], 0)
            seen[parent[k]] = index[k] + 1
            key = (parent[k], self.nodes[k].tag)
            seen[key] = seen.get(key, 0) + 1
        for k in range(1, n):
            same[k] = seen[(parent[k], self.nodes[k].tag)]
        up = np.maximum(parent, 0)
        own_evidence = np.array([sum((evidence.get(t, 0.0) for t in node.tokens), evidence.get(f"<{node.tag}>", 0.0)) for node in self.nodes])
        least, most = own_evidence.copy(), own_evidence.copy()
        for k in range(1, n):
            least[k], most[k] = min(least[k], least[parent[k]]), max(most[k], most[parent[k]])
        text, words, blocks, stops, links, tags = sub.T
        whole = max(1.0, text[0])
        tag = np.array([_TAGS.index(node.tag) if node.tag in _TAGS else -1 for node in self.nodes])
        columns = [
            text, words, text / tags, links / np.maximum(text, 1), stops / np.maximum(words, 1), words / np.maximum(blocks, 1), text / whole,
            np.where(np.isinf(start), total, start) / whole, np.array([node.depth for node in self.nodes]), index, index / np.maximum(children[up], 1), same, children,
            own_evidence, least, most, own_evidence[up], (text / tags)[up], text / np.maximum(text[up], 1), links[up] / np.maximum(text[up], 1), tag, own_text / np.maximum(text, 1),
            np.array(self.inline, float),
        ]
        return np.stack(columns, axis=1)

    def decode(self, odds: np.ndarray) -> list[str]:
        """Blocks of the main text under the consistent choice of highest total log odds.

        Each element is decided as main, as other, or as mixed; only a mixed element lets its children be decided
        for themselves, so nothing below an element can contradict it.
        """
        n = len(self.nodes)
        size = np.zeros(n)
        for k, text, _ in self.runs:
            size[k] += len(text)
        weight = np.log1p(size)
        sub = weight.copy()
        for k in range(n - 1, 0, -1):
            sub[self.parent[k]] += sub[k]
        log_main, log_other = -np.logaddexp(0, -odds), -np.logaddexp(0, odds)
        main, other = log_main * (sub > 0), log_other * (sub > 0)
        mixed = np.maximum(log_main, log_other) * weight / np.maximum(weight, 1e-9) * (size > 0) - MIXED_COST
        for k in range(n - 1, 0, -1):
            up = self.parent[k]
            main[up] += main[k]
            other[up] += other[k]
            mixed[up] += max(main[k], other[k], mixed[k])
        choice = np.empty(n, object)
        for k in range(n):
            above = choice[self.parent[k]] if k else "mixed"
            if above != "mixed":
                choice[k] = above
            else:
                choice[k] = ("main", "other", "mixed")[int(np.argmax([main[k], other[k], mixed[k]]))]
        keep = [c == "main" or c == "mixed" and odds[k] > 0 for k, c in enumerate(choice)]
        return self.blocks(lambda k, text: keep[k])

    def blocks(self, kept) -> list[str]:
        """Texts of the blocks, of their kept runs."""
        out = []
        for _, runs in groupby(self.runs, key=lambda r: r[2]):
            text = _BLANK.sub(" ", "".join(t for k, t, _ in runs if kept(k, t))).strip()
            if text:
                out.append(text)
        return out


class Layouts:
    """Composes pages whose main text is known. The lists are common names in web pages, fixed values."""

    MAIN = "article content post entry story main text body page single blog news detail prose".split()
    OTHER = {
        "nav": "nav menu navbar navigation topnav links breadcrumb breadcrumbs tabs".split(),
        "header": "header masthead banner top brand logo site-header".split(),
        "footer": "footer bottom copyright site-footer legal colophon".split(),
        "aside": "sidebar aside widget related recommended popular trending more rail promo".split(),
        "notice": "notice cookie consent banner alert popup modal gdpr message newsletter subscribe".split(),
        "ad": "ad ads advert advertisement sponsor sponsored promo adsense banner".split(),
        "form": "form search login signup subscribe contact field".split(),
        "comments": "comments comment discussion replies reply disqus respond thread".split(),
        "share": "share social tags meta byline author tools pagination".split(),
    }
    INLINE_MAIN = "highlight term link keyword emphasis dropcap lead quote ref inline name place".split()
    INLINE_OTHER = "ad ads sponsored promo share count reply comment edit permalink tooltip badge label follow subscribe related".split()

    def __init__(self, seed: int = 9):
        self.rng = np.random.default_rng(seed)
        letters = np.array(list("etaoinshrdlcumwfgypbvkjxqz"))
        # only lengths of words matter to the features
        self.words = ["".join(letters[self.rng.integers(0, 26, n)]) for n in self.rng.integers(1, 13, 600)]

    def prose(self, low: int, high: int) -> str:
        n = int(self.rng.integers(low, high + 1))
        picked = [self.words[i] for i in self.rng.integers(0, len(self.words), n)]
        return " ".join(w + ("." if self.rng.random() < 0.1 else "") for w in picked)

    def main(self, low: int, high: int) -> str:
        """Main text, at times with an inline element inside that is main or not."""
        if high < 4 or self.rng.random() < 0.7:
            return f"\x01{self.prose(low, high)}"
        if self.rng.random() < 0.5:
            tag, names, mark = self.pick(["span", "a", "em", "strong", "abbr"]), self.INLINE_MAIN, "\x01"
        else:
            tag, names, mark = self.pick(["span", "a", "small", "span"]), self.INLINE_OTHER, ""
        name = " ".join(self.pick(names) for _ in range(int(self.rng.integers(1, 3))))
        inside = f'<{tag} {self.pick(["class", "class", "id"])}="{name}">{mark}{self.prose(1, 5)}</{tag}>'
        return f"\x01{self.prose(low, high // 2)} {inside} \x01{self.prose(1, high // 2)}"

    def pick(self, options):
        return options[int(self.rng.integers(len(options)))]

    def name(self, options) -> str:
        if self.rng.random() < 0.12:
            return ""
        own = self.pick(options) + (("-" + self.pick(["box", "wrap", "list", "item", "area", "1"])) if self.rng.random() < 0.4 else "")
        return f' {self.pick(["class", "id"])}="{own}"'

    def links(self, low: int, high: int) -> str:
        return "".join(f"<li><a href='/x'>{self.prose(1, 4)}</a></li>" for _ in range(int(self.rng.integers(low, high + 1))))

    def other(self, kind: str) -> str:
        name = self.name(self.OTHER[kind])
        if kind == "nav":
            tag = self.pick(["nav", "div", "nav"])
            return f"<{tag}{name}><ul>{self.links(2, 9)}</ul></{tag}>"
        if kind == "header":
            tag = self.pick(["header", "div"])
            title = self.pick(["div", "div", "h1", "h2", "h3"])
            return f"<{tag}{name}><{title}>{self.prose(1, 6)}</{title}>" + self.pick([f"<p>{self.prose(1, 9)}</p>", ""]) + f"</{tag}>"
        if kind == "footer":
            tag = self.pick(["footer", "div", "footer"])
            return f"<{tag}{name}>" + self.pick([f"&copy; {self.prose(1, 25)}", f"<p>{self.prose(2, 30)}</p><ul>{self.links(1, 5)}</ul>"]) + f"</{tag}>"
        if kind == "aside":
            tag = self.pick(["aside", "div", "section"])
            return f"<{tag}{name}><h3>{self.prose(1, 4)}</h3>" + self.pick([f"<ul>{self.links(2, 8)}</ul>", f"<p>{self.prose(5, 40)}</p>"]) + f"</{tag}>"
        if kind == "notice":
            return f"<div{name}>" + self.pick([f"<p>{self.prose(4, 40)}</p><button>{self.prose(1, 2)}</button>", self.prose(4, 30)]) + "</div>"
        if kind == "ad":
            return f"<{(t := self.pick(['div', 'div', 'aside', 'section']))}{name}>" + self.pick([self.prose(2, 40), f"<p>{self.prose(3, 40)}</p>"]) + f"</{t}>"
        if kind == "form":
            return f"<form{name}><label>{self.prose(1, 3)}</label><input><p>{self.prose(1, 15)}</p><button>{self.prose(1, 2)}</button></form>"
        if kind == "comments":
            own = "".join(f"<div{self.name(['comment', 'reply'])}><p>{self.prose(3, 60)}</p></div>" for _ in range(int(self.rng.integers(1, 5))))
            tag = self.pick(["section", "div", "ol"])
            return f"<{tag}{self.name(self.OTHER[kind]) or ' class=comments'}><h3>{self.prose(1, 3)}</h3>{own}</{tag}>"
        return f"<div{name}>{self.prose(1, 10)}</div>"

    def page(self) -> str:
        """A page; main blocks carry the mark ``\\x01``, all text else does not."""
        rng = self.rng
        blocks = []
        if rng.random() < 0.8:
            blocks.append(f"<h1>\x01{self.prose(2, 14)}</h1>")
        for _ in range(int(rng.integers(1, 9))):
            kind = rng.random()
            if kind < 0.7:
                open_b = "<b>" if rng.random() < 0.2 else ""
                blocks.append(f"<p>{open_b}{self.main(1, 90)}" + ("</p>" if rng.random() < 0.7 else "<br>"))
            elif kind < 0.78:
                blocks.append(f"<h2>\x01{self.prose(1, 8)}</h2>")
            elif kind < 0.86:
                blocks.append("<ul>" + "".join(f"<li>{self.main(2, 18)}</li>" for _ in range(int(rng.integers(2, 6)))) + "</ul>")
            elif kind < 0.9:
                blocks.append(f"<blockquote>{self.main(4, 40)}</blockquote>")
            elif kind < 0.94:
                blocks.append("<table>" + "".join(f"<tr><td>\x01{self.prose(1, 6)}</td><td>\x01{self.prose(1, 6)}</td></tr>" for _ in range(3)) + "</table>")
            else:
                blocks.append(self.other(self.pick(["ad", "aside", "share", "notice"])))
        tag = self.pick(["article", "article", "main", "div", "section", "div"])
        name = self.name(self.MAIN) if tag in ("article", "main") else self.name(self.MAIN) or ' class="content"'
        main = f"<{tag}{name}>{''.join(blocks)}</{tag}>"
        if rng.random() < 0.3:
            main = f"<div{self.name(['container', 'wrapper', 'layout', *self.MAIN])}>{main}{self.other('aside') if rng.random() < 0.4 else ''}</div>"
        before = [self.other(k) for k in ("header", "nav", "notice", "ad", "form", "share") if rng.random() < 0.5]
        after = [self.other(k) for k in ("share", "aside", "comments", "ad", "form", "footer") if rng.random() < 0.55]
        html = f"<html><head><title>{self.prose(1, 8)}</title></head><body>{''.join(before)}{main}{''.join(after)}</body></html>"
        return html[: int(len(html) * rng.uniform(0.6, 1))] if rng.random() < 0.1 else html


class Extractor:
    """The trained trees and the evidence of attribute tokens."""

    def __init__(self, evidence: dict[str, float], trees: BoostedTrees):
        self.evidence, self.trees = evidence, trees

    def texts(self, pages: list[str | None]) -> list[str]:
        parsed = [Page(html) for html in pages]
        features = [p.features(self.evidence) for p in parsed]
        odds = self.trees.predict(np.concatenate(features)) if parsed else np.empty(0)
        bounds = np.cumsum([len(f) for f in features])[:-1]
        return [" ".join(p.decode(o)) for p, o in zip(parsed, np.split(odds, bounds), strict=True)]


@cache
def train_extractor(layouts: int = LAYOUTS) -> Extractor:
    """Train on composed pages, the same each time. An element's label is whether most of its text is main."""
    maker = Layouts()
    pages = [Page(maker.page()) for _ in range(layouts)]
    labels, seen = [], {}
    for page in pages:
        main, text = np.zeros(len(page.nodes)), np.zeros(len(page.nodes))
        for i, (k, run, block) in enumerate(page.runs):
            size = len(run.strip("\x01 "))
            text[k] += size
            main[k] += size * ("\x01" in run)
            page.runs[i] = (k, run.replace("\x01", ""), block)
        for k in range(len(page.nodes) - 1, 0, -1):
            text[page.parent[k]] += text[k]
            main[page.parent[k]] += main[k]
        y = np.where(text > 0, main > text / 2, np.nan)
        labels.append(y)
        for node, own in zip(page.nodes, y, strict=True):
            if own == own and node.parent is not None:
                for t in {*node.tokens, f"<{node.tag}>"}:
                    hits = seen.setdefault(t, [0, 0])
                    hits[int(own)] += 1
    evidence = {t: float(np.log((a + 0.5) / (b + 0.5))) * (a + b) / (a + b + 4) for t, (b, a) in seen.items()}
    y = np.concatenate(labels)
    x = np.concatenate([p.features(evidence) for p in pages])
    # names that no training page used must not decide: a part of the elements is learned without their evidence
    blind = x.copy()
    blind[:, 13:17] = 0
    known = ~np.isnan(y)
    some = known & (np.arange(len(y)) % 4 == 0)
    return Extractor(evidence, BoostedTrees().fit(np.concatenate([x[known], blind[some]]), np.concatenate([y[known], y[some]])))


def _extract(held):
    def run(batches):
        import pyarrow as pa

        for batch in slices(batches, 100):
            texts = held.value.texts(batch.column("html").to_pylist())
            yield pa.record_batch([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return run


def main_text(pages: DataFrame, extractor: Extractor | None = None) -> DataFrame:
    """page_id, url, text (main text, blocks joined by a space; empty if there is none) and n_chars of every page.

    The whole html is read. The trees are trained on composed pages (see ``Layouts``), since pages have no labels. Form
    controls, scripts, comments and the like are never main text; inline elements with a class or id may be left out of
    the block around them. A null or empty html has an empty text. Rows are only mapped: null ids and
    repeated rows keep their rows, an empty table gives an empty result.
    """
    held = pages.sparkSession.sparkContext.broadcast(extractor or train_extractor())
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return pages.mapInArrow(_extract(held), "page_id long, url string, text string, n_chars long")
