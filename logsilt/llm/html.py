"""Main text of web pages by a tree-structured graphical model.

Each page is a tree of block elements with runs of text as leaves. Every node is content or not.
Containers (and whatever is named by a telling class or id) have evidence of their own: tag, names,
the text and links they hold themselves. Paragraphs, list items, cells and leaves have none, so that
no block of an article goes for being short or full of links; they follow their parents. Weights and
the potentials between parent and child are learned from labelled pages. Messages go up the tree and
down again, which gives the exact marginal of every node; the text of leaves that are more likely
content is kept.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser
from math import exp, log1p
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logsilt.llm.common import by_batch
from logsilt.llm.seed_pages import SEED_PAGES

#: About so many pages are labelled and learned from, chosen by hash of the url and id; all are extracted.
TRAINING_PAGES = 4_000
#: Weight of all seed pages together, that of all labelled pages of the corpus being 1.
SEED_WEIGHT = 1.0
RIDGE, ROUNDS = 1e-5, 60

# How HTML nests. Void elements have no content; a start tag on the left closes an open
# element on the right.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s "
    "samp small span strike strong sub sup time tt u var wbr".split()
)
SILENT = frozenset("script style noscript template iframe object svg math canvas audio video head title textarea select".split())
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul".split()
)
CLOSES = {
    "li": ("li", ("ul", "ol", "menu")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)),
    "tr": ("tr td th", ("table",)), "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table")),
    "option": ("option", ("select",)),
}

_CUES = {
    "menu": "nav navbar navigation menu menubar breadcrumb breadcrumbs toc pagination pager tabs skip",
    "frame": "header masthead topbar footer foot bottom copyright legal colophon",
    "side": "sidebar aside side rail widget related recommended recommend more popular trending teaser",
    "notice": "notice cookie cookies consent banner popup modal alert gdpr overlay toast disclaimer message",
    "advert": "ad ads advert advertisement adverts sponsor sponsored promo promotion dfp adsense",
    "form": "form search login signup subscribe newsletter register",
    "reader": "comment comments disqus reply replies respond discussion reader responses",
    "share": "share sharing social follow tools meta byline tags",
    "main": "article content main post entry story body text page maincontent articlebody",
}
CUES = {word: cue for cue, words in _CUES.items() for word in words.split()}
_TAG_GROUPS = {
    "nav": "nav menu", "aside": "aside", "footer": "footer", "header": "header", "form": "form button fieldset",
    "article": "article", "main": "main", "p": "p", "title": "h1 h2 h3 h4 h5 h6", "list": "ul ol dl", "item": "li dt dd",
    "table": "table tbody thead tr td th", "quote": "blockquote pre", "figure": "figure figcaption",
    "section": "section", "div": "div", "page": "html body",
}
TAGS = {tag: group for group, tags in _TAG_GROUPS.items() for tag in tags.split()}

#: Tags whose elements are containers also without a name that tells.
CONTAINERS = frozenset(
    "html body article main section div nav aside header footer form menu fieldset center dialog details search #root".split()
)
FEATURES = (
    *(f"tag {g}" for g in _TAG_GROUPS), *(f"cue {c}" for c in _CUES), "role", "not content", "no own text", "short own text",
    "long own text", "some links", "links", "sentences", "mark",
)
_BIT = {name: 1 << i for i, name in enumerate(FEATURES)}
#: Edges are told apart by the child: no container, a container that is likely not content, another one.
EDGES = 3
_NOT_CONTENT = sum(
    _BIT[f] for f in ("tag nav", "tag aside", "tag footer", "tag header", "tag form")
) + sum(_BIT[f"cue {c}"] for c in _CUES if c != "main")
_ROLES = {
    "navigation": "menu", "banner": "frame", "contentinfo": "frame", "complementary": "side", "search": "form",
    "form": "form", "alert": "notice", "dialog": "notice", "alertdialog": "notice", "main": "main", "article": "main",
}


class Node:
    __slots__ = ("parent", "container", "bits", "text", "chars", "link_chars", "stops", "mark", "label", "hidden", "article")

    def __init__(self, parent: int, tag: str, bits: int, label: str | None, hidden: bool):
        self.parent, self.bits = parent, bits
        self.container = tag in CONTAINERS or bits >= _BIT[f"cue {next(iter(_CUES))}"]
        self.article = {"article": 2, "main": 1}.get(tag, 0)
        self.text: list[str] | None = None
        self.chars = self.link_chars = self.stops = 0
        self.mark = False
        self.label, self.hidden = label, hidden


def _element_bits(tag: str, attrs: dict[str, str | None]) -> int:
    bits = _BIT.get(f"tag {TAGS.get(tag, '')}", 0)
    named = " ".join(attrs.get(a) or "" for a in ("class", "id"))
    for word in re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", named).lower()):
        cue = CUES.get(word)
        if cue:
            bits |= _BIT[f"cue {cue}"]
    role = _ROLES.get((attrs.get("role") or "").lower())
    if role:
        bits |= _BIT[f"cue {role}"] | _BIT["role"]
    # a name that says "article comments" or "post sidebar" is not the article's
    return (bits & ~_BIT["cue main"]) | _BIT["not content"] if bits & _NOT_CONTENT else bits


class TreeBuilder(HTMLParser):
    """Nodes of a page in order: block elements, and leaves with the text between their borders."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.nodes: list[Node] = [Node(-1, "#root", 0, None, False)]
        self._open: list[tuple[str, int]] = [("#root", 0)]  # tags, with the node a tag's children hang on
        self._leaf: Node | None = None
        self._links = 0
        self._silent = 0

    def _pop(self) -> None:
        tag, node = self._open.pop()
        if tag == "a":
            self._links -= 1
        if tag in SILENT:
            self._silent -= 1
        if tag not in INLINE and tag not in self.CDATA_CONTENT_ELEMENTS:
            self._leaf = None

    def _close(self, tags: tuple[str, ...], borders: tuple[str, ...]) -> None:
        for i in range(len(self._open) - 1, 0, -1):
            if self._open[i][0] in tags:
                while len(self._open) > i:
                    self._pop()
                return
            if self._open[i][0] in borders:
                return

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in CLOSES_P:
            self._close(("p",), ("table", "td", "th", "button", "caption"))
        elif tag in CLOSES:
            tags, borders = CLOSES[tag]
            self._close(tuple(tags.split()), borders)
        if self._silent and any(t == "head" for t, _ in self._open) and tag in ("body", "div", "p", "article", "main", "nav"):
            self._close(("head",), ())  # a head that was never closed
        if tag in VOID:
            if tag == "br":
                self.handle_data(" ")
            elif tag == "hr":
                self._leaf = None
            return
        parent = self._open[-1][1]
        if tag in INLINE or tag in SILENT:
            self._open.append((tag, parent))
            self._links += tag == "a"
            self._silent += tag in SILENT
            return
        self._leaf = None
        values = {}
        for name, value in attrs:
            values.setdefault(name, value)
        above = self.nodes[parent]
        style = (values.get("style") or "").replace(" ", "").lower()
        hidden = above.hidden or "hidden" in values or "display:none" in style
        self.nodes.append(Node(parent, tag, _element_bits(tag, values), values.get("data-label"), hidden))
        self._open.append((tag, len(self.nodes) - 1))

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)  # a slash does not close an element that is not void
        if tag in self.CDATA_CONTENT_ELEMENTS:
            self.set_cdata_mode(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag == "p" and not any(t == "p" for t, _ in self._open):
            self._leaf = None
            return
        if tag in VOID:
            return
        # an inline end tag does not reach out of its block
        for i in range(len(self._open) - 1, 0, -1):
            if self._open[i][0] == tag:
                while len(self._open) > i:
                    self._pop()
                return
            if tag in INLINE and self._open[i][0] not in INLINE:
                return

    def handle_data(self, data: str) -> None:
        if self._silent:
            return
        if self._leaf is None:
            if not data.strip():
                return
            parent = self._open[-1][1]
            above = self.nodes[parent]
            self._leaf = Node(parent, "#text", 0, None, above.hidden)
            self._leaf.text = []
            self.nodes.append(self._leaf)
        self._leaf.text.append(data)
        n = len(data.strip())
        self._leaf.chars += n
        self._leaf.link_chars += n if self._links else 0
        self._leaf.stops += data.count(". ") + data.rstrip().endswith((".", "!", "?"))
        self._leaf.mark |= "\u00a9" in data


def parse(html: str) -> list[Node]:
    """The tree of a page, with the evidence of every node."""
    builder = TreeBuilder()
    # what looks like a tag in a script or style is none, and what looks like one of these in a comment neither
    builder.feed(html)
    builder.close()
    nodes = builder.nodes
    # a container's own text is what it holds outside of other containers
    for node in reversed(nodes[1:]):
        if not node.container:
            above = nodes[node.parent]
            above.chars += node.chars
            above.link_chars += node.link_chars
            above.stops += node.stops
            above.mark |= node.mark
    for node in nodes:
        if not node.container:
            node.bits = 0
            continue
        links = node.link_chars / node.chars if node.chars else 0.0
        for name, holds in (
            ("no own text", not node.chars), ("short own text", 0 < node.chars < 60), ("long own text", node.chars >= 200),
            ("some links", 0.2 < links <= 0.6), ("links", links > 0.6), ("sentences", node.stops > 1), ("mark", node.mark),
        ):
            if holds:
                node.bits |= _BIT[name]
    return nodes


def edge_kind(child: Node) -> int:
    return 0 if not child.container else 1 if child.bits & _NOT_CONTENT else 2


class Model(NamedTuple):
    """Log odds of content per feature (bias last), and log potentials [edge, parent, child]."""

    weights: np.ndarray
    edges: np.ndarray

    def evidence(self, bits: int) -> float:
        total, i = float(self.weights[-1]), 0
        while bits:
            low = bits & -bits
            i = low.bit_length() - 1
            total += self.weights[i]
            bits ^= low
        return total


def _log_add(a: float, b: float) -> float:
    if a < b:
        a, b = b, a
    return a + log1p(exp(b - a))


class Reader:
    """Sum-product on the trees of pages, with the evidence of each feature set computed once."""

    def __init__(self, model: Model):
        self._model = model
        self._evidence: dict[int, float] = {}
        # what a child's log odds say about its parent's log odds, for each kind of edge
        self._edges = [[[float(v) for v in row] for row in kind] for kind in model.edges]

    def _own(self, bits: int) -> float:
        known = self._evidence.get(bits) if bits else 0.0
        if known is None:
            known = self._evidence[bits] = self._model.evidence(bits)
        return known

    @staticmethod
    def _message(odds: float, out0_in0: float, out0_in1: float, out1_in0: float, out1_in1: float) -> float:
        """Log odds that the receiver gets from a sender with these log odds."""
        return _log_add(out1_in0, out1_in1 + odds) - _log_add(out0_in0, out0_in1 + odds)

    def marginals(self, nodes: list[Node]) -> list[float]:
        """Log odds of content for every node, given the whole page."""
        up = [self._own(node.bits) for node in nodes]
        sent = [0.0] * len(nodes)
        kinds = [edge_kind(node) for node in nodes]
        for i in range(len(nodes) - 1, 0, -1):  # children stand after their parents
            e = self._edges[kinds[i]]
            sent[i] = self._message(up[i], e[0][0], e[0][1], e[1][0], e[1][1])
            up[nodes[i].parent] += sent[i]
        both = up
        for i in range(1, len(nodes)):
            e = self._edges[kinds[i]]
            above = both[nodes[i].parent] - sent[i]
            both[i] += self._message(above, e[0][0], e[1][0], e[0][1], e[1][1])
        return both

    def blocks(self, html: str) -> list[str]:
        nodes = parse(html)
        odds = self.marginals(nodes)
        found = []
        for node, value in zip(nodes, odds, strict=True):
            if node.text is not None and value > 0 and not node.hidden:
                block = " ".join("".join(node.text).split())
                if block:
                    found.append(block)
        return found


def label_nodes(nodes: list[Node]) -> list[int | None]:
    """Content or not, where the page itself says so.

    A ``data-label`` attribute holds for all below it. Pages without any are labelled by their one
    article (or main) element: what it holds is content but for menus, asides, forms, footers and
    parts named as adverts, notices or comments; everything outside is not. Without such an element
    the page has no labels.
    """
    own: list[int | None] = [None] * len(nodes)
    if any(n.label for n in nodes):
        for i, node in enumerate(nodes):
            above = own[node.parent] if i else 0
            own[i] = {"content": 1, "other": 0}.get(node.label or "", above)
        return own
    inner = [i for i, n in enumerate(nodes) if n.article == 2] or [i for i, n in enumerate(nodes) if n.article]
    if len(inner) != 1:
        return own
    for i, node in enumerate(nodes):
        if i == inner[0]:
            own[i] = 1
        else:
            above = own[node.parent] if i else 0
            own[i] = 0 if node.bits & _NOT_CONTENT else above
    return own


def patterns(html: str) -> Iterator[tuple[int, int, int, int]]:
    """(bits, edge, parent label, label) of the labelled nodes of a page."""
    nodes = parse(html)
    labels = label_nodes(nodes)
    for i, (node, label) in enumerate(zip(nodes, labels, strict=True)):
        if i and label is not None and labels[node.parent] is not None:
            yield node.bits, edge_kind(node), labels[node.parent], label


def fit(rows: list[tuple[int, int, int, int, float]]) -> Model:
    """Weights by ridge logistic regression (Newton's method), potentials by counting.

    A potential is the share of children with a label among those of a parent with a label, so that a
    child without evidence says nothing about its parent, however many there are.
    """
    seen = [r for r in rows if r[0]]
    bits = np.array([r[0] for r in seen], np.int64)
    x = np.ones((len(seen), len(FEATURES) + 1))
    for i in range(len(FEATURES)):
        x[:, i] = (bits >> i) & 1
    y = np.array([r[3] for r in seen], float)
    n = np.array([r[4] for r in seen], float)
    w = np.zeros(x.shape[1])
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (n * (p - y)) + RIDGE * w
        hessian = (x * (n * p * (1 - p))[:, None]).T @ x + RIDGE * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    edges = np.full((EDGES, 2, 2), 1e-4)
    for _, edge, above, label, count in rows:
        edges[edge, above, label] += count
    return Model(w, np.log(edges / edges.sum(axis=2, keepdims=True)))


def train(pages: DataFrame, pages_wanted: int = TRAINING_PAGES) -> Model:
    """Learn from about ``pages_wanted`` pages of the corpus that label themselves, and the seed pages."""
    total = pages.count()
    one_in = max(1, total // pages_wanted)
    some = pages.where(F.pmod(F.xxhash64("url", "page_id"), F.lit(one_in)) == 0) if one_in > 1 else pages

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[tuple, int] = {}
            for html in batch.column("html"):
                for row in patterns(html.as_py()):
                    counts[row] = counts.get(row, 0) + 1
            columns = list(zip(*[(*k, v) for k, v in counts.items()], strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], ["bits", "edge", "above", "label", "n"]
            )

    counted = (
        some.select(F.coalesce("html", F.lit("")).alias("html"))
        .transform(by_batch, label, "bits long, edge long, above long, label long, n long")
        .groupBy("bits", "edge", "above", "label").agg(F.sum("n").alias("n"))
    )
    # one row per set of features that the training pages have, not per page
    rows = [tuple(r) for r in counted.orderBy("bits", "edge", "above", "label").collect()]
    seeds = [(*row, 1) for page in SEED_PAGES for row in patterns(page)]
    return fit(_weighted(rows, 1.0) + _weighted(seeds, SEED_WEIGHT))


def _weighted(rows: list[tuple], weight: float) -> list[tuple]:
    total = sum(r[4] for r in rows)
    return [(*r[:4], r[4] * weight / total) for r in rows]


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of pages (page_id, url, html).

    A null or empty html, and a page without content, give an empty text. Null ids and urls are kept,
    repeated rows are extracted each, an empty table gives no rows. White space in a block becomes one
    space, a line break within a block is white space, and blocks are joined by line ends.
    """
    model = train(pages)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model)
        for batch in batches:
            texts = ["\n".join(reader.blocks(h.as_py())) for h in batch.column("html")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    return pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce("html", F.lit("")).alias("html")
    ).transform(by_batch, read, "page_id long, url string, text string, n_chars long")
