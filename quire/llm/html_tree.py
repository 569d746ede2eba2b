"""Markup to a tree of elements, and the tree-structured model that tells content from the rest.

``parse`` reads any text as HTML: unclosed and stray tags, comments, character references, elements whose content is no
text (scripts, styles, form fields). It keeps the tree, what the model looks at, and the text in page order.

The model gives every element one of two states. Node potentials are linear in features of the element; edge potentials
between parent and child depend on the kind of child. Messages from the leaves up and from the root down give exact
marginals (sum-product), and training climbs the exact gradient of the likelihood of labelled trees.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np

_TAG = re.compile(
    r"<!---?>|<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*+)"
    r"((?:[\s/]++|[^\s/>=]++(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>\"'][^\s>]*+)?)?+|=)*+)(?:>|\Z)",
    re.S,
)
_NAMED = re.compile(r"(class|id|role|style|hidden|aria-hidden)\s*+(?:=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements whose content is never text of the page.
SILENT = frozenset("script style title textarea select button noscript template iframe svg math object canvas audio video "
                   "head option datalist xmp noembed noframes".split())
_RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
                  "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section "
                  "summary table tbody td tfoot th thead tr ul".split())
_CLOSES_P = BLOCK - frozenset("body caption dd dt html legend li tbody td tfoot th thead tr".split())
# What an opening tag ends, and the elements that shield those further out.
_ENDS = {
    "li": (("li",), ("ul", "ol", "menu", "dir")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "caption"), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
    "tbody": (("tbody", "thead", "tfoot", "caption"), ("table",)), "thead": (("caption",), ("table",)),
    "tfoot": (("tbody", "thead"), ("table",)),
}
_P_SHIELD = ("table", "td", "th", "caption", "object", "template")
_END_SHIELD = frozenset("table td th".split())
_TABLE_PARTS = frozenset("table tbody thead tfoot tr td th caption".split())

# Kinds of elements; every other tag is of the last kind.
KINDS = [
    ("article", "main"), ("section",), ("nav", "menu"), ("header", "hgroup"), ("footer",), ("aside", "dialog"),
    ("form", "fieldset", "legend", "label"), ("ul", "ol", "dl", "dir"), ("li", "dt", "dd"), ("p",), ("h1",),
    ("h2",), ("h3", "h4", "h5", "h6"), ("div", "center", "details", "summary"), ("html", "body"),
    ("table", "tbody", "thead", "tfoot", "tr", "td", "th", "caption"), ("blockquote", "pre"), ("a",),
    ("figure", "figcaption", "address"), ("other",),
]
_KIND = {tag: k for k, tags in enumerate(KINDS) for tag in tags}
OTHER = len(KINDS) - 1
_LINK = _KIND["a"]

# Words of class, id and role that name a part of a page.
HINTS = {
    "nav": "nav navbar navigation menu breadcrumb breadcrumbs crumbs pagination pager toc tabs skip",
    "header": "header head masthead topbar top branding logo hero",
    "footer": "footer foot copyright legal colophon bottom contentinfo",
    "side": "sidebar side aside widget widgets rail related recommended popular trending more tags complementary latest",
    "ad": "ad ads advert adverts advertisement advertising sponsor sponsored sponsors promo promotion adsbygoogle banner "
          "commercial partner affiliate",
    "notice": "notice notices cookie cookies consent gdpr alert alerts warning popup modal overlay paywall announcement "
              "message toast dialog disclaimer privacy",
    "form": "form login signin signup subscribe subscription newsletter search register contact field input mailing",
    "comment": "comment comments commentlist reply replies respond response responses discussion disqus reader readers "
               "feedback guestbook reviews",
    "share": "share sharing social follow twitter facebook like likes meta byline author date tools buttons rating",
    "content": "content article post entry story main text body blog page news prose hentry copy single",
}
_HINT = {word: 1 << k for k, words in enumerate(HINTS.values()) for word in words.split()}
_HIDDEN = 1 << len(HINTS)
FLAGS = len(HINTS) + 1


@dataclass
class Page:
    """Elements in page order (a parent comes before its children) and the text between them."""

    parent: list[int] = field(default_factory=list)
    depth: list[int] = field(default_factory=list)
    kind: list[int] = field(default_factory=list)
    inline: list[int] = field(default_factory=list)
    flags: list[int] = field(default_factory=list)
    chars: list[int] = field(default_factory=list)
    marks: list[int] = field(default_factory=list)
    before: list[int] = field(default_factory=list)  # characters of the page ahead of the element
    label: list[int] = field(default_factory=list)  # 1 or 0 where the tags say so, else that of the parent
    pieces: list[tuple[int, str]] = field(default_factory=list)  # element and its text; -1 where a block starts or ends


def _flags(attributes: str) -> int:
    found = 0
    for m in _NAMED.finditer(attributes):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            found |= _HIDDEN
        elif name == "style":
            if "none" in value and re.search(r"display\s*:\s*none", value):
                found |= _HIDDEN
        elif name != "aria-hidden":
            for word in _TOKEN.findall(value):
                found |= _HINT.get(word.lower(), 0)
    return found


def parse(text: str, labels: bool = False) -> Page:
    """The tree of a page; ``labels`` reads an attribute ``data-content`` of 0 or 1 into ``label``."""
    page = Page()
    stack: list[tuple[str, int]] = []
    opened: Counter[str] = Counter()
    seen = 0

    def add(tag: str, attributes: str) -> None:
        node = len(page.parent)
        up = stack[-1][1] if stack else -1
        page.parent.append(up)
        page.depth.append(page.depth[up] + 1 if stack else 0)
        page.kind.append(_KIND.get(tag, OTHER))
        page.inline.append(0 if tag in BLOCK else 1)
        page.flags.append(_flags(attributes) if "=" in attributes or "hidden" in attributes else 0)
        page.chars.append(0)
        page.marks.append(0)
        page.before.append(seen)
        if labels:
            at = attributes.find('data-content="')
            page.label.append(int(attributes[at + 14]) if at >= 0 else page.label[up] if stack else 0)
        stack.append((tag, node))
        opened[tag] += 1

    def close_to(size: int) -> None:
        while len(stack) > size:
            opened[stack.pop()[0]] -= 1

    def end(tags: tuple[str, ...], shield: tuple[str, ...]) -> None:
        if any(opened[t] for t in tags):
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in tags:
                    close_to(k)
                    return
                if stack[k][0] in shield:
                    return

    def say(raw: str) -> None:
        nonlocal seen
        if "&" in raw:
            raw = html.unescape(raw)
        node = stack[-1][1]
        page.pieces.append((node, raw))
        size = len(raw.strip())
        if size:
            seen += size
            page.chars[node] += size
            page.marks[node] += raw.count(".") + raw.count("!") + raw.count("?") + raw.count(",") + raw.count("。")

    add("html", "")
    at, last = 0, len(text)
    while at < last:
        m = _TAG.search(text, at)
        if m is None:
            say(text[at:])
            break
        if m.start() > at:
            say(text[at:m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        block = tag in BLOCK
        if m[1]:
            if block:
                page.pieces.append((-1, ""))
            if tag in ("html", "body", "br") or not opened[tag]:
                continue
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == tag:
                    close_to(k)
                    break
                if (stack[k][0] in _END_SHIELD and tag not in _TABLE_PARTS) or (not block and stack[k][0] in BLOCK):
                    break
            continue
        if tag in SILENT:
            if m[3].endswith("/") and tag in ("svg", "math"):
                continue
            shut = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*+(?:>|\Z)", re.I)
            if tag in _RAW:
                over = shut.search(text, at)
                at = over.end() if over else last
            else:
                at = _past(text, at, tag)
            continue
        if block:
            page.pieces.append((-1, ""))
        if tag in ("html", "body"):
            page.flags[0] |= _flags(m[3]) & _HIDDEN if tag == "html" else 0
            if tag == "body" and not opened["body"]:
                add(tag, m[3])
            continue
        if tag in _CLOSES_P:
            end(("p",), _P_SHIELD)
        if tag in _ENDS:
            end(*_ENDS[tag])
        if tag == "br":
            page.pieces.append((stack[-1][1], " "))
        elif tag not in VOID:
            add(tag, m[3])
    return page


def _past(text: str, at: int, tag: str) -> int:
    """Where an element without text of the page is over: its end tag, nested ones counted."""
    depth = 1
    if tag == "head":  # it may lack an end tag
        mark = re.compile(r"</head\s*>|<body[\s>]", re.I).search(text, at)
        return at if mark is None else mark.end() if mark[0][1] == "/" else mark.start()
    inside = re.compile(rf"<(/?){re.escape(tag)}(?=[\s/>])[^>]*+(?:>|\Z)|<(script|style)(?=[\s/>])", re.I)
    here = at
    while depth:
        m = inside.search(text, here)
        if m is None:
            return at  # never closed: what follows counts as usual
        here = m.end()
        if m[2]:
            over = re.compile(rf"</{m[2]}(?=[\s/>])", re.I).search(text, here)
            here = over.end() if over else len(text)
        else:
            depth += -1 if m[1] else 1
    return here


def text_of(page: Page, chosen: np.ndarray) -> str:
    """Blocks of the chosen elements' text, in page order, one to a line."""
    blocks, words = [], []
    for node, raw in page.pieces:
        if node < 0:
            if words and (block := " ".join("".join(words).split())):
                blocks.append(block)
            words = []
        elif chosen[node]:
            words.append(raw)
    if words and (block := " ".join("".join(words).split())):
        blocks.append(block)
    return "\n".join(blocks)


# ---------------------------------------------------------------- forests and features


class Forest:
    """The elements of some pages as arrays, with their places level by level."""

    def __init__(self, pages: list[Page]):
        sizes = [len(p.parent) for p in pages]
        self.offset = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        join = lambda name: np.array([v for p in pages for v in getattr(p, name)], np.int64)
        shift = np.repeat(self.offset[:-1], sizes)
        self.parent = np.where((up := join("parent")) >= 0, up + shift, -1)
        self.depth, self.kind, self.inline, self.flags = join("depth"), join("kind"), join("inline"), join("flags")
        self.chars, self.marks, self.before = join("chars"), join("marks"), join("before")
        self.page = np.repeat(np.arange(len(pages)), sizes)
        by_depth = np.lexsort((self.parent, self.depth))
        cuts = np.searchsorted(self.depth[by_depth], np.arange(1, int(self.depth.max(initial=0)) + 2))
        self.levels = np.split(by_depth, cuts)[:-1] if len(by_depth) else []
        # children of one parent stand together in a level: where each such group starts, and its parent
        self.groups = []
        for rows in self.levels:
            up = self.parent[rows]
            first = np.flatnonzero(np.append(True, up[1:] != up[:-1])) if len(up) else np.empty(0, np.int64)
            self.groups.append((first, up[first]))
        self.edge = np.where(self.inline == 1, 0, np.where(np.isin(self.kind, _TIGHT), 1, 2))

    def add_up(self, values: np.ndarray) -> np.ndarray:
        """Each element's value with those of all elements below it."""
        out = values.astype(np.float64)
        for rows, (first, up) in zip(self.levels[:0:-1], self.groups[:0:-1]):
            out[up] += np.add.reduceat(out[rows], first, axis=0)
        return out


_TIGHT = [_KIND[t] for t in ("li", "td", "p", "h1", "h2")]
EDGES = 3  # inline, part of a list, table or text, other blocks
_SIZES = np.array([1, 15, 40, 100, 300, 1000])
_SHARES = np.array([0.001, 0.25, 0.5, 0.9])
_DENSITY = np.array([0.001, 0.005, 0.015])
_PLACES = np.array([0.02, 0.2, 0.5, 0.8, 0.95])


def features(forest: Forest) -> np.ndarray:
    """One row an element: its kind, hints of its names, and amount, links, marks and place of its text."""
    n = len(forest.parent)
    linked = np.where(forest.kind == _LINK, forest.chars, 0)
    sums = forest.add_up(np.stack([forest.chars, linked, forest.marks], axis=1))
    inside = np.zeros((n, FLAGS))
    bits = (forest.flags[:, None] >> np.arange(FLAGS)) & 1
    for rows in forest.levels[1:]:  # hints of the elements around
        inside[rows] = np.maximum(inside[forest.parent[rows]], bits[forest.parent[rows]])
    whole = np.maximum(1, sums[forest.offset[:-1]][forest.page, 0]) if n else np.empty(0)
    chars = sums[:, 0]
    below = np.maximum(1, chars)
    parts = [np.ones((n, 1)), np.eye(len(KINDS))[forest.kind], bits,
             _reached(chars, _SIZES), _reached(forest.chars, _SIZES), _reached(sums[:, 1] / below, _SHARES),
             _reached(chars / whole, _SHARES), _reached(sums[:, 2] / below, _DENSITY), _reached(forest.before / whole, _PLACES),
             inside]
    return np.concatenate(parts, axis=1)


def _reached(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Which edges each value has reached: a value beyond all that training met has what the largest ones there have."""
    return (values[:, None] >= edges).astype(np.float64)


# ---------------------------------------------------------------- the model


def sum_product(forest: Forest, score: np.ndarray, psi: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Exact marginals of a forest.

    ``score`` is what state 1 of each element has over state 0; ``psi[e, s, t]`` what a child of kind ``e`` in state ``t``
    has under a parent in state ``s``. Returns P(state 1), P(parent's state, own state) (zero for roots) and the sum of
    the trees' log partition functions.
    """
    n = len(score)
    inner = np.stack([np.zeros(n), score], axis=1)  # own potential and all messages from below
    up = np.zeros((n, 2))
    for rows, (first, parents) in zip(forest.levels[:0:-1], forest.groups[:0:-1]):
        table = psi[forest.edge[rows]] + inner[rows][:, None, :]
        up[rows] = np.logaddexp(table[:, :, 0], table[:, :, 1])
        inner[parents] += np.add.reduceat(up[rows], first, axis=0)
    belief = inner.copy()
    pair = np.zeros((n, 2, 2))
    for rows in forest.levels[1:]:
        cavity = belief[forest.parent[rows]] - up[rows]
        table = psi[forest.edge[rows]] + cavity[:, :, None]
        belief[rows] = inner[rows] + np.logaddexp(table[:, 0], table[:, 1])
        joint = table + inner[rows][:, None, :]
        joint -= joint.max(axis=(1, 2), keepdims=True)
        joint = np.exp(joint)
        pair[rows] = joint / joint.sum(axis=(1, 2), keepdims=True)
    roots = forest.parent < 0
    total = float(np.logaddexp(belief[roots, 0], belief[roots, 1]).sum())
    with np.errstate(over="ignore"):
        return 1 / (1 + np.exp(belief[:, 0] - belief[:, 1])), pair, total


@dataclass
class Model:
    weights: np.ndarray
    psi: np.ndarray

    def marginals(self, forest: Forest) -> np.ndarray:
        """P(content) of every element."""
        return sum_product(forest, features(forest) @ self.weights, self.psi)[0]


def likelihood(forest: Forest, x: np.ndarray, y: np.ndarray, weights: np.ndarray, psi: np.ndarray):
    """Log-likelihood of states ``y`` and its gradients for the weights and for ``psi``."""
    score = x @ weights
    one, pair, total = sum_product(forest, score, psi)
    child = forest.parent >= 0
    e, s, t = forest.edge[child], y[forest.parent[child]], y[child]
    value = float(score @ y + psi[e, s, t].sum() - total)
    seen = np.zeros_like(psi)
    np.add.at(seen, (e, s, t), 1)
    expected = np.stack([pair[child & (forest.edge == k)].sum(axis=0) for k in range(EDGES)])
    return value, x.T @ (y - one), seen - expected


def train(pages: list[Page], rounds: int, penalty: float, rate: float = 0.1) -> Model:
    """Weights by gradient steps of adaptive size on the penalised likelihood of labelled pages."""
    forest = Forest(pages)
    x = features(forest)
    y = np.array([v for p in pages for v in p.label], np.int64)
    weights, psi = np.zeros(x.shape[1]), np.zeros((EDGES, 2, 2))
    state = [np.zeros_like(v) for v in (weights, weights, psi, psi)]
    for k in range(1, rounds + 1):
        _, gw, gp = likelihood(forest, x, y, weights, psi)
        for v, g, m, s in ((weights, gw, state[0], state[1]), (psi, gp, state[2], state[3])):
            g = (g - penalty * v) / len(pages)
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            v += rate * (m / (1 - 0.9**k)) / (np.sqrt(s / (1 - 0.99**k)) + 1e-8)
    return Model(weights, psi)
