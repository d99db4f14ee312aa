"""Main text of web pages by a tree-structured graphical model over the nodes of the document tree.

A page becomes a tree of its block elements, with blocks of text as leaves. Each node is content or not; it has a potential
from its features (tag, words of class and id, length, links, punctuation, place), each parent and child have a joint one.
Sum-product messages, up the tree and down again, give the exact marginal of every node; a block of text belongs to the main
text if its marginal is at least one half. All trees of a batch pass messages together, level by level.

The potentials are trained by maximum likelihood on labelled pages: those of the table's pages (``SAMPLE``, a bounded sample)
that mark their article in HTML itself, and variants of them, laid out anew with other tags, class names, notices, forms and
comments, whose labels are known from the layout. Where no such page exists, a built-in article stands in for them.

Null and empty pages have no text. Broken markup is read as far as it goes: open elements end with the page, stray ends are
passed over. Pages are independent, so repeated pages give equal texts.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripleframe.llm.common import bounded_sample, map_text, sigmoid

#: Elements that stand on lines of their own; all others run with the text around them.
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section select summary "
    "table tbody td tfoot th thead tr ul".split()
)
#: Elements without text for readers; what they hold is passed over.
SILENT = frozenset("head script style template noscript iframe object svg math canvas audio video textarea title".split())
#: Elements that cannot hold others.
EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: An element that starts ends these open ones, up to a boundary.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
BOUNDS = frozenset("ul ol dl table select".split())

#: Hashed features of tags and of the words of class and id.
HASHED = 1 << 12
#: Pages that are learned from, at most, and variants made of each.
SAMPLE = 200
VARIANTS = 3

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<[!?][^>]*+>|</?[a-zA-Z][^>]*+>""", re.S
)
_NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass
class Tree:
    """Nodes of one page in page order; a parent comes before its children."""

    parent: list[int] = field(default_factory=list)
    depth: list[int] = field(default_factory=list)
    tag: list[str] = field(default_factory=list)
    named: list[tuple[str, ...]] = field(default_factory=list)
    text: list[str | None] = field(default_factory=list)
    linked: list[int] = field(default_factory=list)

    def add(self, parent: int, tag: str, named: tuple[str, ...] = (), text: str | None = None, linked: int = 0) -> int:
        """Number of a new node."""
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1 if parent >= 0 else 0)
        self.tag.append(tag)
        self.named.append(named)
        self.text.append(text)
        self.linked.append(linked)
        return len(self.parent) - 1


def _names(attributes: str) -> tuple[str, ...]:
    if "=" not in attributes:
        return ()
    return tuple(w.lower() for m in _NAMED.finditer(attributes) for w in _PARTS.findall(m[1] or m[2] or m[3] or ""))


def parse(page: str) -> Tree:
    """Tree of the blocks of a page."""
    tree = Tree()
    open_: list[int] = [tree.add(-1, "#page")]
    held: list[str] = []
    links, link_chars, at = 0, 0, 0

    def flush() -> None:
        nonlocal link_chars
        if held:
            text = " ".join("".join(held).split())
            held.clear()
            if text:
                tree.add(open_[-1], "#text", (), text, min(link_chars, len(text)))
            link_chars = 0

    def say(raw: str) -> None:
        nonlocal link_chars
        if raw:
            text = html.unescape(raw) if "&" in raw else raw
            held.append(text)
            if links:
                link_chars += len(text)

    def close(names: set[str] | frozenset[str], bounds: frozenset[str] = frozenset()) -> None:
        for i in range(len(open_) - 1, 0, -1):
            if tree.tag[open_[i]] in names:
                del open_[i:]
                return
            if tree.tag[open_[i]] in bounds:
                return

    while (m := _TOKEN.search(page, at)) is not None:
        say(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        name = m[2].lower()
        if name in SILENT:
            if not m[1] and not m[3].endswith("/"):
                end = re.compile(rf"</{name}\b[^>]*>" + (r"|(?=<body\b)" if name == "head" else ""), re.I).search(page, at)
                at = end.end() if end else len(page)
            continue
        if name == "a":
            links = max(0, links + (-1 if m[1] else 1))
        if name not in BLOCKS:
            if name in ("br", "img", "input"):
                held.append(" ")
            continue
        flush()
        if m[1]:
            close({name})
            links = 0
            continue
        # A paragraph ends where another block starts.
        if tree.tag[open_[-1]] == "p":
            open_.pop()
        if name in ENDS:
            close(ENDS[name], BOUNDS)
        if name not in EMPTY and not (name in ("html", "body") and len(open_) > 2):
            open_.append(tree.add(open_[-1], name, _names(m[3])))
    say(page[at:])
    flush()
    return tree


#: Features with a value of their own, before the hashed ones.
NUMERIC = ("bias", "text", "long", "longer", "links", "stops", "early", "late", "linked part", "text part")


def _hash(name: str) -> int:
    h = 2166136261
    for b in name.encode():
        h = (h ^ b) * 16777619 & 0xFFFFFFFF
    return len(NUMERIC) + (h ^ h >> 13) % HASHED


class Batch:
    """Trees end to end, with their features as (node, feature, value)."""

    def __init__(self, trees: list[Tree], known: dict[str, int]):
        base = np.cumsum([0, *(len(t.parent) for t in trees)])
        self.parent = np.concatenate([np.where(np.array(t.parent) < 0, -1, np.array(t.parent) + b) for t, b in zip(trees, base, strict=False)]).astype(np.int64)
        self.depth = np.concatenate([t.depth for t in trees])
        self.size = int(base[-1])
        texts = [x for t in trees for x in t.text]
        length = np.array([len(x) if x else 0 for x in texts], dtype=float)
        linked = np.concatenate([t.linked for t in trees]).astype(float)
        stops = np.array([x.count(".") + x.count(",") + x.count("?") + x.count("!") if x else 0 for x in texts], dtype=float)
        self.kind = (length > 0).astype(np.int64)
        # Text and linked text below each node.
        below, below_linked = length.copy(), linked.copy()
        self.levels = [np.flatnonzero(self.depth == d) for d in range(1, int(self.depth.max()) + 1)]
        for level in reversed(self.levels):
            below += np.bincount(self.parent[level], below[level], self.size)
            below_linked += np.bincount(self.parent[level], below_linked[level], self.size)
        page = np.repeat(np.arange(len(trees)), np.diff(base))
        first = np.concatenate([np.cumsum([0.0, *[len(x or "") for x in t.text][:-1]]) for t in trees])
        total = np.maximum(below[base[:-1]][page], 1)
        values = np.stack([
            np.ones(self.size), length > 0, np.minimum(length / 100, 1), np.minimum(length / 500, 1), linked / np.maximum(length, 1),
            np.minimum(stops / np.maximum(length, 1) * 20, 1), first / total < 0.05, first / total > 0.9,
            below_linked / np.maximum(below, 1), below / total,
        ]).astype(float)
        node, feature, value = [np.tile(np.arange(self.size), len(NUMERIC))], [np.repeat(np.arange(len(NUMERIC)), self.size)], [values.ravel()]
        owner, hashed = [], []
        at = 0
        for t in trees:
            for tag, named in zip(t.tag, t.named, strict=True):
                for name in (f"<{tag}", *named):
                    code = known.get(name)
                    if code is None:
                        code = known.setdefault(name, _hash(name)) if len(known) < 1 << 16 else _hash(name)
                    owner.append(at)
                    hashed.append(code)
                at += 1
        self.node = np.concatenate([*node, np.array(owner, dtype=np.int64)])
        self.feature = np.concatenate([*feature, np.array(hashed, dtype=np.int64)])
        self.value = np.concatenate([*value, np.ones(len(owner))])


@dataclass
class TreeModel:
    """Weights of the features for content, and joint potentials by kind of child: (kind, parent label, child label)."""

    weights: np.ndarray
    joint: np.ndarray

    def marginals(self, batch: Batch) -> tuple[np.ndarray, np.ndarray]:
        """(marginal of content by node, expected joint counts by kind), by one pass up the trees and one down."""
        unary = np.bincount(batch.node, self.weights[batch.feature] * batch.value, batch.size)
        belief = np.zeros((batch.size, 2))
        belief[:, 1] = unary
        sent = np.zeros((batch.size, 2))
        for level in reversed(batch.levels):
            pot = self.joint[batch.kind[level]]
            sent[level] = np.logaddexp(belief[level, 0, None] + pot[:, :, 0], belief[level, 1, None] + pot[:, :, 1])
            for label in (0, 1):
                belief[:, label] += np.bincount(batch.parent[level], sent[level, label], batch.size)
        counts = np.zeros((2, 2, 2))
        whole = belief.copy()
        for level in batch.levels:
            pot = self.joint[batch.kind[level]]
            rest = whole[batch.parent[level]] - sent[level]
            pair = rest[:, :, None] + pot + belief[level][:, None, :]
            pair = np.exp(pair - pair.max(axis=(1, 2), keepdims=True))
            pair /= pair.sum(axis=(1, 2), keepdims=True)
            for kind in (0, 1):
                counts[kind] += pair[batch.kind[level] == kind].sum(axis=0)
            whole[level] = belief[level] + np.logaddexp(rest[:, 0, None] + pot[:, 0], rest[:, 1, None] + pot[:, 1])
        return sigmoid(whole[:, 1] - whole[:, 0]), counts


def train(trees: list[Tree], labels: list[np.ndarray], steps: int = 150, rate: float = 0.1, decay: float = 1e-3) -> TreeModel:
    """Maximum likelihood by Adam; the gradient is observed minus expected counts."""
    batch, y = Batch(trees, {}), np.concatenate(labels).astype(float)
    model = TreeModel(np.zeros(len(NUMERIC) + HASHED), np.zeros((2, 2, 2)))
    held = np.flatnonzero(batch.parent >= 0)
    seen = np.zeros((2, 2, 2))
    np.add.at(seen, (batch.kind[held], y[batch.parent[held]].astype(int), y[held].astype(int)), 1)
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in (model.weights, model.joint)]
    for step in range(1, steps + 1):
        p, expected = model.marginals(batch)
        slope = np.bincount(batch.feature, (y - p)[batch.node] * batch.value, len(model.weights))
        for w, g, (a, b) in zip((model.weights, model.joint), (slope, seen - expected), moments, strict=True):
            g = g / len(trees) - decay * w
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            w += rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-6)
    return model


#: Layouts of the labelled variants, as opening tags: where the article stands, and what stands around and inside it.
ARTICLES = ['<article>', '<main>', '<div class="content">', '<div class="post-body">', '<div id="main-text">', '<section class="entry">', '<div class="article-text">', '<div role="main">']
MENUS = ['<nav>', '<div class="menu">', '<ul class="navigation">', '<div id="navbar">', '<header class="site-header">', '<div class="breadcrumb">', '<header>']
ASIDES = ['<aside>', '<div class="ad">', '<div class="sidebar">', '<div class="promo">', '<div class="advert banner">', '<section class="related">', '<div class="sponsored">', '<div class="widget">', '<div class="share social">']
NOTICES = ['<div class="cookie-notice">', '<div id="consent-banner">', '<div class="notice">', '<dialog>', '<div class="alert popup">']
FORMS = ['<form>', '<form class="newsletter subscribe">', '<form id="search">', '<div class="login"><form>']
COMMENTS = ['<section class="comments">', '<div id="comments">', '<ol class="comment-list">', '<div class="reader-responses comment">', '<div class="discussion replies">']
FOOTERS = ['<footer>', '<div class="footer">', '<div id="copyright">', '<div class="site-info bottom">']
#: Stands in where the table has no page with a marked article.
STAND_IN = ["A heading", "The first sentence of an article goes here, with commas, and ends. A second one follows it.", "Another paragraph says more about it, at some length, so that it is read as prose. It ends here."]


def _wrap(opening: str, inner: str) -> str:
    closing = "".join(f"</{n}>" for n in reversed(re.findall(r"<([a-z0-9]+)", opening)))
    return opening + inner + closing


def variant(blocks: list[str], others: list[str], rng: np.random.Generator) -> str:
    """A page around the blocks, in a layout by chance; content stands between the marks ⟦ and ⟧."""
    def pick(options: list[str]) -> str:
        return options[int(rng.integers(len(options)))]

    def prose() -> str:
        return html.escape(pick(others), quote=False)

    content = [f"<{'h1' if i == 0 else pick(['p', 'p', 'p', 'div', 'blockquote', 'h2', 'li'])}>⟦{html.escape(b, quote=False)}⟧" for i, b in enumerate(blocks)]
    if rng.random() < 0.3:
        content.insert(int(rng.integers(1, len(content) + 1)), _wrap(pick(ASIDES), f"<p>{prose()}</p>"))
    menu = "".join(f'<li><a href="/x">{w}</a></li>' for w in prose().split()[:6])
    parts = [_wrap(pick(MENUS), f"<ul>{menu}</ul>")]
    around = [(ASIDES, 0.8), (NOTICES, 0.5), (FORMS, 0.3)]
    parts += [_wrap(pick(kinds), f"<p>{prose()}</p>" if rng.random() < 0.5 else prose()) for kinds, share in around if rng.random() < share]
    parts.append(_wrap(pick(ARTICLES), "".join(content)))
    if rng.random() < 0.5:
        parts.append(_wrap(pick(COMMENTS), "".join(f"<p>{prose()}</p>" for _ in range(int(rng.integers(1, 4))))))
    if rng.random() < 0.4:
        parts.append(_wrap(pick(ASIDES), f"<p>{prose()}</p>"))
    parts.append(_wrap(pick(FOOTERS), "&copy; " + prose()))
    body = "".join(parts)
    return f"<html><body>{_wrap('<div>', body) if rng.random() < 0.4 else body}</body></html>"


def labelled(page: str) -> tuple[Tree, np.ndarray]:
    """Tree of a page with marked content, and labels: marked text, and elements at least half of whose text is marked."""
    tree = parse(page)
    size, marked = np.zeros(len(tree.parent)), np.zeros(len(tree.parent))
    for i, text in enumerate(tree.text):
        if text:
            inside = "⟦" in text
            tree.text[i] = text.replace("⟦", "").replace("⟧", "")
            size[i], marked[i] = len(text), len(text) * inside
    for i in range(len(tree.parent) - 1, 0, -1):
        size[tree.parent[i]] += size[i]
        marked[tree.parent[i]] += marked[i]
    return tree, (marked * 2 >= np.maximum(size, 1)).astype(int)


def _article(tree: Tree) -> tuple[list[str], list[str]] | None:
    """(blocks in the only article or main element, other blocks), if the page has one."""
    tops = [i for i, t in enumerate(tree.tag) if t in ("article", "main")]
    if len(tops) != 1:
        return None
    inside = np.zeros(len(tree.parent), dtype=bool)
    for i, p in enumerate(tree.parent):
        inside[i] = i == tops[0] or (p >= 0 and inside[p])
    blocks = [t for t, ok in zip(tree.text, inside, strict=True) if t and ok]
    return blocks, [t for t, ok in zip(tree.text, inside, strict=True) if t and not ok]


def learn(pages: list[str], seed: int = 5) -> TreeModel:
    """Train on the pages that mark their article, and on variants of them."""
    rng = np.random.default_rng(seed)
    found = [(p, a) for p in pages if (a := _article(parse(p))) and a[0]]
    prose = [b for _, (blocks, others) in found for b in blocks + others] or STAND_IN
    trees, labels = [], []
    for page, (blocks, _) in found:
        own = parse(page)
        inside = np.zeros(len(own.parent), dtype=int)
        for i, p in enumerate(own.parent):
            inside[i] = own.tag[i] in ("article", "main") or (p >= 0 and inside[p])
        trees.append(own)
        labels.append(inside)
    for blocks in [a[0] for _, a in found] or [STAND_IN] * 20:
        for _ in range(VARIANTS):
            tree, y = labelled(variant(blocks[:30], prose, rng))
            trees.append(tree)
            labels.append(y)
    return train(trees, labels)


def fit(df: DataFrame, column: str = "html", sample: int = SAMPLE, key: str = "page_id") -> TreeModel:
    """Learn from at most ``sample`` pages, those of the smallest hash; longer ones than 20,000 characters are left aside."""
    rows = bounded_sample(df.where(F.length(column) <= 20_000).select(key, column), sample, key, column)
    return learn(list(rows[column]))


def extract(df: DataFrame, model: TreeModel, column: str = "html") -> DataFrame:
    """Replace the page by ``text``: blocks of the main text in page order, joined by blank lines."""

    def make():
        known: dict[str, int] = {}

        def work(pages: list[str]) -> dict[str, pa.Array]:
            trees = [parse(p) for p in pages]
            if not trees:
                return {"text": pa.array([], pa.string())}
            p = model.marginals(Batch(trees, known))[0]
            return {"text": pa.array(list(_texts(trees, p)), pa.string())}

        return work

    return map_text(df, column, "text string", make)


def _texts(trees: list[Tree], p: np.ndarray) -> Iterator[str]:
    at = 0
    for tree in trees:
        yield "\n\n".join(t for t, q in zip(tree.text, p[at : at + len(tree.text)], strict=True) if t and q >= 0.5)
        at += len(tree.text)
