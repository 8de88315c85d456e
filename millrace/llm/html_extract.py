"""Main text of web pages by boosted trees over DOM nodes.

A page is parsed into a tree of its block elements; text within inline
elements belongs to the block around it.  Every node has features: text and
links of its subtree and their density, depth, number and place of its
siblings, its tag, and which kinds of words its attributes and those of its
ancestors hold.  Gradient-boosted trees give each node a probability of
belonging to the main text.

Decoding chooses the set of kept nodes with the largest joint likelihood in
which every kept node has a kept parent: for each node, from the leaves up,
the better of dropping the whole subtree and of keeping the node with the best
choice for each child.  So nothing is kept inside of what is dropped.

No labels come with pages.  The trees are fitted on a bounded sample
(``SAMPLE`` pages, at most ``NODES`` nodes of each) whose nodes are labelled
from explicit markup: inside an article or main element and not inside a part
that its tag or attributes name as something else.  Half of the training nodes
hide their tags, so that pages without such markup are judged by the other
features.  Extraction reads every page whole.

Null and empty html give an empty text.  Unclosed and stray tags are closed or
ignored; the end of the page closes what is open.  A button, select, svg,
noscript or template is left out up to its end tag, to the end of the block
around it or, without an end tag, to the next block.  Without nodes to train on,
or with one kind only, the labelling by markup is used as it is.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrays import append_columns

SAMPLE = 400
NODES = 400
TREES, TREE_DEPTH, RATE, BINS = 40, 3, 0.3, 32

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: What is inside is no markup.
RAW = frozenset("script style textarea title iframe xmp noembed noframes".split())
#: Elements left out with all they hold.
LEFT_OUT = frozenset("head noscript template svg select button".split())
BLOCKS = frozenset(
    "html body div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption pre blockquote section article main nav header footer "
    "aside form fieldset figure figcaption address details summary dialog menu center hgroup search".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: A new one of these ends an open one of the same group, up to the enclosing list or table.
SELF_CLOSING = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}
SCOPES = frozenset("ul ol dl table menu html body article section main div".split())
GROUPS = [
    frozenset({"article", "main"}),
    frozenset({"nav", "menu"}),
    frozenset({"header", "hgroup"}),
    frozenset({"footer", "address"}),
    frozenset({"aside", "dialog", "search"}),
    frozenset({"form", "fieldset"}),
    HEADINGS,
    frozenset({"p", "blockquote", "pre", "figcaption"}),
    frozenset({"ul", "ol", "li", "dl", "dt", "dd"}),
    frozenset({"table", "thead", "tbody", "tfoot", "tr", "td", "th", "caption"}),
    frozenset({"div", "section", "center", "figure"}),
]
#: Words of class, id and role attributes by what they announce.
ATTRIBUTE_WORDS = [
    frozenset("article content main post entry story body text".split()),
    frozenset("nav navbar navigation menu breadcrumb breadcrumbs pagination pager toc tabs".split()),
    frozenset("header masthead banner topbar logo footer foot copyright legal bottom".split()),
    frozenset("sidebar side aside related recommended recommendations widget more popular trending rail".split()),
    frozenset("ad ads advert adverts advertisement advertising promo promotion sponsor sponsored sponsors outbrain taboola".split()),
    frozenset("comment comments reply replies respond discussion disqus".split()),
    frozenset("cookie cookies notice notices consent gdpr popup modal overlay alert newsletter subscribe signup login share social form search paywall".split()),
]
AGAINST_GROUPS = (1, 3, 4, 5)
#: A tag ends at > or, unclosed, before the next < outside of quotes, so a stray < costs no scan of the page.
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^<>]*+>|<(/?)([a-zA-Z][^\s/<>]*+)((?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+)(>|(?=<))", re.S)
END = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.I) for tag in RAW | LEFT_OUT}
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
WORD = re.compile(r"[a-z]+")


@dataclass
class Node:
    tag: str
    parent: int
    depth: int
    words: tuple[bool, ...]
    sibling: int  # place among its siblings
    children: int = 0
    elements: int = 0
    text: list[str] = field(default_factory=list)
    chars: int = 0
    links: int = 0


@dataclass
class LeftOut:
    """An open element that is left out.  A loose one, the head or one without an end tag, ends at the next block."""

    tag: str
    loose: bool
    same: int = 1
    blocks: dict[str, int] = field(default_factory=dict)  # open blocks inside


def _still_left_out(out: list[LeftOut], tag: str, closing: bool, attributes: str, open_outside: bool) -> bool:
    """Whether a tag is part of what is left out.  Ends the elements that end with it."""
    last = out[-1]
    if not closing:
        if tag in BLOCKS and tag != "html":
            while out and out[-1].loose:
                out.pop()
            if not out:
                return False
            inside = out[-1].blocks
            inside[tag] = inside.get(tag, 0) + 1
        elif tag == last.tag and not attributes.endswith("/") and tag not in ("button", "select", "head"):
            last.same += 1
        return True
    for k in range(len(out) - 1, -1, -1):
        if out[k].tag == tag:
            out[k].same -= 1
            del out[k + (out[k].same > 0) :]
            return True
    for one in reversed(out):
        if one.blocks.get(tag):
            one.blocks[tag] -= 1
            return True
    if open_outside:  # the block around ends, and so does what is left out in it
        out.clear()
        return False
    return True


def parse(page: str) -> tuple[list[Node], list[tuple[int, str]]]:
    """Nodes in page order, parents first, and the blocks of text with their nodes."""
    nodes = [Node("html", -1, 0, (False,) * len(ATTRIBUTE_WORDS), 0)]
    blocks: list[tuple[int, str]] = []
    open_ = [0]
    pending: list[str] = []
    in_link = 0
    out: list[LeftOut] = []  # open elements that are left out
    next_end: dict[str, int] = {}

    def end_of(tag: str, at: int) -> int:
        """Where the next end tag begins, or the end of the page; each stretch is searched once."""
        if next_end.get(tag, -1) < at:
            found = END[tag].search(page, at)
            next_end[tag] = found.start() if found else len(page)
        return next_end[tag]

    def flush() -> None:
        if pending:
            text = " ".join(entities.unescape("".join(pending)).split())
            pending.clear()
            if text:
                blocks.append((open_[-1], text))
                nodes[open_[-1]].chars += len(text)

    def close(depth: int) -> None:
        flush()
        del open_[depth:]

    def add(raw: str) -> None:
        if out:
            return
        pending.append(raw)
        if in_link:
            nodes[open_[-1]].links += len(raw.strip())

    at = 0
    while m := TOKEN.search(page, at):
        if m.start() > at:
            add(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if not m[4] and "=" not in m[3]:  # a < of the text
            add(m[0])
            continue
        if out and _still_left_out(out, tag, bool(m[1]), m[3], tag in BLOCKS and any(nodes[k].tag == tag for k in open_[1:])):
            if tag in RAW and not m[1] and not m[3].endswith("/"):
                at = end_of(tag, at)
            continue
        if m[1]:
            if tag == "a":
                in_link = max(0, in_link - 1)
            elif tag in BLOCKS:
                for k in range(len(open_) - 1, 0, -1):
                    if nodes[open_[k]].tag == tag:
                        close(k)
                        in_link = 0
                        break
            continue
        nodes[open_[-1]].elements += 1
        if tag in RAW:
            if not m[3].endswith("/"):
                at = end_of(tag, at)
            continue
        if tag in LEFT_OUT:
            if not m[3].endswith("/"):
                out.append(LeftOut(tag, tag == "head" or end_of(tag, at) == len(page)))
            continue
        if tag in VOID:
            if tag in ("br", "hr"):
                pending.append(" ")
            continue
        if tag == "a":
            in_link += 1
        if tag not in BLOCKS or tag in ("html", "body"):
            continue
        if nodes[open_[-1]].tag == "p" or nodes[open_[-1]].tag in HEADINGS and tag in HEADINGS:
            close(len(open_) - 1)
        for k in range(len(open_) - 1, 0, -1):
            name = nodes[open_[k]].tag
            if name in SELF_CLOSING.get(tag, ()):
                close(k)
                break
            if name in SCOPES:
                break
        flush()
        in_link = 0
        found = set()
        for a in ATTRIBUTE.finditer(m[3]):
            found.update(WORD.findall((a[2] or a[3] or a[4] or "").lower()))
        parent = open_[-1]
        words = tuple(bool(found & w) for w in ATTRIBUTE_WORDS)
        nodes.append(Node(tag, parent, nodes[parent].depth + 1, words, nodes[parent].children))
        nodes[parent].children += 1
        open_.append(len(nodes) - 1)
    if at < len(page):
        add(page[at:])
    flush()
    return nodes, blocks


def features(nodes: list[Node]) -> np.ndarray:
    """A row of numbers for every node; the tag groups come last."""
    n = len(nodes)
    parent = np.array([x.parent for x in nodes])
    own = np.array([[x.chars, x.links, x.elements, 1] for x in nodes], float)
    whole = own.copy()
    above = np.zeros((n, len(GROUPS) + len(ATTRIBUTE_WORDS)))
    flags = np.zeros((n, len(GROUPS) + len(ATTRIBUTE_WORDS)))
    for k, x in enumerate(nodes):
        flags[k] = [*(x.tag in g for g in GROUPS), *x.words]
        if k:
            above[k] = np.maximum(above[parent[k]], flags[parent[k]])
    for k in range(n - 1, 0, -1):
        whole[parent[k]] += whole[k]
    chars = np.maximum(whole[:, 0], 1)
    siblings = np.array([nodes[x.parent].children if x.parent >= 0 else 1 for x in nodes], float)
    numbers = [
        np.log1p(own[:, 0]),
        np.log1p(whole[:, 0]),
        whole[:, 0] / max(whole[0, 0], 1),
        whole[:, 1] / chars,
        whole[:, 0] / (whole[:, 2] + 1),
        whole[:, 0] / whole[:, 3],
        whole[:, 3],
        [x.depth for x in nodes],
        siblings,
        [x.sibling / max(s, 1) for x, s in zip(nodes, siblings)],
        [x.children for x in nodes],
        [nodes[x.parent].links / max(nodes[x.parent].chars, 1) if x.parent >= 0 else 0 for x in nodes],
    ]
    words = slice(len(GROUPS), None)
    return np.column_stack([*numbers, flags[:, words], above[:, words], flags[:, : len(GROUPS)], above[:, : len(GROUPS)]])


def markup_labels(nodes: list[Node]) -> np.ndarray:
    """1 for nodes within an article, and what holds one; 0 for what markup calls something else."""
    inside, against = np.zeros(len(nodes), bool), np.zeros(len(nodes), bool)
    named = any(x.tag in GROUPS[0] for x in nodes)
    for k, x in enumerate(nodes):
        up = x.parent
        inside[k] = x.tag in GROUPS[0] or (not named and k == 0) or (up >= 0 and inside[up])
        bad = any(x.tag in GROUPS[g] for g in AGAINST_GROUPS) or any(x.words[1:]) and x.tag not in GROUPS[0]
        bad |= x.tag in GROUPS[2] and not (up >= 0 and inside[up])
        against[k] = bad or (up >= 0 and against[up])
    good = inside & ~against
    for k in range(len(nodes) - 1, 0, -1):
        good[nodes[k].parent] |= good[k]
    return good


@dataclass
class Boosted:
    """Trees as arrays: each level splits on one feature and cut per branch; leaves hold log odds."""

    base: float
    trees: list[tuple[list[np.ndarray], list[np.ndarray], np.ndarray]]

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for columns, cuts, leaves in self.trees:
            branch = np.zeros(len(x), int)
            for column, cut in zip(columns, cuts):
                branch = 2 * branch + (x[rows, column[branch]] > cut[branch])
            out += leaves[branch]
        return out


def boost(x: np.ndarray, y: np.ndarray) -> Boosted:
    """Gradient boosting of the logistic loss over feature histograms."""
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    model = Boosted(float(np.log(share / (1 - share))), [])
    edges = [np.unique(np.quantile(c, np.arange(1, BINS) / BINS)) for c in x.T]
    binned = np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T)], 1)
    score = np.full(len(x), model.base)
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-score))
        gradient, curvature = y - p, p * (1 - p)
        branch = np.zeros(len(x), int)
        columns, cuts = [], []
        for level in range(TREE_DEPTH):
            width = 1 << level
            gain, column, cut, bin_cut = np.full(width, 1e-9), np.zeros(width, int), np.full(width, np.inf), np.full(width, BINS)
            for c in range(x.shape[1]):
                key = branch * BINS + binned[:, c]
                g = np.bincount(key, gradient, width * BINS).reshape(width, BINS).cumsum(axis=1)
                h = np.bincount(key, curvature, width * BINS).reshape(width, BINS).cumsum(axis=1)
                total_g, total_h = g[:, -1:], h[:, -1:]
                gains = g**2 / (h + 1) + (total_g - g) ** 2 / (total_h - h + 1) - total_g**2 / (total_h + 1)
                gains = gains[:, : len(edges[c])]
                if not gains.shape[1]:
                    continue
                best = gains.argmax(axis=1)
                better = gains[np.arange(width), best] > gain
                gain[better] = gains[np.arange(width), best][better]
                column[better], bin_cut[better], cut[better] = c, best[better], edges[c][best[better]]
            columns.append(column)
            cuts.append(cut)
            branch = 2 * branch + (binned[np.arange(len(x)), column[branch]] > bin_cut[branch])
        size = 1 << TREE_DEPTH
        leaves = RATE * np.bincount(branch, gradient, size) / (np.bincount(branch, curvature, size) + 1)
        model.trees.append((columns, cuts, leaves))
        score += leaves[branch]
    return model


def decode(nodes: list[Node], log_odds: np.ndarray) -> np.ndarray:
    """The likeliest set of kept nodes in which each has a kept parent."""
    yes, no = -np.logaddexp(0, -log_odds), -np.logaddexp(0, log_odds)
    drop, keep = no.copy(), yes.copy()
    for k in range(len(nodes) - 1, 0, -1):
        drop[nodes[k].parent] += drop[k]
        keep[nodes[k].parent] += max(keep[k], drop[k])
    kept = np.zeros(len(nodes), bool)
    for k, x in enumerate(nodes):
        kept[k] = (x.parent < 0 or kept[x.parent]) and keep[k] >= drop[k]
    return kept


def train_extractor(pages: DataFrame, html: str = "html", sample: int = SAMPLE) -> Boosted | None:
    """Fit the trees on a bounded sample of pages, chosen by a hash of their html."""
    source = pages.select(F.col(html).alias("_html")).where(F.octet_length("_html") > 0)
    picked = source.select("_html", F.xxhash64("_html").alias("_h")).orderBy("_h").limit(sample).select("_html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, labels = [], []
            for page in batch.column("_html").to_pylist():
                nodes, _ = parse(page)
                chosen = np.sort(np.random.default_rng(len(page)).permutation(len(nodes))[:NODES])
                rows.append(features(nodes)[chosen].astype(np.float32).tobytes())
                labels.append(markup_labels(nodes)[chosen].astype(np.int8).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary()), pa.array(labels, pa.binary())], names=["x", "y"])

    got = sorted(map(tuple, picked.mapInArrow(run, "x binary, y binary").collect()))
    if not got:
        return None
    y = np.concatenate([np.frombuffer(r[1], np.int8) for r in got]).astype(float)
    x = np.concatenate([np.frombuffer(r[0], np.float32) for r in got]).reshape(len(y), -1).astype(float)
    if y.min() == y.max():
        return None
    hidden = x.copy()
    hidden[:, -2 * len(GROUPS) :] = 0  # the same nodes with their tags hidden
    return boost(np.concatenate([x, hidden]), np.concatenate([y, y]))


def main_text(page: str, model: Boosted | None) -> str:
    nodes, blocks = parse(page)
    if not blocks:
        return ""
    kept = markup_labels(nodes) if model is None else decode(nodes, model.log_odds(features(nodes).astype(np.float32).astype(float)))
    return "\n".join(text for node, text in blocks if kept[node])


def extract_text(pages: DataFrame, model: Boosted | None, html: str = "html", keep: list[str] | None = None) -> DataFrame:
    """The kept columns of every page (all but the html by default), and ``text``."""
    keep = [c for c in pages.columns if c != html] if keep is None else keep

    def make():
        def run(column: pa.Array) -> list[pa.Array]:
            return [pa.array([main_text(page or "", model) for page in column.to_pylist()], pa.string())]

        return run

    return append_columns(pages, html, make, T.StructType().add("text", T.StringType()), keep)
