"""Main text of web pages by a tree-structured graphical model over the DOM.

Every block element, and every run of text directly within one, is a node with a hidden state: content or not. A node
has evidence (tag, words in class and id, length, share of links, punctuation, and whether it stands inside, before or
after the part of the page that structure alone makes its heart), a parent and child a potential. Sum-
product messages go up the tree and down again and give each run's probability of being content; the weights are those
that make the labels of the training pages (html_pages, made by rule) most likely, found by gradient ascent with the
same messages. Runs likelier content than not are the text.

Edges, all tested: null and empty pages, and pages without text, have empty text; anything that is not a tag is text;
unclosed and stray tags are mended; a quote opens an attribute's value only behind an equals sign, and is a character of
it if nothing closes it; a tag that nothing ends goes to the end of the page; references do not reach over tags; pages of any length are read whole; repeated rows each return a row; an empty table
returns no rows. Extra columns are not read and not returned.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

from .html_pages import NAMES, Page

TRAINING_PAGES, STEPS = 600, 120
#: An attribute as tokenizers take it: a quote opens a value only right behind the equals sign, and one that nothing closes
#: is a character like others.
ATTRIBUTE = r"""[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>]*+))?+"""
TAG = re.compile(rf"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[\s/]++|{ATTRIBUTE})*+)(?:>|\Z)", re.S)
NAME = re.compile(rf"(?:(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))|{ATTRIBUTE}", re.I)
WORD = re.compile(r"[a-z]+")
#: Text of these is never text of the page.
RAW = frozenset(("script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "math", "select", "object", "noembed", "xmp"))
VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"))
BLOCKS = ("p", "div", "article", "main", "section", "nav", "header", "footer", "aside", "form", "ul", "ol", "li", "dl", "dt", "dd", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "table", "tr", "td", "th", "thead", "tbody", "tfoot", "caption", "figure", "figcaption", "address", "fieldset", "legend", "details", "summary", "dialog", "center", "body", "html", "head", "hr", "button", "label", "option", "menu", "hgroup", "search")
BLOCK = {t: i for i, t in enumerate(BLOCKS)}
#: A tag on the left closes the nearest open one on the right, if no tag of the last set is in between.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
NAME_WORDS = {w: i for i, kind in enumerate(NAMES) for name in NAMES[kind] for w in WORD.findall(name) if w not in ("box", "site", "top", "page", "side", "text", "body", "main", "area", "list", "reader", "slot", "de", "en", "pub", "pie", "pied", "principal", "articles", "pagina")}
NAME_WORDS |= {"sidebar": 3, "contentinfo": 2, "complementary": 3, "navigation": 0, "teaser": 3, "sponsors": 4, "adsense": 4, "reply": 7, "disqus": 7, "outbrain": 4, "footnav": 0, "cookies": 5, "adbox": 4, "pied": 2, "pie": 2, "pub": 4}
N_NAMES = len(NAMES)


@dataclass
class Tree:
    """Nodes in document order, so a parent is always before its children; runs are the leaves with text."""

    parent: list[int] = field(default_factory=list)
    tag: list[int] = field(default_factory=list)
    names: list[frozenset] = field(default_factory=list)
    text: list[str | None] = field(default_factory=list)
    linked: list[int] = field(default_factory=list)

    def add(self, parent: int, tag: int, names: frozenset, text: str | None = None, linked: int = 0) -> int:
        for column, value in ((self.parent, parent), (self.tag, tag), (self.names, names), (self.text, text), (self.linked, linked)):
            column.append(value)
        return len(self.parent) - 1


@lru_cache(maxsize=4096)
def _names(attributes: str) -> frozenset:
    words = " ".join(m.strip("\"'") for m in NAME.findall(attributes)).lower()
    return frozenset(NAME_WORDS[w] for w in WORD.findall(words) if w in NAME_WORDS)


def parse(page: str) -> Tree:
    tree = Tree()
    stack: list[tuple[str, int]] = [("#", tree.add(-1, len(BLOCKS), frozenset()))]
    pieces: list[str] = []
    linked = link_depth = 0
    inline_names: list[frozenset] = []
    open_tags: Counter[str] = Counter()  # so that an end tag of nothing costs one look

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(pieces).split())
        if text:
            tree.add(stack[-1][1], len(BLOCKS) + 1, inline_names[-1] if inline_names else frozenset(), text, linked)
        pieces.clear()
        linked = 0

    def said(raw: str) -> None:
        nonlocal linked
        pieces.append(html.unescape(raw))  # a reference ends at a tag
        if link_depth:
            linked += len(pieces[-1])

    def close(depth: int) -> None:
        flush()
        inline_names.clear()
        open_tags.subtract(name for name, _ in stack[depth:])
        del stack[depth:]

    at, size = 0, len(page)
    while at < size:
        m = TAG.search(page, at)
        if m is None:
            said(page[at:])
            break
        if m.start() > at:
            said(page[at : m.start()])
        at = m.end()
        name = m[2]
        if name is None:
            continue
        name = name.lower()
        if not m[1]:
            if name in RAW:
                if not m[3].endswith("/") or name not in ("svg", "math"):
                    end = re.compile(rf"</{re.escape(name)}[\s/>]", re.I).search(page, at)
                    stop = page.find(">", end.start()) if end else -1
                    at = stop + 1 if stop >= 0 else size
                    pieces.append(" ")
                continue
            if name in ("br", "hr", "img", "input"):
                pieces.append(" ")
            if name in BLOCK:
                flush()
                inline_names.clear()
                link_depth = 0
                closes, fence = CLOSES.get(name, ({"p"}, set()))
                for d in range(len(stack) - 1, 0, -1) if any(open_tags[t] for t in closes) else ():
                    if stack[d][0] in closes:
                        close(d)
                        break
                    if stack[d][0] in fence or (closes == {"p"} and stack[d][0] != "p"):
                        break
                if name not in VOID:
                    stack.append((name, tree.add(stack[-1][1], BLOCK[name], _names(m[3]))))
                    open_tags[name] += 1
            elif name == "a":
                link_depth = 1
            elif name not in VOID and (own := _names(m[3])):
                inline_names.append(own)
        elif name in BLOCK:
            link_depth = 0
            if not open_tags[name]:
                flush()
                continue
            for d in range(len(stack) - 1, 0, -1):
                if stack[d][0] == name:
                    close(d)
                    break
        elif name == "a":
            link_depth = 0
    flush()
    return tree


BINS = np.array([2, 4, 8, 16, 40, 100, 250])
#: Kinds of place that a tag stands for by itself, as indices into NAMES.
KINDS = list(NAMES)
PLACE_TAGS = {BLOCK[t]: KINDS.index(k) for t, k in {"nav": "nav", "menu": "nav", "header": "head", "footer": "foot", "aside": "side", "form": "form", "search": "form", "button": "form", "label": "form", "article": "body", "main": "body"}.items()}
NOWHERE = N_NAMES
#: tag, names of the node, parent's tag, length, share of links, ends like a sentence, commas, bias, the nearest and the next place around, where it
#: is of the heart, and that with the nearest place
SIZES = (len(BLOCKS) + 2, N_NAMES, len(BLOCKS) + 2, len(BINS) + 1, 5, 2, 4, 1, N_NAMES + 1, (N_NAMES + 1) ** 2, 3, 3 * (N_NAMES + 1))
OFFSETS = np.concatenate(([0], np.cumsum(SIZES)))
N_FEATURES = int(OFFSETS[-1])
#: Kinds of edge, by the child: a run, or one of these groups of elements.
GROUPS = {"run": 0, "item": 1, "box": 2, "heart": 3, "edge": 4, "other": 5}
GROUP_OF = np.array([GROUPS["item"] if t in ("p", "li", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "tr", "td", "th", "dt", "dd", "figcaption", "ul", "ol", "table", "tbody", "figure", "dl") else GROUPS["heart"] if t in ("article", "main") else GROUPS["edge"] if t in ("nav", "footer", "aside", "form", "header", "button", "label") else GROUPS["box"] if t in ("div", "section") else GROUPS["other"] for t in BLOCKS] + [GROUPS["other"], GROUPS["run"]])


def _place(tag: int, names: frozenset) -> int:
    """What a node stands for by its own tag and names; boilerplate names count before a body's."""
    named = sorted(names)
    if named and (KINDS[named[0]] != "body" or tag not in PLACE_TAGS):
        return named[0]
    return PLACE_TAGS.get(tag, NOWHERE)


HEARTS, BOXES = frozenset(BLOCK[t] for t in ("article", "main")), frozenset(BLOCK[t] for t in ("div", "section", "article", "main", "body", "html", "td", "center"))
INSIDE, BEFORE, AFTER = range(3)


def where_of_heart(tree: Tree, length: list[int], linked: list[int]) -> list[int]:
    """For each node, whether it is inside the page's heart, before or after it, by structure alone: from the root, the way
    goes on to the child that has an article, else a first heading, else the most text that is no link, as long as boxes
    hold most of the text; what stands beside the way is outside."""
    n = len(tree.parent)
    kids: list[list[int]] = [[] for _ in range(n)]
    rank, last = [(0, 0)] * n, list(range(n))
    for i in range(n - 1, -1, -1):
        own = (2 * (tree.tag[i] in HEARTS) or int(tree.tag[i] == BLOCK["h1"]), 0)
        rank[i] = max(rank[i], own)
        p = tree.parent[i]
        if p >= 0:
            rank[p], last[p] = max(rank[p], rank[i]), max(last[p], last[i])
            if length[i]:
                kids[p].append(i)
    where, at = [INSIDE] * n, 0
    while kids[at] and tree.tag[at] not in HEARTS:
        plain = lambda i: length[i] - linked[i]
        boxes = [i for i in kids[at] if tree.tag[i] in BOXES]
        if not boxes or 2 * sum(map(plain, boxes)) < plain(at):
            break
        heart = max(boxes, key=lambda i: (rank[i], plain(i), -i))
        for i in kids[at]:
            if i != heart:
                where[i : last[i] + 1] = [BEFORE if i < heart else AFTER] * (last[i] + 1 - i)
        at = heart
    return where


@dataclass
class Forest:
    """Trees side by side: nodes ordered by depth, features as (node, feature) pairs."""

    parent: np.ndarray
    levels: list[np.ndarray]
    slot: np.ndarray  # a node's place in its level
    group: np.ndarray
    node: np.ndarray
    feature: np.ndarray
    run: list[tuple[int, int, str]]  # tree, node, text


def forest(trees: list[Tree]) -> Forest:
    parent, group, depth, nodes, features, runs = [], [], [], [], [], []
    for k, tree in enumerate(trees):
        base, n = len(parent), len(tree.parent)
        length, linked = [0] * n, [0] * n
        for i in range(n - 1, -1, -1):
            if tree.text[i] is not None:
                length[i], linked[i] = len(tree.text[i]), min(tree.linked[i], len(tree.text[i]))
                runs.append((k, base + i, tree.text[i]))
            if tree.parent[i] >= 0:
                length[tree.parent[i]] += length[i]
                linked[tree.parent[i]] += linked[i]
        words = np.searchsorted(BINS, np.array(length) // 6, "right")
        near, next_near = [NOWHERE] * n, [NOWHERE] * n
        where = where_of_heart(tree, length, linked)
        for i in range(n):
            p = tree.parent[i]
            place = _place(tree.tag[i], tree.names[i])
            if p >= 0:
                near[i], next_near[i] = (near[p], next_near[p]) if place in (NOWHERE, near[p]) else (place, near[p])
            parent.append(base + p if p >= 0 else -1)
            depth.append(depth[base + p] + 1 if p >= 0 else 0)
            group.append(GROUP_OF[tree.tag[i]])
            own = [OFFSETS[0] + tree.tag[i], OFFSETS[3] + words[i], OFFSETS[4] + min(4, 5 * linked[i] // length[i] if length[i] else 0), OFFSETS[7]]
            own += [OFFSETS[1] + x for x in tree.names[i]]
            if p >= 0:
                own.append(OFFSETS[2] + tree.tag[p])
            own += [OFFSETS[8] + near[i], OFFSETS[9] + near[i] * (N_NAMES + 1) + next_near[i], OFFSETS[10] + where[i], OFFSETS[11] + 3 * near[i] + where[i]]
            if tree.text[i] is not None:
                own += [OFFSETS[5] + (tree.text[i][-1] in ".!?…:;\"”»。！？"), OFFSETS[6] + min(3, tree.text[i].count(",") + tree.text[i].count(". "))]
            nodes += [base + i] * len(own)
            features += own
    depths = np.array(depth, np.int64)
    levels = np.split(np.argsort(depths, kind="stable"), np.cumsum(np.bincount(depths))[:-1]) if len(depths) else []
    slot = np.zeros(len(depths), np.int64)
    for at in levels:
        slot[at] = np.arange(len(at))
    return Forest(np.array(parent, np.int64), levels, slot, np.array(group, np.int64), np.array(nodes, np.int64), np.array(features, np.int64), sorted(runs, key=lambda r: r[:2]))


def _normal(x: np.ndarray) -> np.ndarray:
    top = x.max(axis=-1, keepdims=True)
    return x - top - np.log(np.exp(x - top).sum(axis=-1, keepdims=True))


def marginals(f: Forest, weights: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum-product over all trees at once, level by level: P(node state), and P(parent state, node state) for children.

    weights: (feature, state); edges: (group, parent state, child state). Messages are logarithms.
    """
    n = len(f.parent)
    own = np.zeros((n, 2))
    for s in (0, 1):
        own[:, s] = np.bincount(f.node, weights=weights[f.feature, s], minlength=n)
    pair = edges[f.group]
    up, inside = np.zeros((n, 2)), own.copy()
    for above, at in reversed(list(zip(f.levels, f.levels[1:]))):
        x = pair[at] + inside[at][:, None, :]
        top = x.max(axis=2)
        up[at] = top + np.log(np.exp(x - top[:, :, None]).sum(axis=2))
        for s in (0, 1):
            inside[above, s] += np.bincount(f.slot[f.parent[at]], weights=up[at, s], minlength=len(above))
    belief = inside.copy()
    joint = np.full((n, 2, 2), 0.0)
    for at in f.levels[1:]:
        down = belief[f.parent[at]] - up[at]
        x = down[:, :, None] + pair[at] + inside[at][:, None, :]
        x = _normal(x.reshape(-1, 4)).reshape(-1, 2, 2)
        joint[at] = np.exp(x)
        top = x.max(axis=1)
        state = top + np.log(np.exp(x - top[:, None, :]).sum(axis=1))
        belief[at] = state
    return np.exp(_normal(belief)), joint


MARK = re.compile(r"q\d+([gb])q ?")


def _labelled(seed: int, unknown: float = 0.25) -> tuple[Tree, list[int]]:
    """A training page's tree and the state of each of its nodes: an element is content if most of its text is."""
    tree = parse(Page(seed, unknown).html())
    n = len(tree.parent)
    good, total = np.zeros(n), np.zeros(n)
    for i in range(n - 1, -1, -1):
        if tree.text[i] is not None:
            marks = MARK.findall(tree.text[i])
            tree.text[i] = MARK.sub("", tree.text[i]) or "x"
            total[i] = len(tree.text[i])
            good[i] = total[i] * (marks.count("g") * 2 > len(marks))
        if tree.parent[i] >= 0:
            good[tree.parent[i]] += good[i]
            total[tree.parent[i]] += total[i]
    return tree, (good * 10 > total * 9).astype(int).tolist()


@lru_cache(maxsize=2)
def train(pages: int = TRAINING_PAGES, steps: int = STEPS, rate: float = 0.5, ridge: float = 2e-4) -> tuple[np.ndarray, np.ndarray]:
    """Weights and edges that make the labels of `pages` generated pages most likely (AdaGrad on the exact gradient)."""
    made = [_labelled(seed) for seed in range(pages)]
    f = forest([tree for tree, _ in made])
    states = np.concatenate([s for _, s in made])
    n = len(states)
    truth = np.eye(2)[states]
    child = np.flatnonzero(f.parent >= 0)
    joint_truth = truth[f.parent[child]][:, :, None] * truth[child][:, None, :]
    weights, edges = np.zeros((N_FEATURES, 2)), np.zeros((len(GROUPS), 2, 2))
    seen_w, seen_e = np.full(weights.shape, 1e-8), np.full(edges.shape, 1e-8)
    for _ in range(steps):
        belief, joint = marginals(f, weights, edges)
        gap = (truth - belief) / n
        grad_w = np.stack([np.bincount(f.feature, weights=gap[f.node, s], minlength=N_FEATURES) for s in (0, 1)], axis=1) - ridge * weights
        grad_e = -ridge * edges
        for g in range(len(GROUPS)):
            at = f.group[child] == g
            grad_e[g] += (joint_truth[at] - joint[child[at]]).sum(axis=0) / n
        seen_w, seen_e = seen_w + grad_w**2, seen_e + grad_e**2
        weights, edges = weights + rate * grad_w / np.sqrt(seen_w), edges + rate * grad_e / np.sqrt(seen_e)
    return weights, edges


def texts(pages: list[str | None], model: tuple[np.ndarray, np.ndarray]) -> list[str]:
    f = forest([parse(p or "") for p in pages])
    belief, _ = marginals(f, *model)
    out: list[list[str]] = [[] for _ in pages]
    for k, node, text in f.run:
        if belief[node, 1] > 0.5:
            out[k].append(text)
    return ["\n\n".join(x) for x in out]


def extract(pages: DataFrame, html_col: Column, keep: Mapping[str, Column]) -> DataFrame:
    """The columns in keep, text and n_chars, a row per input row, without a shuffle."""
    model = train()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                found = texts(part.column(0).to_pylist(), model)
                yield pa.RecordBatch.from_arrays([*part.columns[1:], pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())], names=[*part.schema.names[1:], "text", "n_chars"])

    rows = pages.select(html_col.cast("string").alias("__html"), *[c.alias(k) for k, c in keep.items()])
    return rows.mapInArrow(run, T.StructType([*rows.schema.fields[1:], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]))
