"""Main text of web pages by gradient-boosted trees over DOM nodes, with hierarchical decoding.

A page is read into a tree of block elements, whose leaves are runs of text (inline elements do not cut a run). Each
node has features of its tag and its ancestors', of its attributes' tokens (each hashed token has log-odds of holding
main text, learnt from the training pages), of its subtree (text, links, tags, punctuation), its depth, its place, its
siblings and the elements around it. Trees give each node's odds of holding main text. The decoding takes the most
likely labels among those without contradiction, where a node holds main text if and only if one of its children
does: a dynamic programme from the leaves up, read from the root down.

There are no labelled pages, so the trees learn from TRAIN_PAGES invented pages of many layouts (html_pages.py), of
whose vocabulary nothing here knows but what it learns.
"""

from __future__ import annotations

import html
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fernglass.llm import boosting, html_pages
from fernglass.llm.shared import pick, texts

#: Invented pages that the trees are fitted on.
TRAIN_PAGES = 600
SEED = 11
#: Places of hashed attribute tokens, and the pseudo-counts that pull a token's log-odds to 0.
SLOTS, PULL = 1 << 14, 3.0

# Elements of HTML by what they do to the text around them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is no text of the page; without an end tag only the tag itself is skipped, or, for RAW, see parse().
HIDDEN = frozenset("script style noscript template svg iframe textarea title select datalist audio video".split())
RAW = frozenset("script style".split())
BLOCKS = frozenset("html head body article section nav aside header footer main div p ul ol li dl dt dd table thead tbody tfoot tr td th caption form fieldset legend figure figcaption blockquote pre h1 h2 h3 h4 h5 h6 address details summary dialog menu hgroup search hr center".split())
CLOSES_P = BLOCKS - {"html", "head", "body", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "legend", "li", "dt", "dd"}
SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "p": ("p",)}
STOPS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table")}
#: From the tags that mostly surround main text to those that mostly are it: a tag's number is a feature.
TAGS = ("nav", "aside", "footer", "header", "form", "menu", "ul", "li", "dl", "dt", "dd", "table", "tr", "td", "th", "section", "div", "details", "figure", "figcaption", "pre", "blockquote", "main", "article", "p")
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_BIT = {t: 1 << k for k, t in enumerate(TAGS)}
_NUMBER = {t: float(k) for k, t in enumerate(TAGS)} | dict.fromkeys(HEADINGS, float(len(TAGS))) | {None: -1.0}
_SECTION = _BIT["article"] | _BIT["main"]
_TABLE, _ITEM = _BIT["table"], _BIT["li"]
_APART = sum(_BIT[t] for t in ("nav", "aside", "header", "footer", "form"))

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)", re.S)
_ATTR = re.compile(r"\b(class|id|role|itemprop|data-y)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
_WORD = re.compile(r"[a-z]+")
_HUMP = re.compile(r"([a-z])([A-Z])")
_WHITE = re.compile(r"[ \t\n\x0b\x0c\r]+")
_MARKS = re.compile(r"[.,;:!?…。，]")
_ENDS = frozenset(".!?…。:\"'»”)")
_SIGNS = re.compile("[\u00a9\u00b7\u00bb]|\\([cC]\\)")
_BODY = re.compile(r"</head\b|<body\b", re.I)


class Node:
    """A block element, or a run of text (tag None). first: characters of text before it on the page."""

    __slots__ = ("tag", "parent", "children", "words", "text", "chars", "linked", "marks", "links", "tags", "paragraphs", "items", "runs", "depth", "place", "first", "label")

    def __init__(self, tag: str | None, parent: Node | None, words: tuple[str, ...] = (), first: int = 0):
        self.tag, self.parent, self.children, self.words, self.first = tag, parent, [], words, first
        self.text = ""
        self.chars = self.linked = self.marks = self.links = self.tags = self.paragraphs = self.items = self.runs = 0
        self.label = 0
        self.depth = parent.depth + 1 if parent else 0
        self.place = len(parent.children) if parent else 0
        if parent:
            parent.children.append(self)


def _tokens(attributes: str) -> tuple[str, ...]:
    """The words of class, id, role and itemprop, cut at humps and marks, each once."""
    found: dict[str, None] = {}
    for name, value in _ATTR.findall(attributes):
        if name.lower() != "data-y":
            found |= dict.fromkeys(_WORD.findall(_HUMP.sub(r"\1 \2", value).lower()))
    return tuple(found)


def _mark(attributes: str) -> int | None:
    """The label of an invented page's element, if it has one; only fit() asks."""
    return next((int(value.strip("\"'")) for name, value in _ATTR.findall(attributes) if name.lower() == "data-y"), None)


def parse(page: str, invented: bool = False) -> Node:
    """The tree of a page, however broken: unknown ends are ignored, missing ones implied.

    A hidden element goes up to its end tag. Without one, script and style go up to the page's body, or else to its end;
    a title up to the next tag; of others only the tag is skipped. The labels of invented pages are read for them alone.
    """
    root = Node("html", None)
    at = root
    run: list[str] = []
    linked: list[str] = []
    links = in_link = seen = 0
    label = {id(root): 0}
    open_: Counter = Counter()  # open elements by tag, so that ends without a start cost nothing
    endless: set[str] = set()  # hidden elements that have no end any more

    def end_run() -> None:
        nonlocal links, seen
        if run:
            text = _WHITE.sub(" ", html.unescape("".join(run))).strip(" ")
            if text:
                leaf = Node(None, at, first=seen)
                leaf.text, leaf.chars = text, len(text)
                leaf.linked = min(len(text), len(_WHITE.sub(" ", html.unescape("".join(linked))).strip(" ")))
                leaf.links, leaf.marks, leaf.runs = links, len(_MARKS.findall(text)), 1
                leaf.label = label.get(id(at), 0)
                seen += len(text)
            run.clear()
            linked.clear()
        links = 0

    def put(text: str) -> None:
        run.append(text)
        if in_link:
            linked.append(text)

    def leave(node: Node) -> None:
        """Closes elements up to and including node."""
        nonlocal at
        while at is not node:
            open_[at.tag] -= 1
            at = at.parent
        open_[node.tag] -= 1
        at = node.parent

    place, size = 0, len(page)
    while place < size:
        m = _TAG.search(page, place)
        if m is None:
            put(page[place:])
            break
        if m.start() > place:
            put(page[place : m.start()])
        place = m.end()
        name = m[2] or m[5]
        if not name:
            continue
        name = name.lower()
        closing, attributes = (m[1], m[3]) if m[2] else (m[4], m[6])
        if closing:
            if name == "a":
                in_link = 0
            elif open_[name] > 0:
                node = at
                while node.tag != name:
                    node = node.parent
                end_run()
                leave(node)
            elif name == "p":
                end_run()  # an end without a start is an empty paragraph
            continue
        if name in HIDDEN:
            if not attributes.endswith("/"):
                stop = None if name in endless else re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|\Z)", re.I).search(page, place)
                if stop:
                    place = stop.end()
                else:
                    endless.add(name)
                    if name in RAW:
                        body = _BODY.search(page, place)
                        place = body.start() if body else size
                    elif name == "title":
                        after = page.find("<", place)
                        place = after if after >= 0 else size
            continue
        if name == "a":
            in_link = 1
            links += 1
        elif name == "br":
            put(" ")
        elif name in VOID and name != "hr":
            pass
        elif name in BLOCKS:
            end_run()
            in_link = 0
            if (name in CLOSES_P or name in ("li", "dt", "dd", "tr", "td", "th")) and at.tag == "p":
                leave(at)
            if name in SAME:
                node, stops = at, STOPS.get(name, ())
                while node is not root and node.tag not in SAME[name] and node.tag not in stops and name != "p":
                    node = node.parent
                while node is not root and node.tag in SAME[name]:
                    leave(node)
                    node = at
            if name == "body" and open_["head"]:
                node = at
                while node.tag != "head":
                    node = node.parent
                leave(node)
            if name in ("html", "hr", "body"):
                continue
            parent = at
            at = Node(name, parent, _tokens(attributes) if attributes else (), seen)
            open_[name] += 1
            if invented:
                own = _mark(attributes)
                label[id(at)] = label.get(id(parent), 0) if own is None else own
    end_run()
    return root


def flatten(root: Node) -> list[Node]:
    """All nodes, parents before children and in page order; sums of subtrees are filled in."""
    nodes, stack = [], [root]
    while stack:
        node = stack.pop()
        nodes.append(node)
        stack.extend(reversed(node.children))
    for node in reversed(nodes):
        for child in node.children:
            node.chars += child.chars
            node.linked += child.linked
            node.marks += child.marks
            node.links += child.links
            node.runs += child.runs
            node.tags += child.tags + (child.tag is not None)
            node.paragraphs += child.paragraphs + (child.tag == "p")
            node.items += child.items + (child.tag == "li")
            node.label |= child.label
    return nodes


class Odds(dict):
    """Log-odds of attribute tokens, by their hashed place in a table."""

    def __init__(self, table: np.ndarray):
        super().__init__()
        self.table = table

    def __missing__(self, word: str) -> float:
        found = float(self.table[zlib.crc32(word.encode()) % SLOTS])
        if len(self) < 100_000:
            self[word] = found
        return found

    def __reduce__(self):
        return Odds, (self.table,)


def token_odds(pages: list[list[Node]]) -> Odds:
    """Each token's log-odds between the nodes with it that hold main text and those that hold other text only."""
    counts = np.zeros((2, SLOTS))
    for nodes in pages:
        for n in nodes:
            if n.chars:
                for w in n.words:
                    counts[n.label, zlib.crc32(w.encode()) % SLOTS] += 1
    share = (counts[1].sum() + 1) / (counts.sum() + 2)
    return Odds(np.log((counts[1] + PULL * share) / (counts[0] + PULL * (1 - share))) - math.log(share / (1 - share)))


def features(nodes: list[Node], odds: Odds) -> list[list[float]]:
    total = max(1, nodes[0].chars)
    #: Of a node's ancestors and itself: tags among TAGS as bits, least, greatest and summed token log-odds, and the
    #: nearest element with two paragraphs or more.
    above: dict[int, tuple] = {}
    out = []
    start = (0, 0.0, 0.0, 0.0, nodes[0])
    for n in nodes:
        p = n.parent or n
        g = p.parent or p
        up = above[id(p)] if n.parent else start
        bits, low, high, summed, around = up
        own = [odds[w] for w in n.words]
        o_low, o_high, o_sum = (min(own), max(own), sum(own)) if own else (0.0, 0.0, 0.0)
        bit = _BIT.get(n.tag, 0)
        if n.children:
            above[id(n)] = (bits | bit, min(low, o_low), max(high, o_high), summed + o_sum, n if n.paragraphs > 1 or n.marks > 12 and n.linked * 3 < n.chars else around)
        chars = max(1, n.chars)
        pc = max(1, p.chars)
        kids = p.children
        before = kids[n.place - 1] if n.parent and n.place else None
        after = kids[n.place + 1] if n.parent and n.place + 1 < len(kids) else None
        text = n.text
        gc, ac = max(1, g.chars), max(1, around.chars)
        row = [
            _NUMBER.get(n.tag, -2.0), _NUMBER.get(p.tag, -2.0), _NUMBER.get(g.tag, -2.0), n.tag == "h1" or p.tag == "h1", bits & _SECTION > 0, bits & _APART > 0, bits & _TABLE > 0, bits & _ITEM > 0,
            o_low, o_high, o_sum, low, high, summed,
            n.chars, n.linked / chars, n.marks / chars, n.links, n.tags, n.paragraphs, n.items,
            n.chars / (n.tags + 1), n.chars / max(1, n.runs), n.chars / total, n.first / total, n.depth, n.place, len(kids), n.place / max(1, len(kids)),
            p.chars, p.linked / pc, n.chars / pc, p.marks / pc, p.paragraphs, p.items, g.chars, g.linked / gc, g.marks / gc, g.paragraphs,
            around.chars, around.linked / ac, n.chars / ac, (n.first - around.first) / ac, around is p, around is nodes[0],
            before.chars if before else -1.0, before.linked / max(1, before.chars) if before else -1.0, _NUMBER.get(before.tag, -2.0) if before else -3.0,
            after.chars if after else -1.0, after.linked / max(1, after.chars) if after else -1.0, after is not None and after.tag == n.tag,
            text[-1:] in _ENDS, _SIGNS.search(text) is not None if text and len(text) < 400 else False, "|" in text, text[:1].isupper(),
        ]
        out.append(row)
    return out


def decode(nodes: list[Node], odds: np.ndarray) -> list[bool]:
    """The most likely labels such that a node holds main text if and only if one of its children does.

    odds: each node's log-odds. For a node, `none` is the best for its subtree without main text, relative to its sum
    of log(1 - p): 0; `some` that with it: its own log-odds, its children's gains, and the least bad child if none gains.
    """
    index = {id(n): i for i, n in enumerate(nodes)}
    some = np.zeros(len(nodes))
    force = [-1] * len(nodes)
    for i in range(len(nodes) - 1, -1, -1):
        n = nodes[i]
        if n.tag is None:
            some[i] = odds[i]
            continue
        if not n.children:
            some[i] = -math.inf
            continue
        kids = [index[id(c)] for c in n.children]
        gains = [some[k] for k in kids]
        best = max(range(len(kids)), key=gains.__getitem__)
        gain = sum(g for g in gains if g > 0)
        if gains[best] <= 0:
            force[i] = kids[best]
            gain = gains[best]
        some[i] = odds[i] + gain
    chosen = [False] * len(nodes)
    chosen[0] = some[0] > 0
    for i, n in enumerate(nodes):
        if i and not chosen[i]:
            chosen[i] = chosen[index[id(n.parent)]] and (some[i] > 0 or force[index[id(n.parent)]] == i)
    return chosen


@dataclass
class Model:
    trees: boosting.Trees
    odds: Odds


def extract(pages: list[str], model: Model) -> list[list[str]]:
    """The blocks of main text of each page, in page order."""
    trees_of = [flatten(parse(p)) for p in pages]
    rows = [r for nodes in trees_of for r in features(nodes, model.odds)]
    odds = model.trees.log_odds(np.array(rows)) if rows else np.zeros(0)
    out, at = [], 0
    for nodes in trees_of:
        chosen = decode(nodes, odds[at : at + len(nodes)])
        at += len(nodes)
        out.append([n.text for n, yes in zip(nodes, chosen) if yes and n.tag is None])
    return out


_FITTED: dict[tuple[int, int], Model] = {}


def fit(pages: int = TRAIN_PAGES, seed: int = SEED) -> Model:
    """Fitted on invented pages; the same for the same arguments.

    The trees see each half of the pages with the token log-odds of the other half, so that they learn how far such
    log-odds can be trusted on pages that they were not made from.
    """
    if (pages, seed) not in _FITTED:
        maker = html_pages.Maker(seed)
        made = [flatten(parse(maker.page(), invented=True)) for _ in range(pages)]
        halves = made[::2], made[1::2]
        rows, labels = [], []
        for own, other in (halves, halves[::-1]):
            odds = token_odds(other)
            for nodes in own:
                rows += features(nodes, odds)
                labels += [n.label for n in nodes]
        _FITTED[pages, seed] = Model(boosting.fit(np.array(rows), np.array(labels, float), trees=60, depth=5, share=0.3), token_odds(made))
    return _FITTED[pages, seed]


def _groups(pages: list[str]) -> Iterator[list[str]]:
    """Some pages at a time, few if they are long, as each node has a row of features."""
    held, size = [], 0
    for page in pages:
        held.append(page)
        size += len(page)
        if len(held) >= 50 or size > 400_000:
            yield held
            held, size = [], 0
    if held:
        yield held


def _extractor(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pages = [t.decode("utf-8", "replace") for t in texts(batch.column("html"))]
            blocks = [b for group in _groups(pages) for b in extract(group, shared.value)]
            found = [" ".join(b) for b in blocks]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64()), pa.array(blocks, pa.list_(pa.string()))], names=["page_id", "url", "text", "n_chars", "blocks"])

    return run


def main_text(pages: DataFrame, model: Model | None = None) -> DataFrame:
    """One row per row of pages: page_id, url, text, n_chars, blocks (the parts of text).

    Null html is an empty page; a page without main text has an empty one. Broken markup is read as far as it goes (see
    parse() for hidden elements, closed by themselves or not at all). A very long page is read whole, in memory of some
    times its size. Where labels are equally likely a node holds no main text; of children that tie for the least bad
    the first is taken. Rows that repeat are read each for itself. Other columns, case twins included, are ignored.
    Empty table: no rows.
    """
    rows = pick(pages, "page_id", "url", "html").select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    shared = pages.sparkSession.sparkContext.broadcast(model or fit())
    return rows.mapInArrow(_extractor(shared), "page_id long, url string, text string, n_chars long, blocks array<string>")
