"""Main text of web pages by boosted trees over the nodes of the page.

`parse` turns a page into a tree of elements with the text they hold. Every element is
described by `features`: shares of text, links and elements in its subtree, its depth, its
place among its siblings and theirs, and how many tokens of its name and attributes belong
to page furniture or to content. Gradient-boosted trees (`fit`, logistic loss, histogram
splits) give each element the odds that it holds main text. Decoding is hierarchical: an
element is kept only below kept elements, and of all such choices the most probable is
taken, bottom up (`decode`), so an ancestor and its descendants never contradict.

There are no marked pages, so the trees learn from weak marks: in a bounded sample of
pages (`max_pages`, the first by a hash of the id) what stands inside `article` or `main`
and outside of furniture is content; on a page without these, what stands inside of elements
whose attributes speak of content; without such, blocks of sentences with few links. Every
sampled page is shown as it is, and again
with its elements renamed to plain `div` and their role told by the tokens of a class
attribute; so the trees learn attributes and shape and do not hang on two tag names. Either
way it is shown once more with some content repeated beside and inside of the article as furniture (comments,
notices, adverts with words of their own), which is no content then.

The text is that of the kept elements: character references decoded, white space inside a
block one space, blocks in page order joined by a line feed. Script, style and the like
never hold text, nor do forms, but for one around the article (with a heading or article
in it or half of the page's text), which is a box like any other.

Nulls: a NULL page is empty and gives an empty text; so does a page without any kept
element. A NULL id is passed through; repeated rows give repeated rows; an empty table
gives an empty result, and without pages to learn from everything is kept. Broken markup
is closed as browsers do for paragraphs, list items, table cells and options; declarations of any kind are comments. Other
columns are not looked at.
"""

from __future__ import annotations

import random
import re
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_PAGES = 250
# Elements that are judged together.
AT_ONCE = 4_000
# Characters of a block that passes for told where nothing else says what content is.
LEAST_TOLD = 60
TREES, DEPTH, RATE, LEAST_LEAF, CUTS = 80, 3, 0.1, 30, 32

# Fixed values of HTML: elements without content, without text, and those in a line.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset(
    "script style noscript template title head svg math iframe object canvas audio video select"
    " textarea button".split()
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp"
    " rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
# A start tag of a group closes an open element of the same group, up to a holder.
CLOSERS = {
    "p": "p",
    "li": "li",
    "dt": "dt dd",
    "dd": "dt dd",
    "option": "option",
    "tr": "tr td th",
    "td": "td th",
    "th": "td th",
}
HOLDERS = frozenset("ul ol dl table select body article section div main td th blockquote".split())
# Words in names and attributes: page furniture and content.
FURNITURE = frozenset(
    "ad ads advert advertisement advertising banner sponsor sponsored promo promotion nav navbar"
    " navigation menu breadcrumb breadcrumbs header masthead footer foot sidebar aside rail widget"
    " related recommended share sharing social cookie cookies consent notice alert popup modal"
    " newsletter subscribe signup login form search comment comments disqus reply replies respond"
    " copyright legal pagination pager toolbar skip tags contentinfo complementary dialog".split()
)
CONTENT = frozenset(
    "article main content body post entry story text page blog news paragraph prose".split()
)
DRESSES = {
    True: ["content", "main content", "post-body", "entry", "story text", "article-body"],
    False: ["sidebar", "cookie-notice", "comments", "menu", "site-header", "footer", "advert", "related",
            "newsletter signup", "share social", "breadcrumbs", "notice", "widget", "promo banner", "nav"],
}
# Elements and those inside of them: furniture, and content beside paragraphs.
BOXES = [("div", "p"), ("div", "div"), ("section", "p"), ("aside", "p"), ("div", "span")]
LISTS = [("ul", "li"), ("ol", "li"), ("blockquote", "p"), ("table", "td"), ("div", "p"), ("section", "p")]
_TOKEN = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")


@dataclass
class Node:
    tag: str
    parent: int
    depth: int
    words: str = ""  # attribute text that says what the element is for
    children: list[int] = field(default_factory=list)
    pieces: list[tuple[int, str]] = field(default_factory=list)  # (order, own text)
    silent: bool = False


class _Reader(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.nodes = [Node("#page", -1, 0)]
        self.open = [0]
        self.order = 0

    def handle_starttag(self, tag, attrs):
        if tag in CLOSERS:
            self._close(CLOSERS[tag].split())
        elif tag not in INLINE:
            self._close(["p"])
        at, parent = len(self.nodes), self.open[-1]
        said = " ".join(v for k, v in attrs if v and k in ("class", "id", "role", "aria-label", "itemprop"))
        above = self.nodes[parent]
        node = Node(tag, parent, above.depth + 1, said.lower(), silent=above.silent or tag in SILENT)
        self.nodes.append(node)
        above.children.append(at)
        if tag == "br":
            self.handle_data(" ")
        if tag not in VOID:
            self.open.append(at)

    def _close(self, tags):
        for i in range(len(self.open) - 1, 0, -1):
            tag = self.nodes[self.open[i]].tag
            if tag in tags:
                del self.open[i:]
                return
            if tag in HOLDERS:
                return

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.nodes[self.open[-1]].tag == tag:
            self.open.pop()

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, 0, -1):
            if self.nodes[self.open[i]].tag == tag:
                del self.open[i:]
                return

    def handle_data(self, data):
        self.nodes[self.open[-1]].pieces.append((self.order, data))
        self.order += 1

    def parse_marked_section(self, i, report=1):
        # `<![...` is none of HTML: a comment up to the next `>`, whatever it says.
        end = self.rawdata.find(">", i)
        return end + 1 if end >= 0 else -1


def parse(html: str | None) -> list[Node]:
    """Elements in page order; the first is the page itself."""
    reader = _Reader()
    reader.feed(html or "")
    reader.close()
    _judge_forms(reader.nodes)
    return reader.nodes


def _judge_forms(nodes: list[Node]) -> None:
    """A form around the article is a box like any other; other forms are silent.

    The former holds a heading, an article or half of the page's text.
    """
    if not any(n.tag == "form" for n in nodes):
        return
    chars = [0 if n.silent else sum(len(t.strip()) for _, t in n.pieces) for n in nodes]
    holds = [n.tag in ("article", "main", "h1") and not n.silent for n in nodes]
    for i in range(len(nodes) - 1, 0, -1):
        chars[nodes[i].parent] += chars[i]
        holds[nodes[i].parent] |= holds[i]
    for i, node in enumerate(nodes):
        if node.tag == "form" and not node.silent:
            if holds[i] or 2 * chars[i] >= chars[0]:
                node.tag = "div"
            else:
                node.silent = True
        elif i and nodes[node.parent].silent:
            node.silent = True


NAMES = (
    "chars links elements density link_share depth place siblings same_tag sibling_chars share_of_parent"
    " mean_block marks furniture content furniture_above content_above inline paragraph heading list row"
    " end_share"
).split()


def features(nodes: list[Node]) -> np.ndarray:
    """One row per element, in the order of `NAMES`. What is silent holds no characters."""
    n = len(nodes)
    chars, links, below, blocks, marks = (np.zeros(n) for _ in range(5))
    for i, node in enumerate(nodes):
        if not node.silent:
            own = "".join(t for _, t in node.pieces)
            chars[i] = len(own.strip())
            marks[i] = sum(own.count(c) for c in ".,;:!?")
            blocks[i] = chars[i] > 0 and node.tag not in INLINE
    for i in range(n - 1, 0, -1):
        if nodes[i].tag == "a":
            links[i] = chars[i]
        up = nodes[i].parent
        chars[up] += chars[i]
        links[up] += links[i]
        below[up] += below[i] + 1
        blocks[up] += blocks[i]
        marks[up] += marks[i]
    words = [set(_TOKEN.findall(f"{x.words} {x.tag}")) for x in nodes]
    bad = np.array([len(w & FURNITURE) for w in words], float)
    good = np.array([len(w & CONTENT) - ("body" in w and x.tag == "body") for w, x in zip(words, nodes)], float)
    bad_above, good_above = np.zeros(n), np.zeros(n)
    rows = np.zeros((n, len(NAMES)))
    for i, node in enumerate(nodes):
        up = node.parent
        if up >= 0:
            bad_above[i] = bad_above[up] + bad[up]
            good_above[i] = good_above[up] + good[up]
    places = np.zeros(n)
    same = np.zeros(n)
    beside = np.zeros(n)
    for node in nodes:
        tags: dict[str, int] = {}
        for c in node.children:
            tags[nodes[c].tag] = tags.get(nodes[c].tag, 0) + 1
        total = sum(chars[c] for c in node.children)
        for k, c in enumerate(node.children):
            places[c] = k / len(node.children)
            same[c] = tags[nodes[c].tag]
            beside[c] = total - chars[c]
    all_chars = max(chars[0], 1.0)
    for i, node in enumerate(nodes):
        up = max(node.parent, 0)
        tag = node.tag
        rows[i] = (
            chars[i], links[i], below[i], chars[i] / (below[i] + 1), links[i] / max(chars[i], 1),
            node.depth, places[i], len(nodes[up].children), same[i], beside[i],
            chars[i] / max(chars[up], 1), chars[i] / max(blocks[i], 1), marks[i] / max(chars[i], 1),
            bad[i], good[i], bad_above[i], good_above[i], tag in INLINE, tag == "p",
            tag[:1] == "h" and tag[1:].isdigit(), tag in ("ul", "ol", "li"), tag in ("tr", "td", "th", "table"),
            chars[i] / all_chars,
        )
    return rows


@dataclass
class Forest:
    """Trees as arrays: feature, cut, children (left if value <= cut), value at leaves."""

    prior: float
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.prior)
        rows = np.arange(len(x))
        for of, cut, left, value in self.trees:
            at = np.zeros(len(x), int)
            for _ in range(DEPTH):
                step = left[at] + (x[rows, of[at]] > cut[at])
                at = np.where(left[at] > 0, step, at)
            out += value[at]
        return out


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES) -> Forest:
    """Newton boosting of the logistic loss; splits at quantiles of each feature."""
    if not len(y) or y.min() == y.max():
        return Forest(4.0 if not len(y) or y[0] else -4.0, [])
    share = y.mean()
    margin = np.full(len(y), np.log(share / (1 - share)))
    prior = float(margin[0])
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, CUTS + 1)[:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, x.T)], 1)
    made = []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        tree = _grow(binned, cuts, p - y, p * (1 - p))
        made.append(tree)
        margin += Forest(0.0, [tree]).margin(x)
    return Forest(prior, made)


def _grow(binned, cuts, grad, hess):
    of, cut, left, value = [], [], [], []
    pull = 1.0

    def add(rows):
        of.append(0), cut.append(0.0), left.append(0)
        value.append(-RATE * grad[rows].sum() / (hess[rows].sum() + pull))
        return len(of) - 1

    waiting = [(add(np.arange(len(grad))), np.arange(len(grad)), 0)]
    while waiting:
        at, rows, depth = waiting.pop()
        if depth == DEPTH or len(rows) < 2 * LEAST_LEAF:
            continue
        g, h = grad[rows], hess[rows]
        whole = g.sum() ** 2 / (h.sum() + pull)
        best = (1e-6, -1, -1)
        for f in range(binned.shape[1]):
            size = len(cuts[f]) + 1
            b = binned[rows, f]
            gl, hl, nl = (np.cumsum(np.bincount(b, w, size))[:-1] for w in (g, h, None))
            gain = gl**2 / (hl + pull) + (g.sum() - gl) ** 2 / (h.sum() - hl + pull) - whole
            gain[(nl < LEAST_LEAF) | (len(rows) - nl < LEAST_LEAF)] = -1
            k = int(gain.argmax()) if len(gain) else 0
            if len(gain) and gain[k] > best[0]:
                best = (gain[k], f, k)
        _, f, k = best
        if f < 0:
            continue
        goes = binned[rows, f] <= k
        low, high = rows[goes], rows[~goes]
        of[at], cut[at], left[at] = f, float(cuts[f][min(k, len(cuts[f]) - 1)]), add(low)
        add(high)
        waiting += [(left[at], low, depth + 1), (left[at] + 1, high, depth + 1)]
    return np.array(of), np.array(cut), np.array(left), np.array(value)


def weak_marks(nodes: list[Node]) -> np.ndarray:
    """1 for elements that hold content by their names alone, and all above those.

    Where no element is an `article` or `main`, attributes that speak of content count; where
    none does, blocks of sentences with few links.
    """
    words = [set(_TOKEN.findall(n.words)) for n in nodes]
    bad = [n.silent or bool((w | {n.tag}) & FURNITURE) for n, w in zip(nodes, words)]
    marked = _marked(nodes, bad, lambda i: nodes[i].tag in ("article", "main"))
    if not marked.any():
        marked = _marked(nodes, bad, lambda i: bool(words[i] & CONTENT))
    if not marked.any():
        told = _told(nodes)
        marked = _marked(nodes, bad, lambda i: told[i])
    return marked


def _marked(nodes: list[Node], bad: list[bool], begins) -> np.ndarray:
    inside = np.zeros(len(nodes), bool)
    marked = np.zeros(len(nodes))
    for i, node in enumerate(nodes):
        if i:
            inside[i] = begins(i) or inside[node.parent]
        if bad[i]:
            inside[i] = False
        if inside[i] and any(t.strip() for _, t in node.pieces):
            up = i
            while up >= 0 and not marked[up]:
                marked[up] = 1
                up = nodes[up].parent
    return marked


def _told(nodes: list[Node]) -> list[bool]:
    """Blocks without blocks inside that hold sentences and few links, outside of furniture,
    and what stands in one box with mostly such."""
    n = len(nodes)
    chars, links, marks = [0] * n, [0] * n, [0] * n
    leaf, ok = [True] * n, [True] * n
    for i, node in enumerate(nodes):
        if i:
            said = set(_TOKEN.findall(f"{node.words} {node.tag}"))
            ok[i] = ok[node.parent] and not node.silent and not said & FURNITURE
        if not node.silent:
            own = "".join(t for _, t in node.pieces)
            chars[i], marks[i] = len(own.strip()), sum(own.count(c) for c in ".!?")
    for i in range(n - 1, 0, -1):
        up = nodes[i].parent
        links[i] = chars[i] if nodes[i].tag == "a" else links[i]
        chars[up] += chars[i]
        links[up] += links[i]
        marks[up] += marks[i]
        if nodes[i].tag not in INLINE and nodes[i].tag not in VOID:
            leaf[up] = False
    plain = [i > 0 and ok[i] and 4 * links[i] < chars[i] for i in range(n)]
    told = [
        plain[i] and leaf[i] and nodes[i].tag not in INLINE and chars[i] >= LEAST_TOLD and marks[i] > 0
        for i in range(n)
    ]
    # Short blocks, such as headings, belong to those they stand among.
    among = [
        2 * sum(told[c] for c in node.children) >= max(4, sum(chars[c] > 0 for c in node.children))
        for node in nodes
    ]
    return [told[i] or (plain[i] and leaf[i] and among[nodes[i].parent]) for i in range(n)]


def disguised(nodes: list[Node], marks: np.ndarray, rng: random.Random) -> list[Node]:
    """The page with plain names; a top-most part of either kind is dressed by a class."""
    out = []
    for i, node in enumerate(nodes):
        new = Node(node.tag, node.parent, node.depth, "", node.children, node.pieces, node.silent)
        if i and node.tag in ("article", "main", "nav", "footer", "header", "aside", "section", "div"):
            new.tag = "div"
            kind = bool(marks[i])
            above = marks[node.parent] if node.parent >= 0 else 1
            if node.tag != "section" and (kind or above) and rng.random() < 0.8:
                new.words = rng.choice(DRESSES[kind])
        out.append(new)
    return out


def with_furniture(
    nodes: list[Node], marks: np.ndarray, rng: random.Random
) -> tuple[list[Node], np.ndarray]:
    """The page with content repeated as furniture, once below the page's body and twice
    inside of what holds the content, and once there as a list, a table or a quotation
    that is content."""
    told = [i for i, n in enumerate(nodes) if marks[i] and any(t.strip() for _, t in n.pieces)]
    nodes = [Node(n.tag, n.parent, n.depth, n.words, [*n.children], n.pieces, n.silent) for n in nodes]
    added: list[int] = []
    for inside, good in ((False, 0), (True, 0), (True, 0), (True, 1)):
        holder = nodes[rng.choice(told)].parent
        while not inside and holder > 0 and nodes[holder].tag != "body":
            holder = nodes[holder].parent
        tag, inner = rng.choice(LISTS if good else BOXES)
        box = Node(tag, holder, nodes[holder].depth + 1, "" if good else rng.choice(DRESSES[False]))
        nodes[holder].children.append(len(nodes))
        nodes.append(box)
        at = len(nodes) - 1
        for i in rng.sample(told, min(len(told), rng.randint(1, 3))):
            box.children.append(len(nodes))
            nodes.append(Node(inner, at, box.depth + 1, "", [], nodes[i].pieces))
        added += [good] * (len(nodes) - at)
    return nodes, np.concatenate([marks, added])


def examples(html: str | None, seed: int) -> tuple[np.ndarray, np.ndarray]:
    nodes = parse(html)
    marks = weak_marks(nodes)
    if not marks.any():
        return np.empty((0, len(NAMES))), np.empty(0)
    rng = random.Random(seed)
    shown = [(nodes, marks), with_furniture(nodes, marks, rng)]
    other = disguised(nodes, marks, rng)
    shown += [(other, marks), with_furniture(other, marks, rng)]
    x, y = [], []
    for page, mark in shown:
        loud = np.array([not n.silent for n in page])
        x.append(features(page)[loud])
        y.append(mark[loud])
    return np.concatenate(x), np.concatenate(y)


def decode(nodes: list[Node], margin: np.ndarray) -> np.ndarray:
    """The most probable choice in which nothing is kept below what is dropped."""
    keep = -np.logaddexp(0, -margin)
    drop = -np.logaddexp(0, margin)
    whole_drop, best_keep = drop.copy(), keep.copy()
    for i in range(len(nodes) - 1, 0, -1):
        up = nodes[i].parent
        whole_drop[up] += whole_drop[i]
        best_keep[up] += max(best_keep[i], whole_drop[i])
    kept = np.zeros(len(nodes), bool)
    for i, node in enumerate(nodes):
        above = node.parent < 0 or kept[node.parent]
        kept[i] = above and not node.silent and best_keep[i] >= whole_drop[i]
    return kept


def block_text(nodes: list[Node], kept: np.ndarray) -> str:
    """Text of kept elements; an element that is not in a line begins and ends a block."""
    parts: list[tuple[int, int, str]] = []
    block_of = [0] * len(nodes)
    for i, node in enumerate(nodes):
        block_of[i] = block_of[node.parent] if i and node.tag in INLINE else i
        if kept[i]:
            parts += [(order, i, text) for order, text in node.pieces]
    parts.sort()
    blocks: list[str] = []
    last = None
    for _, i, text in parts:
        if block_of[i] != last:
            blocks.append("")
            last = block_of[i]
        blocks[-1] += text
    clean = (_SPACE.sub(" ", b).strip() for b in blocks)
    return "\n".join(b for b in clean if b)


def main_texts(pages: list[str | None], forest: Forest) -> list[str]:
    """The text of each page; the trees judge the elements of many pages at once."""
    texts: list[str] = []
    waiting: list[list[Node]] = []
    elements = 0

    def judge() -> None:
        if waiting:
            margin = forest.margin(np.concatenate([features(nodes) for nodes in waiting]))
            ends = np.cumsum([len(nodes) for nodes in waiting])
            for nodes, end in zip(waiting, ends):
                texts.append(block_text(nodes, decode(nodes, margin[end - len(nodes) : end])))
            waiting.clear()

    for page in pages:
        waiting.append(parse(page))
        elements += len(waiting[-1])
        if elements >= AT_ONCE:
            judge()
            elements = 0
    judge()
    return texts


def main_text(html: str | None, forest: Forest) -> str:
    return main_texts([html], forest)[0]


def learn(pages: DataFrame, key: str = "page_id", html: str = "html", max_pages: int = MAX_PAGES) -> Forest:
    """Fit on the first `max_pages` pages by a hash of the key; only rows of features reach
    the driver."""
    ids = pages.select(F.col(key).alias("key")).dropna().distinct()
    ids = ids.orderBy(F.xxhash64("key"), "key").limit(max_pages)
    rows = pages.select(F.col(key).alias("key"), F.col(html).alias("html")).join(F.broadcast(ids), "key")

    def run(batches):
        for batch in batches:
            for page in batch.column("html").to_pylist():
                x, y = examples(page, len(page or ""))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x.astype("<f4").tobytes()], pa.binary()), pa.array([y.astype("u1").tobytes()], pa.binary())],
                    names=["x", "y"],
                )

    # Of the pages of one key one teaches, however often the key is repeated.
    one = F.min(F.struct(F.xxhash64("html").alias("h"), "html")).alias("one")
    rows = rows.groupBy("key").agg(one).select("one.html")
    told = rows.mapInArrow(run, "x binary, y binary").toPandas().sort_values(["x", "y"])
    x = [np.frombuffer(b, "<f4").reshape(-1, len(NAMES)) for b in told["x"]]
    y = [np.frombuffer(b, "u1") for b in told["y"]]
    if not x:
        return fit(np.empty((0, len(NAMES))), np.empty(0))
    return fit(np.concatenate(x).astype(float), np.concatenate(y).astype(float))


def extracted(
    pages: DataFrame, forest: Forest, key: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """Per row: key, url, text, n_chars."""
    rows = pages.select(F.col(key).alias(key), F.col(url).alias(url), F.col(html).alias("__html"))
    kinds = [rows.schema[c].dataType.simpleString() for c in (key, url)]

    def run(batches):
        for batch in batches:
            texts = main_texts(batch.column(2).to_pylist(), forest)
            n = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), n], names=[key, url, "text", "n_chars"]
            )

    return rows.mapInArrow(run, f"`{key}` {kinds[0]}, `{url}` {kinds[1]}, text string, n_chars bigint")
