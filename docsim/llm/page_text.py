"""Main text of web pages by a graphical model on the tree of their elements.

Elements and text blocks are the nodes of a tree; each is content or not. Potentials of nodes come from
their features, potentials of edges from the labels of parent and child. Messages passed up and down the
tree (sum-product) give each block's exact marginal; blocks above one half are the text. Wrappers of
content count as content, so an edge from a non-content parent to a content child hardly occurs and what
stands in a menu stays out whatever it looks like.

The model is trained on pages that mark their article with ``article``, ``main`` or ``role=main``; these
marks label the nodes. Weights are pulled towards the prior below, which is used alone where no page has
marks.
"""

from __future__ import annotations

import bisect
import math
import re
from collections.abc import Iterable, Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsim.llm.words import values

TRAINING_PAGES = 300  # bound on the pages the model is fitted on
TRAINING_CHARS = 50_000  # and on the length of each of them

# Element names.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong "
    "sub sup time tt u var".split()
)
VOID = frozenset("area base col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset(
    "script style noscript template title svg math iframe object canvas audio video select button textarea datalist".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol "
    "p pre section table ul".split()
)
ENDS_SKIPPED = CLOSES_P | frozenset("body caption dd dt figcaption li tbody td tfoot th thead tr".split())
SAME_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
SCOPES = frozenset("table ul ol dl div article section main body td".split())

# Words in names, classes, ids and roles that tell what an element is for.
BOILERPLATE = frozenset(
    "ad ads advert advertisement adverts adbox aside banner breadcrumb breadcrumbs byline complementary consent contentinfo "
    "cookie cookies comment comments commentlist dialog discussion disqus footer form gdpr header hidden login masthead menu "
    "modal nav navbar navigation newsletter notice pager pagination popup promo promoted recommended related replies reply "
    "respond responses search share sharing sidebar signup social sponsor sponsored subscribe toolbar topbar widget widgets".split()
)
CONTENT = frozenset("article content entry main page post story text".split())

FEATURES = ("element", "block", "boilerplate", "content", "length", "links", "sentence", "heading", "sign")
PRIOR = np.array([0.3, -0.5, -6.0, 3.0, 0.5, -3.0, 1.0, 1.0, -2.5])
#: Log potentials by (parent, child).
PRIOR_EDGES = np.array([[0.5, -6.0], [0.0, 0.5]])
_TOKEN = re.compile(r"[a-z]+")
_SIGNS = re.compile(r"[©®]|all rights reserved", re.I)
_CUT_TAG = re.compile(r"<[a-zA-Z/!?][^<>]*\Z")
_COMMENT = re.compile(r"<!---?>")
_COMMENT_END = re.compile(r"--(?:!|\s*)>")
_SPACES = re.compile(r"\s+")


class Events(HTMLParser):
    """Tags and texts of a page in page order, as (kind, tag or text, attributes)."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.events: list[tuple[str, str, list]] = []

    def parse_comment(self, i, report=True):
        """End of a comment; one that is not closed goes to the end of the page."""
        found = _COMMENT.match(self.rawdata, i) or _COMMENT_END.search(self.rawdata, i + 4)
        return found.end() if found else len(self.rawdata)

    def handle_starttag(self, tag, attrs):
        self.events.append(("start", tag, attrs))

    def handle_startendtag(self, tag, attrs):
        self.events.append(("both", tag, attrs))

    def handle_endtag(self, tag):
        self.events.append(("end", tag, []))

    def handle_data(self, data):
        self.events.append(("data", data, []))


def skipped_until(events: list[tuple[str, str, list]]) -> dict[int, int]:
    """For the start of each skipped element the event to go on with.

    That is what follows its end tag. An element whose end tag does not come before that of an element around it
    is not closed: it ends at the first block-level tag or at the end tag of an element around it.
    """
    out: dict[int, int] = {}
    stack: list[tuple[str, int]] = []
    opened: dict[str, int] = {}  # how often each tag is on the stack
    blocks: list[int] = []  # events that end an unclosed element
    for k, (kind, tag, _) in enumerate(events):
        if kind == "start" and tag not in INLINE and tag not in VOID:
            stack.append((tag, k))
            opened[tag] = opened.get(tag, 0) + 1
        elif kind == "end" and opened.get(tag):
            while True:
                top, at = stack.pop()
                opened[top] -= 1
                if top == tag:
                    break
                if top in SKIPPED:
                    out[at] = k
            if tag in SKIPPED:
                out[at] = -k - 1  # closed
        if kind in ("start", "both") and tag in ENDS_SKIPPED:
            blocks.append(k)
    for tag, at in stack:
        if tag in SKIPPED:
            out[at] = len(events)
    for at, end in out.items():
        if end < 0:
            out[at] = -end
        else:
            block = bisect.bisect_right(blocks, at)
            out[at] = min(end, blocks[block]) if block < len(blocks) else end
    return out


class Tree:
    """Nodes of a page in page order: parent, features, and the text of blocks."""

    def __init__(self):
        self.parent: list[int] = [-1]
        self.rows: list[list[float]] = [self._features()]
        self.text: list[str | None] = [None]
        self.marked: list[int] = [0]  # 1 an article starts, -1 something else starts
        self.stack: list[tuple[str, int]] = [("", 0)]
        self.links = 0
        self.parts: list[str] = []
        self.linked = 0

    @staticmethod
    def _features() -> list[float]:
        row = [0.0] * len(FEATURES)
        row[0] = 1.0
        return row

    def flush(self) -> None:
        """End the current block."""
        if self.parts:
            text = _SPACES.sub(" ", "".join(self.parts)).strip()
            if text:
                tag, node = self.stack[-1]
                row = [0.0] * len(FEATURES)
                row[1] = 1.0
                row[4] = math.log1p(len(text)) / 3
                row[5] = min(1.0, self.linked / len(text))
                row[6] = float(text[-1] in ".!?…:;\"”»)")
                row[7] = float(tag in ("h1", "h2", "h3", "h4", "h5", "h6"))
                row[8] = float(len(text) < 400 and bool(_SIGNS.search(text)))
                self._add(node, row, text, 0)
            self.parts, self.linked = [], 0

    def _add(self, parent: int, row: list[float], text: str | None, marked: int) -> int:
        self.parent.append(parent)
        self.rows.append(row)
        self.text.append(text)
        self.marked.append(marked)
        return len(self.parent) - 1

    def handle_starttag(self, tag, attrs):
        if tag == "head":
            return  # its end tag is optional; what is skipped in it is skipped by itself
        if tag == "br":
            self.parts.append(" ")
            return
        if tag in INLINE:
            self.links += tag == "a"
            return
        self.flush()
        if tag in VOID:
            return
        if tag in CLOSES_P:
            self._close({"p"})
        if tag in SAME_CLOSES:
            self._close(SAME_CLOSES[tag])
        names = [tag]
        for key, value in attrs:
            if key in ("class", "id", "role") and value:
                names += _TOKEN.findall(re.sub(r"(?<=[a-z])(?=[A-Z])", " ", value).lower())
            elif key == "hidden":
                names.append("hidden")
        row = self._features()
        row[2] = float(any(n in BOILERPLATE for n in names))
        row[3] = float(any(n in CONTENT for n in names))
        marked = 1 if tag in ("article", "main") or ("role", "main") in attrs else -1 if row[2] else 0
        self.stack.append((tag, self._add(self.stack[-1][1], row, None, marked)))

    def handle_startendtag(self, tag, attrs):
        if tag == "br" or tag in VOID or tag not in SKIPPED | INLINE:
            self.handle_starttag(tag, attrs)
            if tag not in VOID and tag != "br":
                self.handle_endtag(tag)

    def _close(self, tags: set[str]) -> None:
        """Close the nearest of ``tags`` that no scope hides."""
        for k in range(len(self.stack) - 1, 0, -1):
            if self.stack[k][0] in tags:
                self.flush()
                del self.stack[k:]
                return
            if self.stack[k][0] in SCOPES:
                return

    def handle_endtag(self, tag):
        if tag in INLINE:
            self.links = max(0, self.links - (tag == "a"))
            return
        for k in range(len(self.stack) - 1, 0, -1):
            if self.stack[k][0] == tag:
                self.flush()
                self.links = 0
                del self.stack[k:]
                return

    def handle_data(self, data):
        self.parts.append(data)
        if self.links:
            self.linked += len(data.strip())


def parse(html: str | None) -> Tree:
    """The tree of a page; a tag or comment cut off at the end is dropped."""
    parser, tree = Events(), Tree()
    parser.feed(_CUT_TAG.sub("", html or ""))
    parser.close()
    events = parser.events
    until, k = skipped_until(events), 0
    while k < len(events):
        kind, tag, attrs = events[k]
        if k in until:
            k = until[k]
            continue
        if kind == "start":
            tree.handle_starttag(tag, attrs)
        elif kind == "both":
            tree.handle_startendtag(tag, attrs)
        elif kind == "end":
            tree.handle_endtag(tag)
        else:
            tree.handle_data(tag)
        k += 1
    tree.flush()
    return tree


def marked_labels(tree: Tree) -> np.ndarray | None:
    """Labels from the page's own marks: what stands in an article and in nothing else, and its wrappers."""
    if 1 not in tree.marked:
        return None
    n = len(tree.parent)
    state = [0] * n  # 1 inside an article, -1 inside something else
    for v in range(1, n):
        above = state[tree.parent[v]]
        state[v] = -1 if above == -1 or tree.marked[v] == -1 else 1 if tree.marked[v] == 1 or above == 1 else 0
    labels = np.array([int(s == 1) for s in state])
    for v in range(n - 1, 0, -1):
        if labels[v]:
            labels[tree.parent[v]] = 1
    return labels


class Model:
    def __init__(self, weights: np.ndarray = PRIOR, edges: np.ndarray = PRIOR_EDGES):
        self.weights, self.edges = weights, edges

    def marginals(self, tree: Tree) -> list[float]:
        """Probability of content per node: messages to the root, then back."""
        n = len(tree.parent)
        node = [math.exp(min(50.0, max(-50.0, x))) for x in (np.array(tree.rows) @ self.weights).tolist()]
        (t00, t01), (t10, t11) = np.exp(self.edges).tolist()
        up0, up1 = [1.0] * n, node[:]  # belief from below, per own label
        to0, to1 = [1.0] * n, [1.0] * n  # message to the parent, per its label
        for v in range(n - 1, 0, -1):
            a, b = up0[v], up1[v]
            m0, m1 = a * t00 + b * t01, a * t10 + b * t11
            s = m0 + m1
            to0[v], to1[v] = m0 / s, m1 / s
            p = tree.parent[v]
            x, y = up0[p] * to0[v], up1[p] * to1[v]
            s = x + y
            up0[p], up1[p] = (x / s, y / s) if s > 0 else (0.5, 0.5)
        out = [0.0] * n
        full0, full1 = up0[:], up1[:]
        for v in range(n):
            if v:
                p = tree.parent[v]
                # the parent's belief without what this node sent
                a, b = full0[p] / max(to0[v], 1e-300), full1[p] / max(to1[v], 1e-300)
                d0, d1 = a * t00 + b * t10, a * t01 + b * t11
                x, y = up0[v] * d0, up1[v] * d1
                s = x + y
                full0[v], full1[v] = (x / s, y / s) if s > 0 else (0.5, 0.5)
            out[v] = full1[v] / (full0[v] + full1[v])
        return out

    def extract(self, html: str | None) -> str:
        tree = parse(html)
        return "\n".join(t for t, p in zip(tree.text, self.marginals(tree)) if t is not None and p > 0.5)


def fit(pages: list[str], pull: float = 0.02, steps: int = 200, rate: float = 0.3) -> Model:
    """Maximise the pseudo-likelihood of marked pages, pulled towards the prior."""
    rows, own, above, below = [], [], [], []
    for html in pages:
        tree = parse(html)
        labels = marked_labels(tree)
        if labels is None:
            continue
        children = np.zeros((len(labels), 2))
        for v in range(1, len(labels)):
            children[tree.parent[v], labels[v]] += 1
        rows.append(np.array(tree.rows))
        own.append(labels)
        above.append(np.array([-1] + [labels[p] for p in tree.parent[1:]]))
        below.append(children)
    if not rows:
        return Model()
    x, y, up, kids = (np.concatenate(v) for v in (rows, own, above, below))
    weights, edges = PRIOR.copy(), PRIOR_EDGES.copy()
    root = up < 0
    for _ in range(steps):
        gain = x @ weights + kids @ (edges[1] - edges[0])
        gain = gain + np.where(root, 0.0, edges[up, 1] - edges[up, 0])
        error = y - 1 / (1 + np.exp(-np.clip(gain, -500, 500)))
        n = len(y)
        step = np.zeros((2, 2))
        for a in (0, 1):
            at = ~root & (up == a)
            step[a, 1] += error[at].sum()
            step[a, 0] -= error[at].sum()
        step[1] += error @ kids
        step[0] -= error @ kids
        weights += rate * (x.T @ error / n - pull * (weights - PRIOR))
        edges += rate * (step / n - pull * (edges - PRIOR_EDGES))
    return Model(weights, edges)


def train(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> Model:
    """Fit on the marked pages with the least hash of their id, at most ``TRAINING_PAGES`` of bounded length.

    Ids are chosen first, so only the chosen pages come to the driver. Pages with null ids are not used.
    """
    marked = pages.select(F.col(id_col).alias("id"), F.col(html_col).alias("html")).where(
        (F.length("html") <= TRAINING_CHARS) & F.col("html").rlike(r"(?i)<(article|main)\b|role=.?main\b")
    )
    chosen = marked.select("id").distinct().orderBy(F.xxhash64("id"), "id").limit(TRAINING_PAGES)
    rows = marked.join(F.broadcast(chosen), "id").groupBy("id").agg(F.min("html").alias("html")).collect()
    return fit(sorted(r.html for r in rows))


def page_texts(pages: DataFrame, model: Model, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id``, ``url``, ``text``, ``n_chars`` for every row; a null or empty page has an empty text."""

    def run(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            texts = [model.extract(h) for h in values(batch.column(2))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    kinds = [pages.schema[c].dataType.simpleString() for c in (id_col, url_col)]
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return rows.mapInArrow(run, f"page_id {kinds[0]}, url {kinds[1]}, text string, n_chars bigint")
