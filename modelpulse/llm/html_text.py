"""Main text of web pages by a minimum cut over their blocks.

A page is cut into text blocks at block-level tags. What a block costs as content or as boilerplate are the capacities
to the two terminals. They come from a logistic classifier of the text, fitted on blocks of a bounded sample of pages
whose tags say what they are, and from what the page's own tags and names say of the block. Neither alone outweighs
the smoothness edges: successive blocks and successive blocks of one parent are joined, the less the further apart they
are in the tree, and less again where the page itself marks a change. The minimum cut, found with Dinic's
algorithm, labels all blocks together, so a doubtful block goes with those around it.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelpulse.llm.registry import query
from modelpulse.llm.text import bounded_batches, documents
from modelpulse.session import pin

# Pages and blocks that the classifier is fitted on, at most.
SAMPLE_PAGES = 400
SAMPLE_BLOCKS = 20_000
# Weight in nats of what tags and plain names say of a block, of what a name only hints at, and the bound of what the
# classifier says. A block amid others of its parent has edges of 2 * (NEIGHBOUR + SIBLING) = 2.8.
STRONG = 2.6
HINT = 2.0
CONTENT_HINT = 1.0
CLASSIFIER_BOUND = 1.5
NEIGHBOUR = 0.8
SIBLING = 0.6
# What is left of an edge between blocks of which the page says opposite things.
ACROSS = 0.25
# Capacities are whole numbers.
SCALE = 1000

BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("script style noscript template svg math iframe object head title select button textarea canvas audio video datalist".split())
CONTENT = frozenset("article main".split())
BOILER = frozenset("nav header footer aside form menu dialog".split())
# Inside these an article is a teaser, not the page's own; a form may hold the whole page.
TEASER = frozenset("nav aside footer menu dialog".split())
NAMED = re.compile(
    r"ad|ads|advert\w*|banner|sponsor\w*|promo\w*|nav\w*|menu\w*|header|footer|sidebar|side|breadcrumb\w*|cookie\w*|consent|notice\w*|"
    r"popup|modal|comment\w*|disqus|respond|reply|share|sharing|social|subscribe|newsletter|signup|login|related|recommend\w*|pagination|pager|widget|"
    r"toolbar|copyright|legal|disclaimer|skip|contentinfo|complementary|search"
)
COMMENTS = re.compile(r"comment\w*|disqus|respond|reply")
CONTENT_NAMED = re.compile(r"article|content|entry|post|story|text|main")
# A name with one of these speaks of a state or of the layout, not of what is inside.
STATES = frozenset(
    "no not non without with has is js can enabled disabled open opened closed on off active inactive ready loaded collapsed expanded visible supports".split()
)
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
SPLIT = re.compile(r"[-_\d]+")
IN_HEAD = frozenset("head title meta link script style base noscript template".split())
# A tag that opens one of these ends an open one of the same set.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
HOLDS = frozenset("ul ol dl table body article section div main".split())
WHITE = re.compile(r"\s+")


@lru_cache(maxsize=4096)
def name_evidence(name: str) -> tuple[float, bool]:
    """What one class, id or role says in nats, and whether it speaks of comments.

    A name that begins or ends with a known word is plain (main-nav, cookieNotice), one that has it in between is a hint.
    """
    parts = [p for p in SPLIT.split(CAMEL.sub("-", name).lower()) if p]
    if not parts or not STATES.isdisjoint(parts):
        return 0.0, False
    known = [bool(NAMED.fullmatch(p)) for p in parts]
    if known[0] or known[-1]:
        return -STRONG, any(COMMENTS.fullmatch(p) for p in parts)
    if any(known):
        return -HINT, False
    return (CONTENT_HINT if any(CONTENT_NAMED.fullmatch(p) for p in parts) else 0.0), False


@dataclass
class Block:
    text: str
    tag: str
    path: tuple[int, ...]  # numbers of the block-level elements around its own, the outermost first
    linked: int  # characters inside links
    said: float  # nats for content that tags and names give; negative ones for boilerplate


@dataclass(frozen=True)
class Open:
    """An open element: its tag and number, what is said of its inside, how deep it is hidden, and whether an article there is none of the page's own."""

    tag: str
    number: int
    said: float
    hidden: int
    teaser: bool


_OUTSIDE = Open("", 0, 0.0, 0, False)


class _Blocks(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[Block] = []
        self.open: list[Open] = []
        self.number = 0
        self.parts: list[str] = []
        self.linked = 0
        self.links = 0

    def _state(self) -> Open:
        return self.open[-1] if self.open else _OUTSIDE

    def flush(self) -> None:
        if self.parts:
            text = WHITE.sub(" ", "".join(self.parts)).strip()
            if text:
                around = [x for x in self.open if x.tag in BLOCK_TAGS]
                tag = around[-1].tag if around else "body"
                self.blocks.append(Block(text, tag, tuple(x.number for x in around[:-1]), min(self.linked, len(text)), self._state().said))
            self.parts, self.linked = [], 0

    def _said(self, tag: str, attrs: list[tuple[str, str | None]]) -> tuple[float, bool]:
        """What is said of the inside of a new element, and whether articles there are others' or none."""
        around = self._state()
        said, teaser = around.said, around.teaser or tag in TEASER
        names = [n for k, v in attrs if k in ("class", "id", "role") and v for n in v.split()] if tag not in ("html", "body") else []
        found = [name_evidence(n) for n in names]
        worst = min((x for x, _ in found), default=0.0)
        comments = any(c for _, c in found)
        if tag in CONTENT:
            # The page's own article, whatever its wrappers and its own state are called.
            if not teaser and not comments:
                return STRONG, False
            return -STRONG, teaser or comments
        if tag in BOILER and not (tag == "header" and said > 0):
            said = -STRONG
        elif worst <= -STRONG:
            said = -STRONG
        elif worst < 0:
            said = max(said + worst, -STRONG)
        elif said >= 0:
            said = min(said + max((x for x, _ in found), default=0.0), STRONG)
        return said, teaser or comments

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        # The end tag of the head may be left out.
        if tag not in IN_HEAD and any(x.tag == "head" for x in self.open) and not any(x.tag in HIDDEN and x.tag != "head" for x in self.open):
            self._close("head")
        if tag in BLOCK_TAGS:
            self.flush()
            if any(x.tag == "p" for x in self.open):
                self._close("p")
            for old in ENDS.get(tag, ()):
                for k in range(len(self.open) - 1, -1, -1):
                    if self.open[k].tag == old:
                        del self.open[k:]
                        break
                    if self.open[k].tag in HOLDS:
                        break
        elif tag == "br":
            self.parts.append(" ")
        if tag in VOID:
            return
        hidden = self._state().hidden
        if tag in HIDDEN:
            hidden += 1
        if any(k == "hidden" or k == "aria-hidden" and v == "true" for k, v in attrs):
            hidden += 1
        said, teaser = self._said(tag, attrs)
        self.number += 1
        self.open.append(Open(tag, self.number, said, hidden, teaser))
        if tag == "a":
            self.links += 1

    def _close(self, tag: str) -> None:
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k].tag == tag:
                self.links -= sum(1 for x in self.open[k:] if x.tag == "a")
                del self.open[k:]
                return

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCK_TAGS:
            self.flush()
        self._close(tag)

    def handle_data(self, data: str) -> None:
        if self._state().hidden:
            return
        self.parts.append(data)
        if self.links:
            self.linked += len(data)


def blocks_of(html: str | None) -> list[Block]:
    """Visible text blocks in page order; white space inside a block is one space."""
    parser = _Blocks()
    parser.feed(html or "")
    parser.close()
    parser.flush()
    return parser.blocks


def features(blocks: list[Block]) -> np.ndarray:
    """A row per block: text statistics and tags, nothing of what the page says of the block."""
    if not blocks:
        return np.zeros((0, 8))
    rows = []
    for i, b in enumerate(blocks):
        n = len(b.text)
        words = b.text.count(" ") + 1
        ends = sum(b.text.count(c) for c in ".!?")
        rows.append((
            1.0, min(np.log1p(n) / 5, 2.0), b.linked / n, min(n / words / 10, 2.0), min(ends / words * 5, 2.0),
            float(b.tag == "li"), float(b.tag[0] == "h" and len(b.tag) == 2), float(b.text[-1] in ".!?"),
        ))
    return np.array(rows)


def fit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of a logistic model with an L2 penalty, by Newton's method; zeros without both kinds of blocks."""
    w = np.zeros(x.shape[1])
    if not len(y) or y.min() == y.max():
        return w
    for _ in range(20):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) / len(y) + 0.01 * w
        hess = (x * (p * (1 - p))[:, None]).T @ x / len(y) + 0.01 * np.eye(len(w))
        w = w - np.linalg.solve(hess, grad)
    return w


def minimum_cut(source: list[int], sink: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """Which nodes stay with the source, when capacities to the terminals and (both ways) between nodes are cut least."""
    n = len(source)
    s, t = n, n + 1
    to: list[int] = []
    left: list[int] = []
    out: list[list[int]] = [[] for _ in range(n + 2)]

    def add(a: int, b: int, forth: int, back: int) -> None:
        out[a].append(len(to))
        to.append(b)
        left.append(forth)
        out[b].append(len(to))
        to.append(a)
        left.append(back)

    for i in range(n):
        # What both terminals claim is cut anyway.
        more = source[i] - sink[i]
        if more > 0:
            add(s, i, more, 0)
        elif more < 0:
            add(i, t, -more, 0)
    for a, b, c in edges:
        add(a, b, c, c)
    while True:
        level = [-1] * (n + 2)
        level[s] = 0
        waiting = deque([s])
        while waiting:
            a = waiting.popleft()
            for e in out[a]:
                if left[e] and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    waiting.append(to[e])
        if level[t] < 0:
            return [level[i] >= 0 for i in range(n)]
        place = [0] * (n + 2)
        path: list[int] = []
        a = s
        while True:
            if a == t:
                flow = min(left[e] for e in path)
                cut = len(path)
                for k in range(len(path) - 1, -1, -1):
                    left[path[k]] -= flow
                    left[path[k] ^ 1] += flow
                    if not left[path[k]]:
                        cut = k
                a = to[path[cut] ^ 1]
                del path[cut:]
                continue
            while place[a] < len(out[a]):
                e = out[a][place[a]]
                if left[e] and level[to[e]] == level[a] + 1:
                    break
                place[a] += 1
            if place[a] < len(out[a]):
                path.append(e)
                a = to[e]
            elif path:
                level[a] = -1
                a = to[path.pop() ^ 1]
            else:
                break


def own_odds(blocks: list[Block], weights: np.ndarray) -> np.ndarray:
    """Nats for content that each block has by itself."""
    if not blocks:
        return np.zeros(0)
    return np.clip(features(blocks) @ weights, -CLASSIFIER_BOUND, CLASSIFIER_BOUND) + np.array([b.said for b in blocks])


def smoothness(blocks: list[Block]) -> list[tuple[int, int, int]]:
    """Edges between successive blocks, by their distance in the tree, and between successive blocks of one parent."""

    def weight(a: Block, b: Block, full: float) -> int:
        return int(full * SCALE * (ACROSS if a.said * b.said < 0 else 1))

    edges, last = [], {}
    for i, b in enumerate(blocks):
        if i:
            a = blocks[i - 1]
            common = next((k for k, (x, y) in enumerate(zip(a.path, b.path)) if x != y), min(len(a.path), len(b.path)))
            edges.append((i - 1, i, weight(a, b, NEIGHBOUR / (1 + len(a.path) + len(b.path) - 2 * common))))
        before = last.get(b.path)
        if before is not None:
            edges.append((before, i, weight(blocks[before], b, SIBLING)))
        last[b.path] = i
    return edges


def label(blocks: list[Block], weights: np.ndarray) -> list[bool]:
    """True for content."""
    odds = own_odds(blocks, weights)
    # The cost of calling a block boilerplate is the surprise of that, and the same for content.
    source = (np.logaddexp(0, odds) * SCALE).astype(np.int64).tolist()
    sink = (np.logaddexp(0, -odds) * SCALE).astype(np.int64).tolist()
    return minimum_cut(source, sink, smoothness(blocks))


def main_text(html: str | None, weights: np.ndarray) -> str:
    blocks = blocks_of(html)
    return "\n".join(b.text for b, content in zip(blocks, label(blocks, weights)) if content)


def fit_classifier(pages: DataFrame, html_col: str = "html", pages_max: int = SAMPLE_PAGES) -> np.ndarray:
    """Weights from at most ``pages_max`` pages (by hash) and ``SAMPLE_BLOCKS`` of their blocks."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for html in batch.column(0).to_pylist():
                blocks = [b for b in blocks_of(html) if abs(b.said) >= STRONG]
                if blocks:
                    rows = pa.array(features(blocks).tolist(), pa.list_(pa.float64()))
                    yield pa.RecordBatch.from_arrays([rows, pa.array([float(b.said > 0) for b in blocks])], names=["x", "y"])

    sample = pages.select(F.col(html_col).alias("html")).orderBy(F.xxhash64("html")).limit(pages_max)
    table = pin(sample).mapInArrow(work, "x array<double>, y double").limit(SAMPLE_BLOCKS).toArrow()
    if not table.num_rows:
        return np.zeros(8)
    return fit(np.array(table["x"].to_pylist()), table["y"].to_numpy())


def extract_text(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """All columns of ``pages`` but the html, with ``text`` and ``n_chars`` (its code points).

    A null or empty page has an empty text. Columns of the input with the new names are replaced. Rows are independent,
    so repeated rows come out as often.
    """
    bounded_batches(pages.sparkSession)
    weights = fit_classifier(pages, html_col)
    keep = [c for c in pages.columns if c not in (html_col, "text", "n_chars")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(html, weights) for html in batch.column(0).to_pylist()]
            sizes = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(texts, pa.string()), sizes], names=[*keep, "text", "n_chars"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in pages.select(*keep).schema.fields]
    return pages.select(F.col(html_col), *keep).mapInArrow(work, ", ".join([*fields, "text string", "n_chars bigint"]))


@query()
def op3_html_text(spark, sf_dir):
    pages = documents(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract_text(pages).select("page_id", "url", "text", "n_chars")
