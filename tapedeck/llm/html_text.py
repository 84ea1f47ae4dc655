"""Main text of web pages by minimum-cut labelling.

A page is cut into blocks of text. A logistic classifier gives each block a cost for either label, which become
the capacities of its edges to the two terminals. Neighbouring blocks and blocks under the same element are tied
by smoothness edges, weaker where an element ends between them. A maximum flow finds the cheapest
labelling of the whole page; blocks on the content side are the text.

The classifier is fitted here on a bounded sample of pages, labelled by the elements that name their
purpose; those features are hidden in half of the rows, so that length, links and punctuation carry pages without
such elements. Its weights are drawn to `PRIOR`, which alone holds where a sample has nothing to learn from.

A name is only evidence. Sites also wrap whole pages in elements with such names, so that a mark counts for nothing where the element
holds the article or most of the page's text, and an article does not inherit what is around it (`_settle`).
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Pages that the classifier is fitted on at most, and blocks taken from each.
SAMPLE_PAGES, SAMPLE_BLOCKS = 400, 100
#: Smoothness: neighbours under one parent, neighbours across an element's border, block and element, element and parent.
NEAR, ACROSS, INSIDE, NESTED = 0.8, 0.15, 0.3, 0.1

# Elements of the HTML standard by their part in a page, and words that sites use in class, id and role.
BLOCK_TAGS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th"
    " thead tr ul".split()
)
VOID_TAGS = set("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN_TAGS = set("script style head title noscript template iframe object svg math canvas audio video".split())
RAW_TAGS = set("script style title textarea iframe noscript".split())
FRAME_TAGS = set("nav header footer aside form menu dialog button select textarea fieldset input label".split())
HEADINGS, LISTED = {"h1", "h2", "h3", "h4", "h5", "h6"}, {"li", "td", "dd", "dt"}
BODY_TAGS = {"article", "main"}
FRAME_WORDS = set(
    "ad ads adv advert advertisement adverts banner bar bottom breadcrumb breadcrumbs byline comment comments consent cookie cookies"
    " copyright dialog disqus feedback foot footer form gdpr head header legal login masthead menu modal nav navbar navigation newsletter"
    " notice notification overlay pager pagination popup popular promo promotion recommended register related reply replies responses"
    " search share sharing sidebar sidenav signup skip social sponsor sponsored subscribe tags toc toolbar top topbar trending widget".split()
)
BODY_WORDS = set("article articlebody content entry main post story text".split())
COMMENT_WORDS = set("comment comments disqus reply replies respond responses discussion".split())
#: Names of lists of links: a mark only where links hold so much of the text.
LIST_WORDS, LINKED = set("related popular recommended trending tags toc breadcrumb breadcrumbs pager pagination promo promotion".split()), 0.3
#: Shares of a page's text outside links: that of an article which inherits no mark, and that of an element whose own mark counts for nothing.
ARTICLE, MOST = 0.3, 0.6

FEATURES = ["bias", "frame", "body", "links", "length", "sentence", "heading", "listed", "symbols"]
PRIOR = np.array([0.0, -6.0, 2.0, -4.0, 0.8, 1.0, 0.4, -0.4, -0.3])

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|[^<]++|<", re.S)
_ATTRIBUTE = re.compile(r"\b(class|id|role|style)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))|\bhidden\b", re.I)
_WORD = re.compile(r"[a-z]+")


@dataclass
class Block:
    parent: int
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    heading: bool = False
    listed: bool = False
    text: str = ""


@dataclass
class Element:
    tag: str
    parent: int
    marks: set[str]
    body: bool
    hidden: bool
    heading: bool = False
    listed: bool = False
    frame: bool = False


def blocks_of(page: str) -> tuple[list[Block], list[Element]]:
    """Blocks with text in page order, and the elements around them."""
    elements = [Element("", -1, set(), False, False)]
    open_now, blocks, block = [0], [], None
    links, at = 0, 0
    last = page.rfind(">")  # no tag ends behind it: what looks like one there is text

    def close(down_to: int) -> None:
        nonlocal links
        while len(open_now) > down_to:
            links -= elements[open_now.pop()].tag == "a"

    while at < len(page):
        m = _TOKEN.match(page, at) if at <= last else None
        token = m[0] if m else page[at:].partition("<!--")[0]
        at = m.end() if m else len(page)
        if m is None or m[2] is None:
            if not token or m and token[0] == "<" and len(token) > 1:
                continue
            if not elements[open_now[-1]].hidden:
                if block is None:
                    inner = elements[open_now[-1]]
                    block = Block(_container(elements, open_now), heading=inner.heading, listed=inner.listed)
                    blocks.append(block)
                block.parts.append(token)
                block.linked += len(token.strip()) if links else 0
            continue
        tag = m[2].lower()
        if tag in BLOCK_TAGS:
            block = None
        elif tag == "br" and block is not None:
            block.parts.append(" ")
        if m[1]:
            for k in range(len(open_now) - 1, 0, -1):
                if elements[open_now[k]].tag == tag:
                    close(k)
                    break
                if tag not in BLOCK_TAGS and elements[open_now[k]].tag in BLOCK_TAGS:
                    break  # an inline end tag doesn't close blocks
            continue
        if tag in BLOCK_TAGS:
            _close_implied(tag, elements, open_now, close)
        if tag in VOID_TAGS:
            continue
        if tag in RAW_TAGS:
            end = re.compile(f"</{re.escape(tag)}", re.I).search(page, at)
            at = end.start() if end else len(page)
        if token.endswith("/>") and tag not in BLOCK_TAGS:
            continue
        above = elements[open_now[-1]]
        marks, body, hidden = _purpose(tag, m[3] or "", above)
        hidden = hidden or above.hidden or tag in HIDDEN_TAGS
        elements.append(Element(tag, open_now[-1], marks, body, hidden, above.heading or tag in HEADINGS, above.listed or tag in LISTED))
        open_now.append(len(elements) - 1)
        links += tag == "a"
    for b in blocks:
        b.text = " ".join(html.unescape("".join(b.parts)).split())
    blocks = [b for b in blocks if b.text]
    _settle(blocks, elements)
    return blocks, elements


def _settle(blocks: list[Block], elements: list[Element]) -> None:
    """Which elements frame the page, once it is known what they hold."""
    size = len(elements)
    plain, linked, article, title = [0] * size, [0] * size, [False] * size, [False] * size
    for b in blocks:
        own = min(b.linked, len(b.text))
        plain[b.parent] += len(b.text) - own
        linked[b.parent] += own
        title[b.parent] |= b.heading
    for k in range(size - 1, 0, -1):  # what is inside comes behind
        above = elements[k].parent
        plain[above] += plain[k]
        linked[above] += linked[k]
        title[above] |= title[k]
    total = max(plain[0], 1)
    for k in range(size - 1, 0, -1):
        e = elements[k]
        main = e.tag in BODY_TAGS and not e.marks and plain[k] >= ARTICLE * total
        article[k] |= main
        article[e.parent] |= article[k]
    for k in range(1, size):
        e, above = elements[k], elements[elements[k].parent]
        mark = bool(e.marks)
        if mark and e.marks <= LIST_WORDS and linked[k] < LINKED * (plain[k] + linked[k]):
            mark = False
        elif mark and (article[k] or plain[k] >= MOST * total and not e.marks & {"nav", "footer", "aside", "menu", "dialog"}):
            mark = not article[k] and bool(e.marks & COMMENT_WORDS) and not title[k]
        resets = e.tag in BODY_TAGS and article[k]
        e.frame = mark or above.frame and not resets


def _container(elements: list[Element], open_now: list[int]) -> int:
    return next((k for k in reversed(open_now) if elements[k].tag in BLOCK_TAGS or elements[k].marks), 0)


def _close_implied(tag: str, elements: list[Element], open_now: list[int], close) -> None:
    """A new block ends an open paragraph; a new item ends the item before it."""
    same = {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
    fences = {"ul", "ol", "dl", "table", "div", "section", "article", "body", "blockquote", "main", "nav", "aside", "select", "td"}
    for k in range(len(open_now) - 1, 0, -1):
        seen = elements[open_now[k]].tag
        if seen == "p" or seen in same.get(tag, ()):
            close(k)
            return
        if seen in fences:
            return


def _purpose(tag: str, attributes: str, above: Element) -> tuple[set[str], bool, bool]:
    """The tag and words by which the element frames the page; does it hold its body (inherited), or stay unseen?"""
    words: set[str] = set()
    hidden = False
    for m in _ATTRIBUTE.finditer(attributes):
        value = (m[2] or m[3] or m[4] or "").lower()
        if m[1] is None or m[1].lower() == "style":
            hidden |= m[1] is None and not re.search(r"[\"'][^\"']*hidden[^\"']*[\"']", attributes) or "display:none" in value.replace(" ", "")
            continue
        for name in re.sub(r"([a-z])([A-Z])", r"\1 \2", m[2] or m[3] or m[4] or "").split():
            parts = _WORD.findall(name.lower())
            if not {"no", "has", "with", "without", "is"} & set(parts):
                words.update(parts)
    if tag in BODY_TAGS | {"html", "body"}:
        marks = words & COMMENT_WORDS
    elif tag in ("header", "hgroup") and above.body:
        marks = words & (FRAME_WORDS - {"head", "header", "top"})  # an article's own heading
    elif re.fullmatch(r"h[1-6]|p|b|i|em|strong|span|a|mark|code|pre|u|q|blockquote|li", tag):
        marks = words & (FRAME_WORDS - {"text", "top", "head", "header", "bar", "bottom", "tags"})
    else:
        marks = {tag} & FRAME_TAGS | (set() if words & {"articlebody"} else words & FRAME_WORDS)
    return marks, above.body or tag in BODY_TAGS or bool(words & BODY_WORDS), hidden


def features_of(blocks: list[Block], elements: list[Element]) -> np.ndarray:
    rows = []
    for b in blocks:
        n, e = len(b.text), elements[b.parent]
        letters = sum(map(str.isalpha, b.text))
        rows.append([
            1.0, float(e.frame), float(e.body), min(1.0, b.linked / n), min(3.0, math.log1p(n) - 3), float(b.text[-1] in ".!?…\"'”»。"),
            float(b.heading), float(b.listed), 1 - letters / n,
        ])
    return np.array(rows, float).reshape(-1, len(FEATURES))


def fit_weights(x: np.ndarray, y: np.ndarray, steps: int = 300) -> np.ndarray:
    """Logistic weights by gradient ascent, drawn to PRIOR; without rows PRIOR itself."""
    weights = PRIOR.copy()
    if len(y) == 0:
        return weights
    hidden = x.copy()
    hidden[:, [FEATURES.index("frame"), FEATURES.index("body")]] = 0
    rows, truth = np.concatenate([x, hidden]), np.concatenate([y, y])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(rows @ weights, -50, 50)))
        weights += 0.5 * (rows.T @ (truth - p) / len(truth) - 0.02 * (weights - PRIOR))
    return weights


def fit(pages: DataFrame, count: int = SAMPLE_PAGES) -> np.ndarray:
    """Weights from at most `count` pages, the first by a hash of page_id and url."""
    own = F.xxhash64("page_id", "url", "html")
    chosen = pages.select(own.alias("h")).distinct().orderBy("h").limit(count)
    texts = pages.select(own.alias("h"), "html").join(F.broadcast(chosen), "h").dropDuplicates(["h"])  # bounded by `count`

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for page in batch["html"]:
                blocks, elements = blocks_of(page or "")
                x = features_of(blocks, elements)
                known = np.nonzero((x[:, 1] > 0) | (x[:, 2] > 0))[0]
                known = known[np.linspace(0, len(known) - 1, min(len(known), SAMPLE_BLOCKS)).astype(int)] if len(known) else known
                if len(known):
                    yield pd.DataFrame({"x": list(x[known]), "y": 1.0 - (x[known, 1] > 0)})

    got = texts.mapInPandas(rows, "x array<double>, y double").collect()
    got.sort(key=lambda r: (r["x"], r["y"]))
    return fit_weights(np.array([r["x"] for r in got], float).reshape(-1, len(FEATURES)), np.array([r["y"] for r in got], float))


def min_cut(costs: np.ndarray, ties: list[tuple[int, int, float]], size: int) -> np.ndarray:
    """Which of `size` nodes end on the content side. costs > 0 pull a node to it, < 0 away; ties: (a, b, weight)."""
    source, sink = size, size + 1
    to, room, edges = [], [], [[] for _ in range(size + 2)]

    def add(a: int, b: int, there: float, back: float) -> None:
        edges[a].append(len(to))
        to.append(b)
        room.append(there)
        edges[b].append(len(to))
        to.append(a)
        room.append(back)

    for k, cost in enumerate(costs):
        if cost > 0:
            add(source, k, float(cost), 0.0)
        elif cost < 0:
            add(k, sink, float(-cost), 0.0)
    for a, b, weight in ties:
        add(a, b, weight, weight)
    tiny = 1e-9
    while True:  # Dinic: levels by breadth, then blocking flow along them
        level = [-1] * (size + 2)
        level[source], queue = 0, [source]
        for node in queue:
            for e in edges[node]:
                if room[e] > tiny and level[to[e]] < 0:
                    level[to[e]] = level[node] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return np.array([level[k] >= 0 for k in range(size)], bool)
        tried, path, node = [0] * (size + 2), [], source
        while True:
            if node == sink:
                flow = min(room[e] for e in path)
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow
                back = next(k for k, e in enumerate(path) if room[e] <= tiny)
                node = to[path[back] ^ 1]
                del path[back:]
            elif tried[node] < len(edges[node]):
                e = edges[node][tried[node]]
                if room[e] > tiny and level[to[e]] == level[node] + 1:
                    path.append(e)
                    node = to[e]
                else:
                    tried[node] += 1
            elif node == source:
                break
            else:
                node = to[path.pop() ^ 1]
                tried[node] += 1


def main_text(page: str | None, weights: np.ndarray) -> str:
    """The blocks on the content side, a line each."""
    blocks, elements = blocks_of(page or "")
    if not blocks:
        return ""
    costs = features_of(blocks, elements) @ weights
    used: dict[int, int] = {}
    ties: list[tuple[int, int, float]] = []
    for k, b in enumerate(blocks):
        below, element, weight = k, b.parent, INSIDE
        while element >= 0 and element not in used:
            used[element] = len(blocks) + len(used)
            ties.append((below, used[element], weight))
            below, element, weight = used[element], elements[element].parent, NESTED
        if element >= 0:
            ties.append((below, used[element], weight))
        if k:
            same = blocks[k - 1].parent == b.parent or elements[blocks[k - 1].parent].parent == elements[b.parent].parent
            ties.append((k - 1, k, NEAR if same else ACROSS))
    size = len(blocks) + len(used)
    content = min_cut(np.concatenate([costs, np.zeros(len(used))]), ties, size)
    return "\n".join(b.text for k, b in enumerate(blocks) if content[k])


def main_text_column(page: Column, weights: np.ndarray) -> Column:
    @F.pandas_udf("string")
    def run(pages: pd.Series) -> pd.Series:
        return pd.Series([main_text(p, weights) for p in pages], dtype=object)

    return run.asNondeterministic()(page)


def extract(pages: DataFrame, weights: np.ndarray) -> DataFrame:
    """page_id, url, html -> page_id, url, text, n_chars: a row for each row of `pages`.

    Null and empty pages, and pages without content, have an empty text. Other columns are ignored.
    """
    told = pages.select("page_id", "url", main_text_column(F.col("html"), weights).alias("text"))
    return told.withColumn("n_chars", F.length("text").cast("long"))
