"""Quality rules: document statistics judged by gradient-boosted trees.

The trees are fitted here on a bounded sample of labelled documents, then written as flat node arrays, so
that a batch of documents is scored by a few numpy steps for each level. On `FALLING` statistics the
predicted quality never rises with the statistic: a split there must not order its sides the other way, and
the values below each side stay on their side of the split's middle.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\v\f\r"
MARKS = "!?~^=_\\{}[]@"
MIN_WORDS = 50
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
RATIOS = ["mean_word", "symbols", "dup_lines", "repeats", "distinct", "capitals", "digits", "marks", "log_words"]
_CODES = [list(x.encode()) for x in (SYMBOLS, MARKS, "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", SPACES)]
FALLING = {"symbols", "dup_lines", "repeats", "marks"}
#: Labelled documents that the trees are fitted on at most, the first by a hash of their doc_id.
SAMPLE = 4000
TREES, DEPTH, BINS, RATE, LEAST = 40, 3, 32, 0.3, 12


def statistics(text: str | None) -> tuple[list[int], list[float]]:
    """The five counts of a whole text and the ratios that the trees read. Null has no words."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    seen = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    symbols, marks, digits, capitals, spaces = (int(seen[k].sum()) for k in _CODES)
    chars = len(text or "") - spaces
    lines = [x for x in raw.split(b"\n") if x.strip()]
    repeated_lines = len(lines) - len(set(lines))
    repeated = _repeat_words(words)
    per = max(n, 1)
    ratios = [
        chars / per, symbols / per, repeated_lines / max(len(lines), 1), repeated / per, len(set(words)) / per,
        capitals / max(chars, 1), digits / max(chars, 1), marks / per, math.log1p(n),
    ]
    return [n, chars, symbols, repeated_lines, repeated], ratios


def _repeat_words(words: list[bytes]) -> int:
    """Words inside three-word windows that occur twice or more."""
    codes = np.fromiter(map(hash, words), np.int64, len(words))
    mixed = np.sort(codes[2:] + 3 * codes[1:-1] + 7 * codes[:-2]) if len(words) > 3 else codes[:0]
    if not (mixed[1:] == mixed[:-1]).any():  # equal windows have equal sums
        return 0
    windows = list(zip(words, words[1:], words[2:], strict=False))
    often = Counter(windows)
    covered, total = 0, 0
    for at, window in enumerate(windows):
        if often[window] > 1:
            total += at + 3 - max(at, covered)
            covered = at + 3
    return total


def statistics_column(text: Column) -> Column:
    """A struct of the counts and `ratios`."""

    @F.pandas_udf(", ".join(f"{c} long" for c in COUNTS) + ", ratios array<double>")
    def run(texts: pd.Series) -> pd.DataFrame:
        found = [statistics(t) for t in texts]
        out = pd.DataFrame([c for c, _ in found], columns=COUNTS, dtype="int64")
        return out.assign(ratios=pd.Series([r for _, r in found], dtype=object))

    return run.asNondeterministic()(text)


# ------------------------------------------------------------ trees


@dataclass
class Trees:
    """Nodes of all trees one after another; a leaf is its own child."""

    start: float
    roots: np.ndarray
    feature: np.ndarray
    limit: np.ndarray
    low: np.ndarray
    high: np.ndarray
    value: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        """The probability of good quality for each row of `x`."""
        at = np.tile(self.roots, (len(x), 1))
        rows = np.arange(len(x))[:, None]
        for _ in range(DEPTH):
            at = np.where(x[rows, self.feature[at]] <= self.limit[at], self.low[at], self.high[at])
        return 1 / (1 + np.exp(-(self.start + self.value[at].sum(axis=1))))


def fit_trees(x: np.ndarray, y: np.ndarray, falling: list[bool], trees: int = TREES) -> Trees:
    """Boosted on the logistic loss, splits at quantiles; without both classes the share of good ones is the answer."""
    share = (y.sum() + 0.5) / (len(y) + 1)
    start = float(np.log(share / (1 - share)))
    nodes: list[list[float]] = []  # feature, limit, low, high, value
    roots, score = [], np.full(len(y), start)
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])] if len(y) else []

    def grow(rows: np.ndarray, level: int, floor: float, ceiling: float) -> int:
        g, h = slope[rows], curve[rows]
        own = len(nodes)
        nodes.append([0, np.inf, own, own, RATE * float(np.clip(g.sum() / (h.sum() + 1), floor, ceiling))])
        best = (1e-6, None)
        if level < DEPTH and len(rows) >= 2 * LEAST:
            for f, cuts in enumerate(edges):
                slot = np.searchsorted(cuts, x[rows, f], side="left")
                size = len(cuts) + 1
                gs, hs, ns = (np.cumsum(np.bincount(slot, weights=w, minlength=size))[:-1] for w in (g, h, np.ones(len(rows))))
                left = np.clip(gs / (hs + 1), floor, ceiling)
                right = np.clip((g.sum() - gs) / (h.sum() - hs + 1), floor, ceiling)
                gain = gs**2 / (hs + 1) + (g.sum() - gs) ** 2 / (h.sum() - hs + 1) - g.sum() ** 2 / (h.sum() + 1)
                allowed = (ns >= LEAST) & (len(rows) - ns >= LEAST) & ((left >= right) | (not falling[f]))
                if len(gain) and (top := int(np.argmax(np.where(allowed, gain, -1)))) is not None and allowed[top] and gain[top] > best[0]:
                    best = (gain[top], (f, cuts[top], left[top], right[top]))
        if best[1]:
            f, cut, left, right = best[1]
            below, middle = x[rows, f] <= cut, (left + right) / 2
            bounds = ((middle, ceiling), (floor, middle)) if falling[f] else ((floor, ceiling),) * 2
            low = grow(rows[below], level + 1, *bounds[0])
            nodes[own] = [f, cut, low, grow(rows[~below], level + 1, *bounds[1]), 0.0]
        return own

    for _ in range(trees if 0 < y.sum() < len(y) else 0):
        p = 1 / (1 + np.exp(-score))
        slope, curve = y - p, p * (1 - p)
        roots.append(grow(np.arange(len(y)), 0, -4.0, 4.0))
        flat = _flat(0.0, roots[-1:], nodes)
        at = np.full(len(y), roots[-1])
        for _ in range(DEPTH):
            at = np.where(x[np.arange(len(y)), flat.feature[at]] <= flat.limit[at], flat.low[at], flat.high[at])
        score = score + flat.value[at]
    return _flat(start, roots, nodes)


def _flat(start: float, roots: list[int], nodes: list[list[float]]) -> Trees:
    columns = np.array(nodes, dtype=float).reshape(-1, 5).T
    feature, low, high = (columns[k].astype(int) for k in (0, 2, 3))
    return Trees(start, np.array(roots, dtype=int), feature, columns[1], low, high, columns[4])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Trees:
    """Trees from at most `sample` labelled documents; a document with several labels counts as good if one says so."""
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # bounded by `sample`
    rows = texts.select("doc_id", "quality", statistics_column(F.col("text"))["ratios"].alias("ratios"))
    # Copies of a doc_id would exceed the bound: one row each.
    got = sorted(rows.groupBy("doc_id").agg(F.min(F.struct("quality", "ratios")).alias("r")).select("doc_id", "r.*").collect())
    x = np.array([r["ratios"] for r in got], float).reshape(-1, len(RATIOS))
    return fit_trees(x, np.array([r["quality"] for r in got], float), [r in FALLING for r in RATIOS])


def judged(text: Column, trees: Trees) -> Column:
    """A struct of the counts, base_failed, quality (0 to 1) and kept."""
    fields = ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, quality double, kept boolean"

    @F.pandas_udf(fields)
    def run(texts: pd.Series) -> pd.DataFrame:
        found = [statistics(t) for t in texts]
        out = pd.DataFrame([c for c, _ in found], columns=COUNTS, dtype="int64")
        failed = (out["n_words"] < MIN_WORDS) | (100 * out["n_repeat_words"] > 50 * out["n_words"])
        quality = trees.score(np.array([r for _, r in found], float).reshape(-1, len(RATIOS)))
        return out.assign(base_failed=failed, quality=quality, kept=~failed & (quality >= 0.5))

    return run.asNondeterministic()(text)


def quality_rules(docs: DataFrame, trees: Trees) -> DataFrame:
    """doc_id, text -> doc_id, counts, base_failed, quality, kept; a row for each row of `docs`.

    Null and empty texts have no words and fail the base rules. Other columns are ignored.
    """
    return docs.select("doc_id", judged(F.col("text"), trees).alias("j")).select("doc_id", "j.*")
