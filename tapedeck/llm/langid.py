"""Language identification by cross-parsing entropy.

Each language has a suffix automaton of labelled text. A text is parsed against it greedily: a phrase is the
longest stretch that occurs in the language's text, and the next phrase starts behind it. The language
that needs the fewest phrases for each letter wins. Texts are parsed in windows of `WINDOW` symbols, each
starting a new phrase, so that numpy steps all windows of a batch through all automata at once.

Symbols are lower-case letters; whatever lies between letters counts as one gap.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapedeck.llm.common import held

WINDOW = 128
#: Labelled rows of a language that its automaton is built from at most, and the characters taken from each.
SAMPLE_ROWS, SAMPLE_CHARS = 120, 240
#: Windows stepped at a time.
WIDTH = 8192
UNKNOWN = "und"


def letters_of(text: str) -> np.ndarray:
    """Code points of the lower-cased letters, every stretch of other characters between letters as one space."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    is_letter = _is_letter(codes)
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]  # the first character behind a letter stands for the gap
    out = np.where(is_letter, codes, 32)[keep]
    return out[:-1] if len(out) and out[-1] == 32 else out


def _is_letter(codes: np.ndarray) -> np.ndarray:
    table = _letter_table()
    low = codes < len(table)
    out = table[np.where(low, codes, 0)]
    for at in np.nonzero(~low)[0]:
        out[at] = chr(codes[at]).isalpha()
    return out


@lru_cache(maxsize=1)
def _letter_table() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x10000)])


class Automata:
    """The suffix automata of all languages in one transition table: row = state, column = symbol, -1 = no way on."""

    def __init__(self, samples: tuple[tuple[str, tuple[str, ...]], ...]):
        self.langs = [lang for lang, _ in samples]
        texts = [[letters_of(t) for t in own] for _, own in samples]
        known = sorted({int(c) for own in texts for t in own for c in np.unique(t)})
        self.symbols = np.full(0x110000, len(known), np.int16)  # the last column: never seen
        self.symbols[known] = np.arange(len(known))
        self.width = len(known) + 1
        parts, self.roots = [], []
        for own in texts:
            self.roots.append(sum(map(len, parts)))
            table = _automaton([self.symbols[t] for t in own], self.width)
            table[table >= 0] += self.roots[-1]
            parts.append(table)
        self.dead = np.int32(sum(map(len, parts)))  # a last state that leads nowhere
        self.next = np.concatenate([*parts, np.full((1, self.width), -1, np.int32)]).ravel()
        self.roots = np.array(self.roots, np.int32)

    def phrases(self, windows: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """windows[k, w]: symbol k of window w. The number of phrases for each language and window."""
        first = self.next.reshape(-1, self.width)[self.roots]
        begun = first[:, windows[0]]
        state = np.where(begun < 0, self.dead, begun)  # an unseen symbol is a phrase of its own
        count = np.broadcast_to((lengths > 0).astype(np.int32), state.shape).copy()
        for k in range(1, int(lengths.max(initial=0))):
            symbol = windows[k]
            on = self.next[state * np.int32(self.width) + symbol]
            stuck = on < 0
            count += stuck & (lengths > k)
            begun = first[:, symbol]
            state = np.where(stuck, np.where(begun < 0, self.dead, begun), on)
        return count

    def score(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """The language of each text and how sure it is (0 to 1)."""
        symbols = [self.symbols[letters_of(t)] if t else np.zeros(0, np.int16) for t in texts]
        sizes = np.array([len(s) for s in symbols])
        counts = np.zeros((len(self.langs), len(texts)), np.int64)
        per = -(-sizes // WINDOW)
        owner = np.repeat(np.arange(len(texts)), per)
        if len(owner) and self.langs:
            place = np.arange(len(owner)) - np.repeat(np.cumsum(per) - per, per)
            lengths = np.minimum(sizes[owner] - place * WINDOW, WINDOW).astype(np.int32)
            joined = np.concatenate([*symbols, np.zeros(WINDOW, np.int16)])
            begins = (np.cumsum(sizes) - sizes)[owner] + place * WINDOW
            by_length = np.argsort(-lengths, kind="stable")
            for at in range(0, len(owner), WIDTH):
                part = by_length[at : at + WIDTH]
                windows = joined[begins[part][None, :] + np.arange(WINDOW)[:, None]]
                got = self.phrases(windows, lengths[part])
                for lang in range(len(self.langs)):
                    counts[lang] += np.bincount(owner[part], weights=got[lang], minlength=len(texts)).astype(np.int64)
        langs, scores = [], []
        for k, size in enumerate(sizes):
            if not size or not self.langs:
                langs.append(UNKNOWN)
                scores.append(0.0)
                continue
            best = int(np.argmin(counts[:, k]))
            # Phrases cost about the same number of nats each; damped, as windows of one text are not independent.
            excess = (counts[:, k] - counts[best, k]) * (10 / max(10.0, math.sqrt(size)))
            langs.append(self.langs[best])
            scores.append(float(1 / np.exp(-np.minimum(excess, 700)).sum()))
        return langs, scores


def _automaton(texts: list[np.ndarray], width: int) -> np.ndarray:
    """The suffix automaton of these texts as a table; the unknown symbol separates them and is never followed."""
    ways: list[dict[int, int]] = [{}]
    link, longest = [-1], [0]
    for text in texts:
        last = 0
        for c in text.tolist():
            if c in ways[last]:  # seen from an earlier text
                q = ways[last][c]
                last = q if longest[q] == longest[last] + 1 else _clone(ways, link, longest, last, c, q)
                continue
            own = len(ways)
            ways.append({})
            longest.append(longest[last] + 1)
            link.append(0)
            p = last
            while p >= 0 and c not in ways[p]:
                ways[p][c] = own
                p = link[p]
            if p >= 0:
                q = ways[p][c]
                link[own] = q if longest[q] == longest[p] + 1 else _clone(ways, link, longest, p, c, q)
            last = own
    table = np.full((len(ways), width), -1, np.int32)
    for state, way in enumerate(ways):
        table[state, list(way.keys())] = list(way.values())
    return table


def _clone(ways: list[dict[int, int]], link: list[int], longest: list[int], p: int, c: int, q: int) -> int:
    own = len(ways)
    ways.append(dict(ways[q]))
    longest.append(longest[p] + 1)
    link.append(link[q])
    link[q] = own
    while p >= 0 and ways[p].get(c) == q:
        ways[p][c] = own
        p = link[p]
    return own


def automata(samples: tuple[tuple[str, tuple[str, ...]], ...]) -> Automata:
    """Built once for each worker from the bounded samples, which are all that is sent to it."""
    return held(("automata", samples), lambda: Automata(samples))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> tuple[tuple[str, tuple[str, ...]], ...]:
    """Sample texts of each language: the first `rows` distinct labelled texts by a hash, a stretch of `chars` characters from a hashed place of each.

    Labelled rows are counted for each language first, so that only a few times `rows` texts of each are moved, however many there are.
    """
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    h = F.xxhash64("text")
    start = F.pmod(h, F.greatest(F.length("text") - chars, F.lit(0)) + 1).cast("int") + 1
    counts = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    if not counts:
        return ()
    share = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, int(min(1.0, 8 * rows / n) * (1 << 30)))])
    known = known.where(F.pmod(F.xxhash64(h), F.lit(1 << 30)) <= share[F.col("lang")])
    cut = known.select("lang", h.alias("h"), F.col("text").substr(start, F.lit(chars)).alias("t")).dropDuplicates(["lang", "h"])
    first = cut.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("h", "t"))).where(F.col("r") <= rows)
    found: dict[str, list[tuple[int, str]]] = {}
    for row in first.collect():
        found.setdefault(row["lang"], []).append((row["r"], row["t"]))
    return tuple((lang, tuple(t for _, t in sorted(found[lang]))) for lang in sorted(found))


def language_column(text: Column, samples: tuple) -> Column:
    """A struct of lang_pred and score."""

    @F.pandas_udf("lang_pred string, score double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = automata(samples)
        for texts in batches:
            langs, scores = [], []
            for at in range(0, len(texts), 1000):
                got = model.score(list(texts.iloc[at : at + 1000]))
                langs += got[0]
                scores += got[1]
            yield pd.DataFrame({"lang_pred": langs, "score": np.array(scores, float)})

    return run.asNondeterministic()(text)


def identify(docs: DataFrame, samples: tuple) -> DataFrame:
    """doc_id, text -> doc_id, held_out, lang_pred, score; a row for each row of `docs`.

    `und` with score 0 for null texts, texts without a letter, and everything if nothing was learned. Of
    languages that need equally few phrases the first by name wins. A null doc_id is not held out. Other
    columns are ignored.
    """
    told = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), language_column(F.col("text"), samples).alias("l"))
    return told.select("doc_id", "held_out", "l.*")
