"""Secret scans: patterns, and strings that look random under a battery of tests.

Patterns give the base spans. Beyond them, every run of 16 or more characters of the encodings' alphabets is
tested for randomness under its inferred encoding (of a run that no alphabet holds, as NAME=value or a path with
hyphens, every such part): chi-squared uniformity over the alphabet, runs above and
below its middle, and correlation between neighbours. The least of the three p-values, corrected for three
looks, is its score: near zero for ordinary words, anywhere between 0 and 1 for random strings.

How rarely ordinary text scores as high is counted over the whole corpus, for each alphabet and length band, over
the letters of every whole text cut into stretches of such lengths. Long words are candidates like all runs with a
letter, as a random string may have no digit. These rates are p-values against "ordinary word", and a Benjamini-Hochberg
step over all candidates keeps the share of false ones among the added spans at `FALSE_SHARE`. Short strings, where words pass
often, need more to be reported than long ones.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from bisect import bisect_left
from collections import Counter
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapedeck.llm.common import Workspace

KINDS = ["assign", "access", "hex", "random"]
FALSE_SHARE = 0.01
SHORTEST = 16
BANDS = [16, 20, 24, 32, 48, 64]
#: Halves of a power of two by which scores are told apart.
STEPS = 80

_ASSIGN = re.compile(
    r"([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"
    r"|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_RUN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
#: What lies between the inner '=' of a run, with the padding at its end, and the parts of it that can be base64 or base64url.
_BETWEEN, _READINGS = re.compile("[^=]+(?:=+$)?"), [re.compile("[A-Za-z0-9+/]+=*"), re.compile("[A-Za-z0-9_-]+=*")]
_DIGITS, _UPPER, _LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The alphabets, in the order in which the runs and correlation tests read their symbols.
ALPHABETS = {
    "hex": _DIGITS + "abcdef",
    "HEX": _DIGITS + "ABCDEF",
    "base32": "234567" + _UPPER,
    "lower36": _DIGITS + _LOWER,
    "upper36": _DIGITS + _UPPER,
    "base64": _DIGITS + _UPPER + _LOWER + "+/",
    "base64url": _DIGITS + _UPPER + _LOWER + "-_",
}
NAMES = list(ALPHABETS)
_ORDER = {name: {c: k for k, c in enumerate(alphabet)} for name, alphabet in ALPHABETS.items()}
#: Hex strings are compared with the letters under the 36 symbols.
_COMPARED = {"hex": "lower36", "HEX": "upper36"}
_IS_LETTER = np.array([chr(c) in _UPPER + _LOWER for c in range(256)])


def _places(name: str, fold=str) -> np.ndarray:
    """The place of each ASCII letter, written in the case that the alphabet has, in the alphabet's order."""
    return np.array([_ORDER[name][fold(chr(c))] if _IS_LETTER[c] else 0 for c in range(256)], np.int64)


#: Alphabets that give letters the same places are tested together.
_LETTER_PLACES = [
    (("lower36", "upper36"), _places("lower36", str.lower)),
    (("base32",), _places("base32", str.upper)),
    (("base64", "base64url"), _places("base64")),
]
#: Stretches tested at a time.
SLAB = 4096


def encoding_of(run: str) -> str | None:
    """The smallest alphabet that holds a run with digits and letters."""
    return None if set(run).isdisjoint(_DIGITS) else _smallest(run)


def letter_encoding_of(run: str) -> str | None:
    """The smallest alphabet that holds a run without digits: a word, or a random string that happens to have none."""
    return _smallest(run) if set(run).isdisjoint(_DIGITS) else None


def _smallest(run: str) -> str | None:
    """None for digits and separators alone (numbers, cards, dates, rules)."""
    seen = set(run.rstrip("="))
    return None if seen <= set(_DIGITS + "-_/+=") else next((name for name in NAMES if seen <= _ORDER[name].keys()), None)


def parts_of(run: str) -> list[tuple[int, int]]:
    """Where the strings to test lie in a run: all of it, or, if no alphabet holds it, what lies between its '='.

    If that has '+' or '/' and also '-' or '_', it may be base64 between the ones or base64url between the others; both
    are parts, which may overlap. Parts shorter than SHORTEST are left out.
    """
    places = set()
    for m in _BETWEEN.finditer(run):
        seen = set(m[0])
        mixed = not seen.isdisjoint("+/") and not seen.isdisjoint("-_")
        places |= {(m.start() + a, m.start() + b) for a, b in (x.span() for r in _READINGS for x in r.finditer(m[0]))} if mixed else {m.span()}
    return sorted((a, b) for a, b in places if b - a >= SHORTEST)


def step_of(run: str, name: str) -> int:
    """The run's score under an alphabet in halves of a power of two: 0 looks random, STEPS - 1 does not. Scores of short runs are remembered."""
    return _known_step(run, name) if len(run) <= 100 else _step(run, name)


def _step(run: str, name: str) -> int:
    order = _ORDER[name]
    values = np.array([order[c] for c in run.rstrip("=") if c in order], np.int64)
    return int(steps_of(values[None, :], len(order))[0]) if len(values) >= 8 else STEPS - 1


_known_step = lru_cache(maxsize=50_000)(_step)


def steps_of(values: np.ndarray, size: int) -> np.ndarray:
    """The scores of equally long strings, one in each row, given by their places in an alphabet of `size` symbols."""
    rows, n = values.shape
    bins = 8 if size > 16 else size // 2
    slots = values * bins // size + bins * np.arange(rows)[:, None]
    seen = np.bincount(slots.ravel(), minlength=bins * rows).reshape(rows, bins)
    width = np.diff(np.ceil(np.arange(bins + 1) * size / bins)) / size  # symbols of each bin, as a share
    chi = ((seen - n * width) ** 2 / (n * width)).sum(axis=1)
    df = bins - 1
    uniform = ((chi / df) ** (1 / 3) - 1 + 2 / (9 * df)) / math.sqrt(2 / (9 * df))
    high = 2 * values >= size
    above = high.sum(axis=1)
    both = 2 * above * (n - above)
    runs = 1 + (high[:, 1:] != high[:, :-1]).sum(axis=1)
    mean = 1 + both / n
    spread = np.sqrt(np.maximum((mean - 1) * (mean - 2) / (n - 1), 1e-9))
    centred = values - values.mean(axis=1, keepdims=True)
    power = (centred**2).sum(axis=1)
    follow = (centred[:, 1:] * centred[:, :-1]).sum(axis=1)
    serial = np.divide(follow, power, out=np.ones(rows), where=power > 0)
    # One side of the middle alone: as likely as that many equal tosses of a coin.
    swing = np.maximum(np.where(both > 0, np.abs(runs - mean) / spread, 0.0), np.abs(serial * n + 1) / math.sqrt(n))
    p = [min(_upper_tail(u), 2 * _upper_tail(v)) for u, v in zip(uniform.tolist(), swing.tolist(), strict=True)]
    score = np.minimum(1.0, 3 * np.minimum(p, np.where(both > 0, 1.0, 2.0 ** (1 - n))))
    return np.minimum(STEPS - 1, -2 * np.log2(np.maximum(score, 2.0**-STEPS))).astype(int)


def _upper_tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def band_of(length: int) -> int:
    return sum(length >= least for least in BANDS) - 1


def scan(text: str | None) -> tuple[list[tuple], list[tuple], Counter]:
    """Base spans (kind, start, end), candidates (start, end, cell, step) and stretches of ordinary letters counted by (cell, step)."""
    base: list[tuple] = []
    candidates: list[tuple] = []
    if not text:
        return base, candidates, Counter()
    if "=" in text or ":" in text:
        base += [(0, *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    at = 0
    # No run holds white space, and each has 16 characters at least.
    for word in [w for w in text.split() if len(w) >= SHORTEST]:
        at = text.index(word, at)
        base += [(1, at + m.start(), at + m.end()) for m in _ACCESS.finditer(word) if len(m[0]) >= 20]
        base += [(2, at + m.start(), at + m.end()) for m in _HEX.finditer(word)]
        for start, run in [(m.start() + a, m[0][a:b]) for m in _RUN.finditer(word) for a, b in parts_of(m[0])]:
            name = encoding_of(run) or letter_encoding_of(run)
            if name:
                candidates.append((at + start, at + start + len(run), _cell(name, band_of(len(run))), step_of(run, name)))
        at += len(word)
    base.sort(key=lambda s: (s[1], s[0]))
    return base, candidates, letter_stretches(text, SHORTEST)


def letter_stretches(text: str, least: int = BANDS[1]) -> Counter:
    """The letters of the whole text, cut into stretches of one length from `least` to 79 that the text decides, counted by (cell, step)."""
    raw = text.encode("utf-8", "surrogatepass")
    size, counted = least + zlib.crc32(raw) % (80 - least), Counter()
    codes = np.frombuffer(raw, np.uint8)
    codes = codes[_IS_LETTER[codes]]
    codes = codes[: len(codes) // size * size].reshape(-1, size)
    for at in range(0, len(codes), SLAB):
        for names, places in _LETTER_PLACES:
            steps = steps_of(places[codes[at : at + SLAB]], len(ALPHABETS[names[0]]))
            for step, n in enumerate(np.bincount(steps).tolist()):
                if n:
                    for name in names:
                        counted[_cell(name, band_of(size)), step] += n
    return counted


def _cell(name: str, band: int) -> int:
    return NAMES.index(_COMPARED.get(name, name)) * len(BANDS) + band


def scan_column(text: Column) -> Column:
    span = "array<struct<kind int, begin long, end long>>"

    @F.pandas_udf(f"base {span}, found array<struct<begin long, end long, cell int, step int>>, words array<struct<cell int, step int, n long>>")
    def run(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            base, found, words = scan(text)
            rows.append((
                [{"kind": k, "begin": a, "end": b} for k, a, b in base],
                [{"begin": a, "end": b, "cell": c, "step": s} for a, b, c, s in found],
                [{"cell": c, "step": s, "n": n} for (c, s), n in words.items()],
            ))
        return pd.DataFrame(rows, columns=["base", "found", "words"])

    return run.asNondeterministic()(text)


def accepted_steps(candidates: dict[tuple[int, int], int], words: dict[tuple[int, int], int], share: float = FALSE_SHARE) -> dict[int, int]:
    """For each cell the highest step that counts as random. Both inputs: rows by (cell, step).

    A band with fewer than 20 stretches is compared with the next shorter one, where they pass more often.
    """
    rates: dict[tuple[int, int], float] = {}
    for cell in {c for c, _ in candidates}:
        band, compared = cell % len(BANDS), cell
        while band and sum(n for (c, _), n in words.items() if c == compared) < 20:
            band, compared = band - 1, compared - 1
        total = sum(n for (c, _), n in words.items() if c == compared)
        for step in {s for c, s in candidates if c == cell}:
            rates[cell, step] = (1 + sum(n for (c, s), n in words.items() if c == compared and s <= step)) / (1 + total)
    every, so_far, limit = sum(candidates.values()), 0, 0.0
    for rate in sorted(set(rates.values())):
        so_far += sum(candidates[k] for k, r in rates.items() if r == rate)
        if rate * every <= share * so_far:
            limit = rate
    return {cell: max(s for (c, s), r in rates.items() if c == cell and r <= limit) for cell in {c for (c, _), r in rates.items() if r <= limit}}


def scanned(docs: DataFrame, work: Workspace, name: str = "__scan", with_text: bool = True) -> tuple[DataFrame, dict[int, int]]:
    """`docs` with a struct of what `scan` found, written aside with or without the text, and the steps accepted over all of them.

    Only counts by cell and step reach the driver: at most len(ALPHABETS) * len(BANDS) * STEPS each.
    """
    found = docs.withColumn(name, scan_column(F.col("text")))
    kept = work.keep(found if with_text else found.drop("text"))

    def counts(field: str, n: Column) -> dict[tuple[int, int], int]:
        rows = kept.select(F.explode(f"{name}.{field}").alias("x")).groupBy("x.cell", "x.step").agg(F.sum(n).alias("n"))
        return {(r["cell"], r["step"]): r["n"] for r in rows.collect()}

    return kept, accepted_steps(counts("found", F.lit(1)), counts("words", F.col("x.n")))


def all_spans(base: list[tuple], found: list[tuple], steps: dict[int, int]) -> list[tuple]:
    """Base spans (kind, start, end) and the accepted ones (start, end, cell, step) that touch none of them, by start, then kind.

    Accepted ones that overlap are one span. Whether a base span is touched is read off the furthest end of those that begin before.
    """
    random, added = KINDS.index("random"), []
    places = sorted((a, b) for _, a, b in base)
    begins, reach = [a for a, _ in places], list(accumulate((b for _, b in places), max))
    for start, end, cell, step in sorted(found):
        if step > steps.get(cell, -1):
            continue
        k = bisect_left(begins, end)
        if k and reach[k - 1] > start:
            continue
        if added and added[-1][2] > start:
            added[-1] = (random, added[-1][1], max(added[-1][2], end))
        else:
            added.append((random, start, end))
    return sorted([*base, *added], key=lambda s: (s[1], s[0]))


def written(spans: list[tuple]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def find_secrets(docs: DataFrame, work: Workspace) -> DataFrame:
    """doc_id, text -> doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random; a row for each row of `docs`.

    Null and empty texts have no spans. Other columns are ignored.
    """
    kept, steps = scanned(docs.select("doc_id", "text"), work, with_text=False)

    @F.pandas_udf("n_assign long, n_access long, n_hex long, base string, spans string, n_random long")
    def run(scans: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for base, found in zip(scans["base"], scans["found"], strict=True):
            own = [(s["kind"], s["begin"], s["end"]) for s in base]
            spans = all_spans(own, [(s["begin"], s["end"], s["cell"], s["step"]) for s in found], steps)
            counts = Counter(k for k, _, _ in spans)
            rows.append((counts[0], counts[1], counts[2], written(own), written(spans), counts[KINDS.index("random")]))
        return pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "base", "spans", "n_random"])

    told = kept.select("doc_id", run.asNondeterministic()(F.col("__scan")).alias("x"))
    return told.select(
        "doc_id", "x.n_assign", "x.n_access", "x.n_hex", F.sha2(F.col("x.base").cast("binary"), 256).alias("base_sha256"), "x.spans", "x.n_random"
    )


def redacted(text: Column, scan: Column, steps: dict[int, int], mark: str = "[SECRET]") -> Column:
    """The text with every span replaced by a mark; spans that overlap are replaced together."""

    @F.pandas_udf("string")
    def run(texts: pd.Series, scans: pd.DataFrame) -> pd.Series:
        rows = zip(texts, scans["base"], scans["found"], strict=True)
        return pd.Series([_redact(t, _hidden_places(base, found, steps), mark) for t, base, found in rows], dtype=object)

    return run.asNondeterministic()(text, scan)


def _hidden_places(base, found, steps: dict[int, int]) -> list[tuple[int, int]]:
    """Base spans and all accepted ones, also those that `all_spans` leaves to the base span they touch: more is hidden, not less."""
    return sorted([(s["begin"], s["end"]) for s in base] + [(s["begin"], s["end"]) for s in found if s["step"] <= steps.get(s["cell"], -1)])


def _redact(text: str | None, places: list[tuple[int, int]], mark: str) -> str | None:
    if text is None or not places:
        return text
    out, at = [], 0
    for begin, end in places:
        if begin >= at:
            out += [text[at:begin], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def digest(spans: list[tuple]) -> str:
    """base_sha256 of spans (kind, start, end), for tests."""
    return hashlib.sha256(",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()
