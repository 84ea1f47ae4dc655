"""Personal data: patterns, and a skip-chain conditional random field that carries what they find to tokens that no pattern knows.

Patterns give the base spans. Tokens with a digit, an '@' or a written-out one are the nodes of a field over the whole document; all other words
are observed as no personal data. Neighbouring tokens share a chain potential. Tokens that repeat or resemble each other (the same last
seven digits however they are written, the same local part of an address), wherever they stand, share a skip potential through the
first of them, so that a group of n has n - 1 edges. Loopy message passing makes the labels of a document agree: tokens inside
base spans are observed, and other ones get the label that their shape, their neighbours and their likes speak for.

Weights are fitted by pseudo-likelihood on a bounded sample of documents. Their labels are the base spans, and rewritten copies of these that the patterns miss
(`variants`), with and without the original elsewhere in the text, next to numbers that are no personal data (`ordinary`).
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ["email", "ip", "card", "phone"]
#: Labels: the kinds, then none.
NONE = len(KINDS)
#: Documents that the weights are fitted on at most, and nodes of each at most.
SAMPLE, SAMPLE_NODES = 1500, 300
#: Rewritten copies of each document that is learned from.
COPIES = 6
#: Probability that a token must have to be reported.
SURE = 0.9
#: Rounds of message passing, the same for every document whatever it is scored with.
ROUNDS = 12
#: Nodes scored together.
SLAB = 50_000

_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]*\Z")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
#: A match that began inside a run of digits could begin at the run's start, too.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile("[^0-9]+")
_SEED = re.compile(r"[0-9@]|[\[({]at[\])}]")
_AT = re.compile(r"@|[\[({]at[\])}]")
_BLANKS = {ord(c): " " for c in "\t\n\v\f\r"}
_LEFT, _RIGHT = "\"'[{<*#&%$!|", ".,;:!?\"']}>*#&%$|"
_DIGITS, _LETTERS = re.compile("[0-9]+"), re.compile(r"[^\W\d_]+")
_NUMBERLIKE = re.compile(r"[+(]?[0-9][0-9().-]*")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Around each '@', so that long runs without one are never tried from each of their places."""
    end = 0
    while (at := text.find("@", end)) >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            yield start, m.end()
        # A run behind an '@' that begins no address may be the local part of the next one.
        end = m.end() if m else at + 1


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by start, then kind."""
    found = [(0, *s) for s in _emails(text)]
    if _SEED.search(text):
        found += [(1, *m.span()) for m in _IP.finditer(text) if all(len(p) < 4 and int(p) <= 255 for p in map(_bare, m[0].split(".")))]
        for m in _CARD.finditer(text):
            digits = _NOT_DIGIT.sub("", m[0])
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((2, *m.span()))
        found += [(3, *m.span()) for m in _PHONE.finditer(text) if 10 <= len(_NOT_DIGIT.sub("", m[0])) <= 15]
    return sorted(found, key=lambda s: (s[1], s[0]))


def _bare(part: str) -> str:
    return part.lstrip("0") or "0"


class Graph:
    """Nodes of one text: places, features, label of observed ones (else -1), chain edges (i, i + 1) and skip edges."""

    def __init__(self, text: str, spans: list[tuple[int, int, int]]):
        self.places: list[tuple[int, int]] = []
        self.features: list[list[str]] = []
        self.labels: list[int] = []
        self.chain: list[tuple[int, int]] = []
        flat = text.translate(_BLANKS)
        tokens, at = [], 0
        while m := _SEED.search(flat, at):
            left = max(flat.rfind(" ", at, m.start()) + 1, at)
            at = flat.find(" ", m.end())
            at = len(flat) if at < 0 else at
            tokens.append((left, at))
        by_start, k = sorted(spans, key=lambda s: s[1]), 0
        reach: list[tuple[int, int, int]] = []
        for n, (left, right) in enumerate(tokens):
            start, end = _core(flat, left, right)
            while k < len(by_start) and by_start[k][1] < end:
                reach.append(by_start[k])
                k += 1
            reach = [s for s in reach if s[2] > start]
            self.labels.append(min((s[0] for s in reach), default=-1))
            self.places.append((start, end))
            self.features.append(_features(flat, left, right, start, end))
            if n and tokens[n - 1][1] + 1 == left:
                self.chain.append((n - 1, n))
        self.skip = self._links(flat)

    def _links(self, flat: str) -> list[tuple[int, int]]:
        groups: dict[str, list[int]] = {}
        for run in self._runs():
            digits = [_NOT_DIGIT.sub("", flat[a:b]) for a, b in (self.places[n] for n in run)]
            whole = "".join(digits) if all(_NUMBERLIKE.fullmatch(flat, *self.places[n]) for n in run) else ""
            for n, own in zip(run, digits, strict=True):
                a, b = self.places[n]
                at = _AT.search(flat, a, b)
                if at or len(own) < 7:
                    name = flat[a : at.start() if at else b].casefold()
                    if len(name) > 4 and not _NUMBERLIKE.fullmatch(name):
                        groups.setdefault("@" + name, []).append(n)
                if len(own) >= 7:
                    groups.setdefault(own[-7:], []).append(n)
                elif 7 <= len(whole) <= 19:
                    groups.setdefault(whole[-7:], []).append(n)
        links = set()
        for members in groups.values():
            centre = next((n for n in members if self.labels[n] >= 0), members[0])
            links |= {(centre, n) for n in members if n != centre}
        return sorted(links)

    def _runs(self) -> list[list[int]]:
        """Nodes that stand side by side; those inside different base spans, or in and outside of one, are apart."""
        joined = {j for i, j in self.chain if self.labels[i] == self.labels[j]}
        runs: list[list[int]] = []
        for n in range(len(self.places)):
            if n in joined:
                runs[-1].append(n)
            else:
                runs.append([n])
        return runs


def _core(flat: str, start: int, end: int) -> tuple[int, int]:
    """A token without quotes, marks and unpaired brackets around it."""
    while start < end - 1 and (flat[start] in _LEFT or (flat[start] == "(" and ")" not in flat[start : min(end, start + 40)])):
        start += 1
    while end > start + 1 and (flat[end - 1] in _RIGHT or (flat[end - 1] == ")" and "(" not in flat[max(start, end - 40) : end])):
        end -= 1
    return start, end


def _shape(core: str) -> str:
    return _LETTERS.sub("a", _DIGITS.sub(lambda m: f"9{min(len(m[0]), 6)}", core))[:30]


def _features(flat: str, left: int, right: int, start: int, end: int) -> list[str]:
    core = flat[start : min(end, start + 80)]
    digits, letters = _NOT_DIGIT.sub("", core), sum(map(len, _LETTERS.findall(core)))
    before, after = left - 1, right + 1
    while before > 0 and flat[before - 1] == " ":
        before -= 1
    while after < len(flat) - 1 and flat[after] == " ":
        after += 1
    word = flat[max(0, flat.rfind(" ", max(0, before - 30), max(before, 0)) + 1) : max(before, 0)]
    follows = flat[after : after + 30].split(" ", 1)[0]
    marks = "".join(c for c in ".-()+:/@_,%=" if c in core)
    return [
        "bias", "s" + _shape(core), f"d{min(len(digits), 20)}", f"l{min(letters, 5)}", "m" + marks, f"n{min((end - start) // 4, 12)}",
        f"u{len(digits) >= 12 and luhn(digits)}{len(digits) >= 14}", f"a{bool(_AT.search(core))}{core.count('.') if core.count('.') < 4 else 4}",
        "p" + word.casefold().strip(_LEFT + _RIGHT)[:12], "f" + follows.casefold().strip(_LEFT + _RIGHT)[:12],
    ]


class Field:
    """The fitted weights; plain arrays and a dictionary of features, so that it travels to the workers."""

    def __init__(self, names: dict[str, int], weights: np.ndarray, chain: np.ndarray, skip: np.ndarray):
        self.names, self.weights, self.chain, self.skip = names, weights, chain, skip

    def beliefs(self, graphs: list[Graph]) -> list[np.ndarray]:
        """For each graph the probability of each label at each node."""
        out: list[np.ndarray] = []
        held: list[Graph] = []
        for k, g in enumerate(graphs):
            held.append(g)
            if k + 1 == len(graphs) or sum(len(x.places) for x in held) >= SLAB:
                sizes = np.cumsum([0] + [len(x.places) for x in held])
                every = self._pass(held, sizes)
                out += [every[a:b] for a, b in zip(sizes[:-1], sizes[1:], strict=True)]
                held = []
        return out

    def _pass(self, graphs: list[Graph], sizes: np.ndarray) -> np.ndarray:
        count, labels = int(sizes[-1]), NONE + 1
        own = np.zeros((count, labels))
        for g, at in zip(graphs, sizes, strict=False):
            for n, (features, label) in enumerate(zip(g.features, g.labels, strict=True)):
                if label >= 0:
                    own[at + n] = -60.0
                    own[at + n, label] = 0.0
                else:
                    known = [self.names[f] for f in features if f in self.names]
                    own[at + n] = self.weights[known].sum(axis=0)
        chain = np.array([(at + i, at + j) for g, at in zip(graphs, sizes, strict=False) for i, j in g.chain], int).reshape(-1, 2)
        skip = np.array([(at + i, at + j) for g, at in zip(graphs, sizes, strict=False) for i, j in g.skip], int).reshape(-1, 2)
        # Each edge twice, once a direction; `back` is the place of the other one.
        source = np.concatenate([chain[:, 0], chain[:, 1], skip[:, 0], skip[:, 1]])
        target = np.concatenate([chain[:, 1], chain[:, 0], skip[:, 1], skip[:, 0]])
        c, s = len(chain), len(skip)
        back = np.concatenate([np.arange(c, 2 * c), np.arange(c), np.arange(2 * c + s, 2 * c + 2 * s), np.arange(2 * c, 2 * c + s)])
        pair = np.concatenate([np.repeat(m[None], n, axis=0) for m, n in ((self.chain, c), (self.chain.T, c), (self.skip, s), (self.skip.T, s))])
        messages = np.zeros((len(source), labels))
        for _ in range(ROUNDS if len(source) else 0):
            total = own + _summed(target, messages, count)
            out = (total[source] - messages[back])[:, :, None] + pair
            top = out.max(axis=1)
            new = top + np.log(np.exp(out - top[:, None, :]).sum(axis=1))
            messages = 0.5 * messages + 0.5 * (new - new.max(axis=1, keepdims=True))
        total = own + _summed(target, messages, count)
        shares = np.exp(total - total.max(axis=1, keepdims=True))
        return shares / shares.sum(axis=1, keepdims=True)


def _summed(at: np.ndarray, rows: np.ndarray, count: int) -> np.ndarray:
    """Rows added up by their place."""
    return np.stack([np.bincount(at, rows[:, k], count) for k in range(rows.shape[1])], axis=1)


def added_spans(graph: Graph, beliefs: np.ndarray, text: str) -> list[tuple[int, int, int]]:
    """Spans of tokens outside all base spans; the parts of a phone or card number that stand side by side are one, up to the digits that it can have."""
    out: list[tuple[int, int, int]] = []
    most = {2: 19, 3: 15}
    sure = beliefs[:, :NONE].max(axis=1, initial=0) >= SURE
    side_by_side, last = {j for _, j in graph.chain}, -2
    for n in np.nonzero(sure)[0].tolist():
        if graph.labels[n] >= 0:
            continue
        kind, (start, end) = int(beliefs[n, :NONE].argmax()), graph.places[n]
        if last == n - 1 and n in side_by_side and kind in most and out[-1][0] == kind and len(_NOT_DIGIT.sub("", text[out[-1][1] : end])) <= most[kind]:
            out[-1] = (kind, out[-1][1], end)
        else:
            out.append((kind, start, end))
        last = n
    return out


def variants(kind: int, span: str, turn: int) -> str:
    """The same address or number in another writing."""
    digits = _NOT_DIGIT.sub("", span)
    if kind == 0:
        local, _, domain = span.partition("@")
        return [f"{local}(at){domain}", f"{local}[at]{domain}", f"{local}@{domain.split('.')[0]}", local][turn % 4]
    if kind == 1:
        return [span.replace(".", "-"), "ip-" + span.replace(".", "-"), span.replace(".", "[.]"), span.replace(".", ",")][turn % 4]
    if kind == 2:
        fours = [digits[k : k + 4] for k in range(0, len(digits), 4)]
        return [".".join(fours), "/".join(fours), "_".join(fours), ":".join(fours)][turn % 4]
    area, first, rest = digits[-10:-7], digits[-7:-4], digits[-4:]
    return [f"({area}) {first}-{rest}", f"{area}-{first}-{rest}", f"{area}.{first}.{rest}", f"{first}-{rest}"][turn % 4]


def ordinary(turn: int) -> str:
    """Numbers that are no personal data, written from a number."""
    a, b, c = turn % 28 + 1, turn // 28 % 12 + 1, turn // 7 % 900 + 100
    forms = [
        f"20{a:02d}-{b:02d}-{a:02d}", f"{a}.{b}.20{b:02d}", f"{b}/{a}/{1900 + c % 100}", f"{a % 24:02d}:{b:02d}", f"{b}.{a}", f"v{b}.{a}.{c}", f"{c},{c:03d}", f"{c}",
        f"1{c}", f"${c}.{a:02d}", f"{a}%", f"{c}.{c},{a:02d}", f"{b}.", f"No. {c}", f"{c:x}{turn * 2654435761 % 2**32:08x}", f"{c}-{a}", f"@user{a}", f"{a}th",
        f"978-3-16-{turn % 10**6:06d}-{a % 10}", f"#{c}{c}", f"page {c}", f"{c}{a:02d}{c}{b:02d}", f"({1900 + c % 100})", f"[{a}]", f"sha1:{turn * 40503 % 2**40:040x}",
        f"id_{c}{a}", f"{a} x {b}", f"{turn * 2654435761 % 10**16:016d}x", f"x{c}@{a}",
    ]
    return forms[turn % len(forms)]


def examples(text: str) -> list[tuple[list[list[str]], list[int], list[list[int]], list[list[int]]]]:
    """(features, labels, chain edges, skip edges) of the text, and of copies with rewritten spans and ordinary numbers among its words."""
    spans, seed = base_spans(text), zlib.crc32(text.encode("utf-8", "surrogatepass"))
    plain = [text]
    marked: list[list[tuple[int, int, int]]] = [spans]
    if spans:
        for copy in range(COPIES):
            out, places, at, later = [], [], 0, []
            for k, (kind, a, b) in enumerate(spans):
                if a < at:
                    continue
                span, turn = text[a:b], seed + 7 * k + copy
                other = variants(kind, span, turn // 2)
                keep = (turn + copy) % 2 == 0
                out.append(text[at:a])
                place = sum(map(len, out))
                out.append(span if keep else other)
                places.append((kind, place, place + len(out[-1])))
                if keep:
                    later.append((kind, other))
                at = b
            out.append(text[at:])
            words = text[:2000].split()[:40]
            for k, (kind, other) in enumerate(later):
                out.append(f" {words[(seed + 3 * k) % len(words)]} {ordinary(seed % 1009 + 31 * k + copy)} {words[(seed + 5 * k) % len(words)]} ")
                place = sum(map(len, out))
                out.append(other)
                places.append((kind, place, place + len(other)))
            out.append(f" {words[seed % len(words)]}.")
            plain.append("".join(out))
            marked.append(places)
    elif words := text[:2000].split()[:40]:
        numbers = " ".join(f"{words[(seed + k) % len(words)]} {ordinary(seed % 1009 + 13 * k)}" for k in range(6))
        plain.append(f"{text} {numbers} {words[0]}")
        marked.append(spans)
    rows = []
    for source, places in zip(plain, marked, strict=True):
        graph = Graph(source, places)
        few = range(min(len(graph.places), SAMPLE_NODES))
        labels = [NONE if graph.labels[n] < 0 else graph.labels[n] for n in few]
        rows.append(([graph.features[n] for n in few], labels, *([list(e) for e in edges if e[0] < len(few) and e[1] < len(few)] for edges in (graph.chain, graph.skip))))
    return [r for r in rows if r[0]]


def fit_field(rows: list[tuple], rounds: int = 300) -> Field:
    """Weights by pseudo-likelihood: each node's label given its features and the labels of its neighbours."""
    counted = Counter(f for features, *_ in rows for node in features for f in node)
    names = {f: k for k, f in enumerate(sorted(f for f, n in counted.items() if n >= 3 or f == "bias"))}
    sizes = np.cumsum([0] + [len(r[0]) for r in rows])
    y = np.array([label for r in rows for label in r[1]], int)
    cells = [(at + n, names[f]) for r, at in zip(rows, sizes, strict=False) for n, node in enumerate(r[0]) for f in node if f in names]
    node, feature = (np.array(c, int) for c in zip(*cells, strict=True)) if cells else (np.zeros(0, int), np.zeros(0, int))
    edges = [np.array([(at + i, at + j) for r, at in zip(rows, sizes, strict=False) for i, j in r[k]], int).reshape(-1, 2) for k in (2, 3)]
    size, total = NONE + 1, max(len(y), 1)
    params = [np.zeros((len(names), size)), np.zeros((size, size)), np.zeros((size, size))]
    squares = [np.full_like(p, 1e-8) for p in params]
    target = np.eye(size)[y]
    for _ in range(rounds if len(y) else 0):
        scores = _summed(node, params[0][feature], len(y))
        for e, pair in zip(edges, params[1:], strict=True):
            scores += _summed(e[:, 1], pair[y[e[:, 0]]], len(y)) + _summed(e[:, 0], pair.T[y[e[:, 1]]], len(y))
        scores -= scores.max(axis=1, keepdims=True)
        miss = np.exp(scores)
        miss = miss / miss.sum(axis=1, keepdims=True) - target
        slopes = [_summed(feature, miss[node], len(names))]
        for e in edges:
            slopes.append(_summed(y[e[:, 0]], miss[e[:, 1]], size) + _summed(y[e[:, 1]], miss[e[:, 0]], size).T)
        for p, slope, square in zip(params, slopes, squares, strict=True):
            slope = slope / total + 2e-5 * p
            square += slope**2
            p -= 0.5 * slope / np.sqrt(square)
    return Field(names, *params)


def learn(docs: DataFrame) -> Field:
    """doc_id, text -> weights from at most SAMPLE documents with a digit or an '@', drawn by a hash of their text.

    Their number is counted first, so that no more than a few times SAMPLE texts are ever moved. Only features and labels of at most SAMPLE_NODES
    tokens of each reach the driver. Without any document all weights are zero.
    """
    seeds = docs.where(F.col("text").rlike("[0-9@]")).select("text", F.xxhash64("text").alias("draw"))
    share = min(1.0, 4 * SAMPLE / max(seeds.count(), 1))
    near = seeds.where(F.pmod(F.xxhash64("draw"), F.lit(1 << 30)) <= int(share * (1 << 30)))
    drawn = near.dropDuplicates(["draw"]).orderBy("draw").limit(SAMPLE)

    @F.pandas_udf("array<struct<features:array<array<string>>, labels:array<int>, chain:array<array<int>>, skip:array<array<int>>>>")
    def made(texts: pd.Series) -> pd.Series:
        names = ["features", "labels", "chain", "skip"]
        return pd.Series([[dict(zip(names, r, strict=True)) for r in examples(t)] for t in texts], dtype=object)

    rows = drawn.select("draw", F.explode(made("text")).alias("x")).select("draw", "x.*").collect()
    return fit_field([(r["features"], r["labels"], r["chain"], r["skip"]) for r in sorted(rows, key=lambda r: (r["draw"], str(r["features"])))])


def scan(texts: list[str | None], field: Field) -> list[tuple[list[tuple], list[tuple]]]:
    """(base spans, added spans) of each text."""
    base = [base_spans(t) if t else [] for t in texts]
    graphs = [Graph(t or "", spans) for t, spans in zip(texts, base, strict=True)]
    return [(spans, added_spans(g, b, t or "")) for t, spans, g, b in zip(texts, base, graphs, field.beliefs(graphs), strict=True)]


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (s[1], s[0], s[2])))


def scan_column(text: Column, field: Field) -> Column:
    """A struct of the base spans and all spans as text, the number of base spans of each kind and of added ones."""

    @F.pandas_udf("n_email long, n_ip long, n_card long, n_phone long, base string, spans string, n_added long")
    def run(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for base, added in scan(list(texts), field):
            counts = Counter(k for k, _, _ in base)
            rows.append((*(counts[k] for k in range(len(KINDS))), written(base), written(base + added), len(added)))
        return pd.DataFrame(rows, columns=["n_email", "n_ip", "n_card", "n_phone", "base", "spans", "n_added"])

    return run.asNondeterministic()(text)


def find_personal_data(docs: DataFrame, field: Field) -> DataFrame:
    """doc_id, text -> doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added; a row for each row of `docs`.

    Null and empty texts have no spans. Added spans overlap no base span. Texts are judged one by one, so that repeated rows get equal
    results. Other columns are ignored.
    """
    found = docs.select("doc_id", scan_column(F.col("text"), field).alias("x"))
    return found.select(
        "doc_id", "x.n_email", "x.n_ip", "x.n_card", "x.n_phone", F.sha2(F.col("x.base").cast("binary"), 256).alias("base_sha256"), "x.spans", "x.n_added"
    )
