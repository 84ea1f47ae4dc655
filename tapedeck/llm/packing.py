"""Best-fit packing of documents into sequences by linear grouping.

Pieces are dealt to blocks of about `BLOCK` pieces by a written row number, and every block is packed on its
own; a block loses one part-filled sequence at most. In a block: large pieces, longest first, form groups of equal
size, whose lengths are rounded up to the group's longest. With these few lengths, configurations of a sequence
are chosen one after another: the longest length that is left and the best filling of the rest (an exact knapsack
over the numbers left), used as often as the numbers allow. Actual pieces then take the places of their group, and
small pieces go, longest first, to the sequence that they fill best.
"""

from __future__ import annotations

import os
import re
import struct
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapedeck.llm.common import WordTable, Workspace, bucket_of, byte_words, held

CAPACITY = 2048
END_ID = 0
BLOCK = 16_384
GROUPS = 256
#: Pieces up to this share of the capacity are small.
SMALL = 0.45


def _byte_symbols() -> str:
    """The printable character that byte-level vocabularies write for each byte: printable Latin-1 as itself, the rest from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    extra = iter(range(256, 512))
    return "".join(chr(b if b in shown else next(extra)) for b in range(256))


_PUNCTUATED = re.compile(rb"([A-Za-z\x80-\xff]+)([!-/:-@\[-`{-~]+)")


class Tokenizer:
    """Ids of a text by a table of distinct words: no token of these vocabularies crosses ASCII white space.

    Words of letters alone skip the search for token borders, which is most of the library's work, and letters with ASCII
    punctuation behind them are put together from both parts: a border lies between them. Both are tried out first.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import tokenizers

        self.tokenizer = tokenizers.Tokenizer.from_file(path)
        self.table = WordTable(self._compute)
        self.symbols = _byte_symbols()
        letters = "".join(c for c in map(chr, range(256)) if c.isalpha())
        self.lowers = self.tokenizer.normalizer is not None and self.tokenizer.normalizer.normalize_str(letters) == letters.lower()
        probe = ["Éa", "straße", "x", "中"]
        self.by_letters = self.tokenizer.normalizer is not None and [self._ids(self._normal(p) or p) for p in probe] == self._library(probe)
        whole = [w + tail for w in probe for tail in (".", "***", "!?", "'", "<|")]
        parts = [w + " " + tail for w in probe for tail in (".", "***", "!?", "'", "<|")]
        self.by_parts = self.by_letters and self._library(whole) == self._library(parts)

    def _library(self, words: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _normal(self, word: str) -> str | None:
        """The word as the model reads it; None if it isn't of letters alone, before or afterwards."""
        if not word.isalpha():
            return None
        # Letters of Latin-1 don't combine with each other, so that each is normalised on its own.
        word = word.lower() if self.lowers and max(word) < "\u0100" else self.tokenizer.normalizer.normalize_str(word)
        return word if word.isalpha() else None

    def _ids(self, normal: str) -> list[int]:
        return [t.id for t in self.tokenizer.model.tokenize(normal.encode("utf-8").decode("latin-1").translate(self.symbols))]

    def _compute(self, words: list[bytes]) -> list[bytes]:
        texts = [w.decode("utf-8", "surrogatepass") for w in words]
        found: list[bytes | None] = [None] * len(words)
        joined, rest = [], []
        for k, text in enumerate(texts):
            if self.by_letters and (normal := self._normal(text)):
                found[k] = _packed(self._ids(normal))
            elif self.by_parts and (m := _PUNCTUATED.fullmatch(words[k])) and self._normal(m[1].decode("utf-8", "surrogatepass")):
                joined.append((k, m[1], m[2]))
            else:
                rest.append(k)
        for k, ids in zip(rest, self._library([texts[k] for k in rest]), strict=True):
            found[k] = _packed(ids)
        if joined:
            heads = self.table.lookup([head for _, head, _ in joined])
            # Tails alone are no punctuated words, so that this goes no deeper.
            tails = self.table.lookup([tail for _, _, tail in joined])
            for (k, _, _), head, tail in zip(joined, heads, tails, strict=True):
                found[k] = head + tail
        return found

    def encode(self, text: str | None) -> bytes:
        """Four bytes for each id, the end id last."""
        return b"".join([*self.table.lookup(byte_words(text or "")), np.array([END_ID], "<u4").tobytes()])


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def tokenizer(path: str) -> Tokenizer:
    return held(("tokenizer", path), lambda: Tokenizer(path))


def pieces_column(text: Column, path: str, capacity: int = CAPACITY) -> Column:
    """Lengths and checksums of the document's pieces; all but the last are of full length."""

    @F.pandas_udf("array<struct<length:long, ids_crc32:long>>")
    def run(texts: pd.Series) -> pd.Series:
        rows = []
        for text in texts:
            ids, step = tokenizer(path).encode(text), 4 * capacity
            parts = [ids[k : k + step] for k in range(0, len(ids), step)]
            rows.append([{"length": len(p) // 4, "ids_crc32": zlib.crc32(p)} for p in parts])
        return pd.Series(rows, dtype=object)

    return run.asNondeterministic()(text)


def fill(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """The sequence (from 0) of each piece and its place there."""
    order = np.argsort(-lengths, kind="stable")
    large = order[lengths[order] > SMALL * capacity]
    small = order[len(large) :]
    sequence, place = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    used: list[int] = []

    # Linear grouping: equal numbers of pieces, each rounded up to the longest of its group.
    step = max(1, -(-len(large) // GROUPS))
    groups = [list(large[k : k + step]) for k in range(0, len(large), step)]
    sizes = [int(lengths[g[0]]) for g in groups]
    merged: dict[int, list[int]] = {}
    for size, group in zip(sizes, groups, strict=True):
        merged.setdefault(size, []).extend(group)
    sizes = sorted(merged, reverse=True)
    left = {s: merged[s][::-1] for s in sizes}
    while sizes:
        first = sizes[0]
        config = {first: 1}
        for s in _best_filling(sizes, {s: len(left[s]) - (s == first) for s in sizes}, capacity - first):
            config[s] = config.get(s, 0) + 1
        for _ in range(min(len(left[s]) // n for s, n in config.items())):
            at = 0
            for s, n in config.items():
                for _ in range(n):
                    piece = left[s].pop()
                    sequence[piece], place[piece] = len(used), at
                    at += int(lengths[piece])
            used.append(at)
        sizes = [s for s in sizes if left[s]]

    # Best fit: `room` has a bit for every free length that some sequence has.
    free: list[list[int]] = [[] for _ in range(capacity + 1)]
    room = 0
    for s, at in enumerate(used):
        free[capacity - at].append(s)
        room |= 1 << (capacity - at)
    for piece in small:
        need = int(lengths[piece])
        fitting = room >> need
        if fitting:
            space = need + ((fitting & -fitting).bit_length() - 1)
            s = free[space].pop()
            if not free[space]:
                room &= ~(1 << space)
        else:
            space, s = capacity, len(used)
            used.append(0)
        sequence[piece], place[piece] = s, capacity - space
        space -= need
        free[space].append(s)
        room |= 1 << space
    return sequence, place


def _best_filling(sizes: list[int], numbers: dict[int, int], room: int) -> list[int]:
    """Sizes, each used as often as `numbers` allows, whose sum comes closest to `room` from below."""
    reached = np.zeros(room + 1, bool)
    reached[0] = True
    by = np.zeros(room + 1, np.int64)
    for s in sizes:
        for _ in range(min(numbers[s], room // s)):
            new = np.zeros(room + 1, bool)
            new[s:] = reached[:-s]
            new &= ~reached
            if not new.any():
                break
            by[new] = s
            reached |= new
        if reached[room]:
            break
    at = int(np.nonzero(reached)[0][-1])
    out = []
    while at:
        out.append(int(by[at]))
        at -= out[-1]
    return out


def cut(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, text -> doc_id, piece, start, length, ids_crc32."""
    parts = docs.select("doc_id", F.posexplode(pieces_column(F.col("text"), path, capacity)).alias("piece", "p"))
    return parts.select("doc_id", "piece", (F.col("piece") * F.lit(capacity).cast("long")).alias("start"), "p.*")


def pack(docs: DataFrame, path: str, work: Workspace, capacity: int = CAPACITY, block: int = BLOCK) -> DataFrame:
    """doc_id, text -> doc_id, piece, start, length, ids_crc32, sequence_id, offset: a row for each piece.

    Null and empty texts are the end id alone. Repeated rows are packed as often as they come. Other columns
    are ignored.
    """
    rows = work.keep(cut(docs, path, capacity).withColumn("row", F.monotonically_increasing_id()))
    blocks = max(1, -(-rows.count() // block))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("row", ignore_index=True)  # so that repeated attempts agree
        sequence, place = fill(pdf["length"].to_numpy(), capacity)
        return pdf.assign(sequence_id=pdf["block"].to_numpy() * 2**32 + sequence, offset=place).drop(columns=["row", "block"])

    dealt = rows.withColumn("block", bucket_of("row", blocks))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name != "row")
    return dealt.groupBy("block").applyInPandas(run, f"{kinds}, sequence_id long, offset long")
