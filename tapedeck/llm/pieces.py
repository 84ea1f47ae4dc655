"""Encoding and decoding with a sentencepiece model through a table of distinct chunks.

No piece of the model has a white-space marker behind another character, so merges never cross from a word to
the marker in front of the next one: a text splits into chunks (some markers and the word behind them) that are
segmented on their own. Each worker segments a chunk once and joins the ids back in the order of the text.
`check_model` refuses a model for which this does not hold.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pandas as pd
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapedeck.llm.common import WordTable, held

MARK = "▁"
_CHUNKS = re.compile(r" ( *[^ ]*)")


class Codec:
    def __init__(self, model: str):
        self.sp = sentencepiece.SentencePieceProcessor(model_file=model)
        check_model(self.sp)
        self.table = WordTable(self._compute)
        self.leads = np.array([self.sp.id_to_piece(i).startswith(MARK) for i in range(self.sp.get_piece_size())])
        self.begin, self.end = (np.array([i], "<u4").tobytes() for i in (self.sp.bos_id(), self.sp.eos_id()))

    def _compute(self, chunks: list[str]) -> list[tuple[bytes, str]]:
        words = [c for c in chunks if c and " " not in c]
        found = dict(zip(words, self._together(words), strict=True))
        odd = [c for c in chunks if c not in found]
        found.update(zip(odd, self._one_by_one(odd), strict=True))
        return [found[c] for c in chunks]

    def _together(self, words: list[str]) -> list[tuple[bytes, str]]:
        """Words in one call of the library: each begins with its only piece that has a marker in front."""
        joined = " ".join(words)
        ids = self.sp.encode(joined)
        raw = np.array(ids, "<u4")
        starts = np.nonzero(self.leads[raw])[0].tolist()
        if len(starts) != len(words) or self.sp.decode(ids) != joined:
            return self._one_by_one(words)
        packed, ends = raw.tobytes(), [*starts[1:], len(ids)]
        return [(packed[4 * a : 4 * b], w) for w, a, b in zip(words, starts, ends, strict=False)]

    def _one_by_one(self, chunks: list[str]) -> list[tuple[bytes, str]]:
        ids = self.sp.encode(chunks, num_threads=1)
        texts = self.sp.decode(ids, num_threads=1)
        # A marker with nothing behind it: the library puts none in front of an empty text.
        lone = self.sp.piece_to_id(MARK)
        return [(np.array(i, "<u4").tobytes(), t) if c else (np.array([lone], "<u4").tobytes(), "") for c, i, t in zip(chunks, ids, texts, strict=True)]

    def encode(self, text: str | None) -> tuple[bytes, str]:
        """The ids with begin and end, four bytes each, and the text that they decode to."""
        if not text:
            return self.begin + self.end, ""
        text = " " + text.replace(MARK, " ")
        chunks = _CHUNKS.findall(text) if "  " in text else text.split(" ")[1:]
        found = self.table.lookup(chunks)
        return b"".join([self.begin, *[i for i, _ in found], self.end]), " ".join([t for _, t in found])


def check_model(sp: sentencepiece.SentencePieceProcessor) -> None:
    """The model must merge by marker-led chunks, leave text as it is, and put a marker in front."""
    if any(re.search(f"[^{MARK}]{MARK}", sp.id_to_piece(i)) for i in range(sp.get_piece_size())):
        raise ValueError("a piece of this model crosses a white-space marker")
    probe = "  a  ﬁ　b\n"
    if sp.decode(sp.encode(probe)) != probe or sp.encode("a", out_type=str)[0][0] != MARK:
        raise ValueError("this model changes text, or puts no marker in front")


def codec(model: str) -> Codec:
    return held(("codec", model), lambda: Codec(model))


def encoded_column(text: Column, model: str) -> Column:
    """A struct of ids (as integers) and decoded text."""

    @F.pandas_udf("ids array<int>, decoded string")
    def run(texts: pd.Series) -> pd.DataFrame:
        found = [codec(model).encode(t) for t in texts]
        return pd.DataFrame({"ids": [np.frombuffer(i, "<i4") for i, _ in found], "decoded": [t for _, t in found]})

    return run.asNondeterministic()(text)


def digest_column(text: Column, model: str) -> Column:
    """n_tokens, ids_sha256 and decoded_sha256, without handing the ids back to the JVM."""

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def run(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            ids, decoded = codec(model).encode(text)
            rows.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded.encode("utf-8", "surrogatepass")).hexdigest()))
        return pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return run.asNondeterministic()(text)


def encode(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, text -> doc_id, ids, decoded: a row for each row of `docs`. Null counts as empty: begin and end alone."""
    return docs.select("doc_id", encoded_column(F.col("text"), model).alias("e")).select("doc_id", "e.*")


def digests(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, text -> doc_id, n_tokens, ids_sha256, decoded_sha256: a row for each row of `docs`. Null counts as empty."""
    return docs.select("doc_id", digest_column(F.col("text"), model).alias("e")).select("doc_id", "e.*")
