"""SimHash near-duplicates: fingerprints linked at a few differing bits, grouped into components.

The join embeds a fingerprint as the bit counts of its two-bit segments. Manhattan distance between
embeddings never exceeds the number of differing bits, so a range join there finds every link. Its grid:
the 32 coordinates are dealt to `GROUPS` groups, and points within distance d agree in at least GROUPS - d
of them; a grid for every choice of that many groups has one cell for each value of their coordinates, so
both ends of a link share a cell. Pairs in a cell are tested in the embedding first, then exactly.

A crowded cell is cut into blocks, and each pair of blocks is one bounded row of work. A block hands on
a spanning star for each of its local components, never its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapedeck.llm.common import Workspace, bucket_of
from tapedeck.llm.components import components

SHINGLE_WORDS = 3
SEED = 42
MAX_BITS = 3
GROUPS = 6
BLOCK = 2048

_EVEN = 0x5555555555555555
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def fingerprint(text: str | None) -> int:
    """A bit is set if over half of the shingles' hashes set it; unsigned, zero without words."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []  # of bytes: only A-Z change
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-1]))
    span = min(SHINGLE_WORDS, len(words))
    n = len(words) - span + 1
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(line[a:b], SEED) for a, b in zip(starts[:n].tolist(), (ends[span - 1 :] - 1).tolist(), strict=True)])
    columns = np.frombuffer(hashes, np.uint8).reshape(n, 8)
    if n < 64:
        counts = np.unpackbits(columns, axis=1).sum(axis=0, dtype=np.int64)
    else:
        counts = np.concatenate([np.bincount(columns[:, k], minlength=256) @ _BITS for k in range(8)])
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")


def fingerprint_column(text: Column) -> Column:
    """The fingerprint's 64 bits as a signed long."""

    @F.pandas_udf("long")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64))

    return run.asNondeterministic()(text)


def _embedding(x):
    """Bit counts of the two-bit segments, each written as that many ones, so that Manhattan distance is a count of
    differing bits. Works on numpy arrays; `_embedding_column` is the same in Spark."""
    even = np.uint64(_EVEN)
    half = x >> np.uint64(1)
    return ((x | half) & even) | ((x & half & even) << np.uint64(1))


def _embedding_column(x: Column) -> Column:
    half = F.shiftrightunsigned(x, 1)
    some, both = x.bitwiseOR(half).bitwiseAND(F.lit(_EVEN)), x.bitwiseAND(half).bitwiseAND(F.lit(_EVEN))
    return some.bitwiseOR(F.shiftleft(both, 1))


def _grid_masks(max_bits: int) -> list[int]:
    """One mask of coordinates for every choice of groups that must agree (signed, for Spark)."""
    groups = max(GROUPS, max_bits + 1)
    parts = [sum(3 << (2 * s) for s in range(32) if s * groups // 32 == g) for g in range(groups)]
    masks = [sum(chosen) for chosen in combinations(parts, groups - max_bits)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def local_stars(prints: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(root, member) for the components among these fingerprints; prints without a link are left out."""
    prints = np.unique(prints.view(np.uint64))
    embedded, size = _embedding(prints), len(prints)
    left, right = [], []
    for at in range(0, size, 512):
        i, j = np.nonzero(np.bitwise_count(embedded[at : at + 512, None] ^ embedded[None, :]) <= max_bits)
        i += at
        near = (np.bitwise_count(prints[i] ^ prints[j]) <= max_bits) & (i != j)
        left.append(i[near])
        right.append(j[near])
    i, j = np.concatenate(left), np.concatenate(right)
    if not len(i):
        return prints[:0].view(np.int64), prints[:0].view(np.int64)
    label, (nodes, first) = np.arange(size), np.unique(i, return_index=True)
    while True:
        new = label.copy()
        new[nodes] = np.minimum(label[nodes], np.minimum.reduceat(label[j], first))
        new = new[new]
        if (new == label).all():
            break
        label = new
    members = nodes[label[nodes] != nodes]
    return prints[label[members]].view(np.int64), prints[members].view(np.int64)


def near_links(prints: DataFrame, work: Workspace, max_bits: int = MAX_BITS) -> DataFrame:
    """Distinct `fp` -> links (a, b) that connect exactly the fingerprints joined by chains of at most `max_bits` bits."""
    masks, e = _grid_masks(max_bits), F.col("e")
    grids = F.explode(F.array(*[F.struct(F.lit(k).alias("grid"), e.bitwiseAND(F.lit(m)).alias("cell")) for k, m in enumerate(masks)]))
    points = prints.select("fp", _embedding_column(F.col("fp")).alias("e")).select("fp", grids.alias("g")).select("fp", "g.*")
    crowds = points.groupBy("grid", "cell").agg(F.count("*").alias("n")).where("n > 1")
    parts = F.ceil(F.col("n") / BLOCK)
    mine = points.join(crowds, ["grid", "cell"]).withColumn("parts", parts).withColumn("own", bucket_of("fp", F.col("parts")))
    dealt = mine.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    blocks = dealt.groupBy("grid", "cell", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high")).agg(
        F.collect_list("fp").alias("fps")
    )

    def stars(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [local_stars(np.asarray(fps, np.int64), max_bits) for fps in batch["fps"]]
            if found:
                yield pd.DataFrame({"a": np.concatenate([a for a, _ in found]), "b": np.concatenate([b for _, b in found])})

    return blocks.select("fps").mapInPandas(stars, "a long, b long")


def roots_of(prints: DataFrame, work: Workspace, max_bits: int = MAX_BITS) -> DataFrame:
    """Distinct `fp` -> fp, root: the same root for fingerprints that are linked."""
    roots = components(near_links(prints, work, max_bits), work)
    return prints.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, work: Workspace, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, text -> doc_id, fingerprint (16 hex digits), component_id, a row for each row of `docs`.

    component_id is the smallest doc_id that can be reached over links. Null and empty texts have
    fingerprint zero and are linked like any other; rows with a null doc_id keep their component, which is
    null if it has no other rows; repeated rows are returned as often as they come. Other columns are ignored.
    """
    marked = work.keep(docs.select("doc_id", fingerprint_column(F.col("text")).alias("fp")))
    prints = work.keep(marked.groupBy("fp").agg(F.min("doc_id").alias("least")))
    rooted = prints.join(roots_of(prints.select("fp"), work, max_bits), "fp")
    named = rooted.join(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("fp", "component_id")
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return marked.join(named, "fp").select("doc_id", digits.alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, work: Workspace, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of `docs` for each component of near duplicates: the smallest doc_id, nulls last, then the smallest digest of the text.

    Rows are written with a number. The choice is made on ids, digests and numbers, first for each fingerprint, which map tasks
    reduce; rows are then picked by their numbers, so that no group of copies meets in one task.
    """
    digest = F.sha2(F.col("text").cast("binary"), 256)
    numbered = docs.withColumns({"__fp": fingerprint_column(F.col("text")), "__row": F.monotonically_increasing_id()})
    rows = work.keep(numbered)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", digest.alias("digest"), F.col("__row").alias("row"))
    least = work.keep(rows.groupBy(F.col("__fp").alias("fp")).agg(F.min(order).alias("least")))
    rooted = least.join(roots_of(least.select("fp"), work, max_bits), "fp")
    chosen = rooted.groupBy("root").agg(F.min("least").alias("least")).select(F.col("least.row").alias("__row"))
    return rows.join(chosen, "__row", "left_semi").select(*docs.columns)
