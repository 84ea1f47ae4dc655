"""Nearest neighbours by multi-index hashing.

Codes are signs of learned rotations (iterative quantisation on a bounded sample, one rotation for every
`dimension` bits). Each shard of the index cuts its codes into eight-bit substrings and keeps a table from
substring value to rows for every one of them. Codes within R differing bits of a query differ in at most
floor(R / substrings) bits in some substring, so probing all values that near in every table retrieves each of
them; the radius grows until enough codes lie inside it, and these are ranked by their inner products. As those
also depend on the lengths of vectors, codes are made of vectors lifted to equal length by one more coordinate. The radius holds
OVERSAMPLE codes for each result wanted, which finds more than nine in ten of the true ones (README has the figures).

With `exact`, what lies outside the radius is passed over only where a bound on its inner products is below the last one found; else the
radius grows to where it is, and a shard where it never is gets scanned.

Equal vectors are searched once: each distinct vector carries its smallest ids, as many as one
result can hold. Shards and blocks of queries have bounded sizes; a shard meets every block of queries.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tapedeck.llm.common import Workspace, bucket_of

NEAREST = 20
CODE_BITS = 256
PART_BITS = 8
#: Codes inside the radius before a search in a shard stops: nearest * OVERSAMPLE.
OVERSAMPLE = 256
SAMPLE = 5000
ROUNDS = 30
SHARD, QUERIES = 32_768, 16_384
#: Queries whose products with a shard are held at a time.
SLAB = 32


def learn_rotations(sample: np.ndarray, bits: int = CODE_BITS, rounds: int = ROUNDS, seed: int = 0) -> np.ndarray:
    """Columns are the directions whose signs make the code: orthogonal blocks fitted to the sample, each from another start."""
    dimension = sample.shape[1]
    rng, blocks = np.random.default_rng(seed), []
    unit = sample / np.maximum(np.linalg.norm(sample, axis=1, keepdims=True), 1e-300)
    for _ in range(-(-bits // dimension)):
        rotation, _ = np.linalg.qr(rng.normal(size=(dimension, dimension)))
        for _ in range(rounds if len(unit) >= dimension else 0):
            u, _, v = np.linalg.svd(unit.T @ np.sign(unit @ rotation))
            rotation = u @ v
        blocks.append(rotation)
    return np.concatenate(blocks, axis=1)[:, :bits]


def codes_of(vectors: np.ndarray, rotations: np.ndarray) -> np.ndarray:
    """One row of bytes for each vector: its substrings."""
    return np.packbits(vectors @ rotations > 0, axis=1)


class Shard:
    """Tables from the value of each substring to the rows that have it."""

    def __init__(self, codes: np.ndarray):
        self.codes, self.parts = codes, codes.shape[1]
        pad = -self.parts % 8
        self.words = np.ascontiguousarray(np.pad(codes, ((0, 0), (0, pad)))).view(np.uint64)
        self.columns = np.ascontiguousarray(self.words.T)
        self.rows = np.stack([np.argsort(codes[:, k], kind="stable") for k in range(self.parts)])
        self.ends = np.stack([np.concatenate(([0], np.cumsum(np.bincount(codes[:, k], minlength=256)))) for k in range(self.parts)])

    def within(self, code: np.ndarray, enough: int) -> tuple[np.ndarray, int]:
        """All rows within the least radius that holds `enough` rows (or every row), and that radius.

        Tables are probed as long as that touches fewer rows than there are; from then on the codes are compared one by one,
        which gives the same rows.
        """
        word = np.ascontiguousarray(np.pad(code, (0, -self.parts % 8))).view(np.uint64)
        seen = np.zeros(len(self.codes), bool)
        for near in range(PART_BITS + 1):
            values = _AT_DISTANCE[near][None, :] ^ code[:, None]
            starts, ends = self.ends[_PARTS[: self.parts], values], self.ends[_PARTS[: self.parts], values.astype(int) + 1]
            touched = int((ends - starts).sum())
            if touched > len(self.codes) or touched < enough <= len(self.codes) and near:
                break
            for k, (a, b) in enumerate(zip(starts.tolist(), ends.tolist(), strict=True)):
                for start, end in zip(a, b, strict=True):
                    if end > start:
                        seen[self.rows[k, start:end]] = True
            # Without a substring at `near` or less, each one differs in near + 1 bits at least.
            radius = self.parts * (near + 1) - 1
            found = np.nonzero(seen)[0]
            apart = np.bitwise_count(self.words[found] ^ word).sum(axis=1)
            if (apart <= radius).sum() >= enough:
                least = np.partition(apart, enough - 1)[enough - 1]
                return found[apart <= least], int(least)
        apart = np.zeros(len(self.codes), np.uint16)
        for column, part in zip(self.columns, word, strict=True):
            apart += np.bitwise_count(column ^ part)
        # The radius is read off the counts of rows at each distance.
        least = int(np.searchsorted(np.cumsum(np.bincount(apart)), enough))
        return np.nonzero(apart <= least)[0], least

    def inside(self, code: np.ndarray, radius: int) -> np.ndarray:
        """All rows within a radius, from a scan of the codes: wide radii probe most values."""
        word = np.ascontiguousarray(np.pad(code, (0, -self.parts % 8))).view(np.uint64)
        return np.nonzero(np.bitwise_count(self.words ^ word).sum(axis=1) <= radius)[0]


_AT_DISTANCE = [np.array([v for v in range(256) if v.bit_count() == d], np.uint8) for d in range(PART_BITS + 1)]
_PARTS = np.arange(CODE_BITS // PART_BITS)[:, None]


def lifted(vectors: np.ndarray) -> np.ndarray:
    """The vectors, scaled alike, with one more coordinate that gives them the length of the longest. Queries have 0 there."""
    scaled = vectors / np.maximum(np.abs(vectors).max(initial=0.0), 1e-300)
    squares = (scaled**2).sum(axis=1)
    return np.column_stack([scaled, np.sqrt(squares.max(initial=0.0) - squares)])


def bounds_of(queries: np.ndarray, rotations: np.ndarray) -> np.ndarray:
    """For each query and r, a bound on its cosines with vectors of which more than r bits differ.

    A bit that differs adds nothing to the inner product of its block, so a block allows the root of what the others hold of
    the query's square; that is averaged over the blocks, at best with the r + 1 least squares missing.
    """
    unit = queries / np.maximum(np.linalg.norm(queries, axis=1, keepdims=True), 1e-300)
    blocks = -(-rotations.shape[1] // rotations.shape[0])
    missing = np.cumsum(np.sort((unit @ rotations) ** 2, axis=1), axis=1) / blocks
    return np.sqrt(np.maximum(1 - missing, 0.0)) + 1e-9


def search_block(index: np.ndarray, queries: np.ndarray, rotations: np.ndarray, nearest: int, exact: bool = False) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query the rows of `index` nearest to it and their inner products, best first; all ties with the last.

    Rotations of one dimension more than the vectors' are those of lifted vectors.
    """
    lift = len(rotations) > index.shape[1]
    asked = np.pad(queries, ((0, 0), (0, 1))) if lift else queries
    shard = Shard(codes_of(lifted(index) if lift else index, rotations))
    codes, enough = codes_of(asked, rotations), min(len(index), nearest * OVERSAMPLE)
    if not exact:
        return [_best(index, query, shard.within(code, enough)[0], nearest) for query, code in zip(queries, codes, strict=True)]
    bounds, reach = bounds_of(asked, rotations), np.linalg.norm(index, axis=1).max(initial=0.0) * np.linalg.norm(queries, axis=1)
    out, open_ = [], []
    for k, (query, code) in enumerate(zip(queries, codes, strict=True)):
        found, radius = shard.within(code, enough)
        out.append(_best(index, query, found, nearest))
        if len(found) == len(index):
            continue
        least = out[k][1][nearest - 1]
        closed = np.nonzero(reach[k] * bounds[k] < least)[0]
        if not len(closed):
            open_.append(k)
        elif closed[0] > radius:
            out[k] = _best(index, query, shard.inside(code, closed[0]), nearest)
    for at in range(0, len(open_), SLAB):
        # Products of matrices are rounded otherwise than those that count: they only tell which rows to look at.
        for k, products in zip(open_[at : at + SLAB], queries[open_[at : at + SLAB]] @ index.T, strict=True):
            rows = np.nonzero(~(products < out[k][1][nearest - 1] - 1e-9 * reach[k]))[0]
            out[k] = _best(index, queries[k], rows, nearest)
    return out


def _best(index: np.ndarray, query: np.ndarray, found: np.ndarray, nearest: int) -> tuple[np.ndarray, np.ndarray]:
    score = (index[found] * query).sum(axis=1)  # of each row alone: no product of matrices, which rounds otherwise
    keep = score >= np.partition(score, -nearest)[-nearest] if len(score) > nearest else slice(None)
    found, score = found[keep], score[keep]
    by_score = np.argsort(-score, kind="stable")
    return found[by_score], score[by_score]


def usable(vectors: DataFrame, dimension: int | None = None) -> DataFrame:
    """vec_id, embedding of the rows that take part: distinct, with an id, finite components, not all zero."""
    fine = F.col("embedding").isNotNull() & (F.size("embedding") > 0) & F.col("vec_id").isNotNull()
    fine &= ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    fine &= F.exists("embedding", lambda x: x != 0)
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding")).where(fine)
    return (rows if dimension is None else rows.where(F.size("embedding") == dimension)).distinct()


def search(vectors: DataFrame, is_query, work: Workspace, nearest: int = NEAREST, sample: int = SAMPLE, exact: bool = False) -> DataFrame:
    """vec_id, embedding -> query_id, rank, vec_id, score for the rows of which `is_query` holds, against all others.

    Vectors that are null, empty, zero or hold null or non-finite components take no part, nor do rows without
    an id. The commonest length (the smaller one of two) is the table's dimension; other lengths take no part. Repeated
    rows count once; rows that share an id but not the vector are candidates of their own, and a query never
    finds its own id. Ties go to the smaller id. Other columns are ignored. `exact`: no true neighbour is missed, at the price of a scan
    where no bound closes.
    """
    spark = work.spark
    lengths = usable(vectors).groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").first()
    result = "query_id long, rank int, vec_id long, score double"
    if lengths is None:
        return spark.createDataFrame([], result)
    rows = usable(vectors, lengths["d"])
    hashed = rows.withColumn("h", F.xxhash64("embedding"))
    # The least ids of each distinct vector: one more than a result holds, as the query's own is left out.
    order = Window.partitionBy("h", "embedding").orderBy("vec_id")
    firsts = hashed.withColumn("r", F.row_number().over(order)).where(F.col("r") <= nearest + 1)
    index = work.keep(firsts.groupBy("h", "embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")))
    asked = work.keep(hashed.where(is_query).select(F.col("vec_id").alias("query_id"), "h", "embedding"))
    # Equal queries are asked once, under a written number: hits carry that instead of the vector.
    asking = work.keep(asked.select("h", "embedding").distinct().withColumn("q", F.monotonically_increasing_id()))
    shards = max(1, -(-index.count() // SHARD))
    blocks = max(1, -(-asking.count() // QUERIES))
    drawn = index.orderBy(F.xxhash64("h"), "h").select("embedding").limit(sample).collect()
    rotations = learn_rotations(lifted(np.array([r["embedding"] for r in drawn], float).reshape(-1, lengths["d"])))

    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)).cast("array<bigint>"))
    left = index.select(bucket_of("h", shards).alias("shard"), each(blocks).alias("block"), "h", "embedding", "ids")
    right = asking.select(each(shards).alias("shard"), bucket_of("h", blocks).alias("block"), "q", "embedding")

    def run(entries: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(entries) or not len(queries):
            return pd.DataFrame({"q": [], "ids": [], "score": []})
        entries = entries.sort_values("h", ignore_index=True)
        matrix, asks = np.stack(entries["embedding"].to_numpy()), np.stack(queries["embedding"].to_numpy())
        got = search_block(matrix, asks, rotations, nearest + 1, exact)
        rows, score = (np.concatenate(part) for part in zip(*got, strict=True))
        asker = np.repeat(queries["q"].to_numpy(), [len(found) for found, _ in got])
        return pd.DataFrame({"q": asker, "ids": entries["ids"].to_numpy()[rows], "score": score})

    hits = left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInPandas(run, "q long, ids array<long>, score double")
    each_hit = hits.select("q", F.explode("ids").alias("vec_id"), "score")
    best = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    # Equal ids with unequal vectors are one candidate each, so a query may have to pass over several of its own.
    ranked = each_hit.withColumn("r", F.row_number().over(best)).where(F.col("r") <= nearest + 1).drop("r")
    own = asked.join(asking, ["h", "embedding"]).select("query_id", "q")
    pairs = own.join(ranked, "q").where("vec_id != query_id")
    last = Window.partitionBy("query_id", "q").orderBy(F.desc("score"), "vec_id")
    return (
        pairs.withColumn("rank", F.row_number().over(last))
        .where(F.col("rank") <= nearest)
        .select("query_id", "rank", "vec_id", "score")
    )


def brute_force(ids: np.ndarray, vectors: np.ndarray, queries: Iterator[int], nearest: int = NEAREST) -> dict[int, list[int]]:
    """For tests: the true nearest ids of each query id."""
    out = {}
    for q in queries:
        score = vectors @ vectors[ids == q][0]
        rows = [k for k in np.lexsort((ids, -score)) if ids[k] != q][:nearest]
        out[q] = ids[rows].tolist()
    return out
