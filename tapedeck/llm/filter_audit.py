"""Filter interaction audit: what each filter removes in every order, from path counts over a lattice.

Documents are first counted by the set of filters they fail (their signature). An order of n filters is a path through the
subset lattice, from no filter applied to all of them, and a step is an edge: filter f applied to what the set S let
through. What an edge removes depends on S and f alone, so 2^(n-1) * n edges hold the steps of all n! orders. Forward
counting gives the orders that reach a state, backward counting those that leave it; their product is the number of orders
that take an edge, and weighs its removals in the sum over all orders (the Shapley value times n!).

Equal texts are found by SHA-256. Only digests and counts are shuffled, each aggregate combines in the map tasks first, and
the joins are on keys that no group of copies, source or repeated id can crowd.
"""

from __future__ import annotations

from collections.abc import Mapping
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapedeck.llm.common import Workspace

_SPACE = r"[\x20\x09-\x0D]+"


def rules(text: Column) -> dict[str, Column]:
    """Failure conditions on a text that is not null, by letter. E, copies, is found over the table."""
    words = F.array_remove(F.split(text, _SPACE), "")
    n = F.size(words)
    return {
        "A": n < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * n,
        "C": 100 * F.length(F.regexp_replace(text, "[^A-Z]+", "")) > 2 * F.length(text),
        "D": text.rlike(r"[#$%&*|]"),
    }


def path_counts(n: int) -> tuple[list[int], list[int]]:
    """For each subset (as bits) of n filters the number of ways to reach it from none, and to go on from it to all."""
    every = 1 << n
    reach, leave = [0] * every, [0] * every
    reach[0] = leave[every - 1] = 1
    for state in range(1, every):
        reach[state] = sum(reach[state ^ (1 << f)] for f in range(n) if state >> f & 1)
    for state in range(every - 2, -1, -1):
        leave[state] = sum(leave[state | (1 << f)] for f in range(n) if not state >> f & 1)
    return reach, leave


def _edges(n: int) -> list[tuple[int, int, int]]:
    """(state before, filter, orders that take this edge)."""
    reach, leave = path_counts(n)
    return [(s, f, reach[s] * leave[s | (1 << f)]) for s in range(1 << n) for f in range(n) if not s >> f & 1]


def signatures(docs: DataFrame, labels: DataFrame, work: Workspace, tests: Mapping[str, Column], copies: str | None, part: str = "source") -> DataFrame:
    """documents -> part, mask, n, good, toxic: counts by part and by the filters that fail (bit k: the k-th letter).

    `tests` gives conditions over column `text`, in which null is empty; `copies` names the letter that fails if a smaller
    doc_id has the same text, or None. A null doc_id has no smaller one and no labels. Repeated rows count as often
    as they come, and rows that share the smallest doc_id of a text are no copies. A document is good or toxic if any row of
    `labels` says so. A null part is the empty string. Other columns are ignored.
    """
    letters = list(tests) + ([copies] if copies else [])
    rows = docs.select("doc_id", F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    mask = sum((F.when(test, 1 << letters.index(name)).otherwise(0) for name, test in tests.items()), F.lit(0))
    kept = work.keep(rows.select("doc_id", "part", mask.alias("mask"), F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest")))
    unnamed = kept.where("doc_id is null").groupBy("part", "mask").agg(F.count("*").alias("n")).select("part", "mask", "n", F.lit(0).alias("good"), F.lit(0).alias("toxic"))
    named = kept.where("doc_id is not null")
    counted = named.groupBy("doc_id", "digest", "part", "mask").agg(F.count("*").alias("n"))
    if copies:
        # The first document of a text is looked up by text and id: a crowded text is spread by its ids.
        first = named.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
        bit = F.when(F.col("first"), 0).otherwise(1 << letters.index(copies))
        counted = counted.join(first, ["doc_id", "digest"], "left").withColumn("mask", F.col("mask") + bit)
    # A doc_id that many rows share is left with one row for each part and mask before it meets its labels.
    by_id = counted.groupBy("doc_id", "part", "mask").agg(F.sum("n").alias("n"))
    marks = labels.where("doc_id is not null").groupBy("doc_id").agg(*[F.max(F.when(F.col(c) == 1, 1).otherwise(0)).alias(c) for c in ("quality", "toxic")])
    marked = by_id.join(marks, "doc_id", "left")
    share = [F.sum(F.col("n") * F.coalesce(c, F.lit(0))).alias(name) for c, name in (("quality", "good"), ("toxic", "toxic"))]
    both = marked.groupBy("part", "mask").agg(F.sum("n").alias("n"), *share).union(unnamed)
    return both.groupBy("part", "mask").agg(*[F.sum(c).cast("long").alias(c) for c in ("n", "good", "toxic")])


def audit(counts: DataFrame, letters: str) -> DataFrame:
    """part, mask, n, good, toxic (as `signatures` makes) -> one row for each part, order of the letters and step.

    Columns: part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley. No rows give none.
    """
    n, edges = len(letters), _edges(len(letters))
    lattice = F.array(*[F.struct(F.lit(k).alias("edge"), F.lit(s).alias("before"), F.lit(1 << f).alias("bit"), F.lit(w).cast("long").alias("weight")) for k, (s, f, w) in enumerate(edges)])
    taken = counts.select("*", F.explode(lattice).alias("e")).select("*", "e.*")
    fails = F.col("mask").bitwiseAND(F.col("bit")) != 0
    passed = F.col("mask").bitwiseAND(F.col("before")) == 0

    def count(of: str, test: Column) -> Column:
        return F.sum(F.when(test, F.col(of)).otherwise(0))

    steps = taken.groupBy("part", "edge").agg(
        count("n", passed & ~fails).alias("kept"), count("n", passed & fails).alias("removed"), count("n", ~passed & fails).alias("redundant"),
        count("n", F.col("mask") == F.col("bit")).alias("unique_fails"), count("good", passed & fails).alias("good_lost"),
        count("toxic", passed & fails).alias("toxic_lost"), F.first("bit").alias("bit"), F.first("weight").alias("weight"),
    )
    # At most n * 2^(n-1) rows a part.
    shapley = steps.groupBy("part", "bit").agg(F.sum(F.col("weight") * F.col("removed")).alias("shapley"))
    place = {(s, f): k for k, (s, f, _) in enumerate(edges)}
    paths = []
    for order in permutations(range(n)):
        state = 0
        for step, f in enumerate(order, 1):
            paths.append((place[state, f], "".join(letters[g] for g in order), step))
            state |= 1 << f
    orders = counts.sparkSession.createDataFrame(paths, "edge int, filter_order string, step int")
    per_step = steps.join(shapley, ["part", "bit"]).join(F.broadcast(orders), "edge")
    numbers = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    return per_step.select("part", "filter_order", "step", *[F.col(c).cast("long") for c in numbers])


def filter_audit(docs: DataFrame, labels: DataFrame, work: Workspace) -> DataFrame:
    """The five filters A to E over documents with doc_id, text and source; see `signatures` and `audit` for odd rows."""
    counts = work.keep(signatures(docs, labels, work, rules(F.col("text")), "E"))
    return audit(counts, "ABCDE")


#: DuckDB, by another path: every order is walked over the counts by signature, document by document first.
SQL = r"""
with recursive words as (
  select doc_id, coalesce(source, '') as part, coalesce(text, '') as t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
marks as (select doc_id, max((quality = 1)::int) as good, max((toxic = 1)::int) as toxic from labels group by doc_id),
failed as (
  select part, doc_id,
    (case when len(w) < 200 then 'A' else '' end)
    || (case when 100 * len(list_distinct(w)) < 50 * len(w) then 'B' else '' end)
    || (case when 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) then 'C' else '' end)
    || (case when regexp_matches(t, '[#$%&*|]') then 'D' else '' end)
    || (case when doc_id > min(doc_id) over (partition by t) then 'E' else '' end) as fails
  from words),
counts as (
  select part, fails, count(*) as n, sum(coalesce(good, 0)) as good, sum(coalesce(toxic, 0)) as toxic
  from failed left join marks using (doc_id) group by part, fails),
orders as (
  select '' as o union all
  select o || f from orders, (select unnest(['A', 'B', 'C', 'D', 'E']) as f) where not contains(o, f)),
steps as (
  select o as filter_order, k as step, o[1:k - 1] as before, o[k] as f
  from (select o, unnest([1, 2, 3, 4, 5]) as k from orders where length(o) = 5)),
walked as (
  select part, filter_order, step, f,
    sum(case when translate(fails, before || f, '') = fails then n else 0 end) as kept,
    sum(case when contains(fails, f) and translate(fails, before, '') = fails then n else 0 end) as removed,
    sum(case when contains(fails, f) and translate(fails, before, '') <> fails then n else 0 end) as redundant,
    sum(case when fails = f then n else 0 end) as unique_fails,
    sum(case when contains(fails, f) and translate(fails, before, '') = fails then good else 0 end) as good_lost,
    sum(case when contains(fails, f) and translate(fails, before, '') = fails then toxic else 0 end) as toxic_lost
  from counts, steps group by part, filter_order, step, f)
select part, filter_order, step::int as step, kept::bigint as kept, removed::bigint as removed, redundant::bigint as redundant,
  unique_fails::bigint as unique_fails, good_lost::bigint as good_lost, toxic_lost::bigint as toxic_lost,
  (sum(removed) over (partition by part, f))::bigint as shapley
from walked
"""
