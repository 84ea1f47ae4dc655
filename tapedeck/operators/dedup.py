"""Keeping one row per key.

`row_number() = 1` is planned with a partial group limit below the shuffle, so each map
task sends at most one row per key: a key with a third of all rows costs no more than any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapedeck.functions.measures import source_priority
from tapedeck.operators.ordering import total_order

_RANK = "_rank"
#: What tells plays apart.
PLAY_KEY = ["played_at_utc", "track_name"]


def first_row_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) == 1).drop(_RANK)


def dedup_subset(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key: the smallest by all the other columns, nulls last."""
    return first_row_per_key(df, keys, total_order(c for c in df.columns if c not in keys))


def dedup_by_priority(events: DataFrame) -> DataFrame:
    """One play per (time, track name): the best source, then the smallest row, track id first."""
    rest = [c for c in events.columns if c not in (*PLAY_KEY, "track_id", "source_type")]
    order = total_order(["_priority", "track_id", *rest])
    ranked = events.withColumn("_priority", source_priority(F.col("source_type")))
    return first_row_per_key(ranked, PLAY_KEY, order).drop("_priority")


def top1_by_count(df: DataFrame, period: list[str], value: str, out: str) -> DataFrame:
    """The most frequent value per period, counted first so that the window sees counts, not rows."""
    counted = df.groupBy(*period, value).agg(F.count(F.lit(1)).alias("_n"))
    order = [F.col("_n").desc(), F.col(value).asc_nulls_last()]
    return first_row_per_key(counted, period, order).select(*period, F.col(value).alias(out))
