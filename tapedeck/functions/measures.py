"""Derived measures of a play and null-aware aggregate expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sources that report real listening time, and the length of a counted play.
EXPORT_SOURCES = ["extended_export", "export"]
FULL_PLAY_MS = 30_000

# Which source wins when several report the same play (lowest first).
SOURCE_PRIORITY = {"api": 1, "extended_export": 2, "export": 3}


def source_priority(source: Column) -> Column:
    """Rank of a source; a source without a rank is an error."""
    ranks = F.create_map([F.lit(x) for pair in SOURCE_PRIORITY.items() for x in pair])
    unknown = F.raise_error(F.concat(F.lit("unknown source_type: "), F.coalesce(source, F.lit("null"))))
    return F.coalesce(F.try_element_at(ranks, source), unknown.cast("int"))


def round_half_up(c: Column, digits: int) -> Column:
    scale = float(10**digits)
    return F.floor(c * scale + 0.5) / scale


def completion_pct(source: Column, played_ms: Column, track_ms: Column) -> Column:
    """Share of the track that was heard; only exports know how long a play really was."""
    known = source.isin(EXPORT_SOURCES) & (track_ms > 0)
    return F.when(known, round_half_up(played_ms.cast("double") / track_ms.cast("double"), 4))


def is_complete(source: Column, played_ms: Column) -> Column:
    return F.when(source.isin(EXPORT_SOURCES), played_ms >= FULL_PLAY_MS)


# The labels of the four quadrants.
def mood_quadrant(energy: Column, valence: Column) -> Column:
    lively, bright = energy > 0.5, valence > 0.5
    return (
        F.when(energy.isNull() | valence.isNull(), F.lit(None).cast("string"))
        .when(lively & bright, "Euphoric")
        .when(lively, "Intense")
        .when(bright, "Chill")
        .otherwise("Melancholic")
    )


def sum_or_zero(c: Column) -> Column:
    """Sum that is 0, not null, for a group without values."""
    return F.coalesce(F.sum(c.cast("bigint")), F.lit(0).cast("bigint"))


def nunique_with_null(c: Column) -> Column:
    """Distinct values of a group, null being one of them."""
    return F.count_distinct(c) + F.max(F.when(c.isNull(), 1).otherwise(0))


def flag_rate(flag: Column) -> Column:
    """True flags per row; rows without a flag count as rows."""
    return sum_or_zero(flag) / F.count(F.lit(1))
