"""Left, semi and anti joins, with names and skew taken care of."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALTS = 256


def left_lookup(facts: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Left join on one key; null keys match nothing, repeated dimension keys multiply rows.

    Without a hint on purpose: Catalyst broadcasts a dimension whose table is small, the adaptive
    planner one whose shuffle turned out small, and skewed partitions of a large join are split.
    """
    return facts.join(dim, key, "left")


def hot_keys(facts: DataFrame, key: str, min_rows: int) -> DataFrame:
    """Keys with at least `min_rows` rows: never more than rows / min_rows of them."""
    return (
        facts.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") >= min_rows)
        .select(key)
    )


def salted_left_lookup(
    facts: DataFrame, dim: DataFrame, key: str, hot: DataFrame, spread: Iterable[str], salts: int = SALTS
) -> DataFrame:
    """left_lookup for a large dimension and a fact whose keys are badly skewed.

    Rows of a hot key are spread over `salts` partitions, and only the hot rows of the dimension
    are copied that often; rows without a key match nothing and are spread as well. The salt is a
    hash of the row, not a random number, so a task that is run again gives the same rows.
    `hot` comes from hot_keys, whose size is bounded by its row threshold.
    """
    flagged = F.broadcast(hot.select(F.col(key), F.lit(True).alias("_hot")))
    every, one = F.sequence(F.lit(0), F.lit(salts - 1)), F.array(F.lit(0))
    copies = (
        dim.join(flagged, key, "left")
        .withColumn("_salt", F.explode(F.when(F.col("_hot"), every).otherwise(one)))
        .drop("_hot")
    )
    salt = F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int")
    salted = (
        facts.join(flagged, key, "left")
        .withColumn("_salt", F.when(F.col("_hot") | F.col(key).isNull(), salt).otherwise(0))
        .drop("_hot")
    )
    return salted.join(copies, [key, "_salt"], "left").drop("_salt")


def semi_join(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key occurs in `keys`."""
    return df.join(keys, on, "left_semi")


def anti_join(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key does not occur in `keys`; a row with a null key is dropped, not kept."""
    return df.na.drop(subset=on).join(keys, on, "left_anti")


def join_with_suffix(left: DataFrame, right: DataFrame, on: list[str], suffix: str = "_right") -> DataFrame:
    """Left join that renames the right side's colliding columns."""
    names = {c: c + suffix for c in right.columns if c in left.columns and c not in on}
    return left.join(right.withColumnsRenamed(names), on, "left")


def fill_by_mapping(events: DataFrame, mapping: DataFrame) -> DataFrame:
    """Fill missing track ids by (artist name, track name).

    The mapping may hold several ids for a pair; the play is then repeated once per id.
    """
    m = mapping.select(
        F.col("search_artist_name").alias("_artist"),
        F.col("search_track_name").alias("_track"),
        F.col("enriched_track_id").alias("_id"),
    )
    matched = events.join(
        m, (events["artist_name"] == m["_artist"]) & (events["track_name"] == m["_track"]), "left"
    )
    return matched.withColumn("track_id", F.coalesce("track_id", "_id")).drop("_artist", "_track", "_id")


def smallest_mapping(mapping: DataFrame) -> DataFrame:
    """One id per (artist name, track name): the smallest.

    The priority dedup would keep the copy with the smallest id anyway, so filling from this gives
    the same events without ever producing the copies.
    """
    return (
        mapping.na.drop(subset=["search_artist_name", "search_track_name"])
        .groupBy("search_artist_name", "search_track_name")
        .agg(F.min("enriched_track_id").alias("enriched_track_id"))
    )


def preserve_columns(
    rebuilt: DataFrame, existing: DataFrame, key: str, extras: list[str], fill: Iterable[str] = ()
) -> DataFrame:
    """Carry columns of the stored table over to its rebuilt version.

    `extras` are taken from the stored table; `fill` columns keep the rebuilt value where there is one.
    """
    kept = [*extras, *[c for c in fill if c not in extras]]
    old = existing.select(key, *[F.col(c).alias(f"_old_{c}") for c in kept])
    joined = rebuilt.drop(*extras).join(old, key, "left")
    carried = {c: F.col(f"_old_{c}") for c in extras}
    filled = {c: F.coalesce(c, f"_old_{c}") for c in fill if c not in extras}
    return joined.withColumns({**carried, **filled}).drop(*[f"_old_{c}" for c in kept])
