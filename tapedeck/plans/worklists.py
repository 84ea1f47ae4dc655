"""What to look up next: keys the fact refers to that no table and no earlier attempt covers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapedeck.functions.text import decode_key, is_pair_key
from tapedeck.operators.dedup import dedup_subset
from tapedeck.operators.joins import anti_join
from tapedeck.operators.sets import missing_keys


def attempted_ids(attempts: DataFrame, name: str) -> DataFrame:
    """Plain ids out of the encoded attempt keys; pair keys and undecodable ones are left out."""
    return attempts.select(decode_key(F.col("key")).alias(name)).filter(~is_pair_key(F.col(name)))


def batch(df: DataFrame, key: str, size: int) -> DataFrame:
    """The first `size` rows by key: a top-n per task, then of those."""
    return df.orderBy(key).limit(size)


def tracks_to_look_up(events: DataFrame, tracks: DataFrame, attempts: DataFrame) -> DataFrame:
    return missing_keys(events.select("track_id"), tracks.select("track_id"), attempted_ids(attempts, "track_id"))


def worklist_tracks(events: DataFrame, tracks: DataFrame, attempts: DataFrame, size: int = 50) -> DataFrame:
    """Track ids of the fact without a dimension row or an attempt."""
    return batch(tracks_to_look_up(events, tracks, attempts), "track_id", size)


def track_tags_to_look_up(events: DataFrame, attempts: DataFrame) -> DataFrame:
    named = events.select("track_id", "track_name", "artist_name").na.drop(subset=["track_id"])
    known = attempts.select(decode_key(F.col("key")).alias("track_id"))
    return dedup_subset(anti_join(named, known, ["track_id"]), ["track_id"])


def worklist_track_tags(events: DataFrame, attempts: DataFrame, size: int = 200) -> DataFrame:
    """Track ids with names to ask tags for."""
    return batch(track_tags_to_look_up(events, attempts), "track_id", size)


def artist_tags_to_look_up(artists: DataFrame, attempts: DataFrame) -> DataFrame:
    known = attempts.select(decode_key(F.col("key")).alias("artist_id"))
    return anti_join(artists, known, ["artist_id"]).select("artist_id", "artist_name")


def worklist_artist_tags(artists: DataFrame, attempts: DataFrame, size: int = 200) -> DataFrame:
    """Artists to ask tags for."""
    return batch(artist_tags_to_look_up(artists, attempts), "artist_id", size)
