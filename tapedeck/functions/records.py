"""Nested track records built from flat catalogue rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tapedeck.functions.text import ARTIST_URI_PREFIX, TRACK_URI_PREFIX


def artist_records(artists: Column) -> Column:
    """Array of {id, name} to full artist entries; entries without an id are left out."""
    named = F.filter(artists, lambda a: F.length(F.coalesce(a["id"], F.lit(""))) > 0)
    entries = F.transform(
        named,
        lambda a: F.struct(
            a["id"].alias("id"),
            a["name"].alias("name"),
            F.concat(F.lit(ARTIST_URI_PREFIX), a["id"]).alias("uri"),
        ),
    )
    return F.coalesce(entries, F.array().cast("array<struct<id: string, name: string, uri: string>>"))


def track_record(row: dict[str, Column]) -> Column:
    """The nested record that the dimension extract reads, from one catalogue row."""
    no_image = F.struct(
        F.lit(None).cast("string").alias("url"),
        F.lit(None).cast("int").alias("height"),
        F.lit(None).cast("int").alias("width"),
    )
    album = F.struct(
        row["album_id"].alias("id"),
        row["album_name"].alias("name"),
        row["album_type"].alias("album_type"),
        row["release_date"].alias("release_date"),
        row["total_tracks"].alias("total_tracks"),
        F.array(no_image).alias("images"),
    )
    return F.struct(
        row["id"].alias("id"),
        row["name"].alias("name"),
        row["duration_ms"].alias("duration_ms"),
        F.coalesce(row["explicit"].cast("boolean"), F.lit(False)).alias("explicit"),
        row["popularity"].alias("popularity"),
        row["track_number"].alias("track_number"),
        row["disc_number"].alias("disc_number"),
        F.concat(F.lit(TRACK_URI_PREFIX), row["id"]).alias("uri"),
        F.struct(row["isrc"].alias("isrc")).alias("external_ids"),
        artist_records(row["artists"]).alias("artists"),
        album.alias("album"),
    )
