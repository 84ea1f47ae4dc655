"""Bronze to silver: dimensions, tag tables and the deduplicated listening events."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tapedeck import schemas
from tapedeck.functions.arrays import first_or_null
from tapedeck.functions.text import track_id_from_uri
from tapedeck.functions.timestamps import parse_minute, parse_utc, try_parse_utc
from tapedeck.operators.dedup import dedup_by_priority, dedup_subset, first_row_per_key
from tapedeck.operators.joins import fill_by_mapping, preserve_columns, smallest_mapping
from tapedeck.operators.ordering import total_order
from tapedeck.operators.sets import union_diagonal


@dataclass(frozen=True)
class Dimensions:
    artists: DataFrame
    albums: DataFrame
    tracks: DataFrame


def artist_rows(records: DataFrame) -> DataFrame:
    """Every artist of every nested track; null and empty lists give nothing."""
    return (
        records.select(F.explode("track.artists").alias("artist"))
        .select(
            F.col("artist.id").alias("artist_id"),
            F.col("artist.name").alias("artist_name"),
            F.col("artist.uri").alias("artist_uri"),
        )
        .na.drop(subset=["artist_id"])
    )


def album_rows(records: DataFrame) -> DataFrame:
    album = F.col("track.album")
    return records.select(
        album["id"].alias("album_id"),
        album["name"].alias("album_name"),
        album["album_type"].alias("album_type"),
        album["release_date"].alias("release_date"),
        album["total_tracks"].cast("bigint").alias("total_tracks"),
        first_or_null(album["images"])["url"].alias("image_url"),
    ).na.drop(subset=["album_id"])


def track_rows(records: DataFrame) -> DataFrame:
    track = F.col("track")
    return records.select(
        track["id"].alias("track_id"),
        track["name"].alias("track_name"),
        track["duration_ms"].cast("bigint").alias("duration_ms"),
        track["explicit"].cast("boolean").alias("explicit"),
        track["popularity"].cast("bigint").alias("popularity"),
        track["track_number"].cast("bigint").alias("track_number"),
        track["album"]["id"].alias("album_id"),
        track["uri"].alias("track_uri"),
        track["external_ids"]["isrc"].alias("isrc"),
    ).na.drop(subset=["track_id"])


def extract_dimensions(records: DataFrame) -> Dimensions:
    """Flat dimensions of a frame with a nested `track` column, one row per id."""
    return Dimensions(
        artists=dedup_subset(artist_rows(records), ["artist_id"]),
        albums=dedup_subset(album_rows(records), ["album_id"]),
        tracks=dedup_subset(track_rows(records), ["track_id"]),
    )


def merge_dimension(from_plays: DataFrame, from_markers: DataFrame, key: str) -> DataFrame:
    """One row per id over both sources; a played record wins over a looked-up one."""
    ranked = union_diagonal(
        from_plays.withColumn("_source", F.lit(0)), from_markers.withColumn("_source", F.lit(1))
    )
    order = total_order(["_source", *[c for c in from_plays.columns if c != key]])
    return first_row_per_key(ranked, [key], order).drop("_source")


def dimension_rows(records: DataFrame) -> Dimensions:
    """What plays or markers say about artists, albums and tracks, any number of rows per id."""
    return Dimensions(artist_rows(records), album_rows(records), track_rows(records))


def build_dimensions(plays: Dimensions, markers: Dimensions, existing: Dimensions) -> Dimensions:
    """Rebuild the dimensions from bronze rows, keeping what only the catalogue phases had filled in."""
    artists = merge_dimension(plays.artists, markers.artists, "artist_id")
    albums = merge_dimension(plays.albums, markers.albums, "album_id")
    tracks = merge_dimension(plays.tracks, markers.tracks, "track_id")
    kept = Dimensions(
        artists=preserve_columns(artists, existing.artists, "artist_id", schemas.ARTIST_EXTRAS),
        albums=preserve_columns(albums, existing.albums, "album_id", schemas.ALBUM_EXTRAS),
        tracks=preserve_columns(
            tracks, existing.tracks, "track_id", schemas.TRACK_EXTRAS, fill=["isrc", "popularity"]
        ),
    )
    return Dimensions(
        artists=schemas.conform(kept.artists, schemas.ARTISTS),
        albums=schemas.conform(kept.albums, schemas.ALBUMS),
        tracks=schemas.conform(kept.tracks, schemas.TRACKS),
    )


def enrichment_mapping(markers: DataFrame) -> DataFrame:
    """(artist name, track name) to track id, as found by the look-ups."""
    return markers.select(
        "search_artist_name", "search_track_name", F.col("track.id").alias("enriched_track_id")
    )


def track_tags(markers: DataFrame) -> DataFrame:
    """One row per track, also when a look-up was recorded twice because its job was repeated."""
    return dedup_subset(schemas.conform(markers, schemas.TRACK_TAGS).na.drop(subset=["track_id"]), ["track_id"])


def artist_tags(markers: DataFrame) -> DataFrame:
    return dedup_subset(schemas.conform(markers, schemas.ARTIST_TAGS).na.drop(subset=["artist_id"]), ["artist_id"])


def _events(rows: DataFrame, kept: tuple[str, ...]) -> DataFrame:
    return schemas.conform(rows, StructType([*schemas.EVENTS.fields, *[rows.schema[c] for c in kept]]))


def api_events(plays: DataFrame, *kept: str) -> DataFrame:
    """Plays as events, before columns that are kept. `duration_ms` is the track's length here, the time heard in exports."""
    track = F.col("track")
    return _events(
        plays.select(
            parse_utc(F.col("played_at")).alias("played_at_utc"),
            track["id"].alias("track_id"),
            track["name"].alias("track_name"),
            first_or_null(track["artists"])["name"].alias("artist_name"),
            track["duration_ms"].alias("duration_ms"),
            F.col("context.type").alias("context_type"),
            F.col("context.uri").alias("context_uri"),
            F.lit("api").alias("source_type"),
            *kept,
        ),
        kept,
    )


def export_fields(exports: DataFrame, zone: str | None = None, *kept: str) -> DataFrame:
    """Both export generations under common names, each row by the fields it has, before columns that are kept.

    Standard rows carry local times; `zone` converts them, without it they are taken as they are.
    """
    marks = ["ts", "ms_played", "spotify_track_uri", "master_metadata_track_name"]
    extended = F.coalesce(*[F.col(c).cast("string") for c in marks]).isNotNull()
    return exports.select(
        F.when(extended, try_parse_utc(F.col("ts"))).otherwise(parse_minute(F.col("endTime"), zone)).alias("played_at_utc"),
        F.coalesce("master_metadata_track_name", "trackName").alias("track_name"),
        F.coalesce("master_metadata_album_artist_name", "artistName").alias("artist_name"),
        F.coalesce("ms_played", "msPlayed").alias("duration_ms"),
        track_id_from_uri(F.coalesce("spotify_track_uri", "uri")).alias("track_id"),
        F.when(extended, "extended_export").otherwise("export").alias("source_type"),
        F.col("master_metadata_album_album_name").alias("album_name"),
        *["platform", "conn_country", "reason_start", "reason_end"],
        *["shuffle", "skipped", "offline", "incognito_mode"],
        *kept,
    )


def exported_plays(exports: DataFrame, zone: str | None = None, *kept: str) -> DataFrame:
    """Exported plays as events, music or not, before columns that are kept."""
    return _events(export_fields(exports, zone, *kept), kept)


def music_exports(exports: DataFrame, zone: str | None = None) -> DataFrame:
    """Exported music plays, with the track ids that the export itself gives."""
    return exported_plays(exports, zone).na.drop(subset=["track_name"])


def fill_exports(music: DataFrame, mapping: DataFrame) -> DataFrame:
    """Missing track ids filled from the look-ups.

    Only plays without an id take part in the join; the others, most of an extended export, are not
    shuffled for it.
    """
    known, unknown = music.filter(F.col("track_id").isNotNull()), music.filter(F.col("track_id").isNull())
    return known.unionByName(fill_by_mapping(unknown, smallest_mapping(mapping)))


def export_events(exports: DataFrame, mapping: DataFrame, zone: str | None = None) -> DataFrame:
    """Exported music plays as events, missing track ids filled from the look-ups."""
    return fill_exports(music_exports(exports, zone), mapping)


def listening_events(api: DataFrame, exports: DataFrame) -> DataFrame:
    """The fact: all sources, one row per play, with its partition columns."""
    return dedup_by_priority(union_diagonal(api, exports)).withColumns(month_parts())


def month_parts() -> dict[str, Column]:
    return {"year": F.year("played_at_utc"), "month": F.month("played_at_utc")}
