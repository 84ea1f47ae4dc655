"""Declared schemas of the bronze records and the silver and gold tables.

Every reader uses one of these, so a field that is missing from some (or all) of the
files is a typed null and no builder has to look for columns before using them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

TEXT, LONG, INT, DOUBLE, FLAG, TIME = (
    StringType(), LongType(), IntegerType(), DoubleType(), BooleanType(), TimestampNTZType()
)
TEXTS = ArrayType(TEXT)


def struct(**fields: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields.items()])


def same(kind: DataType, names: str) -> dict[str, DataType]:
    return dict.fromkeys(names.split(), kind)


# ---------------------------------------------------------------- bronze records

LINKS = MapType(TEXT, TEXT)
ARTIST = struct(**same(TEXT, "id name type uri href"), external_urls=LINKS)
IMAGE = struct(url=TEXT, height=INT, width=INT)
ALBUM = struct(
    **same(TEXT, "id name album_type"),
    total_tracks=LONG,
    **same(TEXT, "release_date release_date_precision type uri href"),
    images=ArrayType(IMAGE),
    artists=ArrayType(ARTIST),
)
TRACK = struct(
    **same(TEXT, "id name"),
    duration_ms=LONG,
    explicit=FLAG,
    **same(LONG, "popularity track_number disc_number"),
    **same(TEXT, "type uri href"),
    is_local=FLAG,
    external_ids=struct(isrc=TEXT),
    album=ALBUM,
    artists=ArrayType(ARTIST),
)
CONTEXT = struct(**same(TEXT, "type uri href"), external_urls=LINKS)
PLAY = struct(played_at=TEXT, context=CONTEXT, track=TRACK)

# Field names of the two account-export formats.
EXPORT = struct(
    **same(TEXT, "endTime artistName trackName"),
    msPlayed=LONG,
    **same(TEXT, "ts platform"),
    ms_played=LONG,
    **same(
        TEXT,
        "conn_country ip_addr master_metadata_track_name master_metadata_album_artist_name "
        "master_metadata_album_album_name spotify_track_uri uri episode_name episode_show_name spotify_episode_uri "
        "audiobook_title audiobook_uri audiobook_chapter_uri audiobook_chapter_title reason_start reason_end",
    ),
    **same(FLAG, "shuffle skipped offline"),
    offline_timestamp=LONG,
    incognito_mode=FLAG,
)

TRACK_MARKER = struct(search_artist_name=TEXT, search_track_name=TEXT, track=TRACK, not_found=FLAG)
TRACK_TAGS_MARKER = struct(track_id=TEXT, tags=TEXTS, top_tag=TEXT, listeners=LONG, playcount=LONG, not_found=FLAG)
ARTIST_TAGS_MARKER = struct(artist_id=TEXT, tags=TEXTS, top_tag=TEXT, not_found=FLAG)

# The fields of these records that silver is made of. Records are judged by all fields, but no others are copied.
_TRACK_TAKEN = struct(
    **same(TEXT, "id name"),
    duration_ms=LONG,
    explicit=FLAG,
    **same(LONG, "popularity track_number"),
    uri=TEXT,
    external_ids=struct(isrc=TEXT),
    album=struct(**same(TEXT, "id name album_type"), total_tracks=LONG, release_date=TEXT, images=ArrayType(struct(url=TEXT))),
    artists=ArrayType(struct(**same(TEXT, "id name uri"))),
)
PLAY_TAKEN = struct(played_at=TEXT, context=struct(**same(TEXT, "type uri")), track=_TRACK_TAKEN)
EXPORT_TAKEN = StructType([f for f in EXPORT.fields if not f.name.startswith(("ip_", "episode_", "spotify_episode_", "audiobook_", "offline_"))])
TRACK_MARKER_TAKEN = struct(search_artist_name=TEXT, search_track_name=TEXT, track=_TRACK_TAKEN, not_found=FLAG)

# What events alone are made of.
PLAY_HEARD = struct(
    played_at=TEXT,
    context=struct(**same(TEXT, "type uri")),
    track=struct(**same(TEXT, "id name"), duration_ms=LONG, artists=ArrayType(struct(name=TEXT))),
)
TRACK_MARKER_MAPPED = struct(search_artist_name=TEXT, search_track_name=TEXT, track=struct(id=TEXT), not_found=FLAG)

ATTEMPTS = struct(key=TEXT, status=TEXT, payload=TEXT, attempted_at=TIME)
CURSOR = struct(last_run_timestamp=TIME, last_played_at_unix_ms=LONG)

# ---------------------------------------------------------------- catalogue dump

# The twelve audio features, three whole-number and nine fractional, in table order.
AUDIO_FEATURES: dict[str, DataType] = {
    "time_signature": LONG,
    "tempo": DOUBLE,
    "key": LONG,
    "mode": LONG,
    "danceability": DOUBLE,
    "energy": DOUBLE,
    "loudness": DOUBLE,
    "speechiness": DOUBLE,
    "acousticness": DOUBLE,
    "instrumentalness": DOUBLE,
    "liveness": DOUBLE,
    "valence": DOUBLE,
}
CATALOGUE = {
    "tracks": struct(
        rowid=LONG, id=TEXT, name=TEXT, duration_ms=LONG, explicit=INT,
        **same(LONG, "popularity track_number disc_number"), external_id_isrc=TEXT, album_rowid=LONG,
    ),
    "albums": struct(
        rowid=LONG, **same(TEXT, "id name album_type release_date"), total_tracks=LONG,
        **same(TEXT, "label external_id_upc"), popularity=LONG,
    ),
    "artists": struct(rowid=LONG, id=TEXT, name=TEXT, followers_total=LONG, popularity=LONG),
    "track_artists": struct(track_rowid=LONG, artist_rowid=LONG),
    "artist_genres": struct(artist_rowid=LONG, genre=TEXT),
    "track_audio_features": struct(track_id=TEXT, null_response=TEXT, **dict.fromkeys(AUDIO_FEATURES, TEXT)),
}

# ---------------------------------------------------------------- silver tables

ARTISTS = struct(
    **same(TEXT, "artist_id artist_name artist_uri"), genres=TEXTS, **same(LONG, "followers_total popularity")
)
ALBUMS = struct(
    **same(TEXT, "album_id album_name album_type release_date"), total_tracks=LONG,
    **same(TEXT, "image_url label upc"), popularity=LONG,
)
TRACKS = struct(
    track_id=TEXT, track_name=TEXT, duration_ms=LONG, explicit=FLAG, popularity=LONG, track_number=LONG,
    **same(TEXT, "album_id track_uri isrc"), disc_number=LONG,
)
TRACK_TAGS = struct(track_id=TEXT, tags=TEXTS, top_tag=TEXT, listeners=LONG, playcount=LONG)
ARTIST_TAGS = struct(artist_id=TEXT, tags=TEXTS, top_tag=TEXT)
FEATURES = struct(track_id=TEXT, **AUDIO_FEATURES)
EVENTS = struct(
    played_at_utc=TIME,
    **same(TEXT, "track_id track_name artist_name"),
    duration_ms=LONG,
    **same(TEXT, "context_type context_uri source_type platform conn_country reason_start reason_end"),
    **same(FLAG, "shuffle skipped offline incognito_mode"),
    album_name=TEXT,
)
EVENTS_PARTITIONED = StructType([*EVENTS.fields, *struct(year=INT, month=INT).fields])

# Columns that only the catalogue phases fill; a rebuild from bronze has to carry them over.
ARTIST_EXTRAS = ["genres", "followers_total", "popularity"]
ALBUM_EXTRAS = ["label", "upc", "popularity"]
TRACK_EXTRAS = ["disc_number"]

# Where each table lives under the lake root.
TABLE_PATHS = {
    "artists": "silver/artists",
    "albums": "silver/albums",
    "tracks": "silver/tracks",
    "track_tags": "silver/lastfm",
    "artist_tags": "silver/lastfm_artists",
    "audio_features": "silver/audio_features",
    "listening_events": "silver/listening_events",
    "dim_tracks": "gold/dim_tracks",
    "dim_artists": "gold/dim_artists",
    "fact_plays": "gold/fact_plays",
    "agg_daily": "gold/agg_daily",
    "agg_monthly": "gold/agg_monthly",
    "agg_artist_stats": "gold/agg_artist_stats",
    "agg_track_stats": "gold/agg_track_stats",
    "partials": "gold/partials",
}
BRONZE_PATHS = {
    "plays": "bronze/spotify_api/recently_played",
    "exports": "bronze/spotify_export",
    "track_markers": "bronze/spotify_enrichment",
    "track_tag_markers": "bronze/lastfm_enrichment",
    "artist_tag_markers": "bronze/lastfm_artist_enrichment",
}
STATE_PATH = "system/state/cursor"

SILVER_SCHEMAS = {
    "artists": ARTISTS,
    "albums": ALBUMS,
    "tracks": TRACKS,
    "track_tags": TRACK_TAGS,
    "artist_tags": ARTIST_TAGS,
    "audio_features": FEATURES,
    "listening_events": EVENTS_PARTITIONED,
}


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Project onto a declared schema: cast what is there, add typed nulls for what is not."""
    return df.select(
        [
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )
