"""The five catalogue phases: resolve track ids, then fill tracks, artists, albums and features.

Wanted keys reach the catalogue as semi joins, never as lists, so that neither side has to fit the
driver; Catalyst broadcasts the keys when their table is small. Of a catalogue that is kept by key (sources.catalogue) each
table is joined on the key of the copy it is read from, so that only the wanted side is shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapedeck import schemas
from tapedeck.functions.records import track_record
from tapedeck.functions.text import encode_key, pair_key, search_key
from tapedeck.operators.dedup import first_row_per_key
from tapedeck.operators.joins import anti_join, semi_join
from tapedeck.operators.ordering import total_order
from tapedeck.schemas import AUDIO_FEATURES
from tapedeck.sources.catalogue import Catalogue
from tapedeck.sources.tables import materialize


# ---------------------------------------------------------------- phase 1


def missing_pairs(events: DataFrame) -> DataFrame:
    """Distinct (artist, track) names of plays that have no track id."""
    return (
        events.filter(F.col("track_id").isNull()).select("artist_name", "track_name").distinct().na.drop()
    )


def pairs_to_resolve(events: DataFrame, attempts: DataFrame) -> DataFrame:
    """Missing pairs whose storage key was not tried. Keys are compared as stored: a name may hold the separator itself."""
    keyed = missing_pairs(events).withColumn("key", encode_key(pair_key(F.col("artist_name"), F.col("track_name"))))
    tried = attempts.select(F.translate("key", "-_", "+/").alias("key")).na.drop().distinct()
    return anti_join(keyed, tried, ["key"]).drop("key")


def first_matches(pairs: DataFrame, catalogue: Catalogue) -> DataFrame:
    """Per pair, the first catalogue track of that name that lists an artist of that name.

    Only tracks with a wanted name and artists with a wanted name take part, and the hits of a pair
    are reduced to the smallest row id before each shuffle, however many tracks share a title.
    """
    wanted_tracks = pairs.select(F.col("track_name")).distinct()
    wanted_artists = pairs.select(F.col("artist_name")).distinct()
    tracks = semi_join(
        catalogue.by("tracks", "name").select(F.col("rowid").alias("track_rowid"), F.col("name").alias("track_name")),
        wanted_tracks,
        ["track_name"],
    )
    artists = semi_join(
        catalogue.by("artists", "name").select(F.col("rowid").alias("artist_rowid"), F.col("name").alias("artist_name")),
        wanted_artists,
        ["artist_name"],
    )
    hits = (
        catalogue.by("track_artists", "track_rowid")
        .join(tracks, "track_rowid")
        .join(artists, "artist_rowid")
        .groupBy("artist_name", "track_name")
        .agg(F.min("track_rowid").alias("track_rowid"))
    )
    return pairs.join(hits, ["artist_name", "track_name"], "left")


def artists_by_track(track_rowids: DataFrame, catalogue: Catalogue) -> DataFrame:
    """The artists of some tracks as a list per track, in row-id order."""
    credits = semi_join(catalogue.by("track_artists", "track_rowid"), track_rowids, ["track_rowid"])
    named = credits.join(
        catalogue.by("artists", "rowid").select(F.col("rowid").alias("artist_rowid"), "id", "name"), "artist_rowid", "left"
    )
    entries = F.sort_array(F.collect_list(F.struct("artist_rowid", "id", "name")))
    return named.groupBy("track_rowid").agg(entries.alias("artists"))


def catalogue_rows(track_rowids: DataFrame, catalogue: Catalogue) -> DataFrame:
    """Tracks with their album and their list of artists."""
    tracks = semi_join(catalogue.by("tracks", "rowid").withColumnRenamed("rowid", "track_rowid"), track_rowids, ["track_rowid"])
    albums = catalogue.by("albums", "rowid").select(
        F.col("rowid").alias("album_rowid"),
        F.col("id").alias("album_id"),
        F.col("name").alias("album_name"),
        "album_type",
        "release_date",
        "total_tracks",
    )
    return (
        tracks.withColumnRenamed("external_id_isrc", "isrc")
        .join(albums, "album_rowid", "left")
        .join(artists_by_track(track_rowids, catalogue), "track_rowid", "left")
    )


def resolve_pairs(pairs: DataFrame, catalogue: Catalogue, work: str) -> DataFrame:
    """One row per pair with its storage key and the nested track record, null where nothing matched.

    The pairs and their matches are each used several times and are written to `work` first.
    """
    matches = materialize(first_matches(materialize(pairs, f"{work}/pairs"), catalogue), f"{work}/matches")
    found, missed = matches.filter("track_rowid is not null"), matches.filter("track_rowid is null")
    rows = catalogue_rows(found.select("track_rowid").distinct(), catalogue)
    records = rows.select("track_rowid", track_record({c: F.col(c) for c in rows.columns}).alias("track"))
    # Pairs without a match would all meet on the null key.
    resolved = found.join(records, "track_rowid", "left").unionByName(missed, allowMissingColumns=True)
    return resolved.select(
        encode_key(pair_key(F.col("artist_name"), F.col("track_name"))).alias("key"),
        F.col("artist_name").alias("search_artist_name"),
        F.col("track_name").alias("search_track_name"),
        "track",
    )


def resolved_markers(resolved: DataFrame) -> DataFrame:
    """The found pairs in the shape of look-up markers, for the next silver build."""
    found = resolved.filter(F.col("track").isNotNull())
    return found.select("search_artist_name", "search_track_name", "track")


def marker_payload(resolved: DataFrame) -> DataFrame:
    """The marker text per key: the record as JSON, or null where nothing was found."""
    record = F.to_json(F.struct("search_artist_name", "search_track_name", "track"))
    return resolved.select("key", F.when(F.col("track").isNotNull(), record).alias("payload"))


# ---------------------------------------------------------------- phases 2 to 5


def _one_per_key(dump: DataFrame, key: str) -> DataFrame:
    """A dump may repeat an id; the first row by its other columns counts, so that no table grows."""
    return first_row_per_key(dump, [key], total_order([c for c in dump.columns if c != key]))


def _ids(df: DataFrame, column: str, name: str) -> DataFrame:
    return df.select(F.col(column).alias(name)).na.drop().distinct()


def enrich_tracks(tracks: DataFrame, catalogue: Catalogue) -> DataFrame:
    """Fill isrc, popularity and disc number; what the table has already stays."""
    dump = semi_join(
        catalogue.by("tracks", "id").select(
            F.col("id").alias("track_id"),
            F.col("external_id_isrc").alias("_isrc"),
            F.col("popularity").alias("_popularity"),
            F.col("disc_number").alias("_disc_number"),
        ),
        _ids(tracks, "track_id", "track_id"),
        ["track_id"],
    )
    filled = {
        "isrc": F.coalesce("isrc", "_isrc"),
        "popularity": F.coalesce("popularity", F.col("_popularity").cast("bigint")),
        "disc_number": F.coalesce(F.col("_disc_number").cast("bigint"), "disc_number"),
    }
    joined = tracks.join(_one_per_key(dump, "track_id"), "track_id", "left").withColumns(filled)
    return schemas.conform(joined, schemas.TRACKS)


def genres_by_artist(artist_rowids: DataFrame, catalogue: Catalogue) -> DataFrame:
    return (
        semi_join(catalogue.by("artist_genres", "artist_rowid"), artist_rowids, ["artist_rowid"])
        .groupBy("artist_rowid")
        .agg(F.sort_array(F.collect_list("genre")).alias("_genres"))
    )


def enrich_artists(artists: DataFrame, catalogue: Catalogue) -> DataFrame:
    """Add followers, popularity and genres; without a match the old values stay."""
    dump = semi_join(
        catalogue.by("artists", "id").select(
            F.col("rowid").alias("artist_rowid"),
            F.col("id").alias("artist_id"),
            F.col("followers_total").alias("_followers"),
            F.col("popularity").alias("_popularity"),
        ),
        _ids(artists, "artist_id", "artist_id"),
        ["artist_id"],
    )
    dump = _one_per_key(dump, "artist_id")
    with_genres = dump.join(genres_by_artist(_ids(dump, "artist_rowid", "artist_rowid"), catalogue), "artist_rowid", "left")
    filled = {
        "genres": F.coalesce("_genres", "genres"),
        "followers_total": F.coalesce(F.col("_followers").cast("bigint"), "followers_total"),
        "popularity": F.coalesce(F.col("_popularity").cast("bigint"), "popularity"),
    }
    joined = artists.join(with_genres, "artist_id", "left").withColumns(filled)
    return schemas.conform(joined, schemas.ARTISTS)


def enrich_albums(albums: DataFrame, catalogue: Catalogue) -> DataFrame:
    """Add label, product code and popularity; without a match the old values stay."""
    dump = semi_join(
        catalogue.by("albums", "id").select(
            F.col("id").alias("album_id"),
            F.col("label").alias("_label"),
            F.col("external_id_upc").alias("_upc"),
            F.col("popularity").alias("_popularity"),
        ),
        _ids(albums, "album_id", "album_id"),
        ["album_id"],
    )
    filled = {
        "label": F.coalesce("_label", "label"),
        "upc": F.coalesce("_upc", "upc"),
        "popularity": F.coalesce(F.col("_popularity").cast("bigint"), "popularity"),
    }
    joined = albums.join(_one_per_key(dump, "album_id"), "album_id", "left").withColumns(filled)
    return schemas.conform(joined, schemas.ALBUMS)


def audio_features(tracks: DataFrame, catalogue: Catalogue) -> DataFrame:
    """Typed features of the known tracks; rows flagged as empty responses are left out."""
    usable = catalogue.by("track_audio_features", "track_id").filter(F.col("null_response") == "0")
    known = semi_join(usable, _ids(tracks, "track_id", "track_id"), ["track_id"])
    known = _one_per_key(known, "track_id")
    return known.select("track_id", *[F.col(c).cast(t).alias(c) for c, t in AUDIO_FEATURES.items()])


# ---------------------------------------------------------------- search by clean names


def best_match_by_clean_name(pairs: DataFrame, catalogue: Catalogue) -> DataFrame:
    """Per pair, the most popular catalogue track whose quote-free track and artist names agree."""
    wanted = pairs.select(
        "artist_name",
        "track_name",
        search_key(F.col("artist_name")).alias("artist_key"),
        search_key(F.col("track_name")).alias("track_key"),
    )
    tracks = semi_join(
        catalogue.tracks.select(
            F.col("rowid").alias("track_rowid"), "id", "popularity", search_key(F.col("name")).alias("track_key")
        ),
        wanted.select("track_key").distinct(),
        ["track_key"],
    )
    artists = semi_join(
        catalogue.artists.select(F.col("rowid").alias("artist_rowid"), search_key(F.col("name")).alias("artist_key")),
        wanted.select("artist_key").distinct(),
        ["artist_key"],
    )
    best = F.min(F.struct((-F.coalesce("popularity", F.lit(-1))).alias("rank"), F.col("id"), F.col("popularity")))
    hits = (
        catalogue.track_artists.join(artists, "artist_rowid")
        .join(tracks, "track_rowid")
        .groupBy("artist_key", "track_key")
        .agg(best.alias("best"))
    )
    return wanted.join(hits, ["artist_key", "track_key"], "left").select(
        "artist_name",
        "track_name",
        F.col("best.id").alias("matched_track_id"),
        F.col("best.popularity").alias("matched_popularity"),
    )
