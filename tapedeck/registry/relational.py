"""Joins, aggregations, dedup, sorts, limits and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapedeck.functions import measures
from tapedeck.operators import dedup, joins, sets, validation
from tapedeck.operators.ordering import first_values
from tapedeck.plans import enrichment, gold, worklists
from tapedeck.plans.silver import track_rows
from tapedeck.registry.catalog import query
from tapedeck.registry.views import Views

# ---------------------------------------------------------------- joins


@query(
    "join_left_track",
    """select p.played_at_utc, p.track_id, t.album_id, t.duration_ms as duration_ms_track, t.explicit,
         t.popularity as track_popularity, t.isrc
       from plays p left join tracks t on p.track_id = t.track_id""",
)
def join_left_track(v: Views) -> DataFrame:
    tracks = v.tracks.select(
        "track_id", "album_id", F.col("duration_ms").alias("duration_ms_track"), "explicit",
        F.col("popularity").alias("track_popularity"), "isrc",
    )
    return joins.left_lookup(v.plays.select("played_at_utc", "track_id"), tracks, "track_id")


@query(
    "join_left_album",
    """select t.track_id, t.popularity, t.album_id, b.album_name, b.release_date, b.popularity as album_popularity,
         b.label as album_label
       from tracks t left join albums b on t.album_id = b.album_id""",
)
def join_left_album(v: Views) -> DataFrame:
    albums = v.albums.select(
        "album_id", "album_name", "release_date", F.col("popularity").alias("album_popularity"),
        F.col("label").alias("album_label"),
    )
    return joins.left_lookup(v.tracks.select("track_id", "popularity", "album_id"), albums, "album_id")


@query(
    "join_left_features",
    """select p.played_at_utc, p.track_id, f.energy, f.valence, f.danceability, f.tempo, f."key"
       from plays p left join features f on p.track_id = f.track_id""",
)
def join_left_features(v: Views) -> DataFrame:
    features = v.features.select("track_id", "energy", "valence", "danceability", "tempo", "key")
    return joins.left_lookup(v.plays.select("played_at_utc", "track_id"), features, "track_id")


@query(
    "join_left_artist_tags",
    """select a.artist_id, a.artist_name, g.top_tag as top_genre
       from artists a left join artist_tags g on a.artist_id = g.artist_id""",
)
def join_left_artist_tags(v: Views) -> DataFrame:
    return gold.artist_lookup(v.artists, v.artist_tags)


@query(
    "join_left_track_tags",
    """select t.track_id, t.track_name, g.top_tag, g.listeners, g.playcount
       from tracks t left join track_tags g on t.track_id = g.track_id""",
)
def join_left_track_tags(v: Views) -> DataFrame:
    return joins.left_lookup(v.tracks.select("track_id", "track_name"), v.track_tags.drop("tags"), "track_id")


@query(
    "join_semi_keys",
    """select id, name, popularity from dump_tracks where id in (select track_id from plays where track_id is not null)""",
)
def join_semi_keys(v: Views) -> DataFrame:
    wanted = v.plays.select(F.col("track_id").alias("id")).na.drop().distinct()
    return joins.semi_join(v.catalogue.tracks.select("id", "name", "popularity"), wanted, ["id"])


@query(
    "join_anti_attempted",
    """select distinct track_id, track_name from plays
       where track_id is not null and track_id not in (select plain from attempts_plain)""",
)
def join_anti_attempted(v: Views) -> DataFrame:
    """Plays of tracks never looked up; plays without an id are dropped, not kept."""
    known = worklists.attempted_ids(v.attempts, "track_id")
    return joins.anti_join(v.plays.select("track_id", "track_name"), known, ["track_id"]).distinct()


@query(
    "join_mapping_fill",
    """select played_at_utc, artist_name, track_name, coalesce(track_id, enriched_track_id) as track_id, source_type
       from plays left join mapping on artist_name = search_artist_name and track_name = search_track_name""",
)
def join_mapping_fill(v: Views) -> DataFrame:
    events = v.plays.select("played_at_utc", "artist_name", "track_name", "track_id", "source_type")
    return joins.fill_by_mapping(events, v.mapping)


@query(
    "join_name_fanout",
    """select p.played_at_utc, p.track_name, p.artist_name, a.artist_id
       from plays p left join artists a on p.artist_name = a.artist_name""",
)
def join_name_fanout(v: Views) -> DataFrame:
    """Two artists of one name: the play appears once for each."""
    events = v.plays.select("played_at_utc", "track_name", "artist_name")
    return joins.left_lookup(events, v.artists.select("artist_name", "artist_id"), "artist_name")


@query(
    "join_junction_collect",
    """select track_rowid, string_agg(artist_name, ';' order by artist_rowid) as artist_names, count(*) as artists
       from credits join dump_artists on artist_rowid = rowid_ group by track_rowid""",
)
def join_junction_collect(v: Views) -> DataFrame:
    wanted = v.catalogue.tracks.select(F.col("rowid").alias("track_rowid"))
    lists = enrichment.artists_by_track(wanted, v.catalogue)
    return lists.select(
        "track_rowid",
        F.array_join(F.col("artists.name"), ";").alias("artist_names"),
        F.size("artists").cast("bigint").alias("artists"),
    )


@query(
    "join_catalogue_chain",
    """select d.rowid_ as track_rowid, d.id, d.name, b.album_id, b.album_type, b.release_date,
         (select count(*) from credits c where c.track_rowid = d.rowid_) as artists
       from dump_tracks d left join albums b on b.album_id = 'Brand#' || d.album_rowid""",
)
def join_catalogue_chain(v: Views) -> DataFrame:
    wanted = v.catalogue.tracks.select(F.col("rowid").alias("track_rowid"))
    rows = enrichment.catalogue_rows(wanted, v.catalogue)
    credited = F.when(F.col("artists").isNull(), 0).otherwise(F.size("artists")).cast("bigint")
    return rows.select(
        "track_rowid", "id", "name", "album_id", "album_type", "release_date", credited.alias("artists")
    )


@query(
    "match_name_artist_first",
    """select p.artist_name, p.track_name, h.track_rowid
       from (select distinct artist_name, track_name from plays where track_id is null and artist_name is not null) p
       left join (
         select a.artist_name, d.name, min(d.rowid_) as track_rowid
         from credits c join dump_tracks d on c.track_rowid = d.rowid_ join dump_artists a on c.artist_rowid = a.rowid_
         group by all) h on p.artist_name = h.artist_name and p.track_name = h.name""",
)
def match_name_artist_first(v: Views) -> DataFrame:
    return enrichment.first_matches(enrichment.missing_pairs(v.plays), v.catalogue).select(
        "artist_name", "track_name", "track_rowid"
    )


@query(
    "join_preserve_columns",
    """select r.track_id, coalesce(r.popularity, t.popularity) as popularity, coalesce(r.isrc, t.isrc) as isrc,
         case when t.track_id is not null then cast(2 as bigint) end as disc_number
       from (select track_id, popularity, isrc from (
           select *, row_number() over (partition by track_id order by track_name nulls last, duration_ms nulls last,
             explicit nulls last, popularity nulls last, track_number nulls last, album_id nulls last,
             track_uri nulls last, isrc nulls last) as rn
           from track_rows where src = 0) where rn = 1) r
       left join tracks t on r.track_id = t.track_id""",
)
def join_preserve_columns(v: Views) -> DataFrame:
    rebuilt = dedup.dedup_subset(track_rows(v.read_plays()), ["track_id"])
    kept = joins.preserve_columns(
        rebuilt, v.stored_dimensions.tracks, "track_id", ["disc_number"], fill=["isrc", "popularity"]
    )
    return kept.select("track_id", "popularity", "isrc", "disc_number")


@query(
    "join_suffix_collision",
    """select t.track_id, t.popularity, t.album_id, b.album_name, b.popularity as popularity_right
       from tracks t left join albums b on t.album_id = b.album_id""",
)
def join_suffix_collision(v: Views) -> DataFrame:
    tracks = v.tracks.select("track_id", "popularity", "album_id")
    return joins.join_with_suffix(tracks, v.albums.select("album_id", "album_name", "popularity"), ["album_id"])


# ---------------------------------------------------------------- aggregations


def _month(df: DataFrame) -> DataFrame:
    return df.withColumns({"year": F.year("played_at_utc"), "month": F.month("played_at_utc")})


_MONTH_SQL = "cast(year(played_at_utc) as int) as year, cast(month(played_at_utc) as int) as month"


@query(
    "agg_sum_zero",
    """select artist_name, coalesce(sum(case when source_type = 'api' then duration_ms end), 0)::bigint as api_ms
       from plays group by artist_name""",
)
def agg_sum_zero(v: Views) -> DataFrame:
    """Artists without a play in one source get 0, not null."""
    api_ms = F.when(F.col("source_type") == "api", F.col("duration_ms"))
    return v.plays.groupBy("artist_name").agg(measures.sum_or_zero(api_ms).alias("api_ms"))


@query(
    "agg_bool_sum",
    """select source_type, context_type, coalesce(sum(skipped::bigint), 0)::bigint as skip_count,
         coalesce(sum(shuffle::bigint), 0)::bigint as shuffled
       from plays group by all""",
)
def agg_bool_sum(v: Views) -> DataFrame:
    return v.plays.groupBy("source_type", "context_type").agg(
        measures.sum_or_zero(F.col("skipped")).alias("skip_count"),
        measures.sum_or_zero(F.col("shuffle")).alias("shuffled"),
    )


@query(
    "agg_nunique_null",
    """select cast(played_at_utc as date) as date,
         count(distinct track_id) + max(case when track_id is null then 1 else 0 end) as unique_tracks
       from plays group by 1""",
)
def agg_nunique_null(v: Views) -> DataFrame:
    """Null counts as one track."""
    unique = measures.nunique_with_null(F.col("track_id"))
    return v.plays.groupBy(F.to_date("played_at_utc").alias("date")).agg(unique.alias("unique_tracks"))


@query(
    "agg_mean",
    """select artist_name, avg(energy) as avg_energy, avg(valence) as avg_valence, avg(danceability) as avg_danceability
       from plays p left join features f on p.track_id = f.track_id group by artist_name""",
)
def agg_mean(v: Views) -> DataFrame:
    joined = joins.left_lookup(v.plays.select("track_id", "artist_name"), v.features, "track_id")
    return joined.groupBy("artist_name").agg(*[F.avg(f).alias(f"avg_{f}") for f in gold.MOOD_FEATURES])


@query(
    "agg_first_last_played",
    """select artist_name, min(played_at_utc) as first_played_at, max(played_at_utc) as last_played_at
       from plays group by artist_name""",
)
def agg_first_last_played(v: Views) -> DataFrame:
    return v.plays.groupBy("artist_name").agg(
        F.min("played_at_utc").alias("first_played_at"), F.max("played_at_utc").alias("last_played_at")
    )


@query(
    "agg_first_value",
    """select track_id, artist_name, album_name, platform from (
         select *, row_number() over (partition by track_id order by played_at_utc nulls last, artist_name nulls last,
           album_name nulls last, platform nulls last) as rn
         from plays where track_id is not null) where rn = 1""",
)
def agg_first_value(v: Views) -> DataFrame:
    named = v.plays.na.drop(subset=["track_id"])
    return first_values(named, "track_id", "played_at_utc", ["artist_name", "album_name", "platform"])


@query(
    "agg_skip_rate",
    """select artist_name, coalesce(sum(skipped::bigint), 0)::double / count(*) as skip_rate
       from plays group by artist_name""",
)
def agg_skip_rate(v: Views) -> DataFrame:
    return v.plays.groupBy("artist_name").agg(measures.flag_rate(F.col("skipped")).alias("skip_rate"))


@query(
    "agg_collect_list",
    "select artist_rowid, string_agg(genre, ',' order by genre) as genres from artist_genres group by artist_rowid",
)
def agg_collect_list(v: Views) -> DataFrame:
    wanted = v.catalogue.artists.select(F.col("rowid").alias("artist_rowid"))
    lists = enrichment.genres_by_artist(wanted, v.catalogue)
    return lists.select("artist_rowid", F.array_join("_genres", ",").alias("genres"))


@query(
    "agg_null_group",
    "select track_id, artist_name, count(*) as plays from plays group by all",
)
def agg_null_group(v: Views) -> DataFrame:
    """Rows without a key form a group of their own."""
    return v.plays.groupBy("track_id", "artist_name").agg(F.count(F.lit(1)).alias("plays"))


_NEW_ARTISTS = """
    select year, month, count(*) as new_artists from (
      select cast(year(min(played_at_utc)) as int) as year, cast(month(min(played_at_utc)) as int) as month
      from {rows} group by artist_name) group by all"""


@query(
    "agg_new_artists",
    f"""select m.year, m.month, n.new_artists
        from (select distinct {_MONTH_SQL} from plays) m
        left join ({_NEW_ARTISTS.format(rows="plays")}) n on m.year = n.year and m.month = n.month""",
)
def agg_new_artists(v: Views) -> DataFrame:
    """Months where no artist was heard for the first time get null, not 0."""
    first = v.plays.groupBy("artist_name").agg(F.min("played_at_utc").alias("played_at_utc"))
    new = _month(first).groupBy("year", "month").agg(F.count(F.lit(1)).alias("new_artists"))
    return _month(v.plays).select("year", "month").distinct().join(new, ["year", "month"], "left")


@query(
    "top1_artist_day",
    """select date, artist_name as top_artist from (
         select date, artist_name, row_number() over (partition by date order by n desc, artist_name nulls last) as rn
         from (select cast(played_at_utc as date) as date, artist_name, count(*) as n from plays group by all))
       where rn = 1""",
)
def top1_artist_day(v: Views) -> DataFrame:
    """A missing artist can be the most played one."""
    dated = v.plays.withColumn("date", F.to_date("played_at_utc"))
    return dedup.top1_by_count(dated, ["date"], "artist_name", "top_artist")


@query(
    "top1_genre_day",
    """select date, top_genre from (
         select date, top_genre, row_number() over (partition by date order by n desc, top_genre) as rn
         from (
           select cast(played_at_utc as date) as date, g.top_tag as top_genre, count(*) as n
           from plays p join artists a on p.artist_name = a.artist_name join artist_tags g on a.artist_id = g.artist_id
           group by all))
       where rn = 1""",
)
def top1_genre_day(v: Views) -> DataFrame:
    """A missing genre cannot."""
    named = joins.left_lookup(v.plays, gold.artist_lookup(v.artists, v.artist_tags), "artist_name")
    dated = named.filter(F.col("top_genre").isNotNull()).withColumn("date", F.to_date("played_at_utc"))
    return dedup.top1_by_count(dated, ["date"], "top_genre", "top_genre")


@query(
    "top1_artist_month",
    f"""select year, month, artist_name as top_artist from (
          select *, row_number() over (partition by year, month order by n desc, artist_name nulls last) as rn
          from (select {_MONTH_SQL}, artist_name, count(*) as n from plays group by all))
        where rn = 1""",
)
def top1_artist_month(v: Views) -> DataFrame:
    return dedup.top1_by_count(_month(v.plays), ["year", "month"], "artist_name", "top_artist")


# ---------------------------------------------------------------- dedup, sort, limit


@query(
    "dedup_subset",
    """select track_name, track_id, artist_name, source_type from (
         select *, row_number() over (partition by track_name order by track_id nulls last, artist_name nulls last,
           source_type nulls last) as rn
         from plays) where rn = 1""",
)
def dedup_subset(v: Views) -> DataFrame:
    """Few names, many plays each: one row per name, the smallest."""
    named = v.plays.select("track_name", "track_id", "artist_name", "source_type")
    return dedup.dedup_subset(named, ["track_name"])


@query("dedup_rows", "select distinct artist_name, track_name from plays")
def dedup_rows(v: Views) -> DataFrame:
    return v.plays.select("artist_name", "track_name").distinct()


@query("dedup_priority", "select * from heard")
def dedup_priority(v: Views) -> DataFrame:
    return dedup.dedup_by_priority(v.plays)


@query(
    "sort_total_plays",
    "select artist_name, count(*) as total_plays from plays group by artist_name order by total_plays desc, artist_name",
)
def sort_total_plays(v: Views) -> DataFrame:
    counted = v.plays.groupBy("artist_name").agg(F.count(F.lit(1)).alias("total_plays"))
    return gold.by_total_plays(counted)


@query(
    "limit_batch",
    "select distinct track_id from plays where track_id is not null order by track_id limit 50",
)
def limit_batch(v: Views) -> DataFrame:
    """The batch of a look-up run: its size is the feature."""
    return worklists.batch(v.plays.select("track_id").na.drop().distinct(), "track_id", 50)


# ---------------------------------------------------------------- set operations


@query(
    "union_diagonal",
    """select artist_id as id, artist_name as name, cast(null as bigint) as total_tracks, followers_total from artists
       union all
       select album_id, album_name, total_tracks, null from albums""",
)
def union_diagonal(v: Views) -> DataFrame:
    artists = v.artists.select(F.col("artist_id").alias("id"), F.col("artist_name").alias("name"), "followers_total")
    albums = v.albums.select(F.col("album_id").alias("id"), F.col("album_name").alias("name"), "total_tracks")
    return sets.union_diagonal(artists, albums)


@query(
    "set_missing_keys",
    """select distinct track_id from plays where track_id is not null
       except select track_id from track_tags except select plain from attempts_plain""",
)
def set_missing_keys(v: Views) -> DataFrame:
    return sets.missing_keys(
        v.plays.select("track_id"), v.track_tags.select("track_id"), worklists.attempted_ids(v.attempts, "track_id")
    )


# ---------------------------------------------------------------- table checks


@query(
    "table_profile",
    """select 'tracks' as table_name, (select count(*) from tracks) as rows, cast(10 as int) as columns,
         (select string_agg(line, '; ' order by line) from (
            select track_id || '|' || track_name as line from tracks order by track_id, track_name limit 3)) as sample
       union all
       select 'albums', (select count(*) from albums), 9,
         (select string_agg(line, '; ' order by line) from (
            select album_id || '|' || album_name as line from albums order by album_id, album_name limit 3))""",
)
def table_profile(v: Views) -> DataFrame:
    tracks = validation.profile(v.tracks, "tracks", ["track_id", "track_name"])
    return tracks.unionByName(validation.profile(v.albums, "albums", ["album_id", "album_name"]))


@query(
    "table_counts",
    """select 'plays' as table_name, count(*) as rows from plays
       union all select 'listening_events', count(*) from heard
       union all select 'tracks', count(*) from tracks
       union all select 'albums', count(*) from albums
       union all select 'artists', count(*) from artists
       union all select 'audio_features', count(*) from features""",
)
def table_counts(v: Views) -> DataFrame:
    return validation.row_counts(
        {
            "plays": v.plays,
            "listening_events": dedup.dedup_by_priority(v.plays),
            "tracks": v.tracks,
            "albums": v.albums,
            "artists": v.artists,
            "audio_features": v.features,
        }
    )
