"""The silver and gold tables, the catalogue phases and the work lists."""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapedeck import schemas
from tapedeck.operators.dedup import dedup_by_priority
from tapedeck.plans import enrichment, gold, jobs, responses, silver, worklists
from tapedeck.registry.catalog import query
from tapedeck.registry.views import Views
from tapedeck.registry.views_sql import FEATURE_COLUMNS
from tapedeck.sources import bronze
from tapedeck.sources.at_once import at_once
from tapedeck.sources.tables import materialize

# ---------------------------------------------------------------- silver


def _first_row(rows: str, key: str, columns: list[str], where: str = "src = 0", source_first: bool = False) -> str:
    order = ", ".join([*(["src"] if source_first else []), *[f"{c} asc nulls last" for c in columns]])
    return f"""select {key}, {", ".join(columns)} from (
        select *, row_number() over (partition by {key} order by {order}) as rn from {rows} where {where}) where rn = 1"""


_TRACK = ["track_name", "duration_ms", "explicit", "popularity", "track_number", "album_id", "track_uri", "isrc"]
_ALBUM = ["album_name", "album_type", "release_date", "total_tracks", "image_url"]


@query(
    "silver_artists",
    f"""select artist_id, artist_name, 'spotify:artist:' || artist_id as artist_uri
        from ({_first_row("artist_rows", "artist_id", ["artist_name"])})""",
)
def silver_artists(v: Views) -> DataFrame:
    return silver.extract_dimensions(v.read_plays()).artists


@query("silver_albums", _first_row("album_rows", "album_id", _ALBUM))
def silver_albums(v: Views) -> DataFrame:
    return silver.extract_dimensions(v.read_plays()).albums


@query("silver_tracks", _first_row("track_rows", "track_id", _TRACK))
def silver_tracks(v: Views) -> DataFrame:
    return silver.extract_dimensions(v.read_plays()).tracks


@query(
    "silver_tracks_merged",
    f"""select r.track_id, r.track_name, r.duration_ms, r.explicit, coalesce(r.popularity, t.popularity) as popularity,
          r.track_number, r.album_id, r.track_uri, coalesce(r.isrc, t.isrc) as isrc,
          case when t.track_id is not null then cast(2 as bigint) end as disc_number
        from ({_first_row("track_rows", "track_id", _TRACK, where="true", source_first=True)}) r
        left join tracks t on r.track_id = t.track_id""",
)
def silver_tracks_merged(v: Views) -> DataFrame:
    return silver.build_dimensions(*[silver.dimension_rows(r) for r in (v.read_plays(), v.read_markers())], v.stored_dimensions).tracks


@query("silver_mapping", "select search_artist_name, search_track_name, track_id as enriched_track_id from marker_rows")
def silver_mapping(v: Views) -> DataFrame:
    return silver.enrichment_mapping(v.read_markers())


@query(
    "silver_track_tags",
    "select track_id, array_to_string(tags, ',') as tags, top_tag, listeners, playcount from track_tags",
)
def silver_track_tags(v: Views) -> DataFrame:
    found = bronze.read_markers(v.spark, v.bronze("track_tag_markers"), schemas.TRACK_TAGS_MARKER)
    return silver.track_tags(found).withColumn("tags", F.array_join("tags", ","))


@query("silver_artist_tags", "select artist_id, array_to_string(tags, ',') as tags, top_tag from artist_tags")
def silver_artist_tags(v: Views) -> DataFrame:
    found = bronze.read_markers(v.spark, v.bronze("artist_tag_markers"), schemas.ARTIST_TAGS_MARKER)
    return silver.artist_tags(found).withColumn("tags", F.array_join("tags", ","))


@query("silver_events_api", "select * from raw_events where source_type = 'api'")
def silver_events_api(v: Views) -> DataFrame:
    return silver.api_events(v.read_plays())


@query("silver_events_export", "select * from raw_events where source_type <> 'api'")
def silver_events_export(v: Views) -> DataFrame:
    return silver.export_events(v.read_exports(), silver.enrichment_mapping(v.read_markers()))


_EVENT_REST = [
    "artist_name", "duration_ms", "context_type", "context_uri", "platform", "conn_country", "reason_start",
    "reason_end", "shuffle", "skipped", "offline", "incognito_mode", "album_name",
]


@query(
    "silver_events",
    f"""select * exclude (rn), cast(year(played_at_utc) as int) as year, cast(month(played_at_utc) as int) as month
        from (
          select *, row_number() over (partition by played_at_utc, track_name order by
            case source_type when 'api' then 1 when 'extended_export' then 2 else 3 end, track_id asc nulls last,
            {", ".join(f"{c} asc nulls last" for c in _EVENT_REST)}) as rn
          from raw_events)
        where rn = 1""",
)
def silver_events(v: Views) -> DataFrame:
    """Exports are written aside as events, as plays with and without an id are read apart: out of the JSON, each would parse all of it."""
    at_once(v.spark, *[partial(v.bronze, name) for name in ("plays", "exports", "track_markers")])
    music = materialize(silver.music_exports(v.read_exports(schemas.EXPORT_TAKEN)), v.scratch("exports"))
    exports = silver.fill_exports(music, silver.enrichment_mapping(v.read_markers(schemas.TRACK_MARKER_MAPPED)))
    return silver.listening_events(silver.api_events(v.read_plays(schemas.PLAY_HEARD)), exports)


# ---------------------------------------------------------------- gold


def build_fact(v: Views) -> DataFrame:
    lookups = {
        "track_id": gold.track_lookup(v.tracks, v.albums, v.features),
        "artist_name": gold.artist_lookup(v.artists, v.artist_tags),
    }
    return jobs.build_fact(dedup_by_priority(v.plays), lookups, v.scratch("fact"))


@query("fact_plays", "select * from fact")
def fact_plays(v: Views) -> DataFrame:
    return build_fact(v)


@query(
    "dim_tracks",
    f"""select t.track_id, t.track_name, t.duration_ms, t.explicit, t.popularity, t.track_number, t.album_id, t.track_uri,
          t.isrc, t.disc_number, b.album_name, b.album_type, b.release_date, b.total_tracks, b.image_url,
          b.label as album_label, b.upc as album_upc, b.popularity as album_popularity,
          try_cast(substr(b.release_date, 1, 4) as int) as release_year,
          array_to_string(g.tags, ',') as lastfm_tags, g.top_tag as lastfm_top_tag, g.listeners as lastfm_listeners,
          g.playcount as lastfm_playcount, {FEATURE_COLUMNS}
        from tracks t left join albums b on t.album_id = b.album_id
          left join track_tags g on t.track_id = g.track_id left join features f on t.track_id = f.track_id""",
)
def dim_tracks(v: Views) -> DataFrame:
    wide = gold.dim_tracks(v.tracks, v.albums, v.track_tags, v.features)
    return wide.withColumn("lastfm_tags", F.array_join("lastfm_tags", ","))


@query(
    "dim_artists",
    """select artist_id, artist_name, artist_uri, array_to_string(genres, ',') as genres, followers_total, popularity,
         primary_genre, array_to_string(lastfm_tags, ',') as lastfm_tags, lastfm_top_tag,
         case when genres is not null or lastfm_tags is not null then array_to_string(list_sort(list_distinct(
           list_concat(coalesce(genres, []), coalesce(lastfm_tags, [])))), ',') end as combined_genres
       from wide_artists""",
)
def dim_artists(v: Views) -> DataFrame:
    wide = gold.dim_artists(v.artists_with_genres, v.artist_tags)
    return wide.withColumns({c: F.array_join(c, ",") for c in ("genres", "lastfm_tags", "combined_genres")})


_PERIOD = """count(*) as total_plays, coalesce(sum(duration_ms_played), 0)::bigint as total_ms_listened,
    count(distinct track_id) + max(case when track_id is null then 1 else 0 end) as unique_tracks,
    count(distinct artist_name) + max(case when artist_name is null then 1 else 0 end) as unique_artists,
    coalesce(sum(is_complete::bigint), 0)::bigint as complete_plays, coalesce(sum(skipped::bigint), 0)::bigint as skip_count,
    avg(energy) as avg_energy, avg(valence) as avg_valence, avg(danceability) as avg_danceability"""


def _top(period: str, value: str, out: str, rows: str) -> str:
    return f"""(select {period}, {value} as {out} from (
        select *, row_number() over (partition by {period} order by n desc, {value} asc nulls last) as rn
        from (select {period}, {value}, count(*) as n from {rows} group by all)) where rn = 1)"""


@query(
    "agg_daily",
    f"""select d.*, a.top_artist, g.top_genre
        from (select date, {_PERIOD} from dated_fact group by date) d
        left join {_top("date", "artist_name", "top_artist", "dated_fact")} a on d.date = a.date
        left join {_top("date", "top_genre", "top_genre", "(select * from dated_fact where top_genre is not null)")} g
          on d.date = g.date""",
)
def agg_daily(v: Views) -> DataFrame:
    return gold.agg_daily(build_fact(v))


@query(
    "agg_monthly",
    f"""select m.*, n.new_artists, a.top_artist
        from (select year, month, {_PERIOD} from fact group by all) m
        left join (
          select year, month, count(*) as new_artists from (
            select cast(year(min(played_at_utc)) as int) as year, cast(month(min(played_at_utc)) as int) as month
            from fact group by artist_name) group by all) n on m.year = n.year and m.month = n.month
        left join {_top("year, month", "artist_name", "top_artist", "fact")} a on m.year = a.year and m.month = a.month""",
)
def agg_monthly(v: Views) -> DataFrame:
    return gold.agg_monthly(build_fact(v))


@query(
    "agg_artist_stats",
    """select s.*, w.artist_id, w.primary_genre, w.followers_total, w.popularity, w.lastfm_top_tag
       from (
         select artist_name, count(*) as total_plays, coalesce(sum(duration_ms_played), 0)::bigint as total_ms_listened,
           count(distinct track_id) + max(case when track_id is null then 1 else 0 end) as unique_tracks,
           min(played_at_utc) as first_played_at, max(played_at_utc) as last_played_at, avg(energy) as avg_energy,
           avg(valence) as avg_valence, avg(danceability) as avg_danceability,
           coalesce(sum(skipped::bigint), 0)::bigint as skip_count,
           coalesce(sum(skipped::bigint), 0)::double / count(*) as skip_rate
         from fact group by artist_name) s
       left join wide_artists w on s.artist_name = w.artist_name
       order by total_plays desc, s.artist_name, artist_id""",
)
def agg_artist_stats(v: Views) -> DataFrame:
    artists = gold.dim_artists(v.artists_with_genres, v.artist_tags)
    return gold.by_total_plays(gold.agg_artist_stats(build_fact(v), artists))


@query(
    "agg_track_stats",
    """select s.track_id, f.track_name, f.artist_name, total_plays, total_ms_listened, first_played_at, last_played_at,
         f.album_name, f.energy, f.valence, f.danceability, f.track_popularity as popularity, skip_count, skip_rate
       from (
         select track_id, count(*) as total_plays, coalesce(sum(duration_ms_played), 0)::bigint as total_ms_listened,
           min(played_at_utc) as first_played_at, max(played_at_utc) as last_played_at,
           coalesce(sum(skipped::bigint), 0)::bigint as skip_count,
           coalesce(sum(skipped::bigint), 0)::double / count(*) as skip_rate
         from fact where track_id is not null group by track_id) s
       join (
         select *, row_number() over (partition by track_id order by played_at_utc nulls last, track_name nulls last,
           artist_name nulls last, album_name nulls last, energy nulls last, valence nulls last, danceability nulls last,
           track_popularity nulls last) as rn
         from fact where track_id is not null) f on s.track_id = f.track_id and f.rn = 1
       order by total_plays desc, s.track_id""",
)
def agg_track_stats(v: Views) -> DataFrame:
    return gold.by_total_plays(gold.agg_track_stats(build_fact(v)))


# ---------------------------------------------------------------- catalogue phases

_MISSING = "select distinct artist_name, track_name from heard where track_id is null and artist_name is not null"


@query("dump_missing_pairs", _MISSING)
def dump_missing_pairs(v: Views) -> DataFrame:
    return enrichment.missing_pairs(dedup_by_priority(v.plays))


@query(
    "dump_resolve",
    f"""select to_base64(encode(p.artist_name || '||' || p.track_name)) as key, p.artist_name as search_artist_name,
          p.track_name as search_track_name, d.id as track_id, d.name as track_name, d.duration_ms, d.popularity,
          coalesce(d.explicit = 1, case when d.id is not null then false end) as explicit, d.isrc, d.disc_number,
          b.album_id, (select string_agg(a.artist_id, ';' order by a.rowid_) from credits c
            join dump_artists a on c.artist_rowid = a.rowid_ where c.track_rowid = h.track_rowid) as artist_ids
        from (select * from ({_MISSING}) m where artist_name || '||' || track_name not in (select plain from attempts_plain)) p
        left join (
          select a.artist_name, d.name, min(d.rowid_) as track_rowid
          from credits c join dump_tracks d on c.track_rowid = d.rowid_ join dump_artists a on c.artist_rowid = a.rowid_
          group by all) h on p.artist_name = h.artist_name and p.track_name = h.name
        left join dump_tracks d on h.track_rowid = d.rowid_
        left join albums b on b.album_id = 'Brand#' || d.album_rowid""",
)
def dump_resolve(v: Views) -> DataFrame:
    pairs = enrichment.pairs_to_resolve(dedup_by_priority(v.plays), v.attempts)
    resolved = enrichment.resolve_pairs(pairs, v.kept_catalogue, v.scratch("resolve"))
    return resolved.select(
        "key",
        "search_artist_name",
        "search_track_name",
        F.col("track.id").alias("track_id"),
        F.col("track.name").alias("track_name"),
        F.col("track.duration_ms").alias("duration_ms"),
        F.col("track.popularity").alias("popularity"),
        F.col("track.explicit").alias("explicit"),
        F.col("track.external_ids.isrc").alias("isrc"),
        F.col("track.disc_number").alias("disc_number"),
        F.col("track.album.id").alias("album_id"),
        F.array_join(F.col("track.artists.id"), ";").alias("artist_ids"),
    )


@query(
    "dump_tracks",
    """select t.track_id, t.track_name, t.duration_ms, t.explicit, coalesce(t.popularity, d.popularity) as popularity,
         t.track_number, t.album_id, t.track_uri, coalesce(t.isrc, d.isrc) as isrc, d.disc_number
       from tracks t left join dump_tracks d on t.track_id = d.id""",
)
def dump_tracks(v: Views) -> DataFrame:
    return enrichment.enrich_tracks(v.tracks, v.catalogue)


@query(
    "dump_artists",
    """select a.artist_id, a.artist_name, a.artist_uri, array_to_string(l.genres, ',') as genres, a.followers_total,
         a.popularity
       from artists a left join genre_lists l on a.artist_id = l.artist_id""",
)
def dump_artists(v: Views) -> DataFrame:
    bare = v.artists.withColumns({c: F.lit(None).cast("bigint") for c in ("followers_total", "popularity")})
    return enrichment.enrich_artists(bare, v.catalogue).withColumn("genres", F.array_join("genres", ","))


@query("dump_albums", "select * from albums")
def dump_albums(v: Views) -> DataFrame:
    bare = schemas.conform(v.albums.drop("label", "upc", "popularity"), schemas.ALBUMS)
    return enrichment.enrich_albums(bare, v.catalogue)


@query("dump_audio_features", f"select track_id, {FEATURE_COLUMNS} from features")
def dump_audio_features(v: Views) -> DataFrame:
    return enrichment.audio_features(v.tracks, v.catalogue)


# ---------------------------------------------------------------- work lists and tag responses


@query(
    "worklist_tracks",
    """select distinct track_id from heard where track_id is not null
         and track_id not in (select track_id from track_tags) and track_id not in (select plain from attempts_plain)
       order by track_id limit 50""",
)
def worklist_tracks(v: Views) -> DataFrame:
    """Known tracks are those with tags here, so that some are missing."""
    return worklists.worklist_tracks(dedup_by_priority(v.plays), v.track_tags, v.attempts)


@query(
    "worklist_track_tags",
    """select track_id, track_name, artist_name from (
         select *, row_number() over (partition by track_id order by track_name nulls last, artist_name nulls last) as rn
         from heard where track_id is not null and track_id not in (select plain from attempts_plain))
       where rn = 1 order by track_id limit 200""",
)
def worklist_track_tags(v: Views) -> DataFrame:
    return worklists.worklist_track_tags(dedup_by_priority(v.plays), v.attempts)


@query(
    "worklist_artist_tags",
    """select artist_id, artist_name from artists where artist_id not in (select plain from attempts_plain)
       order by artist_id limit 200""",
)
def worklist_artist_tags(v: Views) -> DataFrame:
    return worklists.worklist_artist_tags(v.artists, v.attempts)


@query(
    "parse_tag_responses",
    """select track_id, not_found, case when not not_found then tags end as tags,
         case when not not_found then nullif(split_part(tags, ',', 1), '') end as top_tag,
         cast(case when not not_found then listeners end as bigint) as listeners,
         cast(case when not not_found then 0 end as bigint) as playcount
       from (
         select 'T' || p_partkey as track_id, p_size <= 7 as not_found, p_size as listeners,
           lower(case p_type when 'ECONOMY' then p_brand when 'SMALL' then ''
             else split_part(p_name, ' ', 1) || ',' || split_part(p_name, ' ', 2) || ',' || p_type || ',' || p_brand || ',Extra'
             end) as tags
         from part)""",
)
def parse_tag_responses(v: Views) -> DataFrame:
    """Responses with many tags, one tag as an object, noise only, errors, bad counters and no JSON."""
    words = F.split("p_name", " ")

    def tag(*names: Column) -> list[Column]:
        return [F.struct(n.alias("name"), F.lit("page").alias("url")) for n in names]

    def response(tags: Column) -> Column:
        listeners = F.when(F.col("p_size") == 6, "many").otherwise(F.col("p_size").cast("string"))
        track = F.struct(
            F.struct(tags.alias("tag")).alias("toptags"), listeners.alias("listeners"), F.lit("").alias("playcount")
        )
        return F.to_json(F.struct(track.alias("track")))

    many = F.array(
        *tag(
            words[0], F.lit("Seen Live"), words[1], F.col("p_type"), F.lit("Love"), F.col("p_brand"), F.lit("Music"),
            F.lit("Extra"), F.lit("Last"),
        )
    )
    noise = F.array(*tag(F.lit("LOVE"), F.lit("All")))
    text = (
        F.when(F.col("p_size") <= 5, '{"error": 6, "message": "Track not found"}')
        .when(F.col("p_size") == 7, "no JSON")
        .when(F.col("p_type") == "ECONOMY", response(tag(F.col("p_brand"))[0]))
        .when(F.col("p_type") == "SMALL", response(noise))
        .otherwise(response(many))
    )
    raw = v.table("part").select(F.concat(F.lit("T"), "p_partkey").alias("track_id"), text.alias("response"))
    return responses.parse_track_tags(raw).withColumn("tags", F.array_join("tags", ","))
