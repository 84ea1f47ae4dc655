"""Projections, scalar rules and filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapedeck import schemas
from tapedeck.functions import arrays, measures, text, timestamps
from tapedeck.functions.records import track_record
from tapedeck.operators import validation
from tapedeck.plans import backfill, enrichment, silver
from tapedeck.registry.catalog import query
from tapedeck.registry.views import Views
from tapedeck.registry.views_sql import FEATURE_COLUMNS


@query(
    "proj_nested_fields",
    """select track_id, track_name, duration_ms, case when p_size <> 13 then p_brand end as album_id,
         cast(l_linenumber as bigint) as track_number, context_uri
       from nested_lines""",
)
def proj_nested_fields(v: Views) -> DataFrame:
    return v.nested(v.lines).select(
        F.col("track.id").alias("track_id"),
        F.col("track.name").alias("track_name"),
        F.col("track.duration_ms").alias("duration_ms"),
        F.col("track.album.id").alias("album_id"),
        F.col("track.track_number").alias("track_number"),
        F.col("context.uri").alias("context_uri"),
    )


@query(
    "proj_explode_artists",
    """select 'A' || l_suppkey as artist_id, artist_name, 'spotify:artist:A' || l_suppkey as artist_uri
       from nested_lines where artist_name is not null
       union all
       select 'A' || (l_suppkey + 1), 'Guest ' || (l_suppkey + 1), 'spotify:artist:A' || (l_suppkey + 1)
       from nested_lines where artist_name is not null""",
)
def proj_explode_artists(v: Views) -> DataFrame:
    return silver.artist_rows(v.nested(v.lines))


@query(
    "arr_first_safe",
    """select track_name, artist_name as first_artist,
         case when p_size > 20 then 'img/' || p_brand || '/' || p_size end as image_url
       from nested_lines""",
)
def arr_first_safe(v: Views) -> DataFrame:
    return v.nested(v.lines).select(
        F.col("track.name").alias("track_name"),
        arrays.first_or_null(F.col("track.artists"))["name"].alias("first_artist"),
        arrays.first_or_null(F.col("track.album.images"))["url"].alias("image_url"),
    )


@query(
    "proj_optional_field",
    """select track_id, cast(null as varchar) as isrc from api_rows
       union all
       select track_id, case when p_type <> 'SMALL' then 'ISRC' || l_partkey end from marker_rows""",
)
def proj_optional_field(v: Views) -> DataFrame:
    """The recording code: no play has the field, look-up records do."""
    both = [v.read_plays().select("track"), v.read_markers().select("track")]
    return both[0].unionByName(both[1]).select(
        F.col("track.id").alias("track_id"), F.col("track.external_ids.isrc").alias("isrc")
    )


@query("ts_parse_strict", "select played_at_utc, track_name from nested_lines")
def ts_parse_strict(v: Views) -> DataFrame:
    return v.nested(v.lines).select(
        timestamps.parse_utc(F.col("played_at")).alias("played_at_utc"), F.col("track.name").alias("track_name")
    )


@query("ts_parse_lenient", "select played_at_utc, track_name from extended_lines")
def ts_parse_lenient(v: Views) -> DataFrame:
    return v.extended(v.lines).select(
        timestamps.try_parse_utc(F.col("ts")).alias("played_at_utc"),
        F.col("master_metadata_track_name").alias("track_name"),
    )


@query("ts_parse_minute", "select played_at_utc, artist_name from standard_lines")
def ts_parse_minute(v: Views) -> DataFrame:
    return v.standard(v.lines).select(
        timestamps.parse_minute(F.col("endTime")).alias("played_at_utc"), F.col("artistName").alias("artist_name")
    )


@query(
    "proj_pad_schema",
    """select played_at_utc, cast(null as varchar) as track_id, track_name, artist_name, duration_ms,
         cast(null as varchar) as context_type, cast(null as varchar) as context_uri, 'export' as source_type,
         cast(null as varchar) as platform, cast(null as varchar) as conn_country, cast(null as varchar) as reason_start,
         cast(null as varchar) as reason_end, cast(null as boolean) as shuffle, cast(null as boolean) as skipped,
         cast(null as boolean) as offline, cast(null as boolean) as incognito_mode, cast(null as varchar) as album_name
       from standard_lines""",
)
def proj_pad_schema(v: Views) -> DataFrame:
    exports = schemas.conform(v.standard(v.lines), schemas.EXPORT)
    return schemas.conform(silver.export_fields(exports), schemas.EVENTS)


@query("str_uri_id", "select track_id, track_name, duration_ms from extended_lines")
def str_uri_id(v: Views) -> DataFrame:
    return v.extended(v.lines).select(
        text.track_id_from_uri(F.col("spotify_track_uri")).alias("track_id"),
        F.col("master_metadata_track_name").alias("track_name"),
        F.col("ms_played").alias("duration_ms"),
    )


@query(
    "proj_alias_coalesce",
    """select played_at_utc, track_name, artist_name, duration_ms, track_id, 'extended_export' as source_type, album_name
       from extended_rows
       union all
       select played_at_utc, track_name, artist_name, duration_ms, null, 'export', null from standard_rows""",
)
def proj_alias_coalesce(v: Views) -> DataFrame:
    both = v.extended_rows.unionByName(v.standard_rows, allowMissingColumns=True)
    return silver.export_fields(schemas.conform(both, schemas.EXPORT)).select(
        "played_at_utc", "track_name", "artist_name", "duration_ms", "track_id", "source_type", "album_name"
    )


@query("cast_feature_strings", f"select track_id, {FEATURE_COLUMNS} from features")
def cast_feature_strings(v: Views) -> DataFrame:
    return v.features


@query(
    "date_parts",
    """select played_at_utc, cast(year(played_at_utc) as int) as played_year,
         cast(month(played_at_utc) as int) as played_month, cast(day(played_at_utc) as int) as played_day,
         cast(hour(played_at_utc) as int) as played_hour
       from plays""",
)
def date_parts(v: Views) -> DataFrame:
    parts = timestamps.play_date_parts(F.col("played_at_utc"))
    names = ["played_year", "played_month", "played_day", "played_hour"]
    return v.plays.select("played_at_utc", *[parts[n].alias(n) for n in names])


@query(
    "date_weekday",
    """select played_at_utc, cast(isodow(played_at_utc) as int) as played_dow, isodow(played_at_utc) >= 6 as is_weekend
       from plays""",
)
def date_weekday(v: Views) -> DataFrame:
    at = F.col("played_at_utc")
    return v.plays.select(at, timestamps.weekday(at).alias("played_dow"), timestamps.is_weekend(at).alias("is_weekend"))


@query(
    "str_release_year",
    "select album_id, release_date, try_cast(substr(release_date, 1, 4) as int) as release_year from albums",
)
def str_release_year(v: Views) -> DataFrame:
    return v.albums.select("album_id", "release_date", text.release_year(F.col("release_date")).alias("release_year"))


_PLAYED_TRACKS = "from plays p left join tracks t on p.track_id = t.track_id"


def _played_tracks(v: Views) -> DataFrame:
    lengths = v.tracks.select("track_id", F.col("duration_ms").alias("duration_ms_track"))
    return v.plays.join(lengths, "track_id", "left")


@query(
    "num_completion_pct",
    f"""select p.track_id, source_type, p.duration_ms as duration_ms_played, t.duration_ms as duration_ms_track,
          case when source_type in ('extended_export', 'export') and t.duration_ms > 0
            then floor(p.duration_ms::double / t.duration_ms::double * 10000 + 0.5) / 10000 end as completion_pct
        {_PLAYED_TRACKS}""",
)
def num_completion_pct(v: Views) -> DataFrame:
    pct = measures.completion_pct(F.col("source_type"), F.col("duration_ms"), F.col("duration_ms_track"))
    return _played_tracks(v).select(
        "track_id", "source_type", F.col("duration_ms").alias("duration_ms_played"), "duration_ms_track",
        pct.alias("completion_pct"),
    )


@query(
    "flag_is_complete",
    """select source_type, duration_ms as duration_ms_played,
         case when source_type in ('extended_export', 'export') then duration_ms >= 30000 end as is_complete
       from plays""",
)
def flag_is_complete(v: Views) -> DataFrame:
    flag = measures.is_complete(F.col("source_type"), F.col("duration_ms"))
    return v.plays.select("source_type", F.col("duration_ms").alias("duration_ms_played"), flag.alias("is_complete"))


@query(
    "cat_mood_quadrant",
    """select t.track_id, energy, valence,
         case when energy is null or valence is null then null
           when energy > 0.5 and valence > 0.5 then 'Euphoric' when energy > 0.5 then 'Intense'
           when valence > 0.5 then 'Chill' else 'Melancholic' end as mood_quadrant
       from tracks t left join features f on t.track_id = f.track_id""",
)
def cat_mood_quadrant(v: Views) -> DataFrame:
    joined = v.tracks.select("track_id").join(v.features, "track_id", "left")
    mood = measures.mood_quadrant(F.col("energy"), F.col("valence"))
    return joined.select("track_id", "energy", "valence", mood.alias("mood_quadrant"))


@query(
    "fill_coalesce",
    """select t.track_id, coalesce(t.isrc, d.isrc) as isrc, coalesce(t.popularity, d.popularity) as popularity
       from tracks t left join dump_tracks d on t.track_id = d.id""",
)
def fill_coalesce(v: Views) -> DataFrame:
    return enrichment.enrich_tracks(v.tracks, v.catalogue).select("track_id", "isrc", "popularity")


@query(
    "arr_combine_genres",
    """select artist_id, array_to_string(list_sort(list_distinct(
           list_concat(coalesce(genres, []), coalesce(lastfm_tags, [])))), ',') as combined_genres
       from wide_artists where genres is not null or lastfm_tags is not null
       union all
       select artist_id, null from wide_artists where genres is null and lastfm_tags is null""",
)
def arr_combine_genres(v: Views) -> DataFrame:
    tags = v.artist_tags.select("artist_id", "tags")
    joined = v.artists_with_genres.join(tags, "artist_id", "left")
    combined = arrays.combine_genres(F.col("genres"), F.col("tags"))
    return joined.select("artist_id", F.array_join(combined, ",").alias("combined_genres"))


@query(
    "arr_clean_tags",
    """select p_partkey, coalesce(array_to_string(list_slice(list_filter(
           list_transform([p_name, 'Seen Live', p_brand, p_type, 'LOVE', split_part(p_name, ' ', 1), 'music',
             split_part(p_name, ' ', 2), 'Extra'], lambda x: lower(x)),
           lambda x: x not in ('seen live', 'love', 'music')), 1, 5), ','), '') as tags
       from part""",
)
def arr_clean_tags(v: Views) -> DataFrame:
    words = F.split("p_name", " ")
    raw = F.array(
        F.col("p_name"), F.lit("Seen Live"), F.col("p_brand"), F.col("p_type"), F.lit("LOVE"), words[0], F.lit("music"),
        words[1], F.lit("Extra"),
    )
    return v.table("part").select("p_partkey", F.array_join(arrays.clean_tags(raw), ",").alias("tags"))


@query(
    "num_default_zero",
    """select p_partkey, cast(case when p_size <= 10 then 0 when p_size <= 15 then null else p_size end as bigint) as counter
       from part""",
)
def num_default_zero(v: Views) -> DataFrame:
    raw = F.when(F.col("p_size") <= 5, F.lit(None)).when(F.col("p_size") <= 10, "").when(F.col("p_size") <= 15, "many")
    counter = raw.otherwise(F.col("p_size").cast("string"))
    return v.table("part").select("p_partkey", text.counter_or_zero(counter).alias("counter"))


@query(
    "key_base64_roundtrip",
    """select to_base64(encode(line_artist || '||' || p_name || '||' || repeat(p_name, 5))) as encoded,
         replace(replace(to_base64(encode(line_artist || '||' || p_name || '||' || repeat(p_name, 5))), '+', '-'), '/', '_')
           as file_name,
         line_artist as artist_name, p_name || '||' || repeat(p_name, 5) as track_name, true as is_pair
       from (select distinct line_artist, p_name from lines where line_artist is not null)""",
)
def key_base64_roundtrip(v: Views) -> DataFrame:
    """Long pair keys: no line breaks, and only the first separator splits."""
    names = v.lines.select("line_artist", "p_name").na.drop().distinct()
    long_name = F.concat("p_name", F.lit("||"), F.repeat("p_name", 5))
    encoded = names.select(text.encode_key(text.pair_key(F.col("line_artist"), long_name)).alias("encoded"))
    key = text.decode_key(F.col("encoded"))
    return encoded.select(
        "encoded",
        text.path_safe(F.col("encoded")).alias("file_name"),
        text.pair_artist(key).alias("artist_name"),
        text.pair_track(key).alias("track_name"),
        text.is_pair_key(key).alias("is_pair"),
    )


@query(
    "build_nested_record",
    """select d.id as track_id, 'spotify:track:' || d.id as uri, coalesce(d.explicit, 0) = 1 as explicit, d.isrc,
         string_agg(a.artist_id || '=' || a.artist_name || '=' || a.artist_uri, ';' order by a.rowid_) as artists,
         any_value(b.album_id) as album_id, any_value(b.total_tracks) as total_tracks, cast(1 as int) as images
       from dump_tracks d join credits c on d.rowid_ = c.track_rowid join dump_artists a on c.artist_rowid = a.rowid_
         left join albums b on b.album_id = 'Brand#' || d.album_rowid
       group by d.id, d.explicit, d.isrc""",
)
def build_nested_record(v: Views) -> DataFrame:
    credited = v.catalogue.track_artists.select("track_rowid").distinct()
    rows = enrichment.catalogue_rows(credited, v.catalogue)
    record = rows.select(track_record({c: F.col(c) for c in rows.columns}).alias("track"))
    artists = F.transform("track.artists", lambda a: F.concat_ws("=", a["id"], a["name"], a["uri"]))
    return record.select(
        F.col("track.id").alias("track_id"),
        F.col("track.uri").alias("uri"),
        F.col("track.explicit").alias("explicit"),
        F.col("track.external_ids.isrc").alias("isrc"),
        F.array_join(artists, ";").alias("artists"),
        F.col("track.album.id").alias("album_id"),
        F.col("track.album.total_tracks").alias("total_tracks"),
        F.size("track.album.images").alias("images"),
    )


@query(
    "json_roundtrip",
    """select played_at_utc, track_id, track_name, artist_name, duration_ms, context_uri from nested_lines""",
)
def json_roundtrip(v: Views) -> DataFrame:
    as_text = v.nested(v.spread_lines()).select(F.to_json(F.struct("played_at", "context", "track")).alias("json"))
    parsed = as_text.select(F.from_json("json", schemas.PLAY).alias("play")).select("play.*")
    return silver.api_events(parsed).select(
        "played_at_utc", "track_id", "track_name", "artist_name", "duration_ms", "context_uri"
    )


@query(
    "ts_epoch_millis",
    """select ts, epoch_us(ts) // 1000 as millis, date_trunc('millisecond', ts) as back from events""",
)
def ts_epoch_millis(v: Views) -> DataFrame:
    millis = timestamps.epoch_millis(F.col("ts"))
    return v.table("events").select(
        "ts", millis.alias("millis"), timestamps.from_epoch_millis(millis).alias("back")
    )


@query(
    "match_clean_name_top1",
    """select artist_name, track_name, best.id as matched_track_id, best.popularity as matched_popularity
       from (select distinct artist_name || '''' as artist_name, '"' || track_name as track_name
             from plays where artist_name is not null)
       left join (
         select a.artist_name as artist_key, d.name as track_key,
           first({'id': d.id, 'popularity': d.popularity} order by d.popularity desc nulls last, d.id) as best
         from credits c join dump_tracks d on c.track_rowid = d.rowid_ join dump_artists a on c.artist_rowid = a.rowid_
         group by all)
       on replace(artist_name, '''', '') = artist_key and replace(track_name, '"', '') = track_key""",
)
def match_clean_name_top1(v: Views) -> DataFrame:
    """Names with stray quotes find the most popular catalogue track of the same clean names."""
    quoted = v.plays.select(
        F.concat("artist_name", F.lit("'")).alias("artist_name"), F.concat(F.lit('"'), "track_name").alias("track_name")
    )
    return enrichment.best_match_by_clean_name(quoted.na.drop().distinct(), v.catalogue)


# ---------------------------------------------------------------- filters


@query("filt_null_key", "select track_id, track_name, source_type from plays where track_id is not null")
def filt_null_key(v: Views) -> DataFrame:
    return v.plays.na.drop(subset=["track_id"]).select("track_id", "track_name", "source_type")


@query(
    "filt_music_only",
    """select track_name, artist_name from extended_lines where track_name <> '' and artist_name <> ''""",
)
def filt_music_only(v: Views) -> DataFrame:
    named = silver.export_fields(schemas.conform(v.extended(v.lines), schemas.EXPORT))
    return backfill.music_only(named).select("track_name", "artist_name")


# ---------------------------------------------------------------- record rules


@query(
    "dq_export_records",
    """select 'Streaming_History' as kind, count(*) as valid_records, 
         count(distinct coalesce(cast(cast(played_at_utc as date) as varchar), 'none')) as rejected_records from extended_rows
       union all
       select 'StreamingHistory', count(duration_ms), count(*) - count(duration_ms) + count(distinct cast(played_at_utc as date)) from standard_rows""",
)
def dq_export_records(v: Views) -> DataFrame:
    records = backfill.read_export_records(v.spark, v.bronze("exports"))
    kind = F.regexp_extract("file_path", "(StreamingHistory|Streaming_History)", 1)
    return records.groupBy(kind.alias("kind")).agg(
        F.count_if(backfill.record_rule()).alias("valid_records"),
        F.count_if(~backfill.record_rule()).alias("rejected_records"),
    )


@query(
    "dq_track_records",
    """select p_brand as album_name, track_id is not null and p_size <> 13 as valid, count(*) as records
       from api_rows group by all""",
)
def dq_track_records(v: Views) -> DataFrame:
    plays = v.read_plays()
    valid = validation.play_is_valid(F.col("played_at"), F.col("context"), F.col("track"))
    return plays.groupBy(F.col("track.album.name").alias("album_name"), valid.alias("valid")).agg(
        F.count(F.lit(1)).alias("records")
    )


@query(
    "dq_tag_records",
    """select p_partkey, t.track_id is not null as valid, coalesce(listeners, 0) as listeners
       from part left join track_tags t on t.track_id = 'T' || p_partkey""",
)
def dq_tag_records(v: Views) -> DataFrame:
    """Tag records need a key and a list of tags; counters default to 0."""
    records = v.table("part").select("p_partkey", F.concat(F.lit("T"), "p_partkey").alias("track_id")).join(
        v.track_tags, "track_id", "left"
    )
    return records.select(
        "p_partkey",
        validation.tag_record_is_valid(F.col("track_id"), F.col("tags")).alias("valid"),
        F.coalesce("listeners", F.lit(0)).cast("bigint").alias("listeners"),
    )
