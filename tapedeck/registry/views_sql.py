"""The mappings of `views`, in SQL."""

from __future__ import annotations

import re

_RELEASE = """case when {b} <= 6 then cast(1970 + {b} as varchar) when {b} <= 12 then (1970 + {b}) || '-05'
    when {b} <= 20 then (1970 + {b}) || '-05-01' else 'n/a' end"""
_BRAND = "cast(substr(p_brand, 7) as int)"
_ALBUM_TYPE = "case when {b} <= 10 then 'album' when {b} <= 20 then 'single' else 'compilation' end"


def _fraction(factor: int) -> str:
    return f"((p_partkey * {factor}) % 129) / 128.0::double"


# Features as the typed silver table has them.
_FEATURES = f"""
    cast(3 + p_partkey % 3 as bigint) as time_signature,
    cast(60.5 + p_partkey % 100 as double) as tempo,
    cast(p_partkey % 12 as bigint) as "key",
    cast(p_partkey % 2 as bigint) as "mode",
    {_fraction(71)} as danceability,
    {_fraction(37)} as energy,
    p_size / -4.0::double as loudness,
    {_fraction(11)} as speechiness,
    {_fraction(13)} as acousticness,
    {_fraction(17)} as instrumentalness,
    {_fraction(19)} as liveness,
    {_fraction(53)} as valence"""

FEATURE_COLUMNS = (
    'time_signature, tempo, "key", "mode", danceability, energy, loudness, speechiness, acousticness, '
    "instrumentalness, liveness, valence"
)

VIEWS = {
    "lines": """
        select *, l_shipdate + to_hours((l_linenumber % 3) * 6) as played_at_utc,
          case when p_size in (5, 17, 29, 41) then null else 'T' || l_partkey end as line_track_id,
          case when l_returnflag = 'A' and l_tax >= 0.08 then null
            when l_suppkey % 7 = 0 then 'Artist ' || l_suppkey || '-' || year(l_shipdate)
            else 'Artist ' || (l_suppkey - case when l_suppkey % 10 = 9 then 1 else 0 end) end as line_artist
        from lineitem join part on l_partkey = p_partkey""",
    "plays": """
        select played_at_utc, line_track_id as track_id, p_name as track_name, line_artist as artist_name,
          cast(l_quantity * 2000 as bigint) as duration_ms,
          case when l_returnflag = 'A' then case when l_linestatus = 'F' then 'playlist' else 'album' end end as context_type,
          case when l_returnflag = 'A' and l_linestatus = 'F' then 'ctx:' || l_suppkey end as context_uri,
          case l_returnflag when 'A' then 'api' when 'R' then 'extended_export' else 'export' end as source_type,
          case when l_returnflag = 'R' then case when l_linestatus = 'F' then 'ios' else 'android' end end as platform,
          case when l_returnflag = 'R' then case when l_discount > 0.05 then 'BE' else 'FR' end end as conn_country,
          case when l_returnflag = 'R' then case when l_linestatus = 'F' then 'trackdone' else 'clickrow' end end as reason_start,
          case when l_returnflag = 'R' then case when l_linenumber > 3 then 'fwdbtn' else 'trackdone' end end as reason_end,
          case when l_returnflag = 'R' then l_linenumber > 3 end as shuffle,
          case when l_returnflag = 'R' then l_linestatus = 'F' end as skipped,
          case when l_returnflag = 'R' then l_discount = 0 end as offline,
          case when l_returnflag = 'R' then l_tax = 0 end as incognito_mode,
          case when l_returnflag = 'R' then p_brand end as album_name
        from lines""",
    "tracks": """
        select 'T' || p_partkey as track_id, p_name as track_name,
          cast(case when p_size = 22 then 0 else p_size * 2000 end as bigint) as duration_ms,
          p_size % 2 = 0 as explicit,
          cast(case when p_size > 10 then p_size * 2 end as bigint) as popularity,
          cast(p_size as bigint) as track_number,
          case when p_size <> 13 then p_brand end as album_id,
          'spotify:track:T' || p_partkey as track_uri,
          case when p_type <> 'SMALL' then 'ISRC' || p_partkey end as isrc,
          cast(null as bigint) as disc_number
        from part""",
    "brands": f"select distinct p_brand, {_BRAND} as b from part",
    "albums": f"""
        select p_brand as album_id, p_brand as album_name, {_ALBUM_TYPE.format(b="b")} as album_type,
          {_RELEASE.format(b="b")} as release_date, cast(b as bigint) as total_tracks, 'img/' || p_brand as image_url,
          case when b <> 3 then 'Label ' || (b % 5) end as label, case when b <= 20 then 'UPC' || b end as upc,
          cast(b as bigint) as popularity
        from brands""",
    "artists": """
        select 'A' || s_suppkey as artist_id,
          'Artist ' || (s_suppkey - case when s_suppkey % 10 = 9 then 1 else 0 end) as artist_name,
          'spotify:artist:A' || s_suppkey as artist_uri,
          cast(s_suppkey * 100 as bigint) as followers_total, cast(s_suppkey % 100 as bigint) as popularity
        from supplier""",
    "artist_genres": """
        select distinct l_suppkey as artist_rowid, p_type as genre
        from lines where l_suppkey in (select s_suppkey from supplier where s_nationkey >= 4)""",
    "genre_lists": """
        select 'A' || artist_rowid as artist_id, list(genre order by genre) as genres
        from artist_genres group by artist_rowid""",
    "track_tags": """
        select 'T' || p_partkey as track_id, string_split(p_name, ' ') as tags, split_part(p_name, ' ', 1) as top_tag,
          cast(p_size * 10 as bigint) as listeners, cast(p_size * 100 as bigint) as playcount
        from part where p_size > 8""",
    "artist_tags": """
        select 'A' || l_suppkey as artist_id, list_sort(list(distinct split_part(p_name, ' ', 1))) as tags,
          min(split_part(p_name, ' ', 1)) as top_tag
        from lines where l_suppkey in (select s_suppkey from supplier where s_nationkey >= 4) group by l_suppkey""",
    "features": f"""
        select 'T' || p_partkey as track_id, {_FEATURES}
        from part where p_type <> 'PROMO' and p_size < 48""",
    "dump_tracks": f"""
        select p_partkey as rowid_, 'T' || p_partkey as id, p_name as name, cast(p_size * 2000 as bigint) as duration_ms,
          case when p_size <> 1 then p_size % 2 end as explicit,
          cast(case when p_size <= 45 then p_size * 2 end as bigint) as popularity,
          cast(p_size as bigint) as track_number, cast(p_partkey % 3 + 1 as bigint) as disc_number,
          case when p_type <> 'LARGE' then 'ISRC' || p_partkey end as isrc, {_BRAND} as album_rowid
        from part""",
    "dump_artists": "select cast(substr(artist_id, 2) as bigint) as rowid_, * from artists",
    "credits": "select distinct l_partkey as track_rowid, l_suppkey as artist_rowid from lineitem",
    "mapping": """
        select distinct line_artist as search_artist_name, p_name as search_track_name, 'T' || l_partkey as enriched_track_id
        from lines where l_returnflag = 'N' and l_linestatus = 'O'""",
    "small_names": "select distinct p_name from part where p_type = 'SMALL'",
    "attempts_plain": """
        select 'T' || p_partkey as plain, timestamp '2024-01-01 00:00:00' + to_hours(p_size) as attempted_at,
          case when p_size > 25 then 'payload ' || p_size end as payload
        from part where p_type = 'ECONOMY'
        union all
        select 'T' || p_partkey, timestamp '2024-02-01 00:00:00', 'retry ' || p_size
        from part where p_type = 'ECONOMY' and p_size <= 25
        union all
        select distinct artist_name || '||' || track_name, timestamp '2024-01-15 00:00:00', cast(null as varchar)
        from plays where source_type = 'export' and duration_ms >= 80000 and track_name in (select p_name from small_names)
        union all
        select 'A' || s_suppkey, timestamp '2024-01-20 00:00:00', 'tags' from supplier where s_nationkey > 15""",
    # bronze
    "nested_lines": """
        select l_returnflag, played_at_utc, line_track_id as track_id, p_name as track_name, line_artist as artist_name,
          cast(p_size * 2000 as bigint) as duration_ms,
          case when l_discount > 0 then case when l_linestatus = 'F' then 'playlist' else 'album' end end as context_type,
          case when l_discount > 0 then 'ctx:' || l_suppkey end as context_uri,
          l_suppkey, l_linenumber, p_size, p_brand, p_type
        from lines""",
    "api_rows": "select * exclude (l_returnflag) from nested_lines where l_returnflag = 'A'",
    "extended_lines": """
        select l_returnflag, case when p_size = 50 and l_tax = 0 then null else date_trunc('second', played_at_utc) end as played_at_utc,
          case when p_size not in (4) then line_track_id end as track_id,
          case when p_size <> 3 then p_name end as track_name, case when p_size <> 3 then line_artist end as artist_name,
          cast(l_quantity * 2000 as bigint) as duration_ms, p_brand as album_name,
          case when l_linestatus = 'F' then 'ios' else 'android' end as platform,
          case when l_discount > 0.05 then 'BE' else 'FR' end as conn_country,
          case when l_linestatus = 'F' then 'trackdone' else 'clickrow' end as reason_start,
          case when l_linenumber > 3 then 'fwdbtn' else 'trackdone' end as reason_end,
          l_linenumber > 3 as shuffle, l_linestatus = 'F' as skipped, l_discount = 0 as offline, l_tax = 0 as incognito_mode
        from lines""",
    "extended_rows": "select * exclude (l_returnflag) from extended_lines where l_returnflag = 'R'",
    "standard_lines": """
        select l_returnflag, date_trunc('minute', played_at_utc) as played_at_utc,
          case when p_size <> 3 then p_name end as track_name, line_artist as artist_name,
          case when l_quantity <> 1 then cast(l_quantity * 2000 as bigint) end as duration_ms
        from lines""",
    "standard_rows": "select * exclude (l_returnflag) from standard_lines where l_returnflag = 'N'",
    "marker_rows": """
        select line_artist as search_artist_name, p_name as search_track_name, 'T' || l_partkey as track_id,
          l_suppkey, p_size, p_brand, p_type, l_partkey
        from lines where l_returnflag = 'N' and l_linestatus = 'O'""",
    "artist_rows": """
        select 0 as src, 'A' || l_suppkey as artist_id, artist_name from api_rows where artist_name is not null
        union select 0, 'A' || (l_suppkey + 1), 'Guest ' || (l_suppkey + 1) from api_rows where artist_name is not null
        union select 1, 'A' || l_suppkey, search_artist_name from marker_rows""",
    "album_rows": f"""
        select distinct src, p_brand as album_id, p_brand as album_name, {_ALBUM_TYPE.format(b=_BRAND)} as album_type,
          {_RELEASE.format(b=_BRAND)} as release_date, cast(p_size as bigint) as total_tracks,
          case when p_size > 20 then 'img/' || p_brand || '/' || p_size end as image_url
        from (select 0 as src, p_brand, p_size from api_rows union select 1, p_brand, p_size from marker_rows)
        where p_size <> 13""",
    "track_rows": """
        select distinct src, track_id, track_name, cast(p_size * 2000 as bigint) as duration_ms, p_size % 2 = 0 as explicit,
          cast(case when p_size > 10 then p_size * 2 end as bigint) as popularity, cast(track_number as bigint) as track_number,
          case when p_size <> 13 then p_brand end as album_id, 'spotify:track:' || track_id as track_uri, isrc
        from (
          select 0 as src, track_id, track_name, p_size, l_linenumber as track_number, p_brand, cast(null as varchar) as isrc
          from api_rows where track_id is not null
          union
          select 1, track_id, search_track_name, p_size, 1, p_brand, case when p_type <> 'SMALL' then 'ISRC' || l_partkey end
          from marker_rows)""",
    "min_mapping": """
        select search_artist_name, search_track_name, min(enriched_track_id) as enriched_track_id
        from mapping group by all""",
    "export_events": """
        select played_at_utc, track_id, track_name, artist_name, duration_ms, source_type, platform, conn_country,
          reason_start, reason_end, shuffle, skipped, offline, incognito_mode, album_name
        from (
          select played_at_utc, coalesce(track_id, enriched_track_id) as track_id, track_name, artist_name, duration_ms,
            'extended_export' as source_type, platform, conn_country, reason_start, reason_end, shuffle, skipped, offline,
            incognito_mode, album_name
          from extended_rows left join min_mapping on artist_name = search_artist_name and track_name = search_track_name
          union all
          select played_at_utc, enriched_track_id, track_name, artist_name, duration_ms, 'export', null, null, null, null,
            null, null, null, null, null
          from standard_rows left join min_mapping on artist_name = search_artist_name and track_name = search_track_name)
        where track_name is not null""",
    "raw_events": """
        select played_at_utc, track_id, track_name, artist_name, duration_ms, context_type, context_uri, 'api' as source_type,
          cast(null as varchar) as platform, cast(null as varchar) as conn_country, cast(null as varchar) as reason_start,
          cast(null as varchar) as reason_end, cast(null as boolean) as shuffle, cast(null as boolean) as skipped,
          cast(null as boolean) as offline, cast(null as boolean) as incognito_mode, cast(null as varchar) as album_name
        from api_rows
        union all
        select played_at_utc, track_id, track_name, artist_name, duration_ms, null, null, source_type, platform, conn_country,
          reason_start, reason_end, shuffle, skipped, offline, incognito_mode, album_name
        from export_events""",
    # fact
    "heard": """
        select * exclude (rn) from (
          select *, row_number() over (partition by played_at_utc, track_name order by
            case source_type when 'api' then 1 when 'extended_export' then 2 else 3 end, track_id asc nulls last,
            artist_name asc nulls last, duration_ms asc nulls last, context_type asc nulls last, context_uri asc nulls last,
            platform asc nulls last, conn_country asc nulls last, reason_start asc nulls last, reason_end asc nulls last,
            shuffle asc nulls last, skipped asc nulls last, offline asc nulls last, incognito_mode asc nulls last,
            album_name asc nulls last) as rn
          from plays) where rn = 1""",
    "fact": f"""
        select e.* exclude (duration_ms, album_name), e.duration_ms as duration_ms_played,
          coalesce(e.album_name, b.album_name) as album_name,
          cast(year(played_at_utc) as int) as "year", cast(month(played_at_utc) as int) as "month",
          cast(year(played_at_utc) as int) as played_year, cast(month(played_at_utc) as int) as played_month,
          cast(day(played_at_utc) as int) as played_day, cast(hour(played_at_utc) as int) as played_hour,
          cast(isodow(played_at_utc) as int) as played_dow, isodow(played_at_utc) >= 6 as is_weekend,
          t.album_id, t.duration_ms as duration_ms_track, t.explicit, t.popularity as track_popularity, t.isrc,
          b.album_type, b.release_date, b.popularity as album_popularity, b.label as album_label,
          try_cast(substr(b.release_date, 1, 4) as int) as release_year,
          case when e.source_type in ('extended_export', 'export') and t.duration_ms > 0
            then floor(e.duration_ms::double / t.duration_ms::double * 10000 + 0.5) / 10000 end as completion_pct,
          case when e.source_type in ('extended_export', 'export') then e.duration_ms >= 30000 end as is_complete,
          a.artist_id, g.top_tag as top_genre, f.* exclude (track_id),
          case when energy is null or valence is null then null
            when energy > 0.5 and valence > 0.5 then 'Euphoric' when energy > 0.5 then 'Intense'
            when valence > 0.5 then 'Chill' else 'Melancholic' end as mood_quadrant
        from heard e
        left join tracks t on e.track_id = t.track_id
        left join albums b on t.album_id = b.album_id
        left join artists a on e.artist_name = a.artist_name
        left join artist_tags g on a.artist_id = g.artist_id
        left join features f on e.track_id = f.track_id""",
    "dated_fact": "select *, cast(played_at_utc as date) as date from fact",
    "wide_artists": """
        select a.*, l.genres, l.genres[1] as primary_genre, t.tags as lastfm_tags, t.top_tag as lastfm_top_tag
        from artists a left join genre_lists l using (artist_id) left join artist_tags t using (artist_id)""",
}


def _used(sql: str) -> set[str]:
    return {name for name in VIEWS if re.search(rf"\b{name}\b", sql)}


def with_views(sql: str) -> str:
    """Put the views that a query uses, directly or not, in front of it."""
    needed, todo = set(), _used(sql)
    while todo:
        name = todo.pop()
        if name not in needed:
            needed.add(name)
            todo |= _used(VIEWS[name]) - needed
    ctes = [f"{name} as ({body.strip()})" for name, body in VIEWS.items() if name in needed]
    body = sql.strip()
    return f"with {', '.join(ctes)}\n{body}" if ctes else body
