"""Sources, sinks, state, whole jobs and streams: queries that write files and read them back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapedeck import schemas
from tapedeck.functions.timestamps import epoch_millis, from_epoch_millis, parse_utc
from tapedeck.plans import backfill, jobs
from tapedeck.registry.catalog import query
from tapedeck.registry.tables import _EVENT_REST, _first_row
from tapedeck.registry.views import Views
from tapedeck.sources import bronze, state, tables
from tapedeck.sources.catalogue import read_catalogue
from tapedeck.streaming import ingest, upsert

# ---------------------------------------------------------------- sources


@query(
    "src_json_plays",
    """select strftime(played_at_utc, '%Y-%m-%dT%H:%M:%S.%gZ') as played_at, track_id, track_name, duration_ms,
         context_type, case when artist_name is null then 0 else 2 end::int as artists
       from api_rows""",
)
def src_json_plays(v: Views) -> DataFrame:
    return v.read_plays().select(
        "played_at",
        F.col("track.id").alias("track_id"),
        F.col("track.name").alias("track_name"),
        F.col("track.duration_ms").alias("duration_ms"),
        F.col("context.type").alias("context_type"),
        F.size("track.artists").alias("artists"),
    )


@query(
    "src_json_markers",
    """select search_artist_name, search_track_name, track_id, case when p_type <> 'SMALL' then 'ISRC' || l_partkey end as isrc
       from marker_rows""",
)
def src_json_markers(v: Views) -> DataFrame:
    """A cut-off file and the markers of failed look-ups are left out."""
    return v.read_markers().select(
        "search_artist_name",
        "search_track_name",
        F.col("track.id").alias("track_id"),
        F.col("track.external_ids.isrc").alias("isrc"),
    )


@query(
    "src_json_exports",
    """select case when p_size = 50 and l_tax = 0 then 'not a time'
           else strftime(played_at_utc, '%Y-%m-%dT%H:%M:%SZ') end as ts,
         cast(null as varchar) as "endTime", cast(l_quantity * 2000 as bigint) as ms_played, cast(null as bigint) as "msPlayed",
         case when p_size <> 3 then p_name end as master_metadata_track_name, cast(null as varchar) as "trackName",
         l_linenumber > 3 as shuffle
       from lines where l_returnflag = 'R'
       union all
       select null, strftime(played_at_utc, '%Y-%m-%d %H:%M'), null,
         case when l_quantity <> 1 then cast(l_quantity * 2000 as bigint) end, null, case when p_size <> 3 then p_name end, null
       from lines where l_returnflag = 'N'""",
)
def src_json_exports(v: Views) -> DataFrame:
    return v.read_exports().select(
        "ts", "endTime", "ms_played", "msPlayed", "master_metadata_track_name", "trackName", "shuffle"
    )


@query("src_optional_table", "select p_partkey, p_name, cast(null as varchar) as p_comment from part")
def src_optional_table(v: Views) -> DataFrame:
    """A table that is there, with a column it lacks, and one that is not there at all."""
    schema = schemas.struct(p_partkey=schemas.LONG, p_name=schemas.TEXT, p_comment=schemas.TEXT)
    there = tables.read_optional(v.spark, f"{v.sf_dir}/part.parquet", schema)
    return there.unionByName(tables.read_optional(v.spark, f"{v.sf_dir}/no_such_table.parquet", schema))


def _dated(df: DataFrame) -> DataFrame:
    return df.withColumns({"year": F.year("played_at_utc"), "month": F.month("played_at_utc")})


_PARTS = "cast(year(played_at_utc) as int) as year, cast(month(played_at_utc) as int) as month"


@query("src_partitioned_fact", f"select played_at_utc, track_id, track_name, {_PARTS} from plays")
def src_partitioned_fact(v: Views) -> DataFrame:
    path = v.scratch("listening_events")
    tables.write_by_month(_dated(v.plays), path)
    return tables.read_by_month(v.spark, path, schemas.EVENTS_PARTITIONED).select(
        "played_at_utc", "track_id", "track_name", "year", "month"
    )


@query(
    "src_dump_scan",
    """select id, isrc as external_id_isrc, popularity from dump_tracks
       where id in (select track_id from plays where track_id is not null)""",
)
def src_dump_scan(v: Views) -> DataFrame:
    """Three columns of a stored catalogue table, for the wanted keys only."""
    root = v.scratch("dump")
    for name in schemas.CATALOGUE:
        getattr(v.catalogue, name).write.parquet(f"{root}/{name}.parquet")
    wanted = v.plays.select(F.col("track_id").alias("id")).na.drop().distinct()
    scanned = read_catalogue(v.spark, root).tracks.select("id", "external_id_isrc", "popularity")
    return scanned.join(wanted, "id", "left_semi")


def _kind(path: str) -> Column:
    return F.regexp_extract(path, "(StreamingHistory|Streaming_History)", 1)


def _folder() -> Column:
    return F.regexp_extract("path", "/folder=([^/]+)/", 1).alias("folder")


_FOLDERS = """(select case s_suppkey % 3 when 0 then 'StreamingHistory_music_' when 1 then 'Streaming_History_Audio_'
    else 'Userdata_' end || s_suppkey as folder, s_name, s_suppkey from supplier)"""


@query("src_file_inventory", f"select folder, cast(1 as bigint) as files, cast(strlen(s_name) + 1 as bigint) as bytes from {_FOLDERS}")
def src_file_inventory(v: Views) -> DataFrame:
    """Files and bytes per folder."""
    files = bronze.list_files(v.spark, v.named_files()).groupBy(_folder())
    return files.agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))


@query("src_export_discovery", f"select folder, cast(strlen(s_name) + 1 as bigint) as length from {_FOLDERS} where s_suppkey % 3 <> 2")
def src_export_discovery(v: Views) -> DataFrame:
    return bronze.discover_exports(v.spark, v.named_files()).select(_folder(), "length")


@query(
    "quarantine_records",
    """select 'plays' as source, 'badly typed: track' as reason, count(distinct cast(played_at_utc as date)) as records from api_rows
       union all select 'exports', 'badly typed: ms_played, skipped',
         count(distinct coalesce(cast(cast(played_at_utc as date) as varchar), 'none')) from extended_rows
       union all select 'exports', 'badly typed: msPlayed', count(distinct cast(played_at_utc as date)) from standard_rows
       union all select 'track_markers', 'badly typed: track', count(*) from region
       union all select 'track_markers', 'not JSON', 1
       union all select 'track_tag_markers', 'badly typed: listeners', count(*) from region
       union all select 'artist_tag_markers', 'badly typed: tags', count(*) from region""",
)
def quarantine_records(v: Views) -> DataFrame:
    """What the bronze sources hold that can't be read, each record on its own."""
    bad = [
        bronze.unreadable(bronze.read_json(v.spark, v.bronze(name), schema)).select(F.lit(name).alias("source"), bronze.CORRUPT)
        for name, schema in jobs.BRONZE_SCHEMAS.items()
    ]
    rows = reduce(DataFrame.unionByName, bad)
    return rows.groupBy("source", F.col(bronze.CORRUPT).alias("reason")).agg(F.count(F.lit(1)).alias("records"))


# ---------------------------------------------------------------- sinks and state


@query("sink_table_roundtrip", "select track_id, track_name, popularity + 1 as popularity from tracks")
def sink_table_roundtrip(v: Views) -> DataFrame:
    """A table is replaced by a change of itself."""
    path = v.scratch("tracks")
    tables.write_table(v.tracks.select("track_id", "track_name", "popularity"), path)
    stored = tables.read_table(v.spark, path)
    tables.swap_table(stored.withColumn("popularity", F.col("popularity") + 1), path)
    return tables.read_table(v.spark, path)


@query(
    "sink_partition_overwrite",
    f"""select played_at_utc, track_name, {_PARTS},
          case when year(played_at_utc) = 1998 then 'rewritten' else source_type end as source_type
        from plays""",
)
def sink_partition_overwrite(v: Views) -> DataFrame:
    """Writing one year again leaves the months of the others alone."""
    path = v.scratch("events")
    events = _dated(v.plays).select("played_at_utc", "track_name", "source_type", "year", "month")
    tables.write_by_month(events, path)
    again = events.filter(F.col("year") == 1998).withColumn("source_type", F.lit("rewritten"))
    tables.write_by_month(again, path)
    return tables.read_by_month(v.spark, path)


@query(
    "sink_json_landing",
    """select strftime(played_at_utc, '%Y-%m-%dT%H:%M:%S.%gZ') as played_at, track_id,
         'year=2024/month=02/day=03' as folder, 'year=2024/month=02/day=03/2024-02-03-040506' as stem
       from api_rows""",
)
def sink_json_landing(v: Views) -> DataFrame:
    """Plays land in the folder of the day they were ingested."""
    path, at = v.scratch("landing"), F.expr("timestamp_ntz'2024-02-03 04:05:06'")
    bronze.land_plays(v.nested_plays, path, at)
    landed = bronze.read_json(v.spark, path, schemas.PLAY)
    folder = F.regexp_extract(bronze.SOURCE_FILE, "(year=[^/]+/month=[^/]+/day=[^/]+)/", 1)
    return landed.select(
        "played_at",
        F.col("track.id").alias("track_id"),
        folder.alias("folder"),
        bronze.landing_path(at).alias("stem"),
    )


@query(
    "sink_raw_files",
    f"""select folder, cast(strlen(s_name) + 1 as bigint) as length, sha256(s_name || chr(10)) as content_sha256
        from {_FOLDERS} where s_suppkey % 3 <> 2""",
)
def sink_raw_files(v: Views) -> DataFrame:
    """Exports kept byte by byte."""
    path = v.scratch("raw_files")
    bronze.keep_raw_files(v.spark, v.named_files(), path)
    return v.spark.read.parquet(path).select(_folder(), "length", F.sha2("content", 256).alias("content_sha256"))


@query(
    "sink_raw_ranges",
    f"""select folder, cast(strlen(s_name) + 1 as bigint) as length, cast((strlen(s_name) + 8) // 8 as bigint) as ranges,
          sha256(s_name || chr(10)) as content_sha256
        from {_FOLDERS} where s_suppkey % 3 <> 2""",
)
def sink_raw_ranges(v: Views) -> DataFrame:
    """The same files, each kept in ranges of eight bytes and put together again."""
    path = v.scratch("raw_ranges")
    bronze.keep_raw_files(v.spark, v.named_files(), path, size=8)
    ranges = F.array_sort(F.collect_list(F.struct("offset", F.hex("content").alias("hex"))))
    whole = v.spark.read.parquet(path).groupBy(_folder(), "length").agg(ranges.alias("r"))
    content = F.unhex(F.array_join("r.hex", ""))
    return whole.select("folder", "length", F.size("r").cast("bigint").alias("ranges"), F.sha2(content, 256).alias("content_sha256"))


@query(
    "attempts_latest",
    """select key, status, payload, attempted_at from (
         select to_base64(encode(plain)) as key, case when payload is null then 'not_found' else 'found' end as status, payload,
           attempted_at, row_number() over (partition by plain order by attempted_at desc, payload nulls last) as rn
         from attempts_plain where plain is not null)
       where rn = 1""",
)
def attempts_latest(v: Views) -> DataFrame:
    """Attempts are appended; the last one per key counts."""
    path = v.scratch("attempts")
    state.append_attempts(v.attempts, path)
    return state.latest_attempts(state.read_attempts(v.spark, path).na.drop(subset=["key"]))


_RUN_AT = "timestamp_ntz'2024-02-03 04:05:06'"


@query(
    "cursor_advance",
    """select timestamp '2024-02-03 04:05:06' as last_run_timestamp, epoch_us(max(played_at_utc)) // 1000
         as last_played_at_unix_ms
       from api_rows""",
)
def cursor_advance(v: Views) -> DataFrame:
    """From no cursor to the newest play; a batch without plays then moves nothing."""
    path, run_at = v.scratch("cursor"), F.expr(_RUN_AT)
    for batch in (v.nested_plays, v.nested_plays.filter(F.col("played_at").isNull())):
        after = jobs.new_plays(batch, state.read_cursor(v.spark, path))
        tables.swap_table(state.advance_cursor(after, run_at), path)
    return state.read_cursor(v.spark, path)


# ---------------------------------------------------------------- jobs


@query(
    "backfill_report",
    """select 'Streaming_History' as kind, count(*) filter (track_name <> '' and artist_name <> '') as music_records,
         count(*) filter (track_name is null or artist_name is null) as other_records,
         count(distinct coalesce(cast(cast(played_at_utc as date) as varchar), 'none')) as malformed_records
       from extended_rows
       union all
       select 'StreamingHistory', count(*) filter (duration_ms is not null and track_name <> '' and artist_name <> ''),
         count(*) filter (duration_ms is not null and (track_name is null or artist_name is null)),
         count(*) filter (duration_ms is null) + count(distinct cast(played_at_utc as date))
       from standard_rows""",
)
def backfill_report(v: Views) -> DataFrame:
    records = backfill.read_export_records(v.spark, v.bronze("exports"))
    return backfill.backfill_report(records.withColumn("kind", _kind("file_path")), per="kind")


@query(
    "ingest_increment",
    """select played_at_utc, track_id, track_name, (select max(played_at_utc) from api_rows where track_id is not null
         and p_size <> 13) as cursor_at
       from api_rows where track_id is not null and p_size <> 13 and played_at_utc > timestamp '1998-06-01 00:00:00'""",
)
def ingest_increment(v: Views) -> DataFrame:
    """Valid plays after the cursor are landed, then the cursor is their newest."""
    root, start = v.scratch("lake"), F.expr("timestamp_ntz'1998-06-01 00:00:00'")
    cursor_path = f"{root}/{schemas.STATE_PATH}"
    v.spark.range(1).select(
        F.expr(_RUN_AT).alias("last_run_timestamp"), epoch_millis(start).alias("last_played_at_unix_ms")
    ).write.parquet(cursor_path)
    jobs.ingest_increment(v.spark, v.bronze("plays"), root, v.scratch("work"), run_at=F.expr(_RUN_AT))
    landed = bronze.read_plays(v.spark, jobs.bronze_path(root, "plays"))
    cursor = state.read_cursor(v.spark, cursor_path).first()
    return landed.select(
        parse_utc(F.col("played_at")).alias("played_at_utc"),
        F.col("track.id").alias("track_id"),
        F.col("track.name").alias("track_name"),
        from_epoch_millis(F.lit(cursor["last_played_at_unix_ms"])).alias("cursor_at"),
    )


_SILVER_EVENTS = f"""(select * from (
    select *, row_number() over (partition by played_at_utc, track_name order by
      case source_type when 'api' then 1 when 'extended_export' then 2 else 3 end, track_id asc nulls last,
      {", ".join(f"{c} asc nulls last" for c in _EVENT_REST)}) as rn
    from raw_events) where rn = 1)"""
_SILVER_ARTISTS = f"({_first_row('artist_rows', 'artist_id', ['artist_name'], where='true', source_first=True)})"


@query(
    "run_transform_gold",
    f"""select 'artists' as table_name, count(distinct artist_id) as rows from artist_rows
        union all select 'albums', count(distinct album_id) from album_rows
        union all select 'tracks', count(distinct track_id) from track_rows
        union all select 'track_tags', count(*) from track_tags
        union all select 'artist_tags', count(*) from artist_tags
        union all select 'audio_features', count(*) from features
        union all select 'listening_events', count(*) from {_SILVER_EVENTS}
        union all select 'dim_tracks', count(distinct track_id) from track_rows
        union all select 'dim_artists', count(distinct artist_id) from artist_rows
        union all select 'fact_plays', count(*) from {_SILVER_EVENTS} e
          left join {_SILVER_ARTISTS} a on e.artist_name = a.artist_name
        union all select 'agg_daily', count(*) from (select distinct cast(played_at_utc as date) from raw_events
          where track_name is not null)
        union all select 'agg_monthly', count(*) from (
          select distinct year(played_at_utc), month(played_at_utc) from raw_events)
        union all select 'agg_artist_stats', count(*) from (select distinct artist_name from {_SILVER_EVENTS}) e
          left join {_SILVER_ARTISTS} a on e.artist_name = a.artist_name
        union all select 'agg_track_stats', count(distinct track_id) from {_SILVER_EVENTS}""",
)
def run_transform_gold(v: Views) -> DataFrame:
    """Bronze to silver to gold, through storage."""
    root = v.write_bronze(v.scratch("lake"))["root"]
    tables.write_table(v.features, tables.table_path(root, "audio_features"))
    return jobs.transform_gold(v.spark, root, v.scratch("work"))


# ---------------------------------------------------------------- streams


@query("stream_ingest_available_now", "select event_id, ts as played_at_utc, event_type, value from events")
def stream_ingest_available_now(v: Views) -> DataFrame:
    """Files that arrive in two waves are landed once each, over two runs of the stream."""
    source, target, checkpoint = v.scratch("arrivals"), v.scratch("landed"), v.scratch("checkpoint")
    events = v.table("events").select(
        "event_id",
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("played_at"),
        "event_type",
        "value",
    )
    middle = F.col("played_at") < "2024-01-15"
    schema = events.schema
    for wave in (events.filter(middle), events.filter(~middle)):
        wave.write.mode("append").json(source)
        bad = v.table("region").select(F.lit('{"event_id": "x", "value": 1}').alias("value"))
        bad.unionByName(bad.select(F.lit('{"event_id": 1, "val').alias("value"))).write.mode("append").text(source)
        ingest.land_available(ingest.stream_files(v.spark, source, schema), target, checkpoint, v.scratch("quarantine"))
    landed = v.spark.read.parquet(target)
    return landed.select(
        "event_id", parse_utc(F.col("played_at")).alias("played_at_utc"), "event_type", "value"
    )


@query("stream_events_upsert", f"select *, {_PARTS} from heard")
def stream_events_upsert(v: Views) -> DataFrame:
    """The sparsest source arrives first, the best last; the table ends as if all had come at once."""
    source, table, work = v.scratch("arrivals"), v.scratch("events"), v.scratch("work")
    for kind in ("export", "extended_export", "api"):
        v.plays.filter(F.col("source_type") == kind).write.mode("append").parquet(source)
        arrived = ingest.stream_files(v.spark, source, schemas.EVENTS, fmt="parquet")
        upsert.upsert_available(arrived, table, work, f"{work}/checkpoint")
    # A new checkpoint counts its batches anew and hands over everything again.
    again = ingest.stream_files(v.spark, source, schemas.EVENTS, fmt="parquet")
    upsert.upsert_available(again, table, work, f"{work}/second_checkpoint")
    return upsert.read_events(v.spark, table)


@query("silver_refresh", f"select * exclude (rn), {_PARTS} from {_SILVER_EVENTS}")
def silver_refresh(v: Views) -> DataFrame:
    """Plays and exports first, look-ups later: months with plays whose id became known are written again."""
    root, work = v.scratch("lake"), v.scratch("work")
    for write in (v.write_heard, v.write_looked_up):
        write(root)
        jobs.refresh_silver(v.spark, root, work, f"{work}/checkpoint")
    return tables.read_silver(v.spark, root, "listening_events")


@query(
    "gold_refresh",
    f"""select cast(year(played_at_utc) as int) as year, cast(month(played_at_utc) as int) as month, count(*) as total_plays,
          cast(coalesce(sum(duration_ms), 0) as bigint) as total_ms_listened,
          cast(count(distinct track_id) + max(case when track_id is null then 1 else 0 end) as bigint) as unique_tracks,
          cast(count(distinct e.artist_name) + max(case when e.artist_name is null then 1 else 0 end) as bigint) as unique_artists
        from {_SILVER_EVENTS} e left join {_SILVER_ARTISTS} a on e.artist_name = a.artist_name group by 1, 2""",
)
def gold_refresh(v: Views) -> DataFrame:
    """Plays and exports first, look-ups later: gold is brought up to date after each, from what silver wrote and from look-up rows that changed."""
    root, work = v.scratch("lake"), v.scratch("work")
    for write in (v.write_heard, v.write_looked_up):
        write(root)
        jobs.refresh_all(v.spark, root, work, f"{work}/checkpoint")
    return tables.read_gold(v.spark, root, "agg_monthly").select("year", "month", "total_plays", "total_ms_listened", "unique_tracks", "unique_artists")
