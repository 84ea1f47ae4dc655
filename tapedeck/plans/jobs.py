"""The jobs a user calls. Each reads tables, writes tables and passes nothing through the driver."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import timedelta
from functools import partial, reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tapedeck import schemas
from tapedeck.functions.text import encode_key
from tapedeck.functions.timestamps import epoch_millis, parse_utc
from tapedeck.operators.joins import anti_join, hot_keys, semi_join
from tapedeck.operators.validation import profile, row_counts
from tapedeck.plans import enrichment, gold, responses, silver, worklists
from tapedeck.sources import bronze, state
from tapedeck.sources.at_once import at_once
from tapedeck.sources.catalogue import keep_by_key, read_catalogue, read_kept
from tapedeck.sources.files import exists, mark, remove
from tapedeck.sources.tables import (
    Month,
    current_version,
    is_month,
    live_parts,
    materialize,
    months_of,
    read_by_month,
    read_gold,
    read_optional,
    read_silver,
    read_table,
    stored_bytes,
    swap_table,
    table_path,
    write_by_month,
    write_table,
)
from tapedeck.streaming import ingest, parse

GOLD = ["dim_tracks", "dim_artists", "fact_plays", "agg_daily", "agg_monthly", "agg_artist_stats", "agg_track_stats"]
BRONZE_SCHEMAS = {
    "plays": schemas.PLAY,
    "exports": schemas.EXPORT,
    "track_markers": schemas.TRACK_MARKER,
    "track_tag_markers": schemas.TRACK_TAGS_MARKER,
    "artist_tag_markers": schemas.ARTIST_TAGS_MARKER,
}
# What of them is copied, once a record is judged.
TAKEN = {**BRONZE_SCHEMAS, "plays": schemas.PLAY_TAKEN, "exports": schemas.EXPORT_TAKEN, "track_markers": schemas.TRACK_MARKER_TAKEN}
# Size in memory up to which a lookup of the fact is broadcast, and how much larger than its files a table is taken to be there.
BROADCAST_BYTES = 256 * 1024 * 1024
EXPANSION = 8
# How long before the last run a landed file may have been changed and is still read again.
LANDING_SLACK = timedelta(days=1)
# Size of a batch of plays, in columns, from which on it is landed compressed; a smaller one stays text that anyone can read.
LAND_COMPRESSED = 4 * 1024 * 1024
# Plays of one key from which on its rows are spread over several partitions.
HOT_ROWS = 5_000_000


def bronze_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{schemas.BRONZE_PATHS[name]}"


def read_lake(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The seven silver tables."""
    return {name: read_silver(spark, root, name) for name in schemas.SILVER_SCHEMAS}


def attempts_path(root: str, kind: str) -> str:
    return f"{root.rstrip('/')}/bronze/attempts/{kind}"


def attempts(spark: SparkSession, root: str, kind: str) -> DataFrame:
    """All look-ups of a kind so far: those of the table, and marker files that others left."""
    table = state.read_attempts(spark, attempts_path(root, kind))
    return table.unionByName(state.attempts_from_files(spark, bronze_path(root, kind)))


def record(markers: DataFrame, payload: DataFrame, root: str, kind: str) -> None:
    """Keep look-up results: found records as markers, every key (key, payload) as an attempt."""
    bronze.write_json_lines(markers, f"{bronze_path(root, kind)}/run-{uuid.uuid4().hex}")
    rows = state.attempt_rows(payload, F.col("key"), F.col("payload"), F.current_timestamp())
    state.append_attempts(rows, attempts_path(root, kind))


def next_lookups(spark: SparkSession, root: str, tracks: int = 50, tags: int = 200) -> dict[str, DataFrame]:
    """The next batch of keys per look-up kind."""
    events, dims = read_silver(spark, root, "listening_events"), read_lake(spark, root)
    return {
        "track_markers": worklists.worklist_tracks(events, dims["tracks"], attempts(spark, root, "track_markers"), tracks),
        "track_tag_markers": worklists.worklist_track_tags(events, attempts(spark, root, "track_tag_markers"), tags),
        "artist_tag_markers": worklists.worklist_artist_tags(
            dims["artists"], attempts(spark, root, "artist_tag_markers"), tags
        ),
    }


# Key column and parser per look-up kind.
LOOKUPS = {
    "track_markers": ("track_id", responses.parse_tracks),
    "track_tag_markers": ("track_id", responses.parse_track_tags),
    "artist_tag_markers": ("artist_id", responses.parse_artist_tags),
}


def record_responses(raw: DataFrame, root: str, kind: str, work: str) -> None:
    """Parse the raw responses (key column, response) of a look-up batch and keep the results."""
    key, parse = LOOKUPS[kind]
    parsed = materialize(parse(raw), f"{work}/{kind}")
    found = parsed.filter(~F.col("not_found")).drop("not_found")
    payload = parsed.select(
        encode_key(F.col(key)).alias("key"),
        F.when(~F.col("not_found"), F.to_json(F.struct(*found.columns))).alias("payload"),
    )
    markers = found.drop("track_id") if kind == "track_markers" else found
    record(markers, payload, root, kind)


def quarantine_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/quarantine/{name}"


def stage_bronze(spark: SparkSession, root: str, name: str, schema: StructType, work: str) -> DataFrame:
    """Parse one bronze source into a columnar copy; what could not be read goes to quarantine."""
    raw = materialize(bronze.taken(bronze.read_json(spark, bronze_path(root, name), schema, used=TAKEN[name]), TAKEN[name]), f"{work}/{name}")
    bronze.unreadable(raw).write.mode("overwrite").parquet(quarantine_path(root, name))
    return raw


def stage_markers(spark: SparkSession, root: str, work: str) -> dict[str, DataFrame]:
    """Look-up results that found something, parsed once."""
    names = [n for n in BRONZE_SCHEMAS if n.endswith("_markers")]
    return {n: bronze.found_only(stage_bronze(spark, root, n, BRONZE_SCHEMAS[n], work)) for n in names}


def write_dimensions(spark: SparkSession, root: str, played: silver.Dimensions, looked_up: silver.Dimensions, tags: dict[str, DataFrame]) -> None:
    """Artists, albums, tracks and the tag tables, out of what plays say and what look-ups found."""
    existing = silver.Dimensions(*[read_silver(spark, root, t) for t in ("artists", "albums", "tracks")])
    dims = silver.build_dimensions(played, looked_up, existing)
    made = {"artists": dims.artists, "albums": dims.albums, "tracks": dims.tracks, **tags}
    at_once(spark, *[partial(swap_table, df, table_path(root, name)) for name, df in made.items()])


def build_silver(spark: SparkSession, root: str, work: str, export_zone: str | None = None) -> None:
    """Rebuild the silver layer from bronze.

    The raw JSON is parsed once, into columnar copies under `work`, which all tables then read and which go at the end.
    """
    markers = stage_markers(spark, root, work)
    staged = {name: stage_bronze(spark, root, name, BRONZE_SCHEMAS[name], work) for name in ("plays", "exports")}
    plays, exports = bronze.plays_only(staged["plays"]), bronze.readable(staged["exports"])
    tags = {"track_tags": silver.track_tags(markers["track_tag_markers"]), "artist_tags": silver.artist_tags(markers["artist_tag_markers"])}
    write_dimensions(spark, root, silver.dimension_rows(plays), silver.dimension_rows(markers["track_markers"]), tags)
    if not (plays.isEmpty() and exports.isEmpty()):
        mapping = silver.enrichment_mapping(markers["track_markers"])
        events = silver.listening_events(silver.api_events(plays), silver.export_events(exports, mapping, export_zone))
        write_by_month(events, table_path(root, "listening_events"))
    for name in BRONZE_SCHEMAS:
        remove(spark, f"{work}/{name}")


def refresh_silver(spark: SparkSession, root: str, work: str, checkpoint: str, export_zone: str | None = None) -> None:
    """The same tables as build_silver, from files that came since the last run.

    New files of every kind are parsed into batches under `parsed/` and merged into running tables there. Only months that the batches touch are
    deduplicated and written anew, and months with plays whose id a look-up has found since; files of other months, batches and look-ups
    are not read. A run that broke off is made up for by the next one.
    """
    parsed, own = f"{root.rstrip('/')}/parsed", f"{work}/refresh"
    made = {
        "plays": parse.of_plays, "exports": lambda _: {}, "track_markers": parse.of_track_markers,
        "track_tag_markers": parse.of_track_tags, "artist_tag_markers": parse.of_artist_tags,
    }
    shapes = {"plays": parse.played, "exports": partial(parse.exported, zone=export_zone)}

    def take(name: str, frames: Callable) -> None:
        def keep(records: DataFrame, folder: str) -> None:
            parse.keep_batch(frames(records), parsed, folder)

        source, shape = (bronze_path(root, name), BRONZE_SCHEMAS[name], TAKEN[name]), shapes.get(name)
        bad, kept = quarantine_path(root, f"{name}_parsed"), f"{parsed}/events" if shape else None
        parse.parse_available(spark, *source, keep, bad, f"{checkpoint}/{name}", f"{own}/{name}", shape, kept)

    at_once(spark, *[partial(take, name, frames) for name, frames in made.items()])
    merge = parse.Merge(spark, parsed)
    *changed, kept = at_once(spark, *[partial(merge.update, name) for name in merge.schemas], merge.keep_events)
    updated = [name for name, new in zip(merge.schemas, changed, strict=True) if new]

    def dimensions() -> None:
        if set(updated) - {"mapping"}:
            tags = {name: merge.state(name) for name in ("track_tags", "artist_tags")}
            write_dimensions(spark, root, merge.dimensions(), merge.dimensions("marker_"), tags)

    def events() -> None:
        stale = set(kept)
        if "mapping" in updated:
            stale.update(merge.months_without_id(merge.newly_mapped()))
        if stale:
            rows, from_api = merge.kept_events(list(stale)).select(schemas.EVENTS.names), F.col("source_type") == "api"
            filled = silver.fill_exports(rows.filter(~from_api), merge.state("mapping"))
            write_by_month(silver.listening_events(rows.filter(from_api), filled), table_path(root, "listening_events"))

    at_once(spark, dimensions, events)
    merge.done()
    remove(spark, own)


def stage_lookup(lookup: DataFrame, path: str, limit: int) -> tuple[DataFrame, bool]:
    """Write a lookup of the fact; up to `limit` bytes in memory it is broadcast, beyond that (True) shuffled."""
    stored = materialize(lookup, path)
    large = EXPANSION * stored_bytes(lookup.sparkSession, path) > limit
    return (stored if large else F.broadcast(stored)), large


def build_fact(
    events: DataFrame, lookups: dict[str, DataFrame], work: str, broadcast_bytes: int = BROADCAST_BYTES, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """The fact out of deduplicated events and its lookups by key (track_id, artist_name).

    The lookups are written first, so that their real size decides between a broadcast and a shuffle, and only in a
    shuffle the plays of very popular keys are spread.
    """
    sides, hot, keys = [], [], ("track_id", "artist_name")
    staged = at_once(events.sparkSession, *[partial(stage_lookup, lookups[key], f"{work}/by_{key}", broadcast_bytes) for key in keys])
    for key, (side, large) in zip(keys, staged, strict=True):
        skewed = large and events.count() >= hot_rows
        sides.append(side)
        hot.append(materialize(hot_keys(events, key, hot_rows), f"{work}/hot_{key}") if skewed else None)
    return gold.fact_plays(events, *sides, *hot)


# What a build of gold was made from: the write of each month of the events, and the version of each other silver table.
_BUILT = schemas.struct(name=schemas.TEXT, write=schemas.TEXT, year=schemas.INT, month=schemas.INT)
_LOOKUP_TABLES = ["artists", "albums", "tracks", "track_tags", "artist_tags", "audio_features"]


def _built_path(root: str) -> str:
    return f"{root.rstrip('/')}/gold/_built"


def _inputs(spark: SparkSession, root: str) -> set[tuple]:
    """The state of silver by its manifests alone: a row for each month's write and each other table's version."""
    events = table_path(root, "listening_events")
    months = {("listening_events", p.write, p.year, p.month) for p in live_parts(spark, events)}
    if not months and exists(spark, events):  # plain files of others, which nothing tells apart from changed ones
        months = {("listening_events", uuid.uuid4().hex, *m) for m in months_of(read_silver(spark, root, "listening_events"))}
    versions = {n: table_path(root, n) for n in _LOOKUP_TABLES}
    return months | {(n, current_version(spark, p) or "", None, None) for n, p in versions.items() if exists(spark, p)}


def _lookups(s: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "track_id": gold.track_lookup(s["tracks"], s["albums"], s["audio_features"]),
        "artist_name": gold.artist_lookup(s["artists"], s["artist_tags"]),
    }


def _changed_keys(spark: SparkSession, now: DataFrame, path: str, key: str) -> DataFrame:
    """Keys whose rows differ from the stored ones, in either direction."""
    if not exists(spark, path):
        return now.select(key).distinct()
    old = read_table(spark, path).select(*now.columns)
    sides = now.withColumn("_now", F.lit(1)).unionByName(old.withColumn("_now", F.lit(-1)))
    return sides.groupBy(*now.columns).agg(F.sum("_now").alias("_now")).filter(F.col("_now") != 0).select(key).distinct()


def build_gold(
    spark: SparkSession, root: str, work: str, broadcast_bytes: int = BROADCAST_BYTES, hot_rows: int = HOT_ROWS
) -> None:
    """Build the gold layer from silver, all of it, whatever was built before."""
    remove(spark, _built_path(root))
    refresh_gold(spark, root, work, broadcast_bytes, hot_rows)


def refresh_gold(
    spark: SparkSession, root: str, work: str, broadcast_bytes: int = BROADCAST_BYTES, hot_rows: int = HOT_ROWS
) -> list[Month]:
    """Bring gold up to date with silver; returns the months of the fact that were written anew.

    These are the months that silver wrote since, by its manifest, and months with plays whose track or artist looks up to
    other rows than last time. Only they are joined and stored, with their sums per day, track, artist and description (`partials`); the
    aggregates are then made from the sums, and days and months that nothing touched keep their stored rows. A run that broke off
    is made up for by the next one, as what was built is noted last.
    """
    path = {name: table_path(root, name) for name in [*GOLD, "partials"]}
    held = f"{root.rstrip('/')}/gold/_lookups"
    inputs, built = _inputs(spark, root), {tuple(r) for r in read_optional(spark, _built_path(root), _BUILT).collect()}
    if inputs == built:
        return []
    s = read_lake(spark, root)
    tables_changed = {n for n, *_ in inputs ^ built} & set(_LOOKUP_TABLES)
    writes: list[Callable] = []
    if tables_changed or not built:
        dims = [
            (gold.dim_tracks(s["tracks"], s["albums"], s["track_tags"], s["audio_features"]), path["dim_tracks"], s["tracks"]),
            (gold.dim_artists(s["artists"], s["artist_tags"]), path["dim_artists"], s["artists"]),
        ]
        writes = [partial(write_table, *dim) for dim in dims]
    written = {x[2:] for x in inputs if x[0] == "listening_events"}
    stale = {x[2:] for x in inputs ^ built if x[0] == "listening_events"} & written
    known = written - stale
    sides = _lookups(s) if tables_changed or stale else {}
    copies = at_once(spark, *[partial(materialize, df, f"{work}/now_{key}") for key, df in sides.items()], *writes)
    lookups = dict(zip(sides, copies, strict=False))
    if tables_changed and built and known:
        parts = read_gold(spark, root, "partials")

        def touched(key: str) -> list[Month]:
            return months_of(semi_join(parts, _changed_keys(spark, lookups[key], f"{held}/{key}", key), [key]))

        stale |= {m for months in at_once(spark, *[partial(touched, key) for key in lookups]) for m in months if m in written}
    if stale:
        events = read_by_month(spark, table_path(root, "listening_events"), schemas.EVENTS_PARTITIONED, sorted(stale, key=str))
        write_by_month(build_fact(events, lookups, work, broadcast_bytes, hot_rows), path["fact_plays"])
        fresh = read_by_month(spark, path["fact_plays"], months=sorted(stale, key=str))
        write_by_month(gold.partials(fresh), path["partials"])
    if written and (stale or tables_changed):
        _write_aggregates(spark, root, s, path, stale, rebuild=not known)
    at_once(spark, *[partial(write_table, now, f"{held}/{key}") for key, now in lookups.items()])
    write_table(spark.createDataFrame(sorted(inputs, key=str), _BUILT).coalesce(1), _built_path(root))
    for key in lookups:
        remove(spark, f"{work}/now_{key}")
    return sorted(stale, key=str)


def _write_aggregates(spark: SparkSession, root: str, s: dict[str, DataFrame], path: dict[str, str], stale: set[Month], rebuild: bool) -> None:
    """The four aggregates out of the stored sums. Days of untouched months are taken over; what a lifetime counts is summed anew."""
    parts, writes = read_gold(spark, root, "partials"), []
    if stale:
        touched = read_by_month(spark, path["partials"], months=sorted(stale, key=str))
        daily = gold.daily_of(touched)
        if not rebuild:
            month = [F.year("date").alias("year"), F.month("date").alias("month")]
            stored = read_gold(spark, root, "agg_daily").select("*", *month)
            kept = ~F.coalesce(is_month(sorted(stale, key=str)), F.lit(False))
            daily = stored.filter(kept).drop("year", "month").unionByName(daily)
        writes += [
            partial(write_table, daily.orderBy("date"), path["agg_daily"]),
            partial(write_table, gold.monthly_of(parts).orderBy("year", "month"), path["agg_monthly"]),
            partial(write_table, gold.by_total_plays(gold.track_stats_of(parts)), path["agg_track_stats"]),
        ]
    about = gold.dim_artists(s["artists"], s["artist_tags"])
    stats = gold.by_total_plays(gold.artist_stats_of(parts, about))
    at_once(spark, *writes, partial(write_table, stats, path["agg_artist_stats"]))


def keep_catalogue(spark: SparkSession, dump: str, kept: str, buckets: int) -> None:
    """Copy a dump by the keys that the phases look up, once for all later runs; a bucket should be a few hundred megabytes."""
    keep_by_key(read_catalogue(spark, dump), kept, buckets)


def enrich_from_catalogue(spark: SparkSession, root: str, dump: str, work: str) -> None:
    """The five catalogue phases. Phase 1 leaves markers that the next silver build picks up. `dump`: a dump, or copies of `keep_catalogue`."""
    catalogue = (read_kept if exists(spark, f"{dump}/_buckets") else read_catalogue)(spark, dump)
    s = read_lake(spark, root)
    pairs = enrichment.pairs_to_resolve(s["listening_events"], attempts(spark, root, "track_markers"))
    resolved = materialize(enrichment.resolve_pairs(pairs, catalogue, work), f"{work}/resolved")
    record(enrichment.resolved_markers(resolved), enrichment.marker_payload(resolved), root, "track_markers")
    fills = {"tracks": enrichment.enrich_tracks, "artists": enrichment.enrich_artists, "albums": enrichment.enrich_albums}
    for name, fill in fills.items():
        swap_table(fill(s[name], catalogue), table_path(root, name))
    features = enrichment.audio_features(read_silver(spark, root, "tracks"), catalogue)
    swap_table(features, table_path(root, "audio_features"))


def new_plays(plays: DataFrame, cursor: DataFrame) -> DataFrame:
    """Plays after the cursor, which is one row and therefore joined as a scalar."""
    after = cursor.select("last_played_at_unix_ms").first()["last_played_at_unix_ms"]
    return plays.filter(epoch_millis(parse_utc(F.col("played_at"))) > after)


def new_records(spark: SparkSession, landing: str, cursor: DataFrame, slack: timedelta = LANDING_SLACK) -> DataFrame:
    """Records of the files that came since the last run, by the time of their last change.

    Files that were changed in the `slack` before that run are read again: they may have arrived while it was under way, or from a
    machine whose clock is behind. Plays that the cursor covers are left out later.
    """
    last = cursor.select("last_run_timestamp").first()["last_run_timestamp"]
    return bronze.read_json(spark, landing, schemas.PLAY, since=last - slack)


def quarantine(rows: DataFrame, path: str) -> None:
    """Append unreadable or rejected records that the table does not hold yet."""
    spark, names = rows.sparkSession, rows.columns
    if exists(spark, path):
        old = spark.read.schema(rows.schema).parquet(path).withColumnsRenamed({c: f"{c}_old" for c in names})
        rows = rows.join(old, reduce(and_, [F.col(c).eqNullSafe(F.col(f"{c}_old")) for c in names]), "left_anti")
    rows.distinct().write.mode("append").parquet(path)


def ingest_increment(
    spark: SparkSession, landing: str, root: str, work: str, run_at: Column | None = None
) -> None:
    """Land the valid plays that came after the cursor, then move it: bad records and data first, so none is lost.

    Only files that came since the last run are opened. That plays are about to land is noted first: if the run breaks off before
    the cursor moves, the next one leaves out what has landed.
    """
    run_at = F.current_timestamp() if run_at is None else run_at
    cursor_path = f"{root.rstrip('/')}/{schemas.STATE_PATH}"
    cursor = state.read_cursor(spark, cursor_path)
    records = materialize(new_records(spark, landing, cursor), f"{work}/landing")
    valid, bad = bronze.split_plays(records)
    quarantine(bad, quarantine_path(root, "plays_rejected"))
    fresh, plays = materialize(new_plays(valid, cursor), f"{work}/fresh"), bronze_path(root, "plays")
    remove(spark, f"{work}/landing")
    if fresh.isEmpty():
        return
    noted = f"{root.rstrip('/')}/system/landing/after-{cursor.first()['last_played_at_unix_ms']}"
    missing = fresh
    if exists(spark, noted):
        landed = bronze.plays_only(new_records(spark, plays, cursor))
        record = F.to_json(F.struct(*schemas.PLAY.names)).alias("_json")
        missing = anti_join(fresh.withColumn("_json", record), landed.select(record), ["_json"]).drop("_json")
    else:
        mark(spark, noted)
    bronze.land_plays(missing, plays, run_at, compressed=stored_bytes(spark, f"{work}/fresh") > LAND_COMPRESSED)
    swap_table(state.advance_cursor(fresh, run_at), cursor_path)
    remove(spark, noted)
    remove(spark, f"{work}/fresh")


def ingest_stream(spark: SparkSession, landing: str, root: str, checkpoint: str) -> None:
    """Like ingest_increment, but reads only files that came since the last run: the checkpoint plays the part of the cursor.

    Plays land where the silver build reads them.
    """
    ingest.land_plays_available(spark, landing, bronze_path(root, "plays"), quarantine_path(root, "plays_streamed"), checkpoint)


def report(spark: SparkSession, root: str) -> DataFrame:
    """Rows of every silver and gold table that is there."""
    there = [n for n in [*schemas.SILVER_SCHEMAS, *GOLD] if exists(spark, table_path(root, n))]
    return row_counts({n: read_gold(spark, root, n) if n in GOLD else read_silver(spark, root, n) for n in there})


def profile_lake(spark: SparkSession, root: str) -> DataFrame:
    """Rows, columns and first rows (by the first two columns) of every silver table that is there."""
    there = [n for n in schemas.SILVER_SCHEMAS if exists(spark, table_path(root, n))]
    return reduce(DataFrame.unionByName, [profile(read_silver(spark, root, n), n, schemas.SILVER_SCHEMAS[n].names[:2]) for n in there])


def transform_gold(spark: SparkSession, root: str, work: str) -> DataFrame:
    """Silver, then gold; returns the report."""
    build_silver(spark, root, f"{work}/silver")
    build_gold(spark, root, f"{work}/gold")
    return report(spark, root)


def refresh_all(spark: SparkSession, root: str, work: str, checkpoint: str) -> list[Month]:
    """What runs each hour: silver from new files, then gold from what they changed; returns the months of the fact that were written."""
    refresh_silver(spark, root, f"{work}/silver", checkpoint)
    return refresh_gold(spark, root, f"{work}/gold")


def run_all(spark: SparkSession, landing: str, root: str, work: str) -> None:
    """Ingest, then silver."""
    ingest_increment(spark, landing, root, f"{work}/ingest")
    build_silver(spark, root, f"{work}/silver")
