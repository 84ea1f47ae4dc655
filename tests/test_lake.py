"""Files, state, jobs and streams on small hand-made lakes."""

import base64
import json
import os
import threading
from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tapedeck import schemas
from tapedeck.operators import validation
from tapedeck.plans import backfill, enrichment, jobs, responses, worklists
from tapedeck.sources import bronze, state, tables
from tapedeck.sources.catalogue import read_catalogue
from tapedeck.streaming import ingest, parse, upsert


def put(path, value, indent=2):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(value if isinstance(value, str) else json.dumps(value, indent=indent))


def artist(key, name):
    return {"id": key, "name": name, "type": "artist", "uri": f"spotify:artist:{key}", "href": "h", "external_urls": {}}


def track(key, name, who, album="al", **more):
    return {
        "id": key, "name": name, "duration_ms": 60000, "explicit": False, "popularity": None, "track_number": 1,
        "type": "track", "uri": f"spotify:track:{key}", "href": "h", "is_local": False, "artists": [who],
        "album": {
            "id": album, "name": "Album", "album_type": "album", "total_tracks": 9, "release_date": "1999-05",
            "release_date_precision": "month", "type": "album", "uri": "u", "href": "h", "images": [], "artists": [who],
        },
        **more,
    }


def play(at, key, name, who, **more):
    return {"played_at": at, "track": track(key, name, who, **more), "context": None}


A, B, C = artist("a1", "Ann"), artist("b1", "Bob"), artist("d9", "Dee")


def make_lake(root):
    """Three sources that overlap: the same play in all of them, and plays only one of them has."""
    put(
        root / schemas.BRONZE_PATHS["plays"] / "year=2024/month=01/day=02/2024-01-02-000000.json",
        [play("2024-01-01T10:00:00.000Z", "t1", "One", A), play("2024-01-01T11:00:00.000Z", "t2", "Two", B)],
    )
    put(
        root / schemas.BRONZE_PATHS["exports"] / "StreamingHistory0.json",
        [
            {"endTime": "2024-01-01 10:00", "artistName": "Ann", "trackName": "One", "msPlayed": 5000},
            {"endTime": "2024-02-01 10:00", "artistName": "Cyd", "trackName": "Three", "msPlayed": 40000},
        ],
    )
    put(
        root / schemas.BRONZE_PATHS["exports"] / "Streaming_History_Audio_2024_0.json",
        [
            {
                "ts": "2024-01-01T10:00:00Z", "master_metadata_track_name": "One", "ms_played": 6000,
                "master_metadata_album_artist_name": "Ann", "spotify_track_uri": "spotify:track:t1", "skipped": True,
                "offline_timestamp": None,
            },
            {
                "ts": "2024-02-02T10:00:00Z", "master_metadata_track_name": "Two", "ms_played": 60000,
                "master_metadata_album_artist_name": "Bob", "spotify_track_uri": "spotify:track:t2", "skipped": False,
                "offline_timestamp": 1706868000,
            },
        ],
    )
    markers = root / schemas.BRONZE_PATHS["track_markers"]
    put(markers / "found.json", {"search_artist_name": "Bob", "search_track_name": "Four", "track": track("t4", "Four", B)})
    put(markers / "missed.json", {"not_found": True})
    put(markers / "broken.json", '{"search_artist_name": "B')
    put(
        root / schemas.BRONZE_PATHS["track_tag_markers"] / "t1.json",
        {"track_id": "t1", "tags": ["rock"], "top_tag": "rock", "listeners": 5, "playcount": 9},
    )
    put(root / schemas.BRONZE_PATHS["artist_tag_markers"] / "z1.json", {"artist_id": "z1", "tags": [], "top_tag": None})


def make_dump(spark, root):
    rows = {
        "tracks": [(1, "x9", "Three", 1000, 1, 50, 3, 2, "I9", 7), (2, "t1", "One", 1, 0, 77, 1, 4, "I1", 7),
                   (0, "x8", "Three", 1000, None, 10, 3, 2, "I8", 7)],
        "albums": [(7, "al", "Album", "album", "1999", 9, "Label", "UPC", 33)],
        "artists": [(1, "c1", "Cyd", 10, 20), (2, "a1", "Ann", 30, 40), (3, None, "Nobody", 0, 0)],
        "track_artists": [(1, 1), (1, 3), (2, 2)],
        "artist_genres": [(2, "pop"), (2, "art")],
        "track_audio_features": [
            ("t1", "0", "4", "120.5", "1", "0", "0.5", "0.75", "-5.0", "0.1", "0.2", "0.3", "0.4", "0.25"),
            ("t2", "1", *[None] * 12), ("zz", "0", *["1"] * 12),
        ],
    }
    for name, data in rows.items():
        spark.createDataFrame(data, schemas.CATALOGUE[name]).write.parquet(f"{root}/{name}.parquet")


# ---------------------------------------------------------------- bronze


def test_markers_skip_broken_and_missed_files(spark, tmp_path):
    make_lake(tmp_path)
    path = str(tmp_path / schemas.BRONZE_PATHS["track_markers"])
    found = bronze.read_markers(spark, path, schemas.TRACK_MARKER)
    assert [r["search_track_name"] for r in found.collect()] == ["Four"]
    bad = bronze.unreadable(bronze.read_json(spark, path, schemas.TRACK_MARKER)).collect()
    assert len(bad) == 1 and bad[0]["_source_file"].endswith("broken.json")


def test_missing_folder_is_empty_but_other_failures_are_not(spark, tmp_path):
    assert bronze.read_plays(spark, str(tmp_path / "nowhere")).count() == 0
    assert tables.read_silver(spark, str(tmp_path), "tracks").count() == 0
    (tmp_path / "silver/tracks").mkdir(parents=True)
    with pytest.raises(Exception, match="UNABLE_TO_INFER_SCHEMA"):
        tables.read_silver(spark, str(tmp_path), "tracks").collect()
    (tmp_path / "silver/tracks/part-0.parquet").write_text("no parquet")
    with pytest.raises(Exception, match="footer"):
        tables.read_silver(spark, str(tmp_path), "tracks").collect()


def test_files_without_plays_give_no_rows(spark, tmp_path):
    put(tmp_path / "error.json", {"error": {"status": 401}})
    put(tmp_path / "empty.json", [])
    assert bronze.read_plays(spark, str(tmp_path)).count() == 0


def test_json_lines_round_trip(spark, tmp_path):
    df = spark.range(1000).select((F.col("id") % 10).cast("string").alias("played_at"))
    bronze.write_json_lines(df, str(tmp_path / "out"))
    assert bronze.read_plays(spark, str(tmp_path / "out")).count() == 1000


def test_a_bad_record_fails_alone_whatever_is_selected(spark, tmp_path):
    good = {"ts": "2024-01-01T10:00:00Z", "ms_played": 5, "skipped": True}
    put(tmp_path / "Streaming_History_1.json", [good, {**good, "skipped": "maybe"}, {**good, "ms_played": "x"}, good, {"endTime": "e", "msPlayed": None}])
    put(tmp_path / "Streaming_History_2.json", '[{"ts": "cut')
    exports = bronze.read_exports(spark, str(tmp_path))
    assert exports.count() == 3 and exports.select("ts").dropna().count() == 2
    bad = {r["_corrupt_record"]: r["_record"] for r in bronze.unreadable(bronze.read_json(spark, str(tmp_path), schemas.EXPORT)).collect()}
    assert set(bad) == {"badly typed: skipped", "badly typed: ms_played", "not JSON"}
    assert json.loads(bad["badly typed: skipped"])["skipped"] == "maybe" and bad["not JSON"] is None
    report = backfill.backfill_report(backfill.read_export_records(spark, str(tmp_path))).collect()
    assert sorted(r["malformed_records"] for r in report) == [1, 3]
    put(tmp_path / "plays/1.json", [play("2024-01-01T10:00:00Z", "t", "n", A), play("2024-01-01T10:00:00Z", "u", "n", A, duration_ms="long")])
    assert [r["track"]["id"] for r in bronze.read_plays(spark, str(tmp_path / "plays")).collect()] == ["t"]


def test_export_discovery_by_name(spark, tmp_path):
    for name in ("StreamingHistory_music_0.json", "Streaming_History_Audio_1.json", "Userdata.json", "StreamingHistory.csv"):
        put(tmp_path / name, [])
    found = {r["path"].rsplit("/", 1)[1] for r in bronze.discover_exports(spark, str(tmp_path)).collect()}
    assert found == {"StreamingHistory_music_0.json", "Streaming_History_Audio_1.json"}


def test_backfill_counts_music_podcasts_and_malformed_records(spark, tmp_path):
    name = "StreamingHistory0.json"
    put(
        tmp_path / "in" / name,
        [
            {"endTime": "2024-01-01 10:00", "artistName": "A", "trackName": "S", "msPlayed": 1},
            {"endTime": "2024-01-01 10:00", "artistName": "A", "trackName": "", "msPlayed": 1},
            {"ts": "2024-01-01T10:00:00Z", "ms_played": 2, "spotify_track_uri": "spotify:episode:e"},
            {"artistName": "A"},
            {"endTime": "2024-01-01 10:00", "artistName": "A", "trackName": "S", "msPlayed": "long"},
        ],
    )
    put(tmp_path / "in" / "Userdata.json", {"name": "x"})
    report = backfill.backfill(spark, str(tmp_path / "in"), str(tmp_path / "kept")).collect()
    assert [(r["music_records"], r["other_records"], r["malformed_records"]) for r in report] == [(1, 2, 2)]
    kept = spark.read.parquet(str(tmp_path / "kept")).collect()
    assert [bytes(r["content"]) for r in kept] == [(tmp_path / "in" / name).read_bytes()]
    valid, rejected = backfill.split_records(backfill.read_export_records(spark, str(tmp_path / "in")))
    assert (valid.count(), rejected.count()) == (3, 2)


def test_track_record_rules(spark):
    good = track("t", "n", A)
    records = [good, {**good, "href": None}, {**good, "album": {**good["album"], "artists": None}}, None,
               {**good, "artists": [{**A, "uri": None}]}, {**good, "popularity": 3}]
    df = spark.createDataFrame([(r,) for r in records], schemas.struct(track=schemas.TRACK))
    got = [r[0] for r in df.select(validation.track_is_valid(F.col("track"))).collect()]
    assert got == [True, False, False, False, False, True]


# ---------------------------------------------------------------- tables and state


def test_partition_overwrite_leaves_other_months(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("a", 2024, 1), ("b", 2024, 2), ("n", None, None)], "v string, year int, month int")
    tables.write_by_month(df, path)
    untouched = sorted((tmp_path / "t/data").glob("*/year=2024/month=2/*.parquet"))
    again = spark.createDataFrame([("c", 2024, 1)], "v string, year int, month int")
    tables.write_by_month(again, path)
    got = {(r["v"], r["year"], r["month"]) for r in tables.read_by_month(spark, path).collect()}
    assert got == {("c", 2024, 1), ("b", 2024, 2), ("n", None, None)}
    assert sorted((tmp_path / "t/data").glob("*/year=2024/month=2/*.parquet")) == untouched


def test_months_change_together_or_not_at_all(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_by_month(spark.sql("select 'old' v, 2024 year, id as month from range(1, 3)"), path)
    # A write that was cut short before its months were noted.
    spark.sql("select 'new' v").write.parquet(f"{path}/data/write=wcut/year=2024/month=1")
    assert {r["v"] for r in tables.read_by_month(spark, path).collect()} == {"old"}
    for k in range(3):
        tables.write_by_month(tables.read_by_month(spark, path).withColumn("v", F.lit(str(k))), path)
    assert [r["v"] for r in tables.read_by_month(spark, path).collect()] == ["2", "2"]
    assert len(list((tmp_path / "t/data").iterdir())) == 2


def test_swap_reads_and_replaces_the_same_table(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_table(spark.range(3), path)
    tables.swap_table(tables.read_table(spark, path).filter("id > 0"), path)
    assert tables.read_table(spark, path).count() == 2
    tables.swap_table(tables.read_table(spark, path).filter("id > 9"), path)
    assert tables.read_table(spark, path).count() == 2
    for k in range(3):
        tables.write_table(spark.range(k), path)
    assert tables.read_table(spark, path).count() == 2 and len(list((tmp_path / "t").glob("v*"))) == 2


def test_a_version_counts_only_when_it_is_complete(spark, tmp_path):
    path = tables.table_path(str(tmp_path), "tracks")
    half = schemas.conform(spark.createDataFrame([("new",)], "track_id string"), schemas.TRACKS)
    half.write.parquet(f"{path}/v0000000001")
    with pytest.raises(FileNotFoundError):
        tables.read_silver(spark, str(tmp_path), "tracks")
    old = schemas.conform(spark.createDataFrame([("t1",), ("t2",)], "track_id string"), schemas.TRACKS)
    tables.write_table(old, path)
    half.write.parquet(f"{path}/v0000000002")
    assert tables.read_silver(spark, str(tmp_path), "tracks").count() == 2
    tables.write_table(half, path)
    assert [r["track_id"] for r in tables.read_silver(spark, str(tmp_path), "tracks").collect()] == ["new"]


def test_months_prune_folders(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_by_month(spark.sql("select 'a' v, 2024 year, id as month from range(1, 5)"), path)
    df = tables.only_months(tables.read_by_month(spark, path), [(2024, 2)])
    assert len(df.filter("true").select("v").collect()) == 1
    scan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in scan and "PushedFilters: []" in scan and "Filter (" not in scan
    assert tables.only_months(tables.read_by_month(spark, path), []).count() == 0


def test_cursor_defaults_and_advances(spark, tmp_path):
    path = str(tmp_path / "cursor")
    first = state.read_cursor(spark, path).first()
    assert (first["last_played_at_unix_ms"], first["last_run_timestamp"].year) == (0, 2017)
    plays = spark.createDataFrame([("2023-10-22T18:40:00.500Z",), ("2023-10-01T00:00:00Z",)], "played_at string")
    tables.swap_table(state.advance_cursor(plays, F.lit(datetime(2023, 10, 23))), path)
    assert state.read_cursor(spark, path).first()["last_played_at_unix_ms"] == 1698000000500
    assert state.advance_cursor(plays.limit(0), F.current_timestamp()).count() == 0


def test_latest_attempt_per_key(spark):
    rows = [("k", "found", "1", datetime(2024, 1, 1)), ("k", "not_found", None, datetime(2024, 2, 1))]
    got = state.latest_attempts(spark.createDataFrame(rows, schemas.ATTEMPTS)).collect()
    assert [(r["status"], r["payload"]) for r in got] == [("not_found", None)]


def test_work_lists(spark):
    def encoded(text):
        return base64.b64encode(text.encode()).decode()

    attempts = spark.createDataFrame(
        [(encoded("t1"), "found", None, None), (encoded("a||b"), "found", None, None), ("?", "found", None, None)],
        schemas.ATTEMPTS,
    )
    plays = spark.createDataFrame(
        [("t1", "n", "x"), ("t2", "n", "x"), ("t3", "n", "y"), ("t3", "m", "y"), (None, "n", "x")],
        "track_id string, track_name string, artist_name string",
    )
    known = spark.createDataFrame([("t2",)], "track_id string")
    assert [r["track_id"] for r in worklists.worklist_tracks(plays, known, attempts).collect()] == ["t3"]
    assert [tuple(r) for r in worklists.worklist_track_tags(plays, attempts).collect()] == [
        ("t2", "n", "x"), ("t3", "m", "y"),
    ]
    assert worklists.worklist_track_tags(plays, attempts, size=1).count() == 1


def test_tag_responses(spark):
    raw = [
        ("many", {"track": {"toptags": {"tag": [{"name": n} for n in "Love A B C D E F".split()]}, "listeners": "7", "playcount": "x"}}),
        ("one", {"track": {"toptags": {"tag": {"name": "Rock"}}, "listeners": "7"}}),
        ("noise", {"track": {"toptags": {"tag": [{"name": "Seen Live"}]}}}),
        ("bare", {"track": {}}),
        ("error", {"error": 6, "message": "none"}),
        ("list", [1]), ("holder", {"track": {"toptags": ""}}),
    ]
    df = spark.createDataFrame([(k, json.dumps(r)) for k, r in raw] + [("text", "oops"), ("null", None)], "track_id string, response string")
    got = {r["track_id"]: r for r in responses.parse_track_tags(df).collect()}
    assert {k for k, r in got.items() if r["not_found"]} == {"many", "error", "list", "text", "null", "holder"}
    assert (got["one"]["tags"], got["one"]["top_tag"], got["one"]["listeners"], got["one"]["playcount"]) == (["rock"], "rock", 7, 0)
    assert (got["noise"]["tags"], got["noise"]["top_tag"]) == ([], None)
    assert got["bare"]["tags"] == [] and got["error"]["tags"] is None
    plain = df.withColumnRenamed("track_id", "artist_id").withColumn(
        "response", F.when(F.col("artist_id") == "one", '{"toptags": {"tag": {"name": "Jazz"}}}').otherwise(F.col("response"))
    )
    assert {r["artist_id"]: r["top_tag"] for r in responses.parse_artist_tags(plain).collect()}["one"] == "jazz"


# ---------------------------------------------------------------- jobs


def test_bronze_to_gold_and_back_through_the_catalogue(spark, tmp_path):
    root, dump = str(tmp_path / "lake"), str(tmp_path / "dump")
    make_lake(tmp_path / "lake")
    make_dump(spark, dump)
    jobs.transform_gold(spark, root, str(tmp_path / "w1"))

    def events():
        rows = tables.read_silver(spark, root, "listening_events").collect()
        return {(r["track_name"], r["played_at_utc"].month): (r["source_type"], r["track_id"]) for r in rows}

    assert events() == {
        ("One", 1): ("api", "t1"), ("Two", 1): ("api", "t2"), ("Two", 2): ("extended_export", "t2"),
        ("Three", 2): ("export", None),
    }

    jobs.enrich_from_catalogue(spark, root, dump, str(tmp_path / "w2"))
    t1 = tables.read_silver(spark, root, "tracks").filter("track_id = 't1'").first()
    assert (t1["isrc"], t1["popularity"], t1["disc_number"]) == ("I1", 77, 4)
    ann = tables.read_silver(spark, root, "artists").filter("artist_id = 'a1'").first()
    assert (ann["genres"], ann["followers_total"], ann["popularity"]) == (["art", "pop"], 30, 40)
    assert tables.read_silver(spark, root, "audio_features").select("track_id", "energy").collect() == [("t1", 0.75)]

    bad = spark.read.parquet(f"{root}/quarantine/track_markers").collect()
    assert [r["_source_file"].rsplit("/", 1)[1] for r in bad] == ["broken.json"]

    # The next build applies the resolved id and keeps what only the catalogue knows.
    jobs.transform_gold(spark, root, str(tmp_path / "w3"))
    assert events()[("Three", 2)] == ("export", "x9")
    t1 = tables.read_silver(spark, root, "tracks").filter("track_id = 't1'").first()
    assert (t1["isrc"], t1["popularity"], t1["disc_number"]) == ("I1", 77, 4)
    album = tables.read_silver(spark, root, "albums").first()
    assert (album["label"], album["upc"], album["popularity"]) == ("Label", "UPC", 33)
    x9 = tables.read_silver(spark, root, "tracks").filter("track_id = 'x9'").first()
    assert (x9["explicit"], x9["disc_number"], x9["isrc"]) == (True, None, "I9")

    # A second run finds nothing new to resolve, fills the new track and duplicates no column.
    jobs.enrich_from_catalogue(spark, root, dump, str(tmp_path / "w4"))
    assert state.read_attempts(spark, jobs.attempts_path(root, "track_markers")).count() == 1
    assert tables.read_silver(spark, root, "tracks").filter("track_id = 'x9'").first()["disc_number"] == 2
    assert tables.read_table(spark, tables.table_path(root, "artists")).columns == schemas.ARTISTS.names

    fact = tables.read_gold(spark, root, "fact_plays")
    assert fact.count() == 4 and fact.select("year", "month").distinct().count() == 2
    days = tables.read_gold(spark, root, "agg_daily").orderBy("date").collect()
    assert [(r["total_plays"], r["skip_count"], r["complete_plays"]) for r in days] == [(2, 0, 0), (1, 0, 1), (1, 0, 1)]
    months = tables.read_gold(spark, root, "agg_monthly").orderBy("month").collect()
    assert [(r["total_plays"], r["new_artists"]) for r in months] == [(2, 2), (2, 1)]


def test_gold_is_the_same_for_broadcast_shuffled_and_spread_lookups(spark, tmp_path):
    make_lake(tmp_path / "lake")
    root = str(tmp_path / "lake")
    jobs.build_silver(spark, root, str(tmp_path / "w0"))
    seen = []
    for i, (limit, hot_rows) in enumerate([(jobs.BROADCAST_BYTES, 2), (0, jobs.HOT_ROWS), (0, 2)]):
        jobs.build_gold(spark, root, str(tmp_path / f"w{i + 1}"), limit, hot_rows)
        seen.append(sorted(map(str, tables.read_gold(spark, root, "fact_plays").collect())))
    assert seen[0] == seen[1] == seen[2]
    assert not (tmp_path / "w1/hot_track_id").exists() and (tmp_path / "w3/hot_track_id").exists()


def test_a_lookup_is_broadcast_only_up_to_its_limit(spark, tmp_path):
    lookup = spark.range(100).withColumnRenamed("id", "k")
    facts = spark.range(10).withColumnRenamed("id", "k")
    size = 0
    for limit in (10**6, 0):
        side, large = jobs.stage_lookup(lookup, str(tmp_path / "x"), limit)
        size = tables.stored_bytes(spark, str(tmp_path / "x"))
        assert large == (jobs.EXPANSION * size > limit)
        hinted = "broadcast" in facts.join(side, "k", "left")._jdf.queryExecution().analyzed().toString()
        assert hinted != large
    assert size > 0


def test_ingest_lands_new_valid_plays_once(spark, tmp_path):
    landing, root = tmp_path / "landing", str(tmp_path / "lake")
    put(landing / "1.json", [play("2024-01-01T10:00:00Z", "t1", "One", A), {"played_at": "2024-01-01T11:00:00Z", "track": {"id": "bad"}},
                             play("some day", "t9", "Nine", A)])
    put(landing / "cut.json", '[{"played_at": "2024')
    jobs.ingest_increment(spark, str(landing), root, str(tmp_path / "w1"))
    jobs.ingest_increment(spark, str(landing), root, str(tmp_path / "w2"))
    put(landing / "2.json", [play("2024-01-02T10:00:00Z", "t2", "Two", B)])
    jobs.ingest_increment(spark, str(landing), root, str(tmp_path / "w3"), run_at=F.lit(datetime(2024, 3, 4, 5, 6, 7)))
    rejected = spark.read.parquet(f"{root}/quarantine/plays_rejected").collect()
    assert sorted(json.loads(r["_record"])["track"]["id"] for r in rejected if r["_record"]) == ["bad", "t9"]
    assert [r["_source_file"][-8:] for r in rejected if r["_corrupt_record"] == "not JSON"] == ["cut.json"]
    plays = bronze.read_plays(spark, jobs.bronze_path(root, "plays"))
    assert sorted(r["played_at"] for r in plays.collect()) == ["2024-01-01T10:00:00Z", "2024-01-02T10:00:00Z"]
    assert list((tmp_path / "lake").glob("bronze/*/*/year=2024/month=03/day=04/*.txt"))
    cursor = state.read_cursor(spark, f"{root}/{schemas.STATE_PATH}").first()
    assert cursor["last_played_at_unix_ms"] == 1704189600000

    put(landing / "3.json", [play("2024-01-03T10:00:00Z", "t3", "Three", B)])
    jobs.run_all(spark, str(landing), root, str(tmp_path / "w4"))
    heard = tables.read_silver(spark, root, "listening_events").orderBy("played_at_utc").collect()
    assert [r["track_id"] for r in heard] == ["t1", "t2", "t3"]


def test_ingest_opens_only_files_that_came_since_the_last_run(spark, tmp_path):
    root, landing, work = str(tmp_path / "lake"), tmp_path / "landing", str(tmp_path / "w")
    cursor_path = f"{root}/{schemas.STATE_PATH}"
    for k in range(5):
        put(landing / f"{k}.json", [play(f"2024-01-0{k + 1}T10:00:00Z", f"t{k}", f"n{k}", A)])
    assert len(jobs.new_records(spark, str(landing), state.read_cursor(spark, cursor_path)).inputFiles()) == 5
    jobs.ingest_increment(spark, str(landing), root, work)
    for k in range(5):
        os.utime(landing / f"{k}.json", (1_700_000_000, 1_700_000_000))
    put(landing / "5.txt", json.dumps([play("2024-02-01T10:00:00Z", "t9", "n9", A), play("2024-01-01T10:00:00Z", "t0", "n0", A)]))
    opened = jobs.new_records(spark, str(landing), state.read_cursor(spark, cursor_path)).inputFiles()
    assert [f.rsplit("/", 1)[1] for f in opened] == ["5.txt"]
    stored = spark.read.parquet(tables.current_version(spark, cursor_path)).collect()
    jobs.ingest_increment(spark, str(landing), root, work)
    # The same run once more, as if it had broken off before the cursor moved: nothing lands twice.
    tables.write_table(spark.createDataFrame(stored, schemas.CURSOR), cursor_path)
    put(tmp_path / f"lake/system/landing/after-{stored[0]['last_played_at_unix_ms']}", "")
    jobs.ingest_increment(spark, str(landing), root, work)
    landed = bronze.read_plays(spark, jobs.bronze_path(root, "plays"))
    assert sorted(r["track"]["id"] for r in landed.collect()) == ["t0", "t1", "t2", "t3", "t4", "t9"]


def test_raw_files_of_any_size_are_kept_byte_for_byte(spark, tmp_path):
    content = {"Streaming_History_1.json": bytes(range(256)) * 40, "StreamingHistory_2.json": b"x" * 1000, "Userdata.json": b"no"}
    (tmp_path / "in").mkdir()
    for name, data in content.items():
        (tmp_path / "in" / name).write_bytes(data)
    bronze.keep_raw_files(spark, str(tmp_path / "in"), str(tmp_path / "kept"), size=1000)
    kept = spark.read.parquet(str(tmp_path / "kept"))
    rows = {(r["path"].rsplit("/", 1)[1], r["offset"]) for r in kept.collect()}
    assert rows == {("StreamingHistory_2.json", 0), *[("Streaming_History_1.json", k * 1000) for k in range(11)]}
    for path in {r["path"] for r in kept.collect()}:
        assert b"".join(bronze.raw_content(kept, path)) == content[path.rsplit("/", 1)[1]]


def test_look_up_batches_are_recorded_and_not_asked_again(spark, tmp_path):
    root = tmp_path / "lake"
    make_lake(root)
    export = root / schemas.BRONZE_PATHS["exports"] / "Streaming_History_Audio_2025_1.json"
    unknown = [
        {"ts": f"2025-01-0{i}T10:00:00Z", "master_metadata_track_name": f"N{i}", "ms_played": 1,
         "master_metadata_album_artist_name": "Ann", "spotify_track_uri": f"spotify:track:n{i}"} for i in (1, 2, 3)
    ]
    put(export, unknown)
    done = base64.b64encode(b"n3").decode()
    put(root / schemas.BRONZE_PATHS["track_markers"] / f"{done}.json", {"not_found": True})
    jobs.build_silver(spark, str(root), str(tmp_path / "w1"))
    asked = jobs.next_lookups(spark, str(root), tracks=5)
    assert [r["track_id"] for r in asked["track_markers"].collect()] == ["n1", "n2"]
    assert [r["artist_id"] for r in asked["artist_tag_markers"].collect()] == ["a1", "b1"]

    answers = {"n1": json.dumps(track("n1", "N1", A, external_ids={"isrc": "I"})), "n2": json.dumps({"id": "n2"})}
    raw = spark.createDataFrame(list(answers.items()), "track_id string, response string")
    jobs.record_responses(raw, str(root), "track_markers", str(tmp_path / "w2"))
    tag = spark.createDataFrame(
        [("a1", '{"toptags": {"tag": {"name": "Folk"}}}'), ("b1", '{"error": 6}')], "artist_id string, response string"
    )
    jobs.record_responses(tag, str(root), "artist_tag_markers", str(tmp_path / "w3"))

    jobs.build_silver(spark, str(root), str(tmp_path / "w4"))
    n1 = tables.read_silver(spark, str(root), "tracks").filter("track_id = 'n1'").first()
    assert (n1["track_name"], n1["isrc"]) == ("N1", "I")
    top = {r["artist_id"]: r["top_tag"] for r in tables.read_silver(spark, str(root), "artist_tags").collect()}
    assert top == {"a1": "folk", "z1": None}
    again = jobs.next_lookups(spark, str(root))
    assert again["track_markers"].count() == 0 and again["artist_tag_markers"].count() == 0
    kept = state.read_attempts(spark, jobs.attempts_path(str(root), "track_markers")).collect()
    assert {r["status"] for r in kept} == {"found", "not_found"}


# ---------------------------------------------------------------- streams


def stream_event(at, name, source, track_id=None):
    row = {"played_at_utc": at, "track_name": name, "source_type": source, "track_id": track_id}
    return tuple(row.get(c) for c in schemas.EVENTS.names)


def test_upsert_replaces_only_touched_months_and_can_be_repeated(spark, tmp_path):
    table, work = str(tmp_path / "t"), str(tmp_path / "w")
    jan, feb = datetime(2024, 1, 1), datetime(2024, 2, 1)
    first = spark.createDataFrame([stream_event(jan, "a", "export"), stream_event(feb, "b", "export")], schemas.EVENTS)
    second = spark.createDataFrame([stream_event(jan, "a", "api", "1"), stream_event(jan, "c", "api", "2")], schemas.EVENTS)
    upsert.upsert_batch(first, table, work)
    untouched = sorted((tmp_path / "t/data").glob("*/year=2024/month=2/*.parquet"))
    for batch in (second, second, first):
        upsert.upsert_batch(batch, table, work)
        got = {(r["track_name"], r["source_type"], r["month"]) for r in upsert.read_events(spark, table).collect()}
        assert got == {("a", "api", 1), ("b", "export", 2), ("c", "api", 1)}
        assert batch is first or sorted((tmp_path / "t/data").glob("*/year=2024/month=2/*.parquet")) == untouched


def test_a_late_play_reads_and_writes_one_bucket_of_its_month(spark, tmp_path):
    table, work = str(tmp_path / "t"), str(tmp_path / "w")
    month = [stream_event(datetime(2024, 1, 1, k % 24, k % 60), f"n{k}", "export") for k in range(400)]
    other = stream_event(datetime(2024, 2, 1), "x", "export")
    for size in (10**9, 10):  # the second time what is there is too large for one bucket
        upsert.upsert_batch(spark.createDataFrame([*month, other], schemas.EVENTS), table, work, size)
    before = {p.place: p.write for p in tables.live_parts(spark, table)}
    assert {place for place in before if place[1] == 1} == {(2024, 1, k) for k in range(upsert.CUT)}
    late = spark.createDataFrame([stream_event(datetime(2024, 1, 1, 7, 7), "n7", "api", "t7")], schemas.EVENTS)
    dated = late.withColumns({"year": F.lit(2024), "month": F.lit(1)})
    parts = upsert.touched_parts(dated, tables.live_parts(spark, table))
    assert len(parts) == 1 and all(parts[0].folder in f for f in tables.read_parts(spark, table, parts).inputFiles())
    upsert.upsert_batch(late, table, work)
    after = {p.place: p.write for p in tables.live_parts(spark, table)}
    assert set(after) == set(before) and [p for p in after if after[p] != before[p]] == [parts[0].place]
    rows = upsert.read_events(spark, table).collect()
    assert len(rows) == 401 and [r["track_id"] for r in rows if r["source_type"] == "api"] == ["t7"]
    upsert.upsert_batch(late, table, work, 10)
    assert sum(p.month == 1 for p in tables.live_parts(spark, table)) > upsert.CUT and upsert.read_events(spark, table).count() == 401


def test_whole_months_can_be_upserted_and_written_whole_again(spark, tmp_path):
    table, work = str(tmp_path / "t"), str(tmp_path / "w")
    rows = [stream_event(datetime(2024, m, 1), n, "export") for m in (1, 2) for n in ("a", "b", "c")]
    first = spark.createDataFrame(rows, schemas.EVENTS).withColumns({"year": F.year("played_at_utc"), "month": F.month("played_at_utc")})
    tables.write_by_month(first, table)
    upsert.upsert_batch(spark.createDataFrame([stream_event(datetime(2024, 1, 1), "a", "api", "1")], schemas.EVENTS), table, work, 1)
    assert {p.month for p in tables.live_parts(spark, table) if p.bucket is None} == {2} and upsert.read_events(spark, table).count() == 6
    tables.write_by_month(upsert.read_events(spark, table), table)
    assert [p.bucket for p in tables.live_parts(spark, table)] == [None, None] and upsert.read_events(spark, table).count() == 6
    assert tables.read_by_month(spark, table, schemas.EVENTS_PARTITIONED, [(2024, 2)]).count() == 3


def test_of_two_writers_from_one_version_the_second_gets_an_error(spark, tmp_path, monkeypatch):
    path, other = str(tmp_path / "t"), []
    tables.write_table(spark.range(3), path)
    real = tables.mark

    def mark_late(session, where, text=""):
        if where.endswith("v0000000002") and not other:
            other.append(1)  # another job finishes between this one's last file and its marker
            tables.write_table(spark.range(50), path)
        real(session, where, text)

    monkeypatch.setattr(tables, "mark", mark_late)
    with pytest.raises(tables.ConcurrentWrite):
        tables.write_table(spark.range(7), path)
    assert tables.read_table(spark, path).count() == 50 and len(list((tmp_path / "t").glob("v*"))) == 2


def test_writers_of_different_months_both_get_on_and_of_one_month_only_the_first(spark, tmp_path, monkeypatch):
    path, real, turns = str(tmp_path / "t"), tables._switch, []

    def month(value, number):
        return spark.sql(f"select '{value}' v, 2024 year, {number} as month")

    def switch_late(*args):
        if turns:
            tables.write_by_month(turns.pop(), path)
        real(*args)

    tables.write_by_month(month("old", 1), path)
    monkeypatch.setattr(tables, "_switch", switch_late)
    turns.append(month("b", 2))
    tables.write_by_month(month("a", 1), path)
    assert sorted(r["v"] for r in tables.read_by_month(spark, path).collect()) == ["a", "b"]
    turns.append(month("other", 1))
    with pytest.raises(tables.ConcurrentWrite):
        tables.write_by_month(month("mine", 1), path)
    assert sorted(r["v"] for r in tables.read_by_month(spark, path).collect()) == ["b", "other"]


def test_only_live_folders_are_opened(spark, tmp_path):
    path = str(tmp_path / "t")
    for k in range(3):
        tables.write_by_month(spark.sql(f"select {k} v, 2024 year, id as month from range(1, {5 - k})"), path)
    files = tables.read_by_month(spark, path).inputFiles()
    live = {p.folder for p in tables.live_parts(spark, path)}
    assert len({f.split("/data/")[1].rsplit("/", 1)[0] for f in files} ^ live) == 0 and len(live) == 4
    assert len(tables.read_by_month(spark, path, months=[(2024, 2)]).inputFiles()) == 1


def test_upsert_starts_anew_with_a_new_checkpoint(spark, tmp_path):
    source, table, work = (str(tmp_path / n) for n in ("in", "t", "w"))
    for k in (1, 2):
        spark.createDataFrame([stream_event(datetime(2024, k, 1), f"n{k}", "api")], schemas.EVENTS).write.mode("append").parquet(source)
        stream = ingest.stream_files(spark, source, schemas.EVENTS, fmt="parquet")
        upsert.upsert_available(stream, table, work, str(tmp_path / f"cp{k}"))
    assert {r["track_name"] for r in upsert.read_events(spark, table).collect()} == {"n1", "n2"}


def test_stream_lands_each_file_once_and_keeps_bad_lines_apart(spark, tmp_path):
    source, target, checkpoint, bad = (str(tmp_path / n) for n in ("in", "out", "cp", "bad"))
    schema = schemas.struct(k=schemas.TEXT, n=schemas.LONG)
    for wave in ("a", "b"):
        spark.createDataFrame([(wave, 1)], schema).write.mode("append").json(source)
        put(tmp_path / "in" / f"{wave}.json", '{"k": "cut\n{"k": "typed", "n": "x"}\n')
        ingest.land_available(ingest.stream_files(spark, source, schema), target, checkpoint, bad)
    ingest.land_available(ingest.stream_files(spark, source, schema), target, checkpoint, bad)
    assert sorted(r["k"] for r in spark.read.parquet(target).collect()) == ["a", "b"]
    assert spark.read.parquet(bad).count() == 4


def test_streamed_plays_reach_the_silver_tables(spark, tmp_path):
    landing, root, checkpoint = tmp_path / "landing", str(tmp_path / "lake"), str(tmp_path / "cp")
    put(landing / "1.json", [play("2024-01-01T10:00:00Z", "t1", "One", A), play("no time", "t9", "Nine", A)])
    jobs.ingest_stream(spark, str(landing), root, checkpoint)
    put(landing / "2.json", [play("2024-01-02T10:00:00Z", "t2", "Two", B, duration_ms="long"), play("2024-01-02T11:00:00Z", "t3", "Three", B)])
    jobs.ingest_stream(spark, str(landing), root, checkpoint)
    jobs.build_silver(spark, root, str(tmp_path / "w"))
    heard = tables.read_silver(spark, root, "listening_events").orderBy("played_at_utc").collect()
    assert [r["track_id"] for r in heard] == ["t1", "t3"]
    bad = spark.read.parquet(f"{root}/quarantine/plays_streamed").collect()
    assert sorted(r["_corrupt_record"] for r in bad) == ["against the play rules", "badly typed: track"]
    counts = {r["table_name"]: r["rows"] for r in jobs.report(spark, root).collect()}
    assert counts["listening_events"] == 2 and counts["tracks"] == 2
    assert {r["table_name"] for r in jobs.profile_lake(spark, root).collect()} >= {"tracks", "artists"}


def test_catalogue_rows_that_repeat_an_id_multiply_nothing(spark, tmp_path):
    make_dump(spark, str(tmp_path / "dump"))
    catalogue = read_catalogue(spark, str(tmp_path / "dump"))
    twice = replace(catalogue, tracks=catalogue.tracks.union(catalogue.tracks.withColumn("popularity", F.lit(1).cast("bigint"))))
    tracks = schemas.conform(spark.createDataFrame([("t1",), ("zz",)], "track_id string"), schemas.TRACKS)
    assert enrichment.enrich_tracks(tracks, twice).count() == 2


def test_pairs_with_the_separator_in_a_name_are_not_asked_again(spark):
    events = spark.createDataFrame([(None, "A||B", "T"), (None, "C", "U")], "track_id string, artist_name string, track_name string")
    key = base64.b64encode(b"A||B||T").decode()
    attempts = spark.createDataFrame([(key, "not_found", None, None)], schemas.ATTEMPTS)
    assert [r["artist_name"] for r in enrichment.pairs_to_resolve(events, attempts).collect()] == ["C"]


def test_refresh_equals_a_rebuild_and_leaves_other_months_alone(spark, tmp_path):
    lake, work, cp = tmp_path / "lake", str(tmp_path / "w"), str(tmp_path / "cp")
    root, plays = str(lake), lake / schemas.BRONZE_PATHS["plays"]
    make_lake(lake)

    def months():
        """Which write holds each month."""
        held = tables.read_table(spark, f"{root}/silver/listening_events/months").collect()
        return {f"month={r['month']}": r["write"] for r in held}

    def silver_rows():
        names = [n for n in schemas.SILVER_SCHEMAS if n != "audio_features"]
        return {n: sorted(map(repr, tables.read_silver(spark, root, n).collect())) for n in names}

    jobs.refresh_silver(spark, root, work, cp)
    first = months()
    assert set(first) == {"month=1", "month=2"}
    jobs.refresh_silver(spark, root, work, cp)
    assert months() == first  # nothing new, nothing written

    # A second day: one play of March as an array, one of February as a line, each with a bad record; files older than the others.
    put(plays / "b.json", [play("2024-03-01T10:00:00Z", "t5", "Five", A), play("2024-03-01T11:00:00Z", "t9", "Nine", B, duration_ms="long")])
    put(plays / "c.txt", json.dumps(play("2024-02-02T10:00:00Z", "t2", "Two", B)) + '\n{"played_at": "cut')
    for name in ("b.json", "c.txt"):
        os.utime(plays / name, (1_000_000_000, 1_000_000_000))
    jobs.refresh_silver(spark, root, work, cp)
    second = months()
    assert second["month=1"] == first["month=1"] and second["month=2"] != first["month=2"] and "month=3" in second
    bad = spark.read.parquet(f"{root}/quarantine/plays_parsed").collect()
    assert sorted(r["_corrupt_record"] for r in bad) == ["badly typed: track", "not JSON"]

    # A look-up names a track that was heard in February.
    put(lake / schemas.BRONZE_PATHS["track_markers"] / "late.json", {"search_artist_name": "Cyd", "search_track_name": "Three", "track": track("t3", "Three", B)})
    jobs.refresh_silver(spark, root, work, cp)
    third, rows = months(), silver_rows()
    # Nothing of the batches is left to be read again: a write for each month, and one row for each key.
    assert not list((lake / "parsed").glob("*/batch=*")) and len(list((lake / "parsed/kept/data").glob("*/*/*"))) <= 6
    assert third["month=1"] == first["month=1"] and third["month=3"] == second["month=3"] and third["month=2"] != second["month=2"]
    assert any("Three" in r and "'t3'" in r for r in rows["listening_events"])

    jobs.refresh_silver(spark, root, work, str(tmp_path / "another"))  # everything is read again
    assert silver_rows() == rows
    jobs.build_silver(spark, root, work)
    assert silver_rows() == rows
    assert not (tmp_path / "w/plays").exists() and not (tmp_path / "w/refresh").exists()


def test_copies_hold_what_silver_takes_and_records_are_judged_by_all_fields(spark, tmp_path):
    root, plays, handed = str(tmp_path / "lake"), tmp_path / "lake" / schemas.BRONZE_PATHS["plays"], []
    bad = play("2024-01-01T11:00:00Z", "t2", "Two", B)
    bad["track"]["album"]["artists"] = "no list"
    put(plays / "b.txt", json.dumps({**play("2024-01-02T10:00:00Z", "t3", "Three", B), "context": None}) + "\n" + json.dumps(bad))
    cp, work, unread = (str(tmp_path / n) for n in ("cp", "w", "unread"))

    def keep(records, folder):
        handed.append((records.schema, bronze.plays_only(records).collect()))

    parse.parse_available(spark, str(plays), schemas.PLAY, schemas.PLAY_TAKEN, keep, unread, cp, work)
    staged = jobs.stage_bronze(spark, root, "plays", schemas.PLAY, work)
    handed.append((staged.schema, bronze.plays_only(staged).collect()))
    assert len(handed) == 2
    for schema, rows in handed:
        assert schema["track"].dataType.names == schemas.PLAY_TAKEN["track"].dataType.names and "href" not in schema["context"].dataType.names
        assert [(r["track"]["id"], r["track"]["artists"][0]["name"], r["context"]) for r in rows] == [("t3", "Bob", None)]
    for path in (unread, jobs.quarantine_path(root, "plays")):
        rows = spark.read.parquet(path).collect()
        assert [r["_corrupt_record"] for r in rows] == ["badly typed: track"] and "no list" in rows[0]["_record"]


def test_batches_of_events_are_plain_and_those_by_month_are_still_merged(spark, tmp_path):
    parsed, at = str(tmp_path / "parsed"), [datetime(2024, k, 1) for k in (1, 2, 3)]
    events = [spark.createDataFrame([stream_event(t, f"n{t.month}", "api")], schemas.EVENTS) for t in at]
    parse.keep_batch({"events": events[0].unionByName(events[1])}, parsed, "batch=a-0")
    assert not list((tmp_path / "parsed/events/batch=a-0").glob("year=*"))
    old = events[2].withColumns({"year": F.year("played_at_utc"), "month": F.month("played_at_utc")})
    old.write.partitionBy("year", "month").parquet(f"{parsed}/events/batch=b-0")
    merge = parse.Merge(spark, parsed)
    months = merge.keep_events()
    assert sorted(months) == [(2024, 1), (2024, 2), (2024, 3)]
    kept = {(r["track_name"], r["year"], r["month"]) for r in merge.kept_events(months).collect()}
    assert kept == {("n1", 2024, 1), ("n2", 2024, 2), ("n3", 2024, 3)}


def test_a_batch_of_plays_or_exports_is_one_copy_whose_unreadable_records_are_no_events(spark, tmp_path):
    lake, parsed, handed = tmp_path / "lake", str(tmp_path / "parsed"), []
    make_lake(lake)
    bad = {"played_at": "cut", "track": {"id": 1, "duration_ms": "long"}}
    put(lake / schemas.BRONZE_PATHS["plays"] / "c.txt", "\n".join(map(json.dumps, [bad, {}, play("2024-03-01T10:00:00Z", "t2", "Two", B)])))
    put(lake / schemas.BRONZE_PATHS["exports"] / "StreamingHistory1.txt", json.dumps([{"endTime": "no time", "msPlayed": "x", "trackName": "X"}, {"endTime": "2024-03-02 10:00"}]))
    for name, shape in (("plays", parse.played), ("exports", parse.exported)):
        paths = [str(tmp_path / f"{name}-{what}") for what in ("bad", "cp", "work")]
        schema, taken = jobs.BRONZE_SCHEMAS[name], jobs.TAKEN[name]
        parse.parse_available(spark, jobs.bronze_path(str(lake), name), schema, taken, lambda df, at: handed.append((df.count(), at)), *paths, shape, f"{parsed}/events")
        assert [r["_corrupt_record"] for r in spark.read.parquet(paths[0]).collect()] == [{"plays": "badly typed: track", "exports": "badly typed: msPlayed"}[name]]
    assert sorted(n for n, _ in handed) == [1, 2, 2, 4] and {at for _, at in handed} == {f.name for f in (tmp_path / "parsed/events").iterdir()}
    merge = parse.Merge(spark, parsed)
    assert sorted(merge.keep_events()) == [(2024, 1), (2024, 2), (2024, 3)]
    rows = merge.kept_events([(2024, k) for k in (1, 2, 3)]).collect()
    assert sorted((r["source_type"], r["track_name"], r["month"]) for r in rows) == [
        ("api", "One", 1), ("api", "Two", 1), ("api", "Two", 3), ("export", "One", 1), ("export", "Three", 2),
        ("extended_export", "One", 1), ("extended_export", "Two", 2),
    ]


def test_kept_events_are_shuffled_once_into_pieces_of_their_months(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(parse, "PIECE_ROWS", 40)
    at = F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") % 100 * 86_400).cast("timestamp_ntz")
    plays = spark.range(200, numPartitions=1).select(at.alias("played_at_utc"), F.lit("n").alias("track_name"), F.lit("api").alias("source_type"))
    parse.keep_batch({"events": schemas.conform(plays, schemas.EVENTS)}, str(tmp_path), "batch=a-0")
    merge = parse.Merge(spark, str(tmp_path))
    once = parse._each_once(merge._new("events", schemas.EVENTS_PARTITIONED))
    assert once._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1
    months = merge.keep_events()
    assert len(months) == 4 and merge.kept_events(months).count() == 100
    files = list((tmp_path / "kept/data").rglob("*.parquet"))
    assert 4 < len(files) <= 8  # two pieces of a month that has more than 40 rows
    merge.keep_events()
    assert merge.kept_events(months).count() == 100


def test_tables_that_need_no_other_are_written_at_once(spark, tmp_path, monkeypatch):
    make_lake(tmp_path / "lake")
    together, write = threading.Barrier(2, timeout=90), jobs.write_table

    def met(df, path, *args):
        if path.endswith(("agg_daily", "agg_monthly")):
            together.wait()
        write(df, path, *args)

    monkeypatch.setattr(jobs, "write_table", met)
    root, work = str(tmp_path / "lake"), str(tmp_path / "w")
    jobs.refresh_all(spark, root, work, str(tmp_path / "cp"))
    assert tables.read_gold(spark, root, "agg_monthly").count() == 2 and tables.read_gold(spark, root, "agg_daily").count() == 3


def test_refresh_of_an_empty_lake_writes_nothing(spark, tmp_path):
    jobs.refresh_silver(spark, str(tmp_path / "lake"), str(tmp_path / "w"), str(tmp_path / "cp"))
    assert not list((tmp_path / "lake/silver").glob("*"))


def test_gold_of_what_changed_equals_a_full_build(spark, tmp_path):
    lake, work, cp = tmp_path / "lake", str(tmp_path / "w"), str(tmp_path / "cp")
    root, plays = str(lake), lake / schemas.BRONZE_PATHS["plays"]
    make_lake(lake)

    def stored(name):
        return {p.place: p.write for p in tables.live_parts(spark, tables.table_path(root, name))}

    def gold_rows():
        def plain(row):
            return tuple(round(x, 9) if isinstance(x, float) else x for x in row)

        return {n: sorted(map(repr, map(plain, tables.read_gold(spark, root, n).collect()))) for n in jobs.GOLD}

    def versions():
        return {n: tables.current_version(spark, tables.table_path(root, n)) for n in ("dim_tracks", "agg_daily")}

    january, february, march = ((2024, k) for k in (1, 2, 3))
    assert set(jobs.refresh_all(spark, root, work, cp)) == {january, february}
    first = stored("fact_plays"), stored("partials"), versions()
    assert jobs.refresh_gold(spark, root, work) == [] and (stored("fact_plays"), stored("partials"), versions()) == first

    # One day lands, of tracks and artists that are known or unknown to other months.
    put(plays / "day.json", [play("2024-03-01T10:00:00Z", "t5", "Five", C), play("2024-03-01T11:00:00Z", "t6", "Six", C)])
    assert jobs.refresh_all(spark, root, work, cp) == [march]
    for name, before in zip(("fact_plays", "partials"), first, strict=False):
        after = stored(name)
        assert {p: w for p, w in after.items() if p[:2] != march} == before and (*march, None) in after

    # A look-up row that changes reaches every month with its track, and no other.
    tracks = tables.read_silver(spark, root, "tracks")
    tables.swap_table(tracks.withColumn("popularity", F.when(F.col("track_id") == "t5", 99).otherwise(F.col("popularity"))), tables.table_path(root, "tracks"))
    assert jobs.refresh_gold(spark, root, work) == [march]
    changed = gold_rows()
    jobs.build_gold(spark, root, work)
    assert gold_rows() == changed and "99" in str([r for r in changed["agg_track_stats"] if "'t5'" in r])
