"""Joins, dedup and aggregates on hand-made rows, and the shape of their plans."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tapedeck import schemas
from tapedeck.functions import measures
from tapedeck.operators import dedup, joins, sets
from tapedeck.operators.ordering import first_by_order, first_values
from tapedeck.plans import gold, silver

NOON = datetime(2024, 5, 1, 12)


def events(spark, *plays):
    """Events from dicts; what a dict leaves out is null."""
    base = {"played_at_utc": NOON, "track_name": "song", "source_type": "export", "duration_ms": 1000}
    rows = [tuple({**base, **p}.get(c) for c in schemas.EVENTS.names) for p in plays]
    return spark.createDataFrame(rows, schemas.EVENTS)


def fact(spark, plays, tracks=(), albums=(), artists=(), tags=(), features=()):
    def table(rows, schema):
        return spark.createDataFrame([tuple(r.get(c) for c in schema.names) for r in rows], schema)

    return gold.fact_plays(
        events(spark, *plays),
        gold.track_lookup(
            table(tracks, schemas.TRACKS), table(albums, schemas.ALBUMS), table(features, schemas.FEATURES)
        ),
        gold.artist_lookup(table(artists, schemas.ARTISTS), table(tags, schemas.ARTIST_TAGS)),
    )


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ---------------------------------------------------------------- dedup


def test_best_source_wins(spark):
    got = dedup.dedup_by_priority(
        events(spark, {"source_type": "export"}, {"source_type": "extended_export"}, {"source_type": "api"})
    )
    assert [r["source_type"] for r in got.collect()] == ["api"]


def test_same_title_of_two_artists_collapses_to_the_smaller_id(spark):
    got = dedup.dedup_by_priority(
        events(
            spark,
            {"artist_name": "a", "track_id": "9"},
            {"artist_name": "b", "track_id": "1"},
            {"artist_name": "c", "track_id": None},
        )
    )
    assert [(r["artist_name"], r["track_id"]) for r in got.collect()] == [("b", "1")]


def test_missing_names_form_one_group(spark):
    got = dedup.dedup_by_priority(events(spark, {"track_name": None, "track_id": "2"}, {"track_name": None, "track_id": "1"}))
    assert [r["track_id"] for r in got.collect()] == ["1"]


def test_dedup_reduces_before_the_shuffle(spark, sf_dir):
    from tapedeck.registry.views import Views

    p = plan(dedup.dedup_by_priority(Views(spark, sf_dir).plays))
    below = p[p.index("Exchange hashpartitioning") :]
    assert "WindowGroupLimit" in below and "Partial" in below


def test_dimension_dedup_takes_the_smallest_row_nulls_last(spark):
    df = spark.createDataFrame([("1", None, "z"), ("1", "b", "a"), ("1", "b", None)], "id string, x string, y string")
    assert [tuple(r) for r in dedup.dedup_subset(df, ["id"]).collect()] == [("1", "b", "a")]


def test_top1_ties_and_nulls(spark):
    df = spark.createDataFrame(
        [(1, "b"), (1, "a"), (1, "b"), (1, "a"), (2, None), (2, None), (2, None), (2, "a"), (3, None), (3, "x")],
        "day int, artist string",
    )
    got = {r["day"]: r["top"] for r in dedup.top1_by_count(df, ["day"], "artist", "top").collect()}
    assert got == {1: "a", 2: None, 3: "x"}


# ---------------------------------------------------------------- joins


def test_anti_join_drops_null_keys(spark):
    keys = spark.createDataFrame([(None,), (1,), (2,)], "k int")
    known = spark.createDataFrame([(1,), (None,)], "k int")
    assert [r["k"] for r in joins.anti_join(keys, known, ["k"]).collect()] == [2]


def test_missing_keys(spark):
    wanted = spark.createDataFrame([(1,), (1,), (2,), (3,), (None,)], "k int")
    got = sets.missing_keys(wanted, spark.createDataFrame([(2,)], "k int"), spark.createDataFrame([(9,)], "k int"))
    assert sorted(r["k"] for r in got.collect()) == [1, 3]


def test_repeated_mapping_keys(spark):
    mapping = spark.createDataFrame(
        [("a", "song", "7"), ("a", "song", "3"), (None, "song", "1")],
        "search_artist_name string, search_track_name string, enriched_track_id string",
    )
    plays = events(spark, {"artist_name": "a"}, {"artist_name": None, "track_name": "other"})
    filled = joins.fill_by_mapping(plays, mapping)
    assert sorted(r["track_id"] or "" for r in filled.collect()) == ["", "3", "7"]
    reduced = joins.fill_by_mapping(plays, joins.smallest_mapping(mapping))
    same = dedup.dedup_by_priority(filled).collect(), dedup.dedup_by_priority(reduced).collect()
    assert sorted(map(str, same[0])) == sorted(map(str, same[1]))
    assert sorted(r["track_id"] or "" for r in same[1]) == ["", "3"]


def test_suffix_for_colliding_names(spark):
    left = spark.createDataFrame([(1, "l")], "k int, v string")
    right = spark.createDataFrame([(1, "r")], "k int, v string")
    got = joins.join_with_suffix(left, right, ["k"])
    assert got.columns == ["k", "v", "v_right"] and tuple(got.first()) == (1, "l", "r")


def test_preserved_columns(spark):
    rebuilt = spark.createDataFrame([("1", None), ("2", "new")], "id string, isrc string")
    stored = spark.createDataFrame([("1", "old", 2), ("2", "older", 3)], "id string, isrc string, disc int")
    got = joins.preserve_columns(rebuilt, stored, "id", ["disc"], fill=["isrc"])
    assert sorted(map(tuple, got.select("id", "isrc", "disc").collect())) == [("1", "old", 2), ("2", "new", 3)]


@pytest.mark.parametrize("salts", [1, 7])
def test_salted_lookup_equals_the_plain_one(spark, salts):
    keys = ["hot"] * 400 + [f"k{i % 50}" for i in range(400)] + [None] * 100
    facts = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "key string, n int")
    dim = spark.createDataFrame([("hot", 1), ("hot", 2), ("k1", 3), (None, 4), ("unused", 5)], "key string, v int")
    hot = joins.hot_keys(facts, "key", 300)
    assert [r["key"] for r in hot.collect()] == ["hot"]
    plain = joins.left_lookup(facts, dim, "key").collect()
    salted = joins.salted_left_lookup(facts, dim, "key", hot, ["n"], salts).collect()
    assert sorted(map(str, plain)) == sorted(map(str, salted))
    assert len(plain) == 400 * 2 + 400 + 100


def test_salted_fact_equals_the_plain_one(spark, sf_dir):
    from tapedeck.registry.tables import build_fact
    from tapedeck.registry.views import Views

    v = Views(spark, sf_dir)
    plays = dedup.dedup_by_priority(v.plays)
    salted = gold.fact_plays(
        plays,
        gold.track_lookup(v.tracks, v.albums, v.features),
        gold.artist_lookup(v.artists, v.artist_tags),
        joins.hot_keys(plays, "track_id", 20),
        joins.hot_keys(plays, "artist_name", 200),
    )
    plain = build_fact(v)
    assert sorted(map(str, salted.select(plain.columns).collect())) == sorted(map(str, plain.collect()))


def test_no_query_plans_a_cartesian_product(spark, sf_dir):
    import __spark_entry__ as entry

    for name in ("fact_plays", "agg_daily", "agg_monthly", "agg_artist_stats", "match_name_artist_first", "table_profile"):
        p = plan(entry.queries()[name](spark, sf_dir))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def test_scan_reads_only_what_is_needed(spark, sf_dir):
    import __spark_entry__ as entry

    p = plan(entry.queries()["limit_batch"](spark, sf_dir))
    schemas_read = [part.split(">")[0] for part in p.split("ReadSchema: struct<")[1:]]
    assert sorted(schemas_read) == ["l_partkey:bigint", "p_partkey:bigint,p_size:int"]


# ---------------------------------------------------------------- aggregates


def test_first_value_keeps_nulls(spark):
    df = spark.createDataFrame([("t", 2, "late"), ("t", 1, None), ("u", 1, "b"), ("u", 1, "a")], "id string, at int, v string")
    got = df.groupBy("id").agg(first_by_order(["at"], ["v"]).alias("f")).select("id", "f.v")
    assert sorted(map(str, map(tuple, got.collect()))) == ["('t', None)", "('u', 'a')"]


def test_distinct_count_counts_null(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    assert df.agg(measures.nunique_with_null(F.col("k"))).first()[0] == 2


def test_sums_of_nothing(spark):
    df = spark.createDataFrame([(None,), (None,)], "skipped boolean")
    got = df.agg(measures.sum_or_zero(F.col("skipped")), measures.flag_rate(F.col("skipped"))).first()
    assert tuple(got) == (0, 0.0)


def test_daily(spark):
    tracks = [{"track_id": "a", "duration_ms": 60000}]
    plays = [
        {"track_id": "a", "artist_name": "x", "duration_ms": 30000, "track_name": "1", "skipped": True,
         "source_type": "extended_export"},
        {"track_id": "a", "artist_name": "y", "duration_ms": 10000, "track_name": "2", "source_type": "export"},
        {"track_id": None, "artist_name": "y", "duration_ms": None, "track_name": "3", "source_type": "api"},
        {"track_id": None, "artist_name": None, "track_name": "4", "source_type": "api"},
        {"track_id": None, "artist_name": None, "track_name": "5", "source_type": "api"},
        {"played_at_utc": None, "artist_name": "x", "track_name": "6"},
    ]
    features = [{"track_id": "a", "energy": 0.5, "valence": 0.25, "danceability": 1.0}]
    rows = {r["date"]: r for r in gold.agg_daily(fact(spark, plays, tracks, features=features)).collect()}
    day, undated = rows[NOON.date()], rows[None]
    assert (day["total_plays"], day["total_ms_listened"], day["unique_tracks"], day["unique_artists"]) == (5, 42000, 2, 3)
    assert (day["complete_plays"], day["skip_count"], day["avg_energy"]) == (1, 1, 0.5)
    # y and "no artist" have two plays each: the name comes first; no artist has a genre.
    assert (day["top_artist"], day["top_genre"]) == ("y", None)
    assert (undated["total_plays"], undated["top_artist"], undated["avg_energy"]) == (1, None, None)


def test_missing_artist_can_be_the_most_played(spark):
    plays = [{"artist_name": None, "track_name": str(i)} for i in range(3)] + [{"artist_name": "a", "track_name": "x"}]
    assert gold.agg_daily(fact(spark, plays)).first()["top_artist"] is None


def test_monthly_new_artists(spark):
    plays = [
        {"artist_name": "a", "played_at_utc": datetime(2024, 1, 5)},
        {"artist_name": "a", "played_at_utc": datetime(2024, 2, 5)},
        {"artist_name": "b", "played_at_utc": datetime(2024, 3, 5)},
        {"artist_name": None, "played_at_utc": datetime(2024, 3, 6)},
    ]
    got = {(r["year"], r["month"]): r["new_artists"] for r in gold.agg_monthly(fact(spark, plays)).collect()}
    assert got == {(2024, 1): 1, (2024, 2): None, (2024, 3): 2}


def test_two_artists_of_one_name_double_the_play(spark):
    artists = [{"artist_id": "1", "artist_name": "x"}, {"artist_id": "2", "artist_name": "x"}]
    got = fact(spark, [{"artist_name": "x"}], artists=artists, tags=[{"artist_id": "2", "top_tag": "rock"}])
    assert {r["artist_id"]: r["top_genre"] for r in got.collect()} == {"1": None, "2": "rock"}
    assert got.count() == 2


def test_features_without_a_track_row_reach_the_fact(spark):
    got = fact(spark, [{"track_id": "t"}], features=[{"track_id": "t", "energy": 1.0, "valence": 1.0}]).first()
    assert (got["mood_quadrant"], got["album_id"], got["duration_ms_track"]) == ("Euphoric", None, None)


def test_null_keys_never_match(spark):
    got = fact(
        spark,
        [{"track_id": None, "artist_name": None}],
        tracks=[{"track_id": None, "album_id": "x"}],
        artists=[{"artist_id": "1", "artist_name": None}],
        features=[{"track_id": None, "energy": 1.0}],
    ).collect()
    assert [(r["album_id"], r["artist_id"], r["energy"]) for r in got] == [(None, None, None)]


def test_album_name_of_the_event_comes_first(spark):
    tracks = [{"track_id": "t", "album_id": "al"}]
    albums = [{"album_id": "al", "album_name": "from table", "release_date": "1999-05"}]
    plays = [{"track_id": "t", "album_name": "from event", "track_name": "1"}, {"track_id": "t", "track_name": "2"}]
    got = {r["track_name"]: r for r in fact(spark, plays, tracks, albums).collect()}
    assert [got[k]["album_name"] for k in "12"] == ["from event", "from table"]
    assert got["1"]["release_year"] == 1999


def test_track_stats_take_the_earliest_play(spark):
    plays = [
        {"track_id": "t", "played_at_utc": datetime(2024, 1, 2), "album_name": "late", "skipped": True},
        {"track_id": "t", "played_at_utc": datetime(2024, 1, 1), "album_name": None},
        {"track_id": None, "track_name": "unresolved"},
    ]
    got = gold.agg_track_stats(fact(spark, plays)).collect()
    assert len(got) == 1
    row = got[0]
    assert (row["album_name"], row["total_plays"], row["skip_count"], row["skip_rate"]) == (None, 2, 1, 0.5)
    assert row["first_played_at"] == datetime(2024, 1, 1) and row["last_played_at"] == datetime(2024, 1, 2)


def test_skip_rate_counts_plays_without_a_flag(spark):
    plays = [{"artist_name": "a", "track_name": str(i), "source_type": "api"} for i in range(2)]
    about = gold.dim_artists(
        spark.createDataFrame([], schemas.ARTISTS), spark.createDataFrame([], schemas.ARTIST_TAGS)
    )
    got = gold.agg_artist_stats(fact(spark, plays), about).first()
    assert (got["skip_count"], got["skip_rate"], got["total_plays"]) == (0, 0.0, 2)


# ---------------------------------------------------------------- silver


def test_extended_and_standard_rows_are_told_apart_row_by_row(spark):
    rows = [
        {"endTime": "2026-03-10 07:57", "artistName": "A", "trackName": "S", "msPlayed": 5},
        {"ts": "2026-03-10T08:00:00Z", "master_metadata_track_name": "T", "master_metadata_album_artist_name": "B",
         "ms_played": 6, "spotify_track_uri": "spotify:track:x", "skipped": True},
        {"ts": "2026-03-10T09:00:00Z", "ms_played": 7, "spotify_track_uri": "spotify:episode:e"},
    ]
    raw = spark.createDataFrame([tuple(r.get(c) for c in schemas.EXPORT.names) for r in rows], schemas.EXPORT)
    mapping = spark.createDataFrame(
        [("A", "S", "s1")], "search_artist_name string, search_track_name string, enriched_track_id string"
    )
    got = {r["track_name"]: r for r in silver.export_events(raw, mapping).collect()}
    assert set(got) == {"S", "T"}
    assert (got["S"]["source_type"], got["S"]["track_id"], got["S"]["duration_ms"]) == ("export", "s1", 5)
    assert (got["T"]["source_type"], got["T"]["track_id"], got["T"]["skipped"]) == ("extended_export", "x", True)
    assert got["S"]["platform"] is None and got["S"]["shuffle"] is None


def test_dimensions_of_one_nested_play(spark):
    play = {
        "played_at": "2023-01-01T00:00:00Z",
        "track": {
            "id": "t", "name": "Track", "duration_ms": 200000, "explicit": False, "popularity": 85, "track_number": 1,
            "uri": "u",
            "album": {"id": "al", "name": "Album", "album_type": "album", "release_date": "2023-01-01", "total_tracks": 10,
                      "images": [{"url": "http://image"}]},
            "artists": [{"id": "ar", "name": "Artist", "uri": "ua"}, {"name": "no id"}],
        },
    }
    dims = silver.extract_dimensions(spark.createDataFrame([play], schemas.PLAY))
    assert tuple(dims.artists.first()) == ("ar", "Artist", "ua") and dims.artists.count() == 1
    assert dims.albums.first()["total_tracks"] == 10 and dims.albums.first()["image_url"] == "http://image"
    track = dims.tracks.first()
    assert (track["popularity"], track["isrc"], track["album_id"]) == (85, None, "al")


def test_played_records_win_over_looked_up_ones(spark):
    schema = "track_id string, track_name string"
    merged = silver.merge_dimension(
        spark.createDataFrame([("1", "z played")], schema),
        spark.createDataFrame([("1", "a looked up"), ("2", "b")], schema),
        "track_id",
    )
    assert sorted(map(tuple, merged.collect())) == [("1", "z played"), ("2", "b")]


def test_first_values_sorts_nothing_below_the_first_shuffle(spark, tmp_path):
    rows = [("t", 2, "a"), ("t", 1, None), ("t", None, "z"), ("u", None, "b"), ("u", None, "a")]
    spark.createDataFrame(rows, "id string, at int, v string").write.parquet(str(tmp_path / "p"))
    got = first_values(spark.read.parquet(str(tmp_path / "p")), "id", "at", ["v"])
    assert sorted(map(str, map(tuple, got.collect()))) == ["('t', None)", "('u', 'a')"]
    plan = got._jdf.queryExecution().sparkPlan().toString()
    below = plan[plan.rindex("partial_min(at"):]
    assert "Sort" not in below
