"""Scalar rules on hand-made values."""

from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tapedeck.functions import arrays, measures, text, timestamps


def rows(spark, values, schema="value string"):
    return spark.createDataFrame([(v,) for v in values], schema)


def apply(spark, values, rule, schema="value string"):
    return [r[0] for r in rows(spark, values, schema).select(rule(F.col("value"))).collect()]


def test_strict_time_raises_and_lenient_time_is_null(spark):
    good = "2018-06-13T15:55:30.123Z"
    assert apply(spark, [good], timestamps.parse_utc) == [datetime(2018, 6, 13, 15, 55, 30, 123000)]
    with pytest.raises(PySparkException):
        apply(spark, ["yesterday"], timestamps.parse_utc)
    assert apply(spark, ["yesterday", None, "2018-06-13T15:55:30Z"], timestamps.try_parse_utc) == [
        None, None, datetime(2018, 6, 13, 15, 55, 30),
    ]


def test_minute_time_and_its_zone(spark):
    assert apply(spark, ["2026-03-10 07:57"], timestamps.parse_minute) == [datetime(2026, 3, 10, 7, 57)]
    brussels = lambda c: timestamps.parse_minute(c, "Europe/Brussels")
    assert apply(spark, ["2026-03-10 07:57"], brussels) == [datetime(2026, 3, 10, 6, 57)]
    assert apply(spark, ["2026-03-10T07:57:00Z", "2026-13-10 07:57", None], timestamps.parse_minute) == [None, None, None]


def test_epoch_millis_does_not_depend_on_the_session_zone(spark):
    values = [datetime(2024, 3, 31, 2, 30, 15, 123456)]
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Brussels")
        assert apply(spark, values, timestamps.epoch_millis, "value timestamp_ntz") == [1711852215123]
        back = lambda c: timestamps.from_epoch_millis(timestamps.epoch_millis(c))
        assert apply(spark, values, back, "value timestamp_ntz") == [datetime(2024, 3, 31, 2, 30, 15, 123000)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_weekday_starts_on_monday(spark):
    days = [datetime(2024, 1, 1), datetime(2024, 1, 6), datetime(2024, 1, 7)]
    assert apply(spark, days, timestamps.weekday, "value timestamp_ntz") == [1, 6, 7]
    assert apply(spark, days, timestamps.is_weekend, "value timestamp_ntz") == [False, True, True]


def test_track_id_from_uri(spark):
    uris = ["spotify:track:abc123", "spotify:episode:xyz789", None]
    assert apply(spark, uris, text.track_id_from_uri) == ["abc123", None, None]


def test_release_year(spark):
    dates = ["1970", "1970-05", "n/a", None, " 197", ""]
    assert apply(spark, dates, text.release_year) == [1970, 1970, None, None, None, None]


def test_counter(spark):
    assert apply(spark, ["12", "", None, "many"], text.counter_or_zero) == [12, 0, 0, None]


def test_search_key(spark):
    assert apply(spark, ["Don't \"Stop\""], text.search_key) == ["Dont Stop"]


def test_long_key_survives_on_one_line(one):
    key = "artist " * 10 + "||" + "track || name " * 3
    encoded = text.encode_key(F.lit(key))
    got, artist, track, line = one(
        text.decode_key(encoded),
        text.pair_artist(text.decode_key(encoded)),
        text.pair_track(text.decode_key(encoded)),
        encoded,
    )
    assert got == key and artist == "artist " * 10 and track == "track || name " * 3
    assert len(line) > 76 and "\n" not in line and "\r" not in line


def test_undecodable_keys_are_null(spark):
    assert apply(spark, ["%%%", "/w==", "YXx8Yg=="], text.decode_key) == [None, None, "a||b"]


def test_path_safe(spark):
    assert apply(spark, ["a+b/c="], text.path_safe) == ["a-b_c="]


def test_first_of_an_empty_list(spark):
    schema = "value array<string>"
    assert apply(spark, [[], None, ["x", "y"]], arrays.first_or_null, schema) == [None, None, "x"]


def test_combined_genres(spark):
    df = spark.createDataFrame(
        [([], ["rock"]), ([], None), (None, None), (["pop", "rock"], ["rock", "indie"])],
        "genres array<string>, tags array<string>",
    )
    got = [r[0] for r in df.select(arrays.combine_genres(F.col("genres"), F.col("tags"))).collect()]
    assert got == [["rock"], None, None, ["indie", "pop", "rock"]]


def test_clean_tags(spark):
    lists = [["Rock"], ["seen live", "LOVE"], ["A", "b", "Music", "c", "d", "e", "f"], []]
    assert apply(spark, lists, arrays.clean_tags, "value array<string>") == [
        ["rock"], [], ["a", "b", "c", "d", "e"], [],
    ]


def test_tag_names_from_object_list_and_nothing(spark):
    responses = ['{"t": {"tag": {"name": "x"}}}', '{"t": {"tag": [{"name": "x"}, {"name": "y"}]}}', "{}"]
    assert apply(spark, responses, lambda c: arrays.tag_names(c, "$.t.tag")) == [["x"], ["x", "y"], []]


def test_completion(spark):
    df = spark.createDataFrame(
        [
            ("export", 100, 200), ("extended_export", 1, 3), ("export", 100, 0), ("export", 100, None), ("api", 100, 200),
            ("export", 1, 20000), ("export", 30, 10),
        ],
        "source string, played bigint, track bigint",
    )
    pct = measures.completion_pct(F.col("source"), F.col("played"), F.col("track"))
    assert [r[0] for r in df.select(pct).collect()] == [0.5, 0.3333, None, None, None, 0.0001, 3.0]


def test_is_complete(spark):
    df = spark.createDataFrame([("export", 30000), ("export", 29999), ("api", 99999)], "source string, ms bigint")
    got = [r[0] for r in df.select(measures.is_complete(F.col("source"), F.col("ms"))).collect()]
    assert got == [True, False, None]


def test_mood_edges(spark):
    df = spark.createDataFrame(
        [(0.5, 0.5), (0.51, 0.5), (0.5, 0.51), (0.51, 0.51), (None, 1.0), (1.0, None)], "e double, v double"
    )
    got = [r[0] for r in df.select(measures.mood_quadrant(F.col("e"), F.col("v"))).collect()]
    assert got == ["Melancholic", "Intense", "Chill", "Euphoric", None, None]


def test_unknown_source_is_an_error(spark):
    assert apply(spark, ["api", "export"], measures.source_priority) == [1, 3]
    with pytest.raises(PySparkException, match="unknown source_type"):
        apply(spark, ["radio"], measures.source_priority)
