"""Records in lines: parsed once as a whole, judged field by field only where that fails."""

import json

import pytest

from tapedeck import schemas
from tapedeck.plans import silver
from tapedeck.registry import tables
from tapedeck.registry.views import Views
from tapedeck.sources import bronze
from tapedeck.sources.at_once import at_once

GOOD = {"ts": "2024-01-01T10:00:00Z", "ms_played": 5, "skipped": True}


def put_lines(folder, lines):
    folder.mkdir(parents=True)
    (folder / "part-0.txt").write_text("\n".join(lines))
    return str(folder)


def test_lines_of_records_arrays_and_rubbish(spark, tmp_path):
    lines = [
        json.dumps(GOOD), json.dumps([GOOD, {**GOOD, "skipped": "maybe"}, {**GOOD, "ms_played": "7"}, {**GOOD, "ms_played": 2**70, "skipped": [1]}]),
        "", "   ", "[]", '{"ts": "cut', '[{"ts": "also cut"}, {"ts"', "null", "7", '"text"', json.dumps({**GOOD, "unknown": {"a": [1]}, "ts": "ü\\n"}),
        json.dumps({"ts": {"nested": 1}, "ms_played": None}),
    ]
    path = put_lines(tmp_path / "a", lines)
    records = bronze.read_json(spark, path, schemas.EXPORT)
    good = sorted((r["ts"] or "", r["ms_played"] or 0, r["skipped"] or False) for r in bronze.readable(records).collect())
    at = GOOD["ts"]
    # A whole number written as text is taken, as its text fits the type.
    assert good == sorted([(at, 5, True), (at, 5, True), (at, 7, True), ("ü\\n", 5, True), ('{"nested":1}', 0, False)])
    bad = [(r["_corrupt_record"], r["_record"]) for r in bronze.unreadable(records).collect()]
    assert sorted(reason for reason, _ in bad) == ["badly typed: ms_played, skipped", "badly typed: skipped", *["not JSON"] * 5]
    assert json.loads(dict(bad)["badly typed: skipped"]) == {**GOOD, "skipped": "maybe"}
    assert {text for reason, text in bad if reason == "not JSON"} >= {'{"ts": "cut', "7", '"text"'}


def test_nested_fields_of_lines(spark, tmp_path):
    track = {"id": "t", "name": "n", "album": {"id": "b", "images": [{"url": "u", "height": 3}]}, "artists": [{"id": "a", "name": "x"}]}
    rows = [{"played_at": "p", "track": track}, {"played_at": "p", "track": {**track, "duration_ms": "long"}}, {"played_at": "p", "track": None, "context": {"type": 1}}]
    path = put_lines(tmp_path / "a", [json.dumps(rows), json.dumps(rows[0])])
    records = bronze.read_json(spark, path, schemas.PLAY)
    assert [r["track"]["album"]["images"][0]["height"] for r in bronze.readable(records).collect() if r["track"]] == [3, 3]
    assert [r["_corrupt_record"] for r in bronze.unreadable(records).collect()] == ["badly typed: track"]
    markers = put_lines(tmp_path / "b", ['{"track_id":"a","tags":["x","y"],"listeners":3}', '{"track_id":"b","tags":"x"}', '{"track_id":"c","tags":null}'])
    found = bronze.read_json(spark, markers, schemas.TRACK_TAGS_MARKER)
    assert sorted((r["track_id"], r["tags"]) for r in bronze.readable(found).collect()) == [("a", ["x", "y"]), ("c", None)]
    assert [r["_corrupt_record"] for r in bronze.unreadable(found).collect()] == ["badly typed: tags"]


def test_no_field_is_parsed_twice(spark, tmp_path):
    path = put_lines(tmp_path / "a", [json.dumps({"played_at": "2024-01-01T10:00:00Z", "track": {"id": "t"}})])
    events = silver.api_events(bronze.read_plays(spark, path))
    plan = events._jdf.queryExecution().optimizedPlan().toString()
    # Lines: the array, the whole record, then a record that failed: its fields' texts, context and track. Files: context and track.
    assert plan.count("from_json(") == 7
    exports = silver.music_exports(bronze.read_exports(spark, path))
    assert exports._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 3


def test_records_are_judged_by_all_fields_when_few_are_used(spark, tmp_path):
    track = {"id": "t", "name": "n", "href": "h", "album": {"images": [{"url": "u", "height": 3}]}, "artists": [{"id": "a", "name": "x"}]}
    wrong = [{"album": {"images": [{"height": "tall"}]}}, {"album": {"artists": "no list"}}, {"artists": [{"external_urls": 1}]}, {"is_local": "no"}, {"album": 7}]
    rows = [{"played_at": "p", "track": track}, *[{"played_at": "p", "track": {**track, **w}} for w in wrong], {"played_at": "p", "context": "c"}]
    own = {"played_at": "q", "_record": "r", "_corrupt_record": "c"}
    path = put_lines(tmp_path / "a", [json.dumps(rows), *map(json.dumps, [own, rows[1]])])
    (tmp_path / "a" / "b.json").write_text(json.dumps(rows))
    full, few = (bronze.read_json(spark, path, schemas.PLAY, used=used) for used in (None, schemas.PLAY_HEARD))
    assert "href" in full.schema["track"].dataType.names and not {"href", "uri"} & set(few.schema["track"].dataType.names)
    bad = [sorted((r["_corrupt_record"], r["_record"]) for r in bronze.unreadable(records).collect()) for records in (full, few)]
    assert bad[0] == bad[1] and [len([r for r, _ in bad[0] if r == f"badly typed: {name}"]) for name in ("track", "context")] == [11, 2]
    heard = [sorted(map(str, silver.api_events(bronze.plays_only(r).filter("played_at <> 'p'").drop("played_at").selectExpr("'2024-01-01T10:00:00Z' played_at", "*")).collect())) for r in (full, few)]
    assert heard[0] == heard[1] and len(heard[0]) == 1
    assert bronze.plays_only(few).count() == 3


def test_events_of_exports_are_parsed_once(spark, sf_dir):
    read = tables.silver_events(Views(spark, sf_dir)).inputFiles()
    assert read and not [f for f in read if schemas.BRONZE_PATHS["exports"] in f]


def test_jobs_at_once_all_end_before_an_error_is_raised(spark):
    ended = []

    def job(k):
        rows = spark.range(k).count()
        if k == 2:
            raise ValueError("second")
        ended.append(rows)
        return rows

    assert at_once(spark, *[lambda k=k: job(k) for k in (3, 1)]) == [3, 1]
    with pytest.raises(ValueError, match="second"):
        at_once(spark, *[lambda k=k: job(k) for k in (2, 5, 4)])
    assert sorted(ended) == [1, 3, 4, 5] and at_once(spark) == []
