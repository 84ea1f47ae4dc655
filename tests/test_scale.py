"""What keeps the lake's input and copies small, and their tasks even."""

import gzip
import json

from pyspark.sql import functions as F

from tapedeck import schemas
from tapedeck.plans import jobs
from tapedeck.registry import scalars, views
from tapedeck.registry.views import Views
from tapedeck.sources import bronze
from tapedeck.streaming import upsert


def _lines(path) -> list[str]:
    return [line for f in sorted(path.rglob("*.txt.gz")) for line in gzip.open(f, "rt").read().splitlines()]


def test_arrays_are_compressed_and_cut_and_a_day_has_one_bad_record(spark, sf_dir, tmp_path, monkeypatch):
    monkeypatch.setattr(views, "ARRAY", 2)
    v = Views(spark, sf_dir)
    v._write_source("plays", str(tmp_path))
    folder = tmp_path / schemas.BRONZE_PATHS["plays"]
    assert not list(folder.rglob("*.txt"))
    arrays = [json.loads(line) for line in _lines(folder)]
    bad = [r for a in arrays for r in a if r["track"].get("id") == "bad"]
    good = [r for a in arrays for r in a if r["track"].get("id") != "bad"]
    assert len(good) == v.nested_plays.count()
    assert len(bad) == len({r["played_at"][:10] for r in good})
    assert len(arrays) > 1.1 * len(bad) and max(map(len, arrays)) < 12


def test_a_source_is_written_when_it_is_read(spark, sf_dir):
    views._BRONZE.clear()
    v = Views(spark, sf_dir)
    path = v.bronze("track_tag_markers")
    assert list(views._BRONZE.values()) == [path] and v.bronze("track_tag_markers") == path


def test_compressed_lines_are_short_files_and_read_back(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(bronze, "LINES", 30)
    df = spark.range(100, numPartitions=1).select(F.col("id").cast("string").alias("played_at"))
    bronze.write_json_lines(df, str(tmp_path / "out"))
    assert len(list((tmp_path / "out").glob("*.txt.gz"))) == 4
    assert bronze.read_plays(spark, str(tmp_path / "out")).select("played_at").distinct().count() == 100


def test_ingest_lands_a_large_batch_compressed_and_keeps_no_copies(spark, sf_dir, tmp_path, monkeypatch):
    monkeypatch.setattr(jobs, "LAND_COMPRESSED", 0)
    v, root = Views(spark, sf_dir), str(tmp_path / "lake")
    jobs.ingest_increment(spark, v.bronze("plays"), root, str(tmp_path / "work"))
    landed = jobs.bronze_path(root, "plays")
    assert list((tmp_path / "lake").rglob("*.txt.gz")) and not list((tmp_path / "lake").rglob("*.txt"))
    assert bronze.read_plays(spark, landed).count() > 0 and not list((tmp_path / "work").glob("*"))


def test_files_are_written_and_read_by_tasks_in_number_of_the_files(spark, sf_dir, tmp_path, monkeypatch):
    monkeypatch.setattr(views, "TASK_FILES", 2)
    monkeypatch.setattr(bronze, "TASK_RANGES", 2)
    v = Views(spark, sf_dir)
    files = bronze.list_files(spark, v.named_files())
    assert files.count() == v.table("supplier").count()
    tasks = files.select(F.regexp_extract("path", "part-([0-9]+)-", 1)).distinct().count()
    assert tasks > 3
    source = v.named_files()
    bronze.keep_raw_files(spark, source, str(tmp_path / "kept"), size=8)
    kept = spark.read.parquet(str(tmp_path / "kept"))
    exports = files.filter(F.col("path").rlike(bronze.EXPORT_PATH_PATTERN))
    assert kept.count() == exports.agg(F.sum(F.ceil(F.col("length") / 8))).first()[0]
    assert len(list((tmp_path / "kept").glob("part-*"))) > 4


def test_lines_are_made_json_and_parsed_by_tasks_in_number_of_the_lines(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(views, "JSON_LINES", 1000)
    rows = scalars.json_roundtrip(Views(spark, sf_dir)).withColumn("task", F.spark_partition_id())
    counts = [r["count"] for r in rows.groupBy("task").count().collect()]
    lines = Views(spark, sf_dir).lines.count()
    assert sum(counts) == lines and len(counts) == 1 + lines // 1000 and max(counts) < 1500


def test_a_merge_gives_its_tasks_short_files_whatever_the_batch(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(upsert, "FILE_ROWS", 50)
    monkeypatch.setattr(upsert, "TASK_BYTES", 2 * 1024 * 1024)
    seen, before, write = [], spark.conf.get("spark.sql.files.maxPartitionBytes"), upsert.write_buckets

    def watched(df, *args):
        seen.append(spark.conf.get("spark.sql.files.maxPartitionBytes"))
        write(df, *args)

    monkeypatch.setattr(upsert, "write_buckets", watched)
    at = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id")).cast("timestamp_ntz")
    plays = spark.range(300, numPartitions=1).select(at.alias("played_at_utc"), F.lit("n").alias("track_name"), F.lit("api").alias("source_type"))
    batch, table, work = schemas.conform(plays, schemas.EVENTS), str(tmp_path / "events"), str(tmp_path / "work")
    for _ in range(2):
        upsert.upsert_batch(batch, table, work)
    files = [f for f in (tmp_path / "work" / "batch").glob("*.parquet")]
    assert max(spark.read.parquet(str(f)).count() for f in files) <= 50
    assert seen == [str(2 * 1024 * 1024)] * 2 and spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    assert upsert.read_events(spark, table).count() == 300
