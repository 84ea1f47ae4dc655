"""Account exports: validate, count and keep the raw files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapedeck import schemas
from tapedeck.functions.text import is_filled
from tapedeck.operators.validation import export_is_valid, split_valid
from tapedeck.sources.bronze import CORRUPT, EXPORT_PATH_PATTERN, SOURCE_FILE, keep_raw_files, read_json

def read_export_records(spark: SparkSession, path: str) -> DataFrame:
    """Export records under common names with their file and what is wrong with them, the same as the silver build sees."""
    raw = read_json(spark, path, schemas.EXPORT).withColumnRenamed(SOURCE_FILE, "file_path")
    return raw.filter(F.col("file_path").rlike(EXPORT_PATH_PATTERN)).select(
        "file_path",
        F.coalesce("endTime", "ts").alias("played_at"),
        F.coalesce("artistName", "master_metadata_album_artist_name").alias("artist_name"),
        F.coalesce("trackName", "master_metadata_track_name").alias("track_name"),
        F.coalesce("msPlayed", "ms_played").alias("duration_ms"),
        F.coalesce("spotify_track_uri", "uri").alias("track_uri"),
        CORRUPT,
    )


def record_rule():
    return F.col(CORRUPT).isNull() & export_is_valid(F.col("played_at"), F.col("duration_ms"))


def split_records(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid records and the quarantine."""
    return split_valid(records, record_rule())


def is_music():
    """Podcasts have no track or no artist."""
    return is_filled(F.col("track_name")) & is_filled(F.col("artist_name"))


def music_only(records: DataFrame) -> DataFrame:
    return records.filter(is_music())


def backfill_report(records: DataFrame, per: str = "file_path") -> DataFrame:
    """Music tracks, other valid records and malformed records, per file."""
    valid = record_rule()
    return records.groupBy(per).agg(
        F.count_if(valid & is_music()).alias("music_records"),
        F.count_if(valid & ~is_music()).alias("other_records"),
        F.count_if(~valid).alias("malformed_records"),
    )


def backfill(spark: SparkSession, source: str, bronze_files: str) -> DataFrame:
    """Keep the raw export files of a folder and report on their records."""
    keep_raw_files(spark, source, bronze_files)
    return backfill_report(read_export_records(spark, source))
