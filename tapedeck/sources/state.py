"""Look-up attempts and the ingestion cursor."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapedeck import schemas
from tapedeck.functions.timestamps import epoch_millis, parse_utc
from tapedeck.operators.dedup import first_row_per_key
from tapedeck.sources.bronze import list_files
from tapedeck.sources.files import exists
from tapedeck.sources.tables import read_optional

FOUND, NOT_FOUND = "found", "not_found"
# Fixed value: the run time a lake starts from when it has no cursor yet.
FIRST_RUN = datetime(2017, 1, 1)


def attempt_rows(df: DataFrame, key: Column, payload: Column, attempted_at: Column) -> DataFrame:
    """Attempts as table rows: a null payload is a look-up that found nothing."""
    return df.select(
        key.alias("key"),
        F.when(payload.isNull(), NOT_FOUND).otherwise(FOUND).alias("status"),
        payload.alias("payload"),
        attempted_at.cast("timestamp_ntz").alias("attempted_at"),
    )


def latest_attempts(attempts: DataFrame) -> DataFrame:
    """The last attempt per key."""
    order = [
        F.col("attempted_at").desc_nulls_last(), F.col("status").asc(), F.col("payload").asc_nulls_last()
    ]
    return first_row_per_key(attempts, ["key"], order)


def append_attempts(attempts: DataFrame, path: str) -> None:
    attempts.write.mode("append").parquet(path)


def read_attempts(spark: SparkSession, path: str) -> DataFrame:
    """Attempts are only ever appended, so that a folder without files has none yet."""
    if not exists(spark, path):
        return spark.createDataFrame([], schemas.ATTEMPTS)
    return spark.read.schema(schemas.ATTEMPTS).parquet(path)


def attempts_from_files(spark: SparkSession, path: str) -> DataFrame:
    """Attempts out of a folder with one marker file per key, named by the encoded key."""
    if not exists(spark, path):
        return spark.createDataFrame([], schemas.ATTEMPTS)
    key = F.regexp_extract("path", "([^/]+)[.]json$", 1)
    files = list_files(spark, path, "*.json")
    named = files.select(key.alias("key"), F.col("modificationTime").cast("timestamp_ntz").alias("attempted_at"))
    return schemas.conform(named, schemas.ATTEMPTS)


def default_cursor(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(FIRST_RUN, 0)], schemas.CURSOR)


def read_cursor(spark: SparkSession, path: str) -> DataFrame:
    """The stored cursor as one row, or the default when there is none."""
    stored = read_optional(spark, path, schemas.CURSOR)
    return default_cursor(spark) if stored.isEmpty() else stored


def advance_cursor(plays: DataFrame, run_at: Column) -> DataFrame:
    """The cursor after a batch: its newest play; no row for an empty batch, which moves nothing."""
    newest = F.max(epoch_millis(parse_utc(F.col("played_at"))))
    return (
        plays.agg(newest.alias("last_played_at_unix_ms"))
        .filter(F.col("last_played_at_unix_ms").isNotNull())
        .select(run_at.cast("timestamp_ntz").alias("last_run_timestamp"), "last_played_at_unix_ms")
    )
