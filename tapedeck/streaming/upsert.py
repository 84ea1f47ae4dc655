"""Priority dedup across batches.

Exports arrive years after the plays they describe, so no watermark can bound the state. The
state is the fact table itself: its large months are cut into buckets by a hash of what tells plays apart (time and track name), and
a batch re-runs the dedup on the buckets it touches and replaces only these, all at once. One late play so reads and writes
one bucket of bounded size, not its month. Merging a batch twice gives the same rows as merging it once, so that neither a
repeated batch nor a stream that starts anew needs a note of what was done.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapedeck import schemas
from tapedeck.operators.dedup import PLAY_KEY, dedup_by_priority
from tapedeck.operators.sets import union_diagonal
from tapedeck.sources.tables import Month, Part, live_parts, materialize, part_bytes, read_by_month, read_parts, write_buckets
from tapedeck.streaming.ingest import run_available

#: Size of a bucket from which on its month is cut into CUT times as many.
BUCKET_BYTES = 256 * 1024 * 1024
CUT = 8
#: Rows of a file of the batch, and bytes of files that one task of a merge reads: a task sorts its rows before it keeps one of each play.
FILE_ROWS, TASK_BYTES = 250_000, 16 * 1024 * 1024
_SPLIT = "spark.sql.files.maxPartitionBytes"


def bucket_of(buckets: dict[Month, int]) -> Column:
    """The bucket of a row with year and month, by how many its month has."""
    counts = [F.lit(x) for (year, month), n in buckets.items() if n > 1 for x in (f"{year}-{month}", n)]
    month = F.concat(F.coalesce(F.col("year").cast("string"), F.lit("None")), F.lit("-"), F.coalesce(F.col("month").cast("string"), F.lit("None")))
    count = F.coalesce(F.try_element_at(F.create_map(*counts), month), F.lit(1)) if counts else F.lit(1)
    return F.pmod(F.xxhash64(*PLAY_KEY), count).cast("int")


def touched_parts(dated: DataFrame, parts: list[Part]) -> list[Part]:
    """The stored parts that rows with year and month can change. At most their months times the buckets of a month reach the driver."""
    buckets = {p.place[:2]: p.buckets for p in parts if p.buckets}
    places = {tuple(r) for r in dated.select("year", "month", bucket_of(buckets)).distinct().collect()}
    months = {p[:2] for p in places}
    return [p for p in parts if p.place in places or (p.bucket is None and p.place[:2] in months)]


@contextmanager
def short_splits(spark: SparkSession) -> Iterator[None]:
    """What is read meanwhile is given to tasks by TASK_BYTES, whatever the size of the whole."""
    before = spark.conf.get(_SPLIT)
    spark.conf.set(_SPLIT, str(TASK_BYTES))
    try:
        yield
    finally:
        spark.conf.set(_SPLIT, before)


def upsert_batch(batch: DataFrame, table: str, work: str, bucket_bytes: int = BUCKET_BYTES) -> None:
    """Merge one batch of events into the fact. The batch is written aside first, as it is read twice.

    A month with a touched bucket of more than `bucket_bytes` is read and cut anew as a whole, once for each CUT-fold growth.
    """
    spark = batch.sparkSession
    dated = batch.withColumns({"year": F.year("played_at_utc"), "month": F.month("played_at_utc")})
    staged = materialize(dated, f"{work}/batch", FILE_ROWS)
    parts = live_parts(spark, table)
    old = touched_parts(staged, parts)
    crowded = {p.place[:2] for p in old if part_bytes(spark, table, p) > bucket_bytes}
    buckets = {p.place[:2]: (p.buckets or 1) * (CUT if p.place[:2] in crowded else 1) for p in parts}
    old += [p for p in parts if p.place[:2] in crowded and p not in old]
    stored = read_parts(spark, table, old, schemas.EVENTS_PARTITIONED)
    merged = dedup_by_priority(union_diagonal(stored, staged))
    with short_splits(spark):
        write_buckets(merged.withColumn("bucket", bucket_of(buckets)), table, buckets, old)


def upsert_available(stream: DataFrame, table: str, work: str, checkpoint: str) -> None:
    """Merge everything that arrived since the last run, batch by batch, then stop."""
    run_available(stream, lambda df, _: upsert_batch(df, table, work), checkpoint)


def read_events(spark: SparkSession, table: str) -> DataFrame:
    return read_by_month(spark, table, schemas.EVENTS_PARTITIONED)
