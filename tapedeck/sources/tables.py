"""Silver and gold tables on Parquet."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tapedeck import schemas
from tapedeck.sources.bronze import list_files
from tapedeck.sources.files import children, exists, hours_old, mark, marked, remove, stored_size

MONTHLY = {"listening_events", "fact_plays", "partials"}
_COMMITTED, _VERSION, _NO_VALUE = "_committed", "v[0-9]{10}", "__HIVE_DEFAULT_PARTITION__"
_PARTS = schemas.struct(write=schemas.TEXT, **schemas.same(schemas.INT, "year month bucket buckets"))
# After so long a write that is noted as under way is taken to have broken off.
_CLAIM_HOURS = 48


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{schemas.TABLE_PATHS[name]}"


class ConcurrentWrite(RuntimeError):
    """Another writer replaced the table, or the part of it, that this one started from. Nothing of it was written."""


def _versions(spark: SparkSession, path: str) -> list[str]:
    """Folders of the complete versions, oldest first. A marker names its folder, unless it has the folder's name itself."""
    folder = f"{path}/{_COMMITTED}"
    named = [marked(spark, f"{folder}/{m}") or m for m in children(spark, folder)[-2:]]
    return [f"{path}/{name}" for name in named if exists(spark, f"{path}/{name}")]


def current_version(spark: SparkSession, path: str) -> str | None:
    """The folder of a table's last complete version; None where no versions are kept.

    A version counts once its marker is there, which is set after the last file. Versions without any marker are
    a first write that was cut short: an error, as an empty table would be taken for the truth.
    """
    versions = _versions(spark, path)
    if versions:
        return versions[-1]
    if any(re.match(_VERSION, name) for name in children(spark, path)):
        raise FileNotFoundError(f"{path} has no complete version")
    return None


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The last complete version of a table, or the plain Parquet files of one that others wrote."""
    return spark.read.parquet(current_version(spark, path) or path)


def read_optional(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A table with its declared schema; empty when the path does not exist, an error for anything else."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return schemas.conform(read_table(spark, path), schema)


def read_silver(spark: SparkSession, root: str, name: str) -> DataFrame:
    path, schema = table_path(root, name), schemas.SILVER_SCHEMAS[name]
    return read_by_month(spark, path, schema) if name in MONTHLY else read_optional(spark, path, schema)


def read_gold(spark: SparkSession, root: str, name: str) -> DataFrame:
    path = table_path(root, name)
    return read_by_month(spark, path) if name in MONTHLY else read_table(spark, path)


def materialize(df: DataFrame, path: str, file_rows: int = 0) -> DataFrame:
    """Write a frame aside and go on from the copy, in files of `file_rows` rows at most, if that is not 0.

    For frames that several plans start from: they are computed once, the copy survives the loss of
    executors, and its size is known when the next join is planned.
    """
    writer = df.write.mode("overwrite")
    (writer.option("maxRecordsPerFile", file_rows) if file_rows else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Size of a stored table on disk."""
    return list_files(spark, path, "*.parquet").agg(F.sum("length")).first()[0] or 0


def _write_version(df: DataFrame, path: str, keep_empty: bool) -> None:
    """Every writer has a folder of its own. The marker of the next number can be set once, so that of two
    writers that start from one version the second to finish gets ConcurrentWrite."""
    spark = df.sparkSession
    marks = children(spark, f"{path}/{_COMMITTED}")
    number = int(marks[-1][1:]) + 1 if marks else 1
    name = f"v{number:010d}-{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{name}")
    if not keep_empty and spark.read.schema(df.schema).parquet(f"{path}/{name}").isEmpty():
        remove(spark, f"{path}/{name}")
        if not marks and not children(spark, path):
            remove(spark, path)
        return
    try:
        mark(spark, f"{path}/{_COMMITTED}/v{number:010d}", name)
    except FileExistsError:
        remove(spark, f"{path}/{name}")
        raise ConcurrentWrite(f"{path} has a new version {number}") from None
    # The version before stays for those who are reading it. Writers that started from an older one can't finish any more.
    for old in children(spark, f"{path}/{_COMMITTED}"):
        if int(old[1:]) < number - 1:
            remove(spark, f"{path}/{_COMMITTED}/{old}")
    for old in children(spark, path):
        if re.match(_VERSION, old) and int(old[1:11]) < number - 1:
            remove(spark, f"{path}/{old}")


def write_table(df: DataFrame, path: str, when: DataFrame | None = None) -> None:
    """Write a table's next version, unless the stored table it is made from (`when`) has no rows.

    `df` may be read from the table itself: the old version stays until the new one is complete.
    """
    if when is None or not when.isEmpty():
        _write_version(df, path, keep_empty=True)


def swap_table(df: DataFrame, path: str) -> None:
    """write_table, but an empty result leaves the table as it is."""
    _write_version(df, path, keep_empty=False)


Month = tuple[int | None, int | None]


class Part(NamedTuple):
    """A stored piece of a fact: a month, or one of the `buckets` that a month is cut into by a hash of its keys."""

    write: str
    year: int | None
    month: int | None
    bucket: int | None = None
    buckets: int | None = None

    @property
    def place(self) -> tuple:
        return self.year, self.month, self.bucket

    @property
    def folder(self) -> str:
        names = {"write": self.write, "year": self.year, "month": self.month, "bucket": self.bucket}
        kept = [(k, v) for k, v in names.items() if k != "bucket" or v is not None]
        return "/".join(f"{k}={_NO_VALUE if v is None else v}" for k, v in kept)


def _value(folder: str) -> int | None:
    text = folder.split("=", 1)[1]
    return None if text == _NO_VALUE else int(text)


def month_folders(spark: SparkSession, data: str) -> list[Month]:
    years = [y for y in children(spark, data) if y.startswith("year=")]
    return [(_value(y), _value(m)) for y in years for m in children(spark, f"{data}/{y}") if m.startswith("month=")]


def _stored_parts(spark: SparkSession, path: str, write: str, buckets: dict[Month, int]) -> list[Part]:
    own, out = f"{path}/data/write={write}", []
    for year, month in month_folders(spark, own):
        part = Part(write, year, month)
        cut = [b for b in children(spark, f"{path}/data/{part.folder}") if b.startswith("bucket=")]
        out += [part._replace(bucket=_value(b), buckets=buckets.get((year, month), 1)) for b in cut] or [part]
    return out


def _parts_of(spark: SparkSession, version: str) -> list[Part]:
    rows = schemas.conform(spark.read.parquet(version), _PARTS)
    return [Part(*r) for r in rows.collect()]


def live_parts(spark: SparkSession, path: str) -> list[Part]:
    """Which write holds each part: a row for each month of the calendar at most, times the buckets of a month."""
    folder = f"{path}/months"
    return _parts_of(spark, current_version(spark, folder)) if exists(spark, folder) else []


def _put(df: DataFrame, path: str, write: str, by: list[str], placed: bool = False) -> None:
    """Write rows under a folder of their own, noted as being written. The rebalance hint lets the adaptive planner cut parts
    that hold much of the data into files of a common size and put small ones together; rows that are `placed` lie so already."""
    claim = f"{path}/writing/{write}"
    mark(df.sparkSession, claim)
    rows = df if placed else df.hint("rebalance", *[F.col(c) for c in by])
    rows.write.partitionBy(*by).parquet(f"{path}/data/write={write}")


def _switch(spark: SparkSession, path: str, write: str, written: list[Part], replaced: list[Part]) -> None:
    """Let the new parts stand for the replaced ones, all at once; ConcurrentWrite if others have replaced any of these since.

    The parts that the last manifest but one held go, for readers may still use the last. So does a write that nobody notes as
    under way any more.
    """
    folder, places = f"{path}/months", {p.place for p in written}
    months, whole = {p.place[:2] for p in written}, {p.place[:2] for p in written if p.bucket is None}
    while True:
        before = live_parts(spark, path)
        same = [p for p in before if p.place in places or p.place[:2] in whole or (p.bucket is None and p.place[:2] in months)]
        taken = set(same) - set(replaced)
        if not set(replaced) <= set(before) or taken:
            remove(spark, f"{path}/data/write={write}")
            raise ConcurrentWrite(f"{path}: months were written by another job")
        older = _versions(spark, folder)[:-1]
        dead = {p for v in older for p in _parts_of(spark, v)}
        now = [p for p in before if p not in replaced] + written
        try:
            write_table(spark.createDataFrame(now, _PARTS).coalesce(1), folder)
            break
        except ConcurrentWrite:
            continue
    live = {*before, *now}
    for part in dead - live:
        remove(spark, f"{path}/data/{part.folder}")
    busy = {w for w in children(spark, f"{path}/writing") if hours_old(spark, f"{path}/writing/{w}") < _CLAIM_HOURS}
    held = {p.write for p in live} | busy
    for old in children(spark, f"{path}/data"):
        if old.removeprefix("write=") not in held:
            remove(spark, f"{path}/data/{old}")


def _replace(
    df: DataFrame, path: str, by: list[str], replaced: Callable[[list[Part]], list[Part]], buckets: dict[Month, int], placed: bool = False
) -> None:
    spark, write = df.sparkSession, f"w{uuid.uuid4().hex}"
    try:
        _put(df, path, write, by, placed)
        written = _stored_parts(spark, path, write, buckets)
        if written:
            _switch(spark, path, write, written, replaced(written))
        else:
            remove(spark, f"{path}/data/write={write}")
    finally:
        remove(spark, f"{path}/writing/{write}")


def write_by_month(df: DataFrame, path: str, placed: bool = False) -> None:
    """Write a fact by (year, month), replacing only the months that occur in `df`.

    Every write has a folder of its own; a small versioned table says which write holds which month and is switched last,
    so that readers see all of the new months or none. `df` may be read from the fact itself. Its rows are shuffled by month, unless
    they are `placed`: a few tasks hold each month's.
    """
    before = live_parts(df.sparkSession, path)

    def replaced(written: list[Part]) -> list[Part]:
        months = {p.place[:2] for p in written}
        return [p for p in before if p.place[:2] in months]

    _replace(df, path, ["year", "month"], replaced, {}, placed)


def write_buckets(df: DataFrame, path: str, buckets: dict[Month, int], replaced: list[Part]) -> None:
    """Write parts (year, month, bucket) of a fact, in place of the parts that `df` was made from. `buckets`: how many a month has, if not one."""
    _replace(df, path, ["year", "month", "bucket"], lambda _: replaced, buckets)


def part_bytes(spark: SparkSession, path: str, part: Part) -> int:
    return stored_size(spark, f"{path}/data/{part.folder}")


def read_parts(spark: SparkSession, path: str, parts: list[Part], schema: StructType | None = None) -> DataFrame:
    """Some parts of a fact. Only their folders are opened and listed."""
    frames = []
    for cut in (False, True):
        folders = [f"{path}/data/{p.folder}" for p in parts if (p.bucket is not None) == cut]
        if folders:
            rows = spark.read.option("basePath", f"{path}/data").parquet(*folders).drop("write", "bucket")
            frames.append(rows if schema is None else schemas.conform(rows, schema))
    if not frames:
        if schema is None:
            raise FileNotFoundError(f"{path} has no such month")
        return spark.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, frames)


def read_by_month(spark: SparkSession, path: str, schema: StructType | None = None, months: list[Month] | None = None) -> DataFrame:
    """A fact of write_by_month or write_buckets, each part from its last complete write, only some months if any are named;
    empty if there is none and a schema says of what."""
    if not exists(spark, path) and schema is not None:
        return spark.createDataFrame([], schema)
    parts = live_parts(spark, path)
    if not parts:
        if exists(spark, f"{path}/data"):
            raise FileNotFoundError(f"{path} has no complete month")
        return read_optional(spark, path, schema) if schema is not None else read_table(spark, path)
    return read_parts(spark, path, [p for p in parts if months is None or p.place[:2] in months], schema)


def is_month(months: list[Month]) -> Column:
    def one(year: int | None, month: int | None) -> Column:
        y = F.col("year").isNull() if year is None else F.col("year") == year
        m = F.col("month").isNull() if month is None else F.col("month") == month
        return y & m

    return reduce(lambda a, b: a | b, [one(y, m) for y, m in months], F.lit(False))


def only_months(df: DataFrame, months: list[Month]) -> DataFrame:
    """Rows of some (year, month) partitions, as a filter that prunes folders."""
    return df.filter(is_month(months))


def months_of(df: DataFrame) -> list[Month]:
    """The distinct (year, month) of a frame: as many as the calendar has, so they fit the driver."""
    return [(r["year"], r["month"]) for r in df.select("year", "month").distinct().collect()]
