"""Small helpers that the operators share."""

from __future__ import annotations

import os
import uuid
from pathlib import Path
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapedeck.sources.scratch import scratch_root


#: Rows that a Python worker is handed at a time at most: texts are long.
BATCH_ROWS = 1000


def prepare(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver did, if it isn't installed for them, and keep their batches small."""
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH")]))
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(name)) > BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


_held: dict = {}


def held(key: tuple, build):
    """What `build` makes for this key, kept by the worker until another key is asked for: workers outlive operators, tables needn't."""
    if key not in _held:
        _held.clear()
        _held[key] = build()
    return _held[key]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Workspace:
    """Tables written aside in the shared folder, so that lost executors cost no earlier work."""

    def __init__(self, spark: SparkSession):
        prepare(spark)
        self.spark, self.root = spark, scratch_root(spark)

    def keep(self, df: DataFrame) -> DataFrame:
        path = f"{self.root}/{uuid.uuid4().hex}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def bucket_of(columns: list[str] | str, buckets: Column | int) -> Column:
    """A bucket that depends on the row alone, hence the same in every attempt of a task."""
    columns = [columns] if isinstance(columns, str) else columns
    return F.pmod(F.xxhash64(*columns), F.lit(buckets) if isinstance(buckets, int) else buckets)


def byte_words(text: str) -> list[bytes]:
    """Words between space, tab, line feed, vertical tab, form feed and carriage return."""
    return text.encode("utf-8", "surrogatepass").split()


class WordTable:
    """Distinct words with what was computed for each.

    `compute` gets a list of words and returns one value for each. The bounds limit a worker's memory, not
    the result: words behind `bound`, and words longer than `longest`, are computed whenever they come.
    """

    def __init__(self, compute, bound: int = 300_000, longest: int = 100):
        self.compute, self.bound, self.longest, self.known = compute, bound, longest, {}

    def lookup(self, words: list) -> list:
        found = list(map(self.known.get, words))
        if None in found:
            fresh = list({w for w, x in zip(words, found, strict=True) if x is None})
            new = dict(zip(fresh, self.compute(fresh), strict=True))
            found = [new[w] if x is None else x for w, x in zip(words, found, strict=True)]
            if len(self.known) + len(new) <= self.bound:
                self.known.update((w, x) for w, x in new.items() if len(w) <= self.longest)
        return found
