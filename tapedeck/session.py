"""A local session for tests, bench and checks; on a cluster the caller brings its own."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", memory: str | None = None, partitions: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tapedeck")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory or os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
