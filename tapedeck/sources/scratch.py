"""Where intermediate tables go."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_root(spark: SparkSession) -> str:
    """A new folder under the cluster's shared checkpoint folder.

    Only a local session that names none (tests, bench) gets a machine-local one.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if shared:
        return f"{shared.rstrip('/')}/tapedeck-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="tapedeck-")
