"""Jobs that don't need each other, under way at the same time."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

# Jobs that are under way at a time: enough for one to use the cores that the last tasks of another leave idle.
AT_ONCE = 6


def at_once(spark: SparkSession, *jobs: Callable[[], Any]) -> list[Any]:
    """What the jobs return, in their order. All come to their end before the first error, by that order, is raised."""
    with ThreadPoolExecutor(AT_ONCE) as pool:
        under_way = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
    return [job.result() for job in under_way]
