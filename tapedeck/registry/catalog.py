"""Registration of queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tapedeck.registry.views import Views
from tapedeck.registry.views_sql import with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable:
    """Register a function of the views under a name, with the SQL that must give the same rows."""

    def register(build: Callable[[Views], DataFrame]) -> Callable:
        QUERIES[name] = lambda spark, sf_dir: build(Views(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = with_views(sql)
        return build

    return register
