"""Every registered query against its SQL, on whole tables of the smallest scale."""

import pytest

import __spark_entry__ as entry
from check_oracle import compare, duck

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()
# Queries of the corpus operators run trained models; their tests are in a folder of their own.
NAMES = [name for name in QUERIES if not name.startswith("op") and name != "pipeline"]


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, con, sf_dir, name):
    note, _, ok = compare(spark, con, name, QUERIES[name], ORACLES.get(name), sf_dir)
    assert ok, note


def test_every_query_has_sql():
    assert not set(NAMES) - set(ORACLES)


def test_entry(spark, sf_dir):
    df = entry.entry(spark)
    assert df.columns[:2] == ["date", "total_plays"]
    assert df.count() > 0
