"""One total order for every place where the semantics leave the choice of a row open."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def total_order(columns: Iterable[str]) -> list[Column]:
    """Ascending by each column in turn, nulls last."""
    return [F.col(c).asc_nulls_last() for c in columns]


def order_struct(*columns: str) -> Column:
    """A struct that compares like total_order, so min() of it is the first row."""
    parts: list[Column] = []
    for i, name in enumerate(columns):
        parts += [F.col(name).isNull().alias(f"null_{i}"), F.col(name).alias(f"value_{i}")]
    return F.struct(*parts)


def first_by_order(order: list[str], values: list[str]) -> Column:
    """Aggregate: the values of the first row by `order`, then by the values; nulls are kept.

    A plain min() of structs: every map task reduces a group to one row, but has to sort its rows to do so.
    """
    names = list(dict.fromkeys([*order, *values]))
    first = F.min(order_struct(*names))
    return F.struct(*[first.getField(f"value_{names.index(v)}").alias(v) for v in values])


def first_values(df: DataFrame, key: str, at: str, values: list[str]) -> DataFrame:
    """Per key the values of its first row by `at`, then by the values; nulls last, and kept.

    Rows are reduced to the distinct values of a key first, by hash: min() of a struct with text needs sorted input,
    which then is those few rows and not all of them.
    """
    distinct = df.groupBy(key, *values).agg(F.min(at).alias(at))
    return distinct.groupBy(key).agg(first_by_order([at], values).alias("first")).select(key, "first.*")


def most_frequent(count: Column, name: Column, when: Column) -> Column:
    """Aggregate over counted values: the value with the highest count, ties by name, null last."""
    candidate = F.when(when, F.struct((-count).alias("n"), name.isNull().alias("missing"), name.alias("value")))
    return F.min(candidate).getField("value")
