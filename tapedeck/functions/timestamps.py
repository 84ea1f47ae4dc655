"""Parsing, splitting and formatting of play times. All table times are zone-less and mean UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def _without_zulu(c: Column) -> Column:
    return F.regexp_replace(c, "Z$", "")


def parse_utc(c: Column) -> Column:
    """ISO-8601 text with a trailing Z to a UTC timestamp; bad text is an error."""
    return _without_zulu(c).cast("timestamp_ntz")


def try_parse_utc(c: Column) -> Column:
    """Like parse_utc, but bad text is null."""
    return _without_zulu(c).try_cast("timestamp_ntz")


def parse_minute(c: Column, zone: str | None = None) -> Column:
    """`yyyy-MM-dd HH:mm` text to a timestamp, read as UTC unless the account's zone is given; bad text is null."""
    minute = F.when(c.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}$"), F.concat(c, F.lit(":00")))
    parsed = minute.try_cast("timestamp_ntz")
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), parsed) if zone else parsed


def epoch_millis(c: Column) -> Column:
    """Milliseconds since 1970 of a UTC timestamp, whatever the session zone is."""
    seconds = (c - F.expr(_EPOCH)).cast("interval second").cast("decimal(20,6)")
    return F.floor(seconds * 1000).cast("bigint")


def from_epoch_millis(c: Column) -> Column:
    zero = F.lit(0)
    return F.expr(_EPOCH) + F.make_dt_interval(zero, zero, zero, (c / F.lit(1000).cast("decimal(5,1)")).cast("decimal(18,6)"))


def weekday(c: Column) -> Column:
    """1 for Monday to 7 for Sunday."""
    return F.weekday(c) + 1


def is_weekend(c: Column) -> Column:
    return weekday(c) >= 6


def play_date_parts(c: Column) -> dict[str, Column]:
    return {
        "played_year": F.year(c),
        "played_month": F.month(c),
        "played_day": F.dayofmonth(c),
        "played_hour": F.hour(c),
        "played_dow": weekday(c),
        "is_weekend": is_weekend(c),
    }


def landing_parts(c: Column) -> dict[str, Column]:
    """Folder values of the landing zone: year, and zero-padded month and day."""
    return {
        "year": F.date_format(c, "yyyy"),
        "month": F.date_format(c, "MM"),
        "day": F.date_format(c, "dd"),
    }


def landing_stamp(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd-HHmmss")
