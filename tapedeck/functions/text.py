"""String rules: ids inside URIs, years inside dates, search keys and storage keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# URI prefixes of the music service.
TRACK_URI_PREFIX = "spotify:track:"
ARTIST_URI_PREFIX = "spotify:artist:"
# Fixed value: what separates artist from track in a pair key.
PAIR_SEPARATOR = "||"


def track_id_from_uri(uri: Column) -> Column:
    """The last part of a track URI; null for any other kind of URI."""
    return F.when(uri.startswith(TRACK_URI_PREFIX), F.element_at(F.split(uri, ":"), -1))


def release_year(release_date: Column) -> Column:
    """First four characters as a number when they are one; release dates come as year, month or day."""
    head = F.substring(release_date, 1, 4)
    return F.when(head.rlike("^-?[0-9]+$"), head.try_cast("int"))


def search_key(c: Column) -> Column:
    """A name without the quotes that a structured search cannot hold."""
    return F.translate(c, "'\"", "")


def is_filled(c: Column) -> Column:
    return F.length(F.coalesce(c, F.lit(""))) > 0


def counter_or_zero(c: Column) -> Column:
    """A text counter as a number: missing or empty is 0, anything else that is no number is null."""
    return F.when(is_filled(c), F.trim(c).try_cast("bigint")).otherwise(F.lit(0).cast("bigint"))


def pair_key(artist: Column, track: Column) -> Column:
    return F.concat(artist, F.lit(PAIR_SEPARATOR), track)


def encode_key(c: Column) -> Column:
    """Base64 of a key on one line (Spark breaks base64 into lines of 76 characters)."""
    return F.regexp_replace(F.base64(c.cast("binary")), r"\s", "")


def path_safe(encoded: Column) -> Column:
    """An encoded key that can be a file name: plain base64 may hold a slash."""
    return F.translate(encoded, "+/", "-_")


def decode_key(encoded: Column) -> Column:
    """The key behind its base64 form, or null when the text is no base64 or the bytes are no UTF-8."""
    return F.try_validate_utf8(F.try_to_binary(encoded, F.lit("base64")).cast("string"))


def is_pair_key(key: Column) -> Column:
    return key.contains(PAIR_SEPARATOR)


def pair_artist(key: Column) -> Column:
    return F.when(is_pair_key(key), F.get(F.split(key, r"\|\|", 2), 0))


def pair_track(key: Column) -> Column:
    return F.when(is_pair_key(key), F.get(F.split(key, r"\|\|", 2), 1))
