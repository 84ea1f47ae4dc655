"""Raw responses of the look-up services to marker records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapedeck.functions.arrays import clean_tags, first_or_null, tag_names
from tapedeck.functions.text import counter_or_zero
from tapedeck.operators.validation import track_is_valid
from tapedeck.schemas import TRACK


def _failed(response: Column) -> Column:
    """No JSON object, or one that reports an error."""
    parsed = F.try_parse_json(response)
    is_object = F.coalesce(F.schema_of_variant(parsed).startswith("OBJECT"), F.lit(False))
    return ~is_object | F.get_json_object(response, "$.error").isNotNull()


def _tagged(responses: DataFrame, key: str, path: str, counters: dict[str, Column]) -> DataFrame:
    response = F.col("response")
    names = tag_names(response, path)
    holder = F.get_json_object(response, path.removesuffix(".tag"))
    no_object = F.coalesce(~F.ltrim(holder).startswith("{"), F.lit(False))
    failed = _failed(response) | no_object | F.exists(names, lambda n: n.isNull())
    for c in counters.values():
        failed = failed | c.isNull()
    tags = F.when(~failed, clean_tags(names))
    return responses.select(
        key,
        tags.alias("tags"),
        first_or_null(tags).alias("top_tag"),
        *[F.when(~failed, c).alias(name) for name, c in counters.items()],
        failed.alias("not_found"),
    )


def parse_track_tags(responses: DataFrame) -> DataFrame:
    """(track_id, response) to tags and counters; an unusable response is marked not_found."""
    counters = {
        name: counter_or_zero(F.get_json_object("response", f"$.track.{name}"))
        for name in ("listeners", "playcount")
    }
    return _tagged(responses, "track_id", "$.track.toptags.tag", counters)


def parse_artist_tags(responses: DataFrame) -> DataFrame:
    """(artist_id, response) to tags; an unusable response is marked not_found."""
    return _tagged(responses, "artist_id", "$.toptags.tag", {})


def parse_tracks(responses: DataFrame) -> DataFrame:
    """(track_id, response) to track markers; a missing or incomplete record is marked not_found."""
    parsed = responses.select("track_id", F.from_json("response", TRACK).alias("track"))
    found = track_is_valid(F.col("track"))
    return parsed.select(
        "track_id",
        F.when(found, first_or_null(F.col("track.artists"))["name"]).alias("search_artist_name"),
        F.when(found, F.col("track.name")).alias("search_track_name"),
        F.when(found, F.col("track")).alias("track"),
        (~found).alias("not_found"),
    )
