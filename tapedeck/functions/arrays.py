"""List rules: first element, genre union, tag clean-up."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tags without analytical signal.
NOISE_TAGS = [
    "seen live", "favourite", "favorites", "love", "loved", "awesome", "good", "bad", "cool",
    "my favorite", "favorite", "amazing", "great", "best", "beautiful", "nice", "songs i like",
    "my music", "check", "todo", "to listen", "heard on rdio", "spotify", "youtube",
    "under 2000 listeners", "all", "music",
]
# Fixed value: how many tags a record keeps.
MAX_TAGS = 5


def first_or_null(c: Column) -> Column:
    """First element; null for an empty or missing list."""
    return F.get(c, F.lit(0))


def combine_genres(genres: Column, tags: Column) -> Column:
    """Distinct union of two lists in sorted order; null when nothing is left."""
    empty = F.array().cast("array<string>")
    union = F.sort_array(F.array_distinct(F.concat(F.coalesce(genres, empty), F.coalesce(tags, empty))))
    return F.when(F.size(union) > 0, union)


def clean_tags(names: Column) -> Column:
    """Lower-case tag names, noise removed, the first five kept in their order."""
    lowered = F.transform(names, F.lower)
    kept = F.filter(lowered, lambda t: t.isNotNull() & ~t.isin(NOISE_TAGS))
    return F.slice(kept, 1, MAX_TAGS)


def tag_names(response: Column, path: str) -> Column:
    """Tag names of a raw response, where one tag comes as an object and several as a list."""
    found = F.from_json(F.get_json_object(response, path), "array<struct<name: string>>")
    return F.coalesce(found.getField("name"), F.array().cast("array<string>"))
