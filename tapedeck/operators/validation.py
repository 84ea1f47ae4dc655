"""Record rules: required and typed fields, with failing records set apart and counted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapedeck.functions.timestamps import try_parse_utc

# Fields that the service sends with every record.
_LINK_FIELDS = ["id", "name", "type", "uri", "href", "external_urls"]
_ALBUM_FIELDS = [
    "id", "name", "album_type", "total_tracks", "release_date", "release_date_precision", "type", "uri", "href",
]
_TRACK_FIELDS = ["id", "name", "duration_ms", "explicit", "track_number", "type", "uri", "href", "is_local"]


def _all_set(record: Column, fields: list[str]) -> Column:
    rule = record.isNotNull()
    for name in fields:
        rule = rule & record.getField(name).isNotNull()
    return rule


def _list_ok(items: Column, fields: list[str]) -> Column:
    return items.isNotNull() & F.forall(items, lambda x: _all_set(x, fields))


def track_is_valid(track: Column) -> Column:
    """A full track record: its own fields, its album's, and those of every image and artist."""
    album = track.getField("album")
    rule = (
        _all_set(track, _TRACK_FIELDS)
        & _list_ok(track.getField("artists"), _LINK_FIELDS)
        & _all_set(album, _ALBUM_FIELDS)
        & _list_ok(album.getField("images"), ["url"])
        & _list_ok(album.getField("artists"), _LINK_FIELDS)
    )
    return F.coalesce(rule, F.lit(False))


def play_is_valid(played_at: Column, context: Column, track: Column) -> Column:
    """A played item: a readable time, a full track, and a context that is absent or complete."""
    context_ok = context.isNull() | _all_set(context, ["type", "uri", "href", "external_urls"])
    return F.coalesce(try_parse_utc(played_at).isNotNull() & context_ok & track_is_valid(track), F.lit(False))


def tag_record_is_valid(key: Column, tags: Column) -> Column:
    """A tag record needs its key and a list of tags, empty or not."""
    return F.coalesce(key.isNotNull() & F.forall(tags, lambda t: t.isNotNull()), F.lit(False))


def export_is_valid(played_at: Column, duration_text: Column) -> Column:
    """An export record needs its time and a whole number of milliseconds."""
    return F.coalesce(played_at.isNotNull() & duration_text.try_cast("bigint").isNotNull(), F.lit(False))


def split_valid(df: DataFrame, rule: Column) -> tuple[DataFrame, DataFrame]:
    """Records that pass a rule, and those that do not (for a quarantine table)."""
    return df.filter(rule), df.filter(~rule)


def profile(df: DataFrame, name: str, order: list[str], sample: int = 3) -> DataFrame:
    """Row count, column count and the first rows of a table, as one row."""
    counts = df.agg(F.count(F.lit(1)).alias("rows"))
    head = df.select(*order).orderBy(*order).limit(sample)
    lines = F.sort_array(F.collect_list(F.concat_ws("|", *order)))
    rendered = head.agg(F.array_join(lines, "; ").alias("sample"))
    both = counts.unionByName(rendered, allowMissingColumns=True)
    return both.agg(F.max("rows").alias("rows"), F.max("sample").alias("sample")).select(
        F.lit(name).alias("table_name"), "rows", F.lit(len(df.columns)).alias("columns"), "sample"
    )


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table as one frame."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name, df in tables.items()
    ]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out
