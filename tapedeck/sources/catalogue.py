"""The catalogue dump: one Parquet table per entity and per junction."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapedeck import schemas
from tapedeck.sources.files import exists, mark, marked

# The keys by which the phases look a table up, and the columns they take from it then.
COPIES = {
    ("tracks", "name"): ["rowid", "name"],
    ("tracks", "rowid"): schemas.CATALOGUE["tracks"].names,
    ("tracks", "id"): ["id", "external_id_isrc", "popularity", "disc_number"],
    ("artists", "name"): ["rowid", "name"],
    ("artists", "rowid"): ["rowid", "id", "name"],
    ("artists", "id"): ["rowid", "id", "followers_total", "popularity"],
    ("albums", "rowid"): ["rowid", "id", "name", "album_type", "release_date", "total_tracks"],
    ("albums", "id"): ["id", "label", "external_id_upc", "popularity"],
    ("track_artists", "track_rowid"): schemas.CATALOGUE["track_artists"].names,
    ("artist_genres", "artist_rowid"): schemas.CATALOGUE["artist_genres"].names,
    ("track_audio_features", "track_id"): schemas.CATALOGUE["track_audio_features"].names,
}


@dataclass(frozen=True)
class Catalogue:
    tracks: DataFrame
    albums: DataFrame
    artists: DataFrame
    track_artists: DataFrame
    artist_genres: DataFrame
    track_audio_features: DataFrame
    kept: dict[tuple[str, str], DataFrame] = field(default_factory=dict)

    def by(self, name: str, key: str) -> DataFrame:
        """A table for look-ups by one of its columns: the copy that is kept by it, if there is one."""
        return self.kept.get((name, key), getattr(self, name))


def read_catalogue(spark: SparkSession, root: str) -> Catalogue:
    """Open the dump; each use reads only the columns it selects."""

    def table(name: str) -> DataFrame:
        return schemas.conform(spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet"), schemas.CATALOGUE[name])

    return Catalogue(**{name: table(name) for name in schemas.CATALOGUE})


def _table_name(root: str, name: str, key: str) -> str:
    return f"catalogue_{hashlib.sha1(root.encode()).hexdigest()[:12]}_{name}_by_{key}"


def keep_by_key(catalogue: Catalogue, root: str, buckets: int) -> None:
    """Copy the dump under `root`, a copy for each key in COPIES, cut into buckets by the key and sorted by it.

    The dump is shuffled once for this, and no more when phases join the copies on their keys. Every bucket is one file: a task sorts a bucket. The
    number of buckets is noted when all copies are there.
    """
    spark = catalogue.tracks.sparkSession
    for (name, key), columns in COPIES.items():
        table, path = _table_name(root, name, key), f"{root}/{name}_by_{key}"
        spark.sql(f"drop table if exists {table}")
        rows = schemas.conform(getattr(catalogue, name), schemas.CATALOGUE[name]).select(columns).repartition(buckets, F.col(key))
        rows.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(table)
    if not exists(spark, f"{root}/_buckets"):
        mark(spark, f"{root}/_buckets", str(buckets))


def read_kept(spark: SparkSession, root: str) -> Catalogue:
    """The copies of `keep_by_key`, made known to a session that did not write them."""
    buckets, kept = int(marked(spark, f"{root}/_buckets")), {}
    for (name, key), columns in COPIES.items():
        table = _table_name(root, name, key)
        ddl = ", ".join(f"`{c}` {schemas.CATALOGUE[name][c].dataType.simpleString()}" for c in columns)
        spark.sql(
            f"create table if not exists {table} ({ddl}) using parquet clustered by (`{key}`) sorted by (`{key}`) "
            f"into {buckets} buckets location '{root}/{name}_by_{key}'"
        )
        kept[name, key] = spark.table(table)
    # Phases look tables up by a key; whoever takes a table as such gets the copy by row number, or its only one.
    whole = {name: kept.get((name, "rowid")) or next(df for (n, _), df in kept.items() if n == name) for name in schemas.CATALOGUE}
    return Catalogue(**whole, kept=kept)
