"""The given tables seen as a music-listening history, in Spark.

The tables hold no listening data, so order lines play the part of plays, parts that of tracks,
brands of albums and suppliers of artists. `views_sql` states the same mappings in SQL.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property, partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from tapedeck import schemas
from tapedeck.functions.text import ARTIST_URI_PREFIX, TRACK_URI_PREFIX, encode_key, pair_key
from tapedeck.plans.silver import Dimensions
from tapedeck.schemas import AUDIO_FEATURES, conform
from tapedeck.sources import bronze
from tapedeck.sources.at_once import at_once
from tapedeck.sources.catalogue import Catalogue, keep_by_key, read_kept
from tapedeck.sources.scratch import scratch_root

_BRONZE: dict[tuple[str, str, str], str] = {}
_KEPT: dict[tuple[str, str], str] = {}
# Records of an array, about, and order lines of a task that writes arrays.
ARRAY, TASK_LINES = 1000, 250_000
# Order lines of a task that makes JSON of them and parses it.
JSON_LINES = 100_000
# Files that one task writes, about.
TASK_FILES = 500


def when_null(condition: Column, otherwise: Column) -> Column:
    return F.when(~condition, otherwise)


class Views:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def scratch(self, name: str) -> str:
        """A new folder for files that a query writes and reads back."""
        return f"{scratch_root(self.spark)}/{name}"

    # ------------------------------------------------------------ plays

    @cached_property
    def lines(self) -> DataFrame:
        """Order lines with their part and the names that all play views share."""
        li, part = self.table("lineitem"), self.table("part")
        supp = F.col("l_suppkey")
        shared = supp - F.when(supp % 10 == 9, 1).otherwise(0)
        name = (
            F.when((F.col("l_returnflag") == "A") & (F.col("l_tax") >= 0.08), None)
            .when(supp % 7 == 0, F.concat(F.lit("Artist "), supp, F.lit("-"), F.year("l_shipdate")))
            .otherwise(F.concat(F.lit("Artist "), shared))
        )
        return (
            li.join(part, li["l_partkey"] == part["p_partkey"])
            .withColumn("played_at_utc", F.expr("l_shipdate + make_dt_interval(0, (l_linenumber % 3) * 6)"))
            .withColumn("line_track_id", when_null(F.col("p_size").isin(5, 17, 29, 41), F.concat(F.lit("T"), "l_partkey")))
            .withColumn("line_artist", name)
        )

    def spread_lines(self) -> DataFrame:
        """`lines` dealt evenly to tasks in number of the lines, for work that costs much a line: the files' splits follow their bytes,
        which are few for a line, and are whole row groups."""
        tasks = 1 + self.table("lineitem").count() // JSON_LINES
        return self.lines.repartition(tasks, "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")

    @cached_property
    def plays(self) -> DataFrame:
        """Events of all three sources before dedup."""
        flag, status = F.col("l_returnflag"), F.col("l_linestatus")
        api, extended = flag == "A", flag == "R"
        return conform(
            self.lines.select(
                "played_at_utc",
                F.col("line_track_id").alias("track_id"),
                F.col("p_name").alias("track_name"),
                F.col("line_artist").alias("artist_name"),
                (F.col("l_quantity") * 2000).cast("bigint").alias("duration_ms"),
                F.when(api, F.when(status == "F", "playlist").otherwise("album")).alias("context_type"),
                F.when(api & (status == "F"), F.concat(F.lit("ctx:"), "l_suppkey")).alias("context_uri"),
                F.when(api, "api").when(extended, "extended_export").otherwise("export").alias("source_type"),
                F.when(extended, F.when(status == "F", "ios").otherwise("android")).alias("platform"),
                F.when(extended, F.when(F.col("l_discount") > 0.05, "BE").otherwise("FR")).alias("conn_country"),
                F.when(extended, F.when(status == "F", "trackdone").otherwise("clickrow")).alias("reason_start"),
                F.when(extended, F.when(F.col("l_linenumber") > 3, "fwdbtn").otherwise("trackdone")).alias("reason_end"),
                F.when(extended, F.col("l_linenumber") > 3).alias("shuffle"),
                F.when(extended, status == "F").alias("skipped"),
                F.when(extended, F.col("l_discount") == 0).alias("offline"),
                F.when(extended, F.col("l_tax") == 0).alias("incognito_mode"),
                F.when(extended, F.col("p_brand")).alias("album_name"),
            ),
            schemas.EVENTS,
        )

    # ------------------------------------------------------------ silver dimensions

    @staticmethod
    def release_date(brand: Column) -> Column:
        year = F.lit(1970) + brand
        return (
            F.when(brand <= 6, year.cast("string"))
            .when(brand <= 12, F.concat(year, F.lit("-05")))
            .when(brand <= 20, F.concat(year, F.lit("-05-01")))
            .otherwise("n/a")
        )

    @staticmethod
    def brand_number() -> Column:
        return F.expr("cast(substring(p_brand, 7) as int)")

    @staticmethod
    def album_type(brand: Column) -> Column:
        return F.when(brand <= 10, "album").when(brand <= 20, "single").otherwise("compilation")

    @cached_property
    def tracks(self) -> DataFrame:
        size = F.col("p_size")
        return conform(
            self.table("part").select(
                F.concat(F.lit("T"), "p_partkey").alias("track_id"),
                F.col("p_name").alias("track_name"),
                F.when(size == 22, 0).otherwise(size * 2000).alias("duration_ms"),
                (size % 2 == 0).alias("explicit"),
                when_null(size <= 10, size * 2).alias("popularity"),
                size.alias("track_number"),
                when_null(size == 13, F.col("p_brand")).alias("album_id"),
                F.concat(F.lit(TRACK_URI_PREFIX), F.lit("T"), "p_partkey").alias("track_uri"),
                when_null(F.col("p_type") == "SMALL", F.concat(F.lit("ISRC"), "p_partkey")).alias("isrc"),
            ),
            schemas.TRACKS,
        )

    @cached_property
    def albums(self) -> DataFrame:
        brand = self.brand_number()
        return conform(
            self.table("part").select("p_brand").distinct().select(
                F.col("p_brand").alias("album_id"),
                F.col("p_brand").alias("album_name"),
                self.album_type(brand).alias("album_type"),
                self.release_date(brand).alias("release_date"),
                brand.alias("total_tracks"),
                F.concat(F.lit("img/"), "p_brand").alias("image_url"),
                when_null(brand == 3, F.concat(F.lit("Label "), brand % 5)).alias("label"),
                when_null(brand > 20, F.concat(F.lit("UPC"), brand)).alias("upc"),
                brand.alias("popularity"),
            ),
            schemas.ALBUMS,
        )

    @cached_property
    def artists(self) -> DataFrame:
        key = F.col("s_suppkey")
        return conform(
            self.table("supplier").select(
                F.concat(F.lit("A"), key).alias("artist_id"),
                F.concat(F.lit("Artist "), key - F.when(key % 10 == 9, 1).otherwise(0)).alias("artist_name"),
                F.concat(F.lit(ARTIST_URI_PREFIX), F.lit("A"), key).alias("artist_uri"),
                (key * 100).alias("followers_total"),
                (key % 100).alias("popularity"),
            ),
            schemas.ARTISTS,
        )

    @cached_property
    def described_lines(self) -> DataFrame:
        """All lines of the suppliers that the services describe: those of the first four nations have neither genres nor tags."""
        known = self.table("supplier").filter(F.col("s_nationkey") >= 4).select(F.col("s_suppkey").alias("l_suppkey"))
        return self.lines.join(known, "l_suppkey", "left_semi")

    @cached_property
    def artist_genres(self) -> DataFrame:
        """(supplier, part type) of everything a supplier sells."""
        return self.described_lines.select(F.col("l_suppkey").alias("artist_rowid"), F.col("p_type").alias("genre")).distinct()

    @cached_property
    def artists_with_genres(self) -> DataFrame:
        genres = self.artist_genres.groupBy(F.concat(F.lit("A"), "artist_rowid").alias("artist_id")).agg(
            F.sort_array(F.collect_list("genre")).alias("genres")
        )
        return conform(self.artists.drop("genres").join(genres, "artist_id", "left"), schemas.ARTISTS)

    @cached_property
    def track_tags(self) -> DataFrame:
        words = F.split("p_name", " ")
        return conform(
            self.table("part").filter(F.col("p_size") > 8).select(
                F.concat(F.lit("T"), "p_partkey").alias("track_id"),
                words.alias("tags"),
                F.get(words, F.lit(0)).alias("top_tag"),
                (F.col("p_size") * 10).alias("listeners"),
                (F.col("p_size") * 100).alias("playcount"),
            ),
            schemas.TRACK_TAGS,
        )

    @cached_property
    def artist_tags(self) -> DataFrame:
        """The first words of the names of all parts that a supplier sells."""
        words = F.sort_array(F.collect_set(F.get(F.split("p_name", " "), F.lit(0))))
        return conform(
            self.described_lines.groupBy(F.concat(F.lit("A"), "l_suppkey").alias("artist_id"))
            .agg(words.alias("tags"))
            .withColumn("top_tag", F.get("tags", F.lit(0))),
            schemas.ARTIST_TAGS,
        )

    # ------------------------------------------------------------ features and catalogue

    @cached_property
    def feature_text(self) -> DataFrame:
        """The feature dump, all text. Fractions are multiples of 1/128, whose sums are exact."""
        key = F.col("p_partkey")

        def fraction(factor: int) -> Column:
            return (key * factor % 129) / F.lit(128.0)

        values = {
            "time_signature": F.lit(3) + key % 3,
            "tempo": F.lit(60.5) + key % 100,
            "key": key % 12,
            "mode": key % 2,
            "danceability": fraction(71),
            "energy": fraction(37),
            "loudness": F.col("p_size") / F.lit(-4.0),
            "speechiness": fraction(11),
            "acousticness": fraction(13),
            "instrumentalness": fraction(17),
            "liveness": fraction(19),
            "valence": fraction(53),
        }
        return self.table("part").filter(F.col("p_type") != "PROMO").select(
            F.concat(F.lit("T"), key).alias("track_id"),
            F.when(F.col("p_size") >= 48, "1").otherwise("0").alias("null_response"),
            *[values[c].cast("string").alias(c) for c in AUDIO_FEATURES],
        )

    @cached_property
    def features(self) -> DataFrame:
        usable = self.feature_text.filter(F.col("null_response") == "0")
        return usable.select("track_id", *[F.col(c).cast(t).alias(c) for c, t in AUDIO_FEATURES.items()])

    @cached_property
    def catalogue(self) -> Catalogue:
        size, key, brand = F.col("p_size"), F.col("p_partkey"), self.brand_number()
        tracks = self.table("part").select(
            key.alias("rowid"),
            F.concat(F.lit("T"), key).alias("id"),
            F.col("p_name").alias("name"),
            (size * 2000).alias("duration_ms"),
            when_null(size == 1, size % 2).alias("explicit"),
            when_null(size > 45, size * 2).alias("popularity"),
            size.alias("track_number"),
            (key % 3 + 1).alias("disc_number"),
            when_null(F.col("p_type") == "LARGE", F.concat(F.lit("ISRC"), key)).alias("external_id_isrc"),
            brand.alias("album_rowid"),
        )
        albums = self.albums.select(
            F.expr("cast(substring(album_id, 7) as bigint)").alias("rowid"),
            F.col("album_id").alias("id"),
            F.col("album_name").alias("name"),
            "album_type",
            "release_date",
            "total_tracks",
            "label",
            F.col("upc").alias("external_id_upc"),
            "popularity",
        )
        artists = self.artists.select(
            F.expr("cast(substring(artist_id, 2) as bigint)").alias("rowid"),
            F.col("artist_id").alias("id"),
            F.col("artist_name").alias("name"),
            "followers_total",
            "popularity",
        )
        credits = self.table("lineitem").select(
            F.col("l_partkey").alias("track_rowid"), F.col("l_suppkey").alias("artist_rowid")
        ).distinct()
        frames = {
            "tracks": tracks,
            "albums": albums,
            "artists": artists,
            "track_artists": credits,
            "artist_genres": self.artist_genres,
            "track_audio_features": self.feature_text,
        }
        return Catalogue(**{n: conform(df, schemas.CATALOGUE[n]) for n, df in frames.items()})

    # ------------------------------------------------------------ look-ups

    @cached_property
    def mapping(self) -> DataFrame:
        """Resolved names: several parts share a name, so a pair may have several ids."""
        resolved = (F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "O")
        return self.lines.filter(resolved).select(
            F.col("line_artist").alias("search_artist_name"),
            F.col("p_name").alias("search_track_name"),
            F.concat(F.lit("T"), "l_partkey").alias("enriched_track_id"),
        ).distinct()

    @cached_property
    def attempts(self) -> DataFrame:
        """Earlier look-ups: ids of one part type, pairs of another, and artists; some tried twice."""
        part, supplier = self.table("part"), self.table("supplier")
        economy = part.filter(F.col("p_type") == "ECONOMY").select(
            F.concat(F.lit("T"), "p_partkey").alias("plain"),
            F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, p_size)").alias("attempted_at"),
            when_null(F.col("p_size") <= 25, F.concat(F.lit("payload "), "p_size")).alias("payload"),
        )
        retried = part.filter((F.col("p_type") == "ECONOMY") & (F.col("p_size") <= 25)).select(
            F.concat(F.lit("T"), "p_partkey").alias("plain"),
            F.expr("timestamp_ntz'2024-02-01 00:00:00'").alias("attempted_at"),
            F.concat(F.lit("retry "), "p_size").alias("payload"),
        )
        pairs = self.plays.join(
            part.filter(F.col("p_type") == "SMALL").select(F.col("p_name").alias("track_name")).distinct(),
            "track_name",
            "left_semi",
        )
        pairs = pairs.filter((F.col("source_type") == "export") & (F.col("duration_ms") >= 80_000)).select(
            pair_key(F.col("artist_name"), F.col("track_name")).alias("plain"),
            F.expr("timestamp_ntz'2024-01-15 00:00:00'").alias("attempted_at"),
            F.lit(None).cast("string").alias("payload"),
        ).distinct()
        artists = supplier.filter(F.col("s_nationkey") > 15).select(
            F.concat(F.lit("A"), "s_suppkey").alias("plain"),
            F.expr("timestamp_ntz'2024-01-20 00:00:00'").alias("attempted_at"),
            F.lit("tags").alias("payload"),
        )
        every = economy.unionByName(retried).unionByName(pairs).unionByName(artists)
        return every.select(
            encode_key(F.col("plain")).alias("key"),
            F.when(F.col("payload").isNull(), "not_found").otherwise("found").alias("status"),
            "payload",
            "attempted_at",
        )

    # ------------------------------------------------------------ bronze

    def artist_entry(self, artist_id: Column, name: Column) -> Column:
        return F.struct(
            artist_id.alias("id"),
            name.alias("name"),
            F.lit("artist").alias("type"),
            F.concat(F.lit(ARTIST_URI_PREFIX), artist_id).alias("uri"),
            F.concat(F.lit("api/artists/"), artist_id).alias("href"),
            F.create_map(F.lit("page"), artist_id).alias("external_urls"),
        )

    def album_entry(self) -> Column:
        brand, size = self.brand_number(), F.col("p_size")
        image = F.struct(
            F.concat(F.lit("img/"), "p_brand", F.lit("/"), size).alias("url"),
            F.lit(640).alias("height"),
            F.lit(640).alias("width"),
        )
        owner = self.artist_entry(F.concat(F.lit("A"), "l_suppkey"), F.concat(F.lit("Owner "), "l_suppkey"))
        return F.struct(
            when_null(size == 13, F.col("p_brand")).alias("id"),
            F.col("p_brand").alias("name"),
            self.album_type(brand).alias("album_type"),
            size.cast("bigint").alias("total_tracks"),
            self.release_date(brand).alias("release_date"),
            F.lit("year").alias("release_date_precision"),
            F.lit("album").alias("type"),
            F.concat(F.lit("spotify:album:"), "p_brand").alias("uri"),
            F.concat(F.lit("api/albums/"), "p_brand").alias("href"),
            F.when(size > 20, F.array(image)).otherwise(F.array().cast(ArrayType(schemas.IMAGE))).alias("images"),
            F.array(owner).alias("artists"),
        )

    def track_entry(self, track_id: Column, track_number: Column, artists: Column, isrc: Column | None) -> Column:
        size = F.col("p_size")
        fields = [
            track_id.alias("id"),
            F.col("p_name").alias("name"),
            (size * 2000).cast("bigint").alias("duration_ms"),
            (size % 2 == 0).alias("explicit"),
            when_null(size <= 10, size * 2).cast("bigint").alias("popularity"),
            track_number.cast("bigint").alias("track_number"),
            F.lit("track").alias("type"),
            F.concat(F.lit(TRACK_URI_PREFIX), track_id).alias("uri"),
            F.concat(F.lit("api/tracks/"), track_id).alias("href"),
            F.lit(False).alias("is_local"),
            self.album_entry().alias("album"),
            artists.alias("artists"),
        ]
        if isrc is not None:
            fields.append(F.struct(isrc.alias("isrc")).alias("external_ids"))
        return F.struct(*fields)

    @cached_property
    def nested_plays(self) -> DataFrame:
        """Recently-played items: the lines of the first source."""
        return self.nested(self.lines.filter(F.col("l_returnflag") == "A"))

    @cached_property
    def extended_rows(self) -> DataFrame:
        return self.extended(self.lines.filter(F.col("l_returnflag") == "R"))

    @cached_property
    def standard_rows(self) -> DataFrame:
        return self.standard(self.lines.filter(F.col("l_returnflag") == "N"))

    def nested(self, lines: DataFrame, *kept: str) -> DataFrame:
        """Nested items with a guest artist, without the field the service leaves out, behind columns that are kept."""
        key = F.col("l_suppkey")
        main = self.artist_entry(F.concat(F.lit("A"), key), F.col("line_artist"))
        guest = self.artist_entry(F.concat(F.lit("A"), key + 1), F.concat(F.lit("Guest "), key + 1))
        artists = F.when(F.col("line_artist").isNull(), F.array().cast(ArrayType(schemas.ARTIST))).otherwise(
            F.array(main, guest)
        )
        context = F.struct(
            F.when(F.col("l_linestatus") == "F", "playlist").otherwise("album").alias("type"),
            F.concat(F.lit("ctx:"), key).alias("uri"),
            F.concat(F.lit("api/ctx/"), key).alias("href"),
            F.create_map(F.lit("page"), F.lit("x")).alias("external_urls"),
        )
        return lines.select(
            *kept,
            F.date_format("played_at_utc", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("played_at"),
            F.when(F.col("l_discount") > 0, context).alias("context"),
            self.track_entry(F.col("line_track_id"), F.col("l_linenumber"), artists, None).alias("track"),
        )

    def extended(self, lines: DataFrame, *kept: str) -> DataFrame:
        """Extended export rows; some are podcasts, some have an unreadable time."""
        size, status = F.col("p_size"), F.col("l_linestatus")
        stamp = F.date_format("played_at_utc", "yyyy-MM-dd'T'HH:mm:ss'Z'")
        uri = F.when(size == 4, F.concat(F.lit("spotify:episode:"), "l_partkey")).otherwise(
            F.concat(F.lit(TRACK_URI_PREFIX), "line_track_id")
        )
        return lines.select(
            *kept,
            F.when((size == 50) & (F.col("l_tax") == 0), "not a time").otherwise(stamp).alias("ts"),
            F.when(status == "F", "ios").otherwise("android").alias("platform"),
            (F.col("l_quantity") * 2000).cast("bigint").alias("ms_played"),
            F.when(F.col("l_discount") > 0.05, "BE").otherwise("FR").alias("conn_country"),
            when_null(size == 3, F.col("p_name")).alias("master_metadata_track_name"),
            when_null(size == 3, F.col("line_artist")).alias("master_metadata_album_artist_name"),
            F.col("p_brand").alias("master_metadata_album_album_name"),
            uri.alias("spotify_track_uri"),
            F.when(status == "F", "trackdone").otherwise("clickrow").alias("reason_start"),
            F.when(F.col("l_linenumber") > 3, "fwdbtn").otherwise("trackdone").alias("reason_end"),
            (F.col("l_linenumber") > 3).alias("shuffle"),
            (status == "F").alias("skipped"),
            (F.col("l_discount") == 0).alias("offline"),
            (F.col("l_tax") == 0).alias("incognito_mode"),
        )

    def standard(self, lines: DataFrame, *kept: str) -> DataFrame:
        """Standard export rows; durations are missing on some, which makes them malformed."""
        return lines.select(
            *kept,
            F.date_format("played_at_utc", "yyyy-MM-dd HH:mm").alias("endTime"),
            F.col("line_artist").alias("artistName"),
            when_null(F.col("p_size") == 3, F.col("p_name")).alias("trackName"),
            when_null(F.col("l_quantity") == 1, (F.col("l_quantity") * 2000).cast("bigint")).alias("msPlayed"),
        )

    @cached_property
    def marker_rows(self) -> DataFrame:
        """Look-up results: full records for resolved pairs, not_found for the others."""
        new = self.lines.filter(F.col("l_returnflag") == "N")
        artist = F.array(self.artist_entry(F.concat(F.lit("A"), "l_suppkey"), F.col("line_artist")))
        isrc = when_null(F.col("p_type") == "SMALL", F.concat(F.lit("ISRC"), "l_partkey"))
        record = self.track_entry(F.concat(F.lit("T"), "l_partkey"), F.lit(1), artist, isrc)
        found = new.filter(F.col("l_linestatus") == "O").select(
            F.col("line_artist").alias("search_artist_name"),
            F.col("p_name").alias("search_track_name"),
            record.alias("track"),
        )
        missed = new.filter(F.col("l_linestatus") == "F").select(F.lit(True).alias("not_found"))
        return found.unionByName(missed, allowMissingColumns=True)

    def _arrays(self, flag: str, build: Callable[..., DataFrame], bad: str) -> DataFrame:
        """Arrays as other tools write them, of the records that `build` makes of the lines with a flag.

        A day, of the records' first field, has an array for about every ARRAY of them, and a badly typed record in one of them. Lines are
        shuffled, not their JSON: it is made where it is written.
        """
        lines = self.lines.filter(F.col("l_returnflag") == flag)
        at = build(lines, *lines.columns).columns[len(lines.columns)]
        dated = build(lines, *lines.columns).select(*lines.columns, F.substring(at, 1, 10).alias("_day"))
        dated = dated.withColumn("_hash", F.xxhash64("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))
        days = dated.groupBy(F.col("_day").alias("_of")).agg(
            (F.floor(F.count(F.lit(1)) / ARRAY) + 1).alias("_pieces"), F.min("_hash").alias("_first")
        )
        cut = dated.join(F.broadcast(days), F.col("_day").eqNullSafe(F.col("_of")))
        cut = cut.withColumns({"_piece": F.pmod("_hash", "_pieces"), "_bad": F.pmod("_hash", "_pieces") == F.pmod("_first", "_pieces")})
        tasks = 1 + self.table("lineitem").count() // TASK_LINES
        keys = ["_day", "_piece", "_bad"]
        records = build(cut.repartition(tasks, "_day", "_piece"), *keys)
        made = records.select(*keys, F.to_json(F.struct(*records.columns[len(keys):])).alias("json")).groupBy(*keys)
        first = F.when(F.col("_bad"), F.lit(f"{bad},")).otherwise("")
        return made.agg(F.array_join(F.collect_list("json"), ",").alias("json")).select(
            F.concat(F.lit("["), first, "json", F.lit("]")).alias("value")
        )

    def _write_source(self, name: str, root: str) -> str:
        """The raw JSON of one source under `root`, compressed."""
        path = f"{root}/{schemas.BRONZE_PATHS[name]}"
        if name == "plays":
            bad = '{"played_at":"1997-01-01T00:00:00.000Z","track":{"id":"bad","duration_ms":"long"}}'
            bronze.write_lines(self._arrays("A", self.nested, bad), path)
        elif name == "exports":
            bad = '{"ts":"1997-01-01T00:00:00Z","ms_played":"x","skipped":"maybe"}', '{"endTime":"1997-01-01 00:00","msPlayed":"x"}'
            at_once(
                self.spark,
                lambda: bronze.write_lines(self._arrays("R", self.extended, bad[0]), f"{path}/Streaming_History_Audio"),
                lambda: bronze.write_lines(self._arrays("N", self.standard, bad[1]), f"{path}/StreamingHistory"),
            )
        else:
            records, bad = {
                "track_markers": (self.marker_rows, '{"search_artist_name":"bad","track":{"id":"bad","duration_ms":"long"}}'),
                "track_tag_markers": (self.track_tags, '{"track_id":"bad","tags":["x"],"listeners":"many"}'),
                "artist_tag_markers": (self.artist_tags, '{"artist_id":"bad","tags":"x"}'),
            }[name]
            bronze.write_json_lines(records, path)
            self.table("region").select(F.lit(bad).alias("value")).write.mode("append").text(path)
            if name == "track_markers":
                broken = self.spark.range(1, numPartitions=1).select(F.lit('{"search_artist_name": "cut o').alias("value"))
                broken.write.mode("append").text(path)
        return path

    def write_bronze(self, root: str) -> dict[str, str]:
        """The raw JSON of a lake under `root`."""
        self.write_heard(root)
        return self.write_looked_up(root)

    def write_heard(self, root: str) -> None:
        """Plays and exports, as arrays."""
        at_once(self.spark, *[partial(self._write_source, name, root) for name in ("plays", "exports")])

    def write_looked_up(self, root: str) -> dict[str, str]:
        """Results of look-ups, a record in a line. Returns all paths."""
        names = ("track_markers", "track_tag_markers", "artist_tag_markers")
        at_once(self.spark, *[partial(self._write_source, name, root) for name in names])
        return {**{n: f"{root}/{p}" for n, p in schemas.BRONZE_PATHS.items()}, "root": root}

    def bronze(self, name: str) -> str:
        """The folder with the raw JSON of a source, written once per session."""
        slot = (self.spark.sparkContext.applicationId, self.sf_dir, name)
        if slot not in _BRONZE:
            _BRONZE[slot] = self._write_source(name, f"{scratch_root(self.spark)}/lake")
        return _BRONZE[slot]

    @property
    def kept_catalogue(self) -> Catalogue:
        """Copies of the catalogue by key, written once per session."""
        slot = (self.spark.sparkContext.applicationId, self.sf_dir)
        if slot not in _KEPT:
            _KEPT[slot] = f"{scratch_root(self.spark)}/catalogue"
            keep_by_key(self.catalogue, _KEPT[slot], buckets=8)
        return read_kept(self.spark, _KEPT[slot])

    def named_files(self) -> str:
        """A folder with a file for each supplier, whose name and text are known; one in three is no listening history.

        The number of tasks follows that of the files, as the bytes are few; each moves its own files to their place.
        """
        key = F.col("s_suppkey")
        kind = F.when(key % 3 == 0, "StreamingHistory_music_").when(key % 3 == 1, "Streaming_History_Audio_").otherwise("Userdata_")
        root, supplier = self.scratch("files"), self.table("supplier")
        named = supplier.select(F.concat(kind, key).alias("folder"), F.col("s_name").alias("value"))
        spread = named.repartition(1 + supplier.count() // TASK_FILES, "folder")
        spread.write.option("mapreduce.fileoutputcommitter.algorithm.version", "2").partitionBy("folder").text(root)
        return root

    def read_plays(self, used: StructType | None = None) -> DataFrame:
        return bronze.read_plays(self.spark, self.bronze("plays"), used)

    def read_exports(self, used: StructType | None = None) -> DataFrame:
        return bronze.read_exports(self.spark, self.bronze("exports"), used)

    def read_markers(self, used: StructType | None = None) -> DataFrame:
        return bronze.read_markers(self.spark, self.bronze("track_markers"), schemas.TRACK_MARKER, used)

    @cached_property
    def stored_dimensions(self) -> Dimensions:
        """An earlier state of the dimensions, as the catalogue phases left it."""
        with_discs = self.tracks.withColumn("disc_number", F.lit(2).cast("bigint"))
        return Dimensions(artists=self.artists_with_genres, albums=self.albums, tracks=with_discs)

