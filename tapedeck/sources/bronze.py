"""Readers of raw JSON and the writers that land it."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from datetime import datetime

import pandas as pd
from pyarrow.fs import FileSystem
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructField, StructType

from tapedeck import schemas
from tapedeck.functions.timestamps import landing_parts, landing_stamp
from tapedeck.operators.validation import play_is_valid, split_valid
from tapedeck.sources.files import exists

# Why a record can't be read (null if it can), its text, and the file it came from.
CORRUPT, RECORD, SOURCE_FILE = "_corrupt_record", "_record", "_source_file"
# Bytes of a raw file that are kept in one row.
RANGE = 64 * 1024 * 1024
# Ranges that one task reads, about: as many as hold these bytes, but no more than so many.
TASK_BYTES, TASK_RANGES = 2 * RANGE, 2000
# Name patterns of the two export generations (of a file, or of a folder of its parts).
EXPORT_PATH_PATTERN = "(StreamingHistory|Streaming_History).*[.](json|txt|txt[.]gz)$"
# Files of lines, as they are or compressed, and the most lines of a compressed one, as it is read by one task.
LINE_FILES, LINES = "*.{txt,txt.gz}", 100_000


def as_text(reader, schema: StructType):
    """Options of a reader (or stream reader) that takes every top-level field as text, nested ones as their JSON."""
    return (
        reader.schema(_texts(schema))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("recursiveFileLookup", True)
    )


def _texts(schema: StructType) -> StructType:
    return StructType([StructField(name, StringType()) for name in (*schema.names, CORRUPT)])


def _parsed(text: Column, schema: StructType, *more: StructField) -> Column:
    """A record or nested field by its schema, with a field that says whether something did not fit."""
    marked = StructType([*schema.fields, StructField(CORRUPT, StringType()), *more])
    return F.from_json(text, marked, {"columnNameOfCorruptRecord": CORRUPT})


def _nested(kind: DataType) -> bool:
    return isinstance(kind, StructType | ArrayType)


def _field(name: str, kind: DataType, text: Column, parsed: Column) -> tuple[Column, Column]:
    """A field's typed value out of its text (of a nested one out of what was parsed), and whether the text does not fit the type."""
    if isinstance(kind, StringType):
        return text, F.lit(False)
    if isinstance(kind, StructType):
        return parsed.dropFields(CORRUPT), text.isNotNull() & (parsed.isNull() | parsed[CORRUPT].isNotNull())
    value = parsed if isinstance(kind, ArrayType) else text.try_cast(kind)
    return value, text.isNotNull() & value.isNull()


def _judged(schema: StructType, texts: Column, parsed: dict[str, Column], record: Column) -> Column:
    """A record with its types out of its fields' texts, with what is wrong with it and its text."""
    fields = {f.name: _field(f.name, f.dataType, texts[f.name], parsed.get(f.name)) for f in schema.fields}
    wrong = F.array_compact(F.array(*[F.when(bad, F.lit(name)) for name, (_, bad) in fields.items()]))
    broken = texts.isNull() | texts[CORRUPT].isNotNull()
    reason = F.when(broken, F.lit("not JSON")).when(
        F.size(wrong) > 0, F.concat(F.lit("badly typed: "), F.array_join(wrong, ", "))
    )
    values = [value.cast(schema[name].dataType).alias(name) for name, (value, _) in fields.items()]
    return F.struct(*values, reason.alias(CORRUPT), F.when(broken | (F.size(wrong) > 0), record).alias(RECORD))


def _once(df: DataFrame, record: Column) -> DataFrame:
    """`record` computed once for each row, whatever is filtered and selected later.

    Filters on a computed column are moved below it and compute it again; out of an explode they can't be moved.
    """
    return df.select(SOURCE_FILE, F.explode(F.array(record)).alias("_r")).select("_r.*", SOURCE_FILE)


def _fields_parsed(df: DataFrame, schema: StructType, texts: str) -> tuple[DataFrame, dict[str, Column]]:
    """A column for each nested field out of its text, parsed once."""
    nested = {f.name: f.dataType for f in schema.fields if _nested(f.dataType)}
    columns = {
        f"_parsed_{name}": _parsed(F.col(texts)[name], kind) if isinstance(kind, StructType) else F.from_json(F.col(texts)[name], kind)
        for name, kind in nested.items()
    }
    return df.withColumns(columns), {name: F.col(f"_parsed_{name}") for name in nested}


def typed(texts: DataFrame, schema: StructType) -> DataFrame:
    """Records of `as_text` with their types, each judged by all of its fields, whatever is selected later.

    A record with a field of the wrong type fails alone; of a file that holds no JSON only the fact is kept.
    """
    whole = texts.select(F.struct(*schema.names, CORRUPT).alias("_texts"), SOURCE_FILE)
    fields, parsed = _fields_parsed(whole, schema, "_texts")
    # Without the values of other fields there is no text of a file's broken record.
    record = F.when(F.col("_texts")[CORRUPT].isNull(), F.to_json(F.col("_texts")))
    return _once(fields, _judged(schema, F.col("_texts"), parsed, record))


def typed_lines(lines: DataFrame, schema: StructType) -> DataFrame:
    """Like `typed`, out of lines of text that hold a record or an array of records; of a bad one its text is kept.

    A record is parsed once, as a whole. Only one that does not fit as a whole is judged field by field.
    """
    line = F.col("value")
    several = F.when(F.ltrim(line).startswith("["), F.from_json(line, ArrayType(StringType())))
    texts = lines.filter(F.trim(line) != "").select(F.explode(F.coalesce(several, F.array(line))).alias("_text"), SOURCE_FILE)
    whole = texts.select("*", _parsed(F.col("_text"), schema, StructField(RECORD, StringType())).alias("_whole"))
    # What fits is passed on as it was parsed, with its two marks null, and not taken apart and put together again.
    fits = F.col("_whole").isNotNull() & F.col("_whole")[CORRUPT].isNull() & F.col("_whole")[RECORD].isNull()
    apart = whole.withColumn("_texts", F.when(~fits, F.from_json("_text", _texts(schema), {"columnNameOfCorruptRecord": CORRUPT})))
    fields, parsed = _fields_parsed(apart, schema, "_texts")
    return _once(fields, F.when(fits, F.col("_whole")).otherwise(_judged(schema, F.col("_texts"), parsed, F.col("_text"))))


def judging(schema: StructType, taken: StructType | None = None) -> StructType:
    """The schema of lines of which only the fields of `taken` are used: without its other texts, also the nested ones.

    Any value fits a text, so that a record is judged the same without them, and they need not be made.
    """

    def inner(kind: DataType, used: DataType | None) -> DataType:
        if isinstance(kind, ArrayType):
            return ArrayType(inner(kind.elementType, getattr(used, "elementType", None)), kind.containsNull)
        return judging(kind, used or StructType()) if isinstance(kind, StructType) else kind

    if taken is None:
        return schema
    used = {f.name: f.dataType for f in taken.fields}
    kept = [f for f in schema.fields if f.name in used or not isinstance(f.dataType, StringType)] or schema.fields[:1]
    return StructType([StructField(f.name, inner(f.dataType, used.get(f.name)), f.nullable) for f in kept])


def read_json(
    spark: SparkSession, path: str, schema: StructType, since: datetime | None = None, used: StructType | None = None
) -> DataFrame:
    """JSON files under `path`, sub-folders included, with _corrupt_record, _record and _source_file.

    A `.json` file comes from elsewhere and holds one value, an array of records or a record, over as many lines as it
    likes; one task reads it. A `.txt` file comes from the writers below and holds one record (or array) in a line; it splits. A
    `.txt.gz` file is the same compressed, and short enough for one task.
    Files that were last changed before `since` (UTC) are not opened. Records are judged by all fields; of the texts, those of `used`
    are there, if any are named.
    """
    kept = judging(schema, used)
    if not exists(spark, path):
        marks = [StructField(c, StringType()) for c in (CORRUPT, RECORD, SOURCE_FILE)]
        return spark.createDataFrame([], StructType([*kept.fields, *marks]))
    source = F.col("_metadata.file_path").alias(SOURCE_FILE)
    recent = {} if since is None else {"modifiedAfter": since.strftime("%Y-%m-%dT%H:%M:%S"), "timeZone": "UTC"}
    whole = as_text(spark.read.options(**recent), schema).option("multiLine", True).option("pathGlobFilter", "*.json").json(path)
    lines = spark.read.options(**recent).option("recursiveFileLookup", True).option("pathGlobFilter", LINE_FILES).text(path)
    values = typed(whole.select("*", source), schema)
    return (values if used is None else taken(values, kept)).unionByName(typed_lines(lines.select("*", source), kept))


def _narrowed(value: Column, kind: DataType) -> Column:
    if isinstance(kind, StructType):
        return F.when(value.isNotNull(), F.struct(*[_narrowed(value[f.name], f.dataType).alias(f.name) for f in kind.fields]))
    if isinstance(kind, ArrayType) and _nested(kind.elementType):
        return F.transform(value, lambda x: _narrowed(x, kind.elementType))
    return value


def taken(records: DataFrame, schema: StructType) -> DataFrame:
    """Records with the fields of a narrower schema only, also the nested ones, and what tells whether they could be read.

    For a copy of them: in full, a play has some sixty columns on disk, and storing these takes as long as parsing them.
    """
    fields = [_narrowed(F.col(f.name), f.dataType).alias(f.name) for f in schema.fields]
    return records.select(*fields, CORRUPT, RECORD, SOURCE_FILE)


def readable(df: DataFrame) -> DataFrame:
    return df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT, RECORD, SOURCE_FILE)


def unreadable(df: DataFrame) -> DataFrame:
    """Records for a quarantine table: their file, what is wrong, and the record's own text."""
    return df.filter(F.col(CORRUPT).isNotNull()).select(SOURCE_FILE, CORRUPT, RECORD)


def plays_only(df: DataFrame) -> DataFrame:
    """Readable plays; a file that holds something else gives none."""
    return readable(df).filter(F.col("played_at").isNotNull() | F.col("track").isNotNull())


def split_plays(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid plays out of the records of a play source, and what goes to quarantine: unreadable, or against the play rules."""
    is_play = F.col("played_at").isNotNull() | F.col("track").isNotNull()
    plays = records.filter(F.col(CORRUPT).isNull() & is_play)
    valid, rejected = split_valid(plays, play_is_valid(F.col("played_at"), F.col("context"), F.col("track")))
    text = F.to_json(F.struct(*schemas.PLAY.names))
    bad = rejected.withColumns({CORRUPT: F.lit("against the play rules"), RECORD: text})
    return valid.select(*schemas.PLAY.names), unreadable(records).unionByName(unreadable(bad))


def found_only(markers: DataFrame) -> DataFrame:
    """Readable markers of look-ups that found something."""
    return readable(markers).filter(~F.coalesce(F.col("not_found"), F.lit(False))).drop("not_found")


def read_plays(spark: SparkSession, path: str, used: StructType | None = None) -> DataFrame:
    """Recently-played dumps."""
    return plays_only(read_json(spark, path, schemas.PLAY, used=used))


def read_exports(spark: SparkSession, path: str, used: StructType | None = None) -> DataFrame:
    """Both export generations in one frame; the fields of the other generation are null."""
    return readable(read_json(spark, path, schemas.EXPORT, used=used))


def read_markers(spark: SparkSession, path: str, schema: StructType, used: StructType | None = None) -> DataFrame:
    """Result markers, one or several per file."""
    return found_only(read_json(spark, path, schema, used=used))


def write_lines(lines: DataFrame, path: str, by: Iterable[str] = (), compressed: bool = True) -> None:
    """Append lines of text (`value`). Raw JSON repeats its field names in each record, so that compressed files are a tenth as long,
    at a low level, too, which takes a third of the time of the usual one."""
    writer = lines.write.mode("append").partitionBy(*by)
    if compressed:
        writer = writer.option("compression", "gzip").option("zlib.compress.level", "TWO").option("maxRecordsPerFile", LINES)
    writer.text(path)


def write_json_lines(df: DataFrame, path: str, folders: dict[str, Column] | None = None, compressed: bool = True) -> None:
    """Append records as lines of JSON, in sub-folders if any are given. No shuffle, and files that one task can read or that split."""
    folders = folders or {}
    write_lines(df.select(F.to_json(F.struct(*df.columns)).alias("value")).withColumns(folders), path, folders, compressed)


def land_plays(plays: DataFrame, path: str, ingested_at: Column, compressed: bool = True) -> None:
    """Append plays to folders named by the time of ingestion, not of play."""
    write_json_lines(plays, path, landing_parts(ingested_at), compressed)


def landing_path(ingested_at: Column) -> Column:
    """Folder and file stem of a landing, as text."""
    p = landing_parts(ingested_at)
    return F.concat(
        F.lit("year="), p["year"], F.lit("/month="), p["month"], F.lit("/day="), p["day"], F.lit("/"),
        landing_stamp(ingested_at),
    )


def list_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Path, length and time of the files under a folder; contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", True)
        .load(path)
    )
    return files.select("path", "length", "modificationTime")


def discover_exports(spark: SparkSession, path: str) -> DataFrame:
    """The files of a folder that look like listening history."""
    return list_files(spark, path).filter(F.col("path").rlike(EXPORT_PATH_PATTERN))


def _read_ranges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The bytes of (path, offset) on, in frames of RANGE bytes at most: one range may be as large."""
    for batch in batches:
        rows, held = [], 0
        for row in batch.itertuples(index=False):
            if rows and held + row.size > RANGE:
                yield pd.DataFrame(rows)
                rows, held = [], 0
            store, where = FileSystem.from_uri(row.path)
            with store.open_input_file(where) as file:
                file.seek(row.offset)
                content = file.read(row.size)
            rows.append({"path": row.path, "modificationTime": row.modificationTime, "length": row.length, "offset": row.offset, "content": content})
            held += row.size
        if rows:
            yield pd.DataFrame(rows)


def keep_raw_files(spark: SparkSession, source: str, target: str, size: int = RANGE) -> None:
    """Keep export files byte by byte as a table (path, modificationTime, length, offset, content), of any length.

    A file of more than `size` bytes is kept as ranges of that size, a row each; several tasks read it. Empty files have no row.
    The number of these tasks follows that of the ranges: their list is so short that the planner would give it to one.
    """
    kept = ["path", "modificationTime", "length", "offset", "content"]
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(source).filter(F.col("path").rlike(EXPORT_PATH_PATTERN))
    whole = files.filter(F.col("length") <= size).withColumn("offset", F.lit(0).cast("bigint"))
    starts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("length") - 1, F.lit(size).cast("bigint")))
    ranges = files.filter(F.col("length") > size).select("path", "modificationTime", "length", starts.alias("offset"), F.lit(size).alias("size"))
    schema = "path string, modificationTime timestamp, length bigint, offset bigint, content binary"
    count = files.filter(F.col("length") > size).agg(F.sum(F.ceil(F.col("length") / size))).first()[0] or 0
    tasks = 1 + count // max(1, min(TASK_BYTES // size, TASK_RANGES))
    cut = ranges.repartition(tasks, F.col("path"), F.col("offset")).mapInPandas(_read_ranges, schema)
    whole.select(*kept).unionByName(cut).write.mode("append").parquet(target)


def raw_content(kept: DataFrame, path: str) -> Iterator[bytes]:
    """The bytes of one kept file, range by range."""
    for row in kept.filter(F.col("path") == path).select("offset", "content").orderBy("offset").toLocalIterator():
        yield bytes(row["content"])
