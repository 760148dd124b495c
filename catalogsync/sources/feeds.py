"""Supplier CSV files."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalogsync.functions.text import clean_text, fix_cp1252
from catalogsync.schemas import FEEDS, Feed
from catalogsync.sources.splits import read_records

_BAD = "_bad_record"
# Stands for a missing value while reading, so that an empty quoted field stays an empty text.
_ABSENT = "\x00"


def _raw(spark: SparkSession, feed: Feed, path: str, cp1252: bool, line_breaks: bool) -> DataFrame:
    """All fields as text. Rows with the wrong number of fields are marked, whichever columns are asked for."""
    fields = [T.StructField(f.name, T.StringType()) for f in feed.schema]
    return (
        spark.read.schema(T.StructType([*fields, T.StructField(_BAD, T.StringType())]))
        .option("header", True)
        .option("enforceSchema", True)
        .option("columnPruning", False)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", line_breaks)
        .option("nullValue", _ABSENT)
        .option("encoding", "ISO-8859-1" if cp1252 else "UTF-8")
        .option("columnNameOfCorruptRecord", _BAD)
        .csv(path)
    )


def _raw_in_splits(spark: SparkSession, feed: Feed, path: str, cp1252: bool) -> DataFrame:
    """The same from records that are cut from byte ranges of the files, and the file in ``_file``."""
    schema = ", ".join(f"`{c}` string" for c in (*feed.schema.names, _BAD))
    options = {"quote": '"', "escape": '"', "nullValue": _ABSENT, "columnNameOfCorruptRecord": _BAD, "multiLine": "true"}
    records = read_records(spark, path, cp1252)
    return records.select(F.from_csv("record", schema, options).alias("_row"), F.col("file").alias("_file")).select("_row.*", "_file")


def _number_text(name: str) -> Column:
    return F.nullif(F.trim(F.col(name)), F.lit(""))


def _bad_number(f: T.StructField) -> Column:
    text = _number_text(f.name)
    return text.isNotNull() & text.try_cast(f.dataType).isNull()


def _readable(feed: Feed) -> Column:
    """The row says which product or category it is about."""
    f = feed.schema[feed.key]
    return F.trim(F.col(f.name)) != "" if isinstance(f.dataType, T.StringType) else ~_bad_number(f)


def _flawed(feed: Feed) -> Column:
    """A number is none, or the row has too few or too many fields. Refers to each column, so no projection changes it."""
    checks = [F.col(_BAD).isNotNull() | ~F.coalesce(_readable(feed), F.lit(False))]
    for f in feed.schema:
        checks.append((F.length(f.name) < 0) if isinstance(f.dataType, T.StringType) else _bad_number(f))
    return reduce(Column.__or__, [F.coalesce(c, F.lit(False)) for c in checks])


def _tidy(feed: Feed, cp1252: bool) -> list[Column]:
    """Transcode and clean text, cut it to its width, then fill what is missing. A number that is none stays NULL."""
    columns = []
    for f in feed.schema:
        if isinstance(f.dataType, T.StringType):
            value = clean_text(fix_cp1252(F.col(f.name)) if cp1252 else F.col(f.name))
            if f.name in feed.widths:
                value = F.left(value, F.lit(feed.widths[f.name]))
            missing = value.isNull()
        else:
            value, missing = _number_text(f.name).try_cast(f.dataType), _number_text(f.name).isNull()
        if f.name in feed.defaults:
            value = F.when(missing, F.lit(feed.defaults[f.name]).cast(f.dataType)).otherwise(value)
        columns.append(value.alias(f.name))
    return columns


def delivery_day(spark: SparkSession, path: str) -> date | None:
    """The day on which the last file of a delivery was changed. Reads the listing only."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.agg(F.to_date(F.max("modificationTime"))).first()[0]


def read_feed(
    spark: SparkSession,
    name: str,
    path: str,
    cp1252: bool = True,
    line_breaks: bool = True,
    day: date | None = None,
    in_splits: bool = False,
) -> DataFrame:
    """The rows of a feed, typed, transcoded, cleaned and with defaults filled in.

    No record is lost: line breaks inside quotes are part of the field, missing
    trailing fields take their defaults, surplus ones are ignored, and a number
    that is none becomes NULL, which changes nothing in the store. Only rows that
    don't say what they are about are left out; ``rejected_rows`` lists all these.

    ``path`` may name a folder of files, which are read in parallel. A single
    large file is read by many tasks ``in_splits``, which takes two passes over
    it and gives the same rows, or in one pass where the caller knows that its
    fields have no ``line_breaks``; else by one task. ``snapshot_date`` is one
    day for the whole delivery: ``day``, or that of its file changed last.
    Columns are taken by position; the header line of each file is skipped.
    """
    feed = FEEDS[name]
    dated = F.lit(day or delivery_day(spark, path)).cast("date").alias("snapshot_date")
    raw = _raw_in_splits(spark, feed, path, cp1252) if in_splits else _raw(spark, feed, path, cp1252, line_breaks)
    return raw.where(_readable(feed)).select(*_tidy(feed, cp1252), dated)


def rejected_rows(
    spark: SparkSession, name: str, path: str, cp1252: bool = True, line_breaks: bool = True, in_splits: bool = False
) -> DataFrame:
    """Rows with a bad number, the wrong number of fields or no key: ``(feed, key, file, record, kept)``.

    ``kept`` tells whether the rest of the row takes part in a run.
    """
    feed = FEEDS[name]
    raw = _raw_in_splits(spark, feed, path, cp1252) if in_splits else _raw(spark, feed, path, cp1252, line_breaks)
    raw = raw.where(_flawed(feed))
    fields = F.concat_ws(",", *[F.coalesce(f.name, F.lit("")) for f in feed.schema])
    return raw.select(
        F.lit(name).alias("feed"),
        F.coalesce(F.col(feed.key), F.lit("")).alias("key"),
        F.col("_file" if in_splits else "_metadata.file_path").alias("file"),
        F.coalesce(_BAD, fields).alias("record"),
        F.coalesce(_readable(feed), F.lit(False)).alias("kept"),
    )


def require_feeds(manifest: DataFrame, names: tuple[str, ...] = tuple(FEEDS)) -> bool:
    """Whether the manifest (column ``name``) lists every feed of a run."""
    return manifest.where(F.col("name").isin(*names)).select("name").distinct().count() == len(names)
