"""Change detection of source files and the record of dated feed snapshots."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalogsync.schemas import FEEDS
from catalogsync.settings import REPLAY_TIME
from catalogsync.sources.paths import below


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """``(name, length, md5)`` of each file below a folder, named by its path there. Contents stay in the scanning task."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(below("path", path).alias("name"), "length", F.md5("content").alias("md5"))


def text_digests(spark: SparkSession, path: str) -> DataFrame:
    """``(name, md5)`` for text files of any size: a digest of line digests, made in splits.

    It does not see a change in the order of lines, which no feed gives a meaning to.
    """
    lines = spark.read.option("recursiveFileLookup", True).text(path)
    digest = F.xxhash64("value").cast("decimal(38,0)")
    sums = lines.groupBy(F.col("_metadata.file_path").alias("path")).agg(
        F.count("*").alias("n"), F.sum(digest).alias("total"), F.bit_xor(F.xxhash64("value")).alias("mix")
    )
    return sums.select(below("path", path).alias("name"), F.md5(F.concat_ws(":", "n", "total", "mix")).alias("md5"))


def changed_sources(test: DataFrame, active: DataFrame) -> DataFrame:
    """Files that the active set lacks or has with another digest. Both sides are unique by name."""
    known = active.select(F.col("name").alias("_name"), F.col("md5").alias("_md5"))
    return (
        test.join(known, F.col("name") == F.col("_name"), "left")
        .where(F.col("_name").isNull() | (F.col("md5") != F.col("_md5")))
        .drop("_name", "_md5")
    )


def archive_feed(rows: DataFrame, name: str, root: str) -> None:
    """Record a feed's rows under the days in ``snapshot_date``; a day written again is replaced."""
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("snapshot_date")
        .parquet(f"{root}/{name}")
    )


def _record(spark: SparkSession, name: str, root: str) -> DataFrame:
    schema = T.StructType([*FEEDS[name].schema, T.StructField("snapshot_date", T.DateType())])
    return spark.read.schema(schema).parquet(f"{root}/{name}")


def read_snapshot(spark: SparkSession, name: str, root: str, day: date) -> DataFrame:
    """A feed as recorded on a day; reads only that day's files."""
    return _record(spark, name, root).where(F.col("snapshot_date") == F.lit(day)).drop("snapshot_date")


def snapshot_days(spark: SparkSession, name: str, root: str) -> list[date]:
    """Days on record, oldest first: one entry per recorded day, none if the feed was never recorded."""
    try:
        record = _record(spark, name, root)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return []
        raise
    return [r[0] for r in record.select("snapshot_date").distinct().orderBy("snapshot_date").collect()]


def recorded_days(spark: SparkSession, root: str) -> dict[str, list[date]]:
    """The days on record of each feed: one listing for a whole replay."""
    return {name: snapshot_days(spark, name, root) for name in FEEDS}


def replay_time(day: date) -> datetime:
    """The moment that stands for a replayed day."""
    return datetime.combine(day, datetime.strptime(REPLAY_TIME, "%H:%M:%S").time())
