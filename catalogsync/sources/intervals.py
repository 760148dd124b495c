"""The record of a feed as intervals: a row is stored once for all the days in a row on which it stood.

A day adds the rows that it opens, with the first day they hold, and closes rows of
the day before, by a digest and the day from which they hold no more. A day is read
as the rows opened until then without those closed until then. Every day becomes
visible by one entry, so a day is on record whole or not at all.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalogsync.schemas import FEEDS
from catalogsync.session import stage
from catalogsync.sources.published import publish, read_entry, write_part

_MARKS = [T.StructField("copies", T.LongType()), T.StructField("row_digest", T.StringType()), T.StructField("valid_from", T.DateType())]
_CLOSED = T.StructType([T.StructField("row_digest", T.StringType()), T.StructField("valid_from", T.DateType()), T.StructField("valid_to", T.DateType())])


def _opened_schema(name: str) -> T.StructType:
    return T.StructType([*FEEDS[name].schema, *_MARKS])


def _read(spark: SparkSession, root: str, parts: list[str], schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(*[f"{root}/{p}" for p in parts]) if parts else spark.createDataFrame([], schema)


def _digest(names: list[str]):
    """Tells rows apart that differ in any field; NULL is not an empty text."""
    return F.sha2(F.to_json(F.struct(*names), {"ignoreNullFields": "false"}), 256)


def _held(spark: SparkSession, name: str, root: str, entry: dict | None, day: date | None = None) -> DataFrame:
    """Rows that hold on a day, or after the last one on record; files of later days are not opened."""
    days = [d for d in (entry or {}).get("days", ()) if day is None or d["day"] <= day.isoformat()]
    opened = _read(spark, root, [d["opened"] for d in days if d["opened"]], _opened_schema(name))
    closed = _read(spark, root, [d["closed"] for d in days if d["closed"]], _CLOSED)
    return opened.join(closed, ["row_digest", "valid_from"], "left_anti")


def record_day(rows: DataFrame, name: str, root: str, day: date) -> int:
    """Record a feed's rows of a day; writes what differs from the last day on record. Returns the number of the entry.

    Days have to come in order. Rows that repeat are kept with how often they do.
    A day that equals the one before is on record too, without files.
    """
    spark, columns = rows.sparkSession, FEEDS[name].schema.names
    entry = read_entry(spark, root)
    days = list((entry or {}).get("days", ()))
    if days and day.isoformat() <= days[-1]["day"]:
        raise ValueError(f"{day} does not come after {days[-1]['day']}")
    typed = rows.select(*[F.col(f.name).cast(f.dataType) for f in FEEDS[name].schema])
    counted = typed.groupBy(*columns).agg(F.count(F.lit(1)).alias("copies"))
    today = counted.withColumn("row_digest", _digest([*columns, "copies"]))
    before = _held(spark, name, root, entry).select(F.col("row_digest").alias("_digest"), F.col("valid_from").alias("_from"))
    diff = today.join(before, F.col("row_digest") == F.col("_digest"), "full_outer").where("row_digest is null or _digest is null")
    diff = stage(diff, "day")
    opened = diff.where("row_digest is not null").withColumn("valid_from", F.lit(day)).select(*_opened_schema(name).names)
    closed = diff.where("_digest is not null").select(F.col("_digest").alias("row_digest"), F.col("_from").alias("valid_from"), F.lit(day).alias("valid_to"))
    days.append({"day": day.isoformat(), "opened": write_part(opened, root, "opened"), "closed": write_part(closed, root, "closed")})
    return publish(spark, root, {"days": days}, entry["number"] if entry else 0)


def recorded(spark: SparkSession, root: str) -> list[date]:
    """Days on record, oldest first, from the newest entry alone."""
    return [date.fromisoformat(d["day"]) for d in (read_entry(spark, root) or {}).get("days", ())]


def read_day(spark: SparkSession, name: str, root: str, day: date) -> DataFrame:
    """The feed as it stood on a day: that of the last recorded day until then, nothing before the first."""
    rows = _held(spark, name, root, read_entry(spark, root), day)
    return rows.withColumn("_", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select(*FEEDS[name].schema.names)


def intervals(spark: SparkSession, name: str, root: str) -> DataFrame:
    """All rows ever recorded with ``copies``, ``valid_from`` and ``valid_to`` (NULL while they hold)."""
    days = (read_entry(spark, root) or {}).get("days", ())
    opened = _read(spark, root, [d["opened"] for d in days if d["opened"]], _opened_schema(name))
    closed = _read(spark, root, [d["closed"] for d in days if d["closed"]], _CLOSED)
    return opened.join(closed, ["row_digest", "valid_from"], "left").select(*FEEDS[name].schema.names, "copies", "valid_from", "valid_to")
