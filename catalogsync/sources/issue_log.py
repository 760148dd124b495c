"""The issue logs on disk, kept from run to run.

Every run adds one part per log with the entries whose key no earlier run has
written. A part is laid out by a hash of the key: each file holds a range of
BUCKETS, and the entry lists every file's range. So telling which keys are known
reads only files that may hold one of them. All three logs of a run become visible
by one entry; a run that dies while it writes leaves the log as it was.
"""

from __future__ import annotations

from dataclasses import fields
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalogsync import schemas
from catalogsync.operators.merge import first_wins
from catalogsync.plans import categories as C
from catalogsync.plans import placements as L
from catalogsync.plans import products as P
from catalogsync.plans.run import LOGS, Issues
from catalogsync.session import stage
from catalogsync.sources.published import publish, read_entry, write_part

# Ranges of key hashes, and entries of a file.
BUCKETS = 4096
FILE_ROWS = 500_000
# Parts of a log that are folded into one.
MOST_PARTS = 30

KEYS = dict(zip(LOGS, (C.ISSUE_KEY, P.ISSUE_KEY, L.ISSUE_KEY)))
SCHEMAS = dict(zip(LOGS, (schemas.CATEGORY_ISSUES, schemas.PRODUCT_ISSUES, schemas.PLACEMENT_ISSUES)))


def _bucket(key: list[str]) -> Column:
    # A NULL in a key leaves the hash as it is, so keys that hold NULL have a bucket too.
    return F.pmod(F.xxhash64(*key), F.lit(BUCKETS)).cast("int").alias("bucket")


def _part_schema(name: str) -> T.StructType:
    return T.StructType([*SCHEMAS[name], T.StructField("run", T.IntegerType()), T.StructField("bucket", T.IntegerType())])


def _paths(entry: dict | None, root: str, name: str, buckets: set[int] | None = None) -> list[str]:
    files = [f for part in (entry or {}).get(name, ()) for f in part["files"]]
    if buckets is None:
        return [f"{root}/{f['path']}" for f in files]
    return [f"{root}/{f['path']}" for f in files if not buckets.isdisjoint(range(f["low"], f["high"] + 1))]


def read_entries(spark: SparkSession, root: str, name: str, number: int | None = None) -> DataFrame:
    """One log with the number of the run that wrote each entry, as of a published number, by default all."""
    paths = _paths(read_entry(spark, root, number), root, name)
    schema = _part_schema(name)
    rows = spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
    return rows.drop("bucket")


def read_log(spark: SparkSession, root: str) -> Issues:
    """The logs as the next run needs them; empty ones before the first run."""
    return Issues(**{name: read_entries(spark, root, name).drop("run") for name in LOGS})


def unknown_entries(found: DataFrame, entry: dict | None, root: str, name: str) -> tuple[DataFrame, list[str]]:
    """The first entry of each key that the log does not hold yet, with its ``bucket``, and the files this opens."""
    spark, key = found.sparkSession, KEYS[name]
    fresh = first_wins(found.select(*SCHEMAS[name].names), key).withColumn("bucket", _bucket(key))
    if not (entry or {}).get(name):
        return fresh, []
    # What a run has found is read twice: for the buckets of its keys, of which there are BUCKETS at most, and itself.
    fresh = stage(fresh, f"found_{name}")
    buckets = {r[0] for r in fresh.select("bucket").distinct().collect()}
    paths = _paths(entry, root, name, buckets)
    if not paths:
        return fresh, []
    known = spark.read.schema(_part_schema(name)).parquet(*paths).select(*[F.col(k).alias(f"_{k}") for k in key], F.col("bucket").alias("_bucket"))
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in key])
    return fresh.join(known, (F.col("bucket") == F.col("_bucket")) & same, "left_anti"), paths


def _write(rows: DataFrame, root: str, name: str, file_rows: int) -> dict | None:
    """A part laid out by bucket, and what the entry says about it."""
    spark, rows = rows.sparkSession, stage(rows.select(*_part_schema(name).names), f"new_{name}")
    files = min(BUCKETS, -(-rows.count() // file_rows))
    if not files:
        return None
    part = write_part(rows.repartitionByRange(files, "bucket").sortWithinPartitions("bucket", *KEYS[name]), root, name)
    written = spark.read.schema(_part_schema(name)).parquet(f"{root}/{part}").groupBy(F.col("_metadata.file_name").alias("file"))
    # A row per file of the part.
    stats = written.agg(F.min("bucket").alias("low"), F.max("bucket").alias("high"), F.count("*").alias("rows")).collect()
    files = [{"path": f"{part}/{r['file']}", "low": r["low"], "high": r["high"], "rows": r["rows"]} for r in stats]
    return {"part": part, "files": sorted(files, key=lambda f: (f["low"], f["path"]))}


def extend_log(found: Issues, root: str, most_parts: int = MOST_PARTS, file_rows: int = FILE_ROWS) -> int:
    """Add what a run has found; for each key the entry written first stays. Returns the log's number.

    Nothing is published where all keys are known. Keys may hold NULL, which
    equals itself. Once a log has more than ``most_parts`` parts, they are written
    as one.
    """
    spark = found.products.sparkSession
    entry = read_entry(spark, root)
    number = entry["number"] if entry else 0
    parts = {name: list((entry or {}).get(name, ())) for name in LOGS}
    added = False
    for name in (f.name for f in fields(Issues)):
        fresh, _ = unknown_entries(getattr(found, name), entry, root, name)
        part = _write(fresh.withColumn("run", F.lit(number + 1)), root, name, file_rows)
        if part:
            added = True
            parts[name].append(part)
        if len(parts[name]) > most_parts:
            paths = _paths({name: parts[name]}, root, name)
            parts[name] = [_write(spark.read.schema(_part_schema(name)).parquet(*paths), root, name, file_rows)]
    return publish(spark, root, parts, number) if added else number
