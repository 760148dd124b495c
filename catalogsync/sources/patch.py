"""The patch as text files."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogsync.operators.assign import allocate_ids
from catalogsync.sources.published import publish, read_entry

# The phases of a patch, in order.
PHASES = {1: "departments", 2: "products", 3: "placements"}


def write_patch(patch: DataFrame, path: str) -> None:
    """Compressed text, statements in order of phase, step and key across the numbered part files.

    The order comes from a range partitioning, so no task holds more than its
    share even if one step has most of the statements.
    """
    patch.orderBy("phase", "step", "sort_key").select("statement").write.mode("overwrite").option(
        "compression", "gzip"
    ).text(path)


def write_dated_patch(patch: DataFrame, root: str, moment: datetime) -> str:
    """A patch in a folder of its own, named by the time of its run, so that no later one replaces it."""
    path = f"{root}/{moment:%Y.%m.%d-%H%M%S}"
    write_patch(patch, path)
    return path


def write_phase_patches(patch: DataFrame, path: str) -> None:
    """One folder for each phase, for slow connections. Pass a staged patch: it is read once per phase."""
    for phase, name in PHASES.items():
        write_patch(patch.where(F.col("phase") == phase), f"{path}/{name}")


# Statements of a part of an ordered patch.
PART_ROWS = 1_000_000


def numbered_statements(patch: DataFrame) -> DataFrame:
    """``number`` (from 1) and ``statement`` of all statements in the order of a run; what ties goes by its text.

    Numbers come from ranges and their row counts, so no task sorts the whole patch.
    Pass a staged patch: its rows are counted first.
    """
    order = F.struct("phase", "step", "sort_key", "statement").alias("place")
    numbered = allocate_ids(patch.select(order, "statement"), "place", "number", 0, rows=patch.count())
    return numbered.select("number", "statement")


def publish_patch(patch: DataFrame, root: str, after: int, part_rows: int = PART_ROWS) -> int:
    """Write a patch as ordered parts and publish them with a manifest as patch number ``after`` + 1.

    Every part is one compressed file; as members of one gzip stream, in the order
    of the manifest, they are the whole patch. The manifest has each part's first
    and last statement, their number and a digest of them with their numbers. A
    patch is there whole or not at all.
    """
    spark, name = patch.sparkSession, f"patch-{uuid.uuid4().hex}"
    rows = numbered_statements(patch).withColumn("part", F.expr(f"(number - 1) div {part_rows}"))
    found = rows.groupBy("part").agg(F.min("number").alias("first"), F.max("number").alias("last"), _digest().alias("digest")).collect()
    laid = rows.repartition(max(1, len(found)), "part").sortWithinPartitions("part", "number")
    laid.select("part", "statement").write.partitionBy("part").option("compression", "gzip").text(f"{root}/{name}")
    parts = [{"folder": f"{name}/part={r['part']}", "first": r["first"], "last": r["last"], "digest": r["digest"]} for r in sorted(found)]
    return publish(spark, root, {"parts": parts}, after)


def _digest():
    return F.md5(F.sum(F.xxhash64("number", "statement").cast("decimal(38,0)")).cast("string"))


def read_patch_part(spark: SparkSession, root: str, number: int, part: int) -> list[str]:
    """A part's statements in order, checked against the manifest: what a client runs at a time."""
    given = read_entry(spark, root, number)["parts"][part]
    rows = spark.read.text(f"{root}/{given['folder']}").withColumn("at", F.monotonically_increasing_id())
    lines = [r["value"] for r in rows.orderBy("at").select("value").collect()]
    numbers = spark.createDataFrame(list(enumerate(lines, given["first"])), "number int, statement string")
    if len(lines) != given["last"] - given["first"] + 1 or numbers.agg(_digest()).first()[0] != given["digest"]:
        raise ValueError(f"part {part} of patch {number} is not what was published")
    return lines
