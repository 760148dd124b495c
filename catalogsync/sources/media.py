"""Image folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogsync.sources.paths import below


def scan_media(spark: SparkSession, root: str) -> DataFrame:
    """``(dir, name, length, md5)`` of each file below ``root``. Contents stay in the scanning task."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    rest = below("path", root)
    return files.select(
        F.regexp_extract(rest, r"^(?:(.*)/)?[^/]*$", 1).alias("dir"),
        F.substring_index(rest, "/", -1).alias("name"),
        "length",
        F.md5("content").alias("md5"),
    )


def write_missing_report(missing: DataFrame, path: str) -> None:
    """One path per line, in order."""
    missing.orderBy("key").select("key").write.mode("overwrite").text(path)
