"""Folders that grow by whole steps: data sets below a root, and numbered entries that say which of them count.

Everything is written to a new folder first. The step becomes visible by one
small entry, put in place by a rename that never replaces a file. A writer that
dies before leaves folders that no entry names; of two writers that start from
the same entry one fails.
"""

from __future__ import annotations

import json
import uuid

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

_ENTRIES = "_entries"


class Conflict(RuntimeError):
    """Another writer has published a step after the one that this writer started from."""


def _files(spark: SparkSession, root: str):
    """The root's file system and a maker of its paths."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    return path(root).getFileSystem(spark._jsc.hadoopConfiguration()), path


def entry_numbers(spark: SparkSession, root: str) -> list[int]:
    """Numbers of all published entries, ascending; reads one listing."""
    fs, path = _files(spark, root)
    folder = path(f"{root}/{_ENTRIES}")
    if not fs.exists(folder):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(folder)]
    return sorted(int(name[:-5]) for name in names if name.endswith(".json"))


def read_entry(spark: SparkSession, root: str, number: int | None = None) -> dict | None:
    """An entry, by default the newest; ``None`` where nothing was published."""
    numbers = entry_numbers(spark, root)
    if number is None:
        if not numbers:
            return None
        number = numbers[-1]
    elif number not in numbers:
        raise FileNotFoundError(f"no published version {number} under {root}")
    rows = spark.read.text(f"{root}/{_ENTRIES}/{number:09d}.json", wholetext=True).collect()
    return {**json.loads(rows[0][0]), "number": number}


def publish(spark: SparkSession, root: str, entry: dict, after: int) -> int:
    """Make ``entry`` the one after number ``after`` (0 for the first)."""
    fs, path = _files(spark, root)
    number = after + 1
    target = path(f"{root}/{_ENTRIES}/{number:09d}.json")
    draft = path(f"{root}/{_ENTRIES}/.draft-{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    out.write(bytearray(json.dumps(entry, sort_keys=True).encode()))
    out.close()
    # HDFS never renames to a name that is taken; for file systems that would, the name is looked up right before.
    if number in entry_numbers(spark, root) or not fs.rename(draft, target):
        fs.delete(draft, False)
        raise Conflict(f"version {number} under {root} is already there")
    return number


def write_part(rows: DataFrame, root: str, kind: str) -> str | None:
    """Write a data set under a name of its own and return that, or ``None`` if it has no rows."""
    name = f"{kind}-{uuid.uuid4().hex}"
    rows.write.option("compression", "zstd").parquet(f"{root}/{name}")
    if part_size(rows.sparkSession, root, name)[0]:
        return name
    fs, path = _files(rows.sparkSession, root)
    fs.delete(path(f"{root}/{name}"), True)
    return None


def part_size(spark: SparkSession, root: str, name: str) -> tuple[int, int]:
    """Rows and bytes of a data set, from its footers and its listing."""
    fs, path = _files(spark, root)
    size = fs.getContentSummary(path(f"{root}/{name}")).getLength()
    try:
        return spark.read.parquet(f"{root}/{name}").count(), size
    except PySparkException as error:
        if error.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            return 0, size
        raise


def unnamed_parts(spark: SparkSession, root: str) -> list[str]:
    """Folders that no entry names: what writers that died have left. A writer at work may still publish them."""
    fs, path = _files(spark, root)
    if not fs.exists(path(root)):
        return []
    found = {s.getPath().getName() for s in fs.listStatus(path(root)) if s.isDirectory()} - {_ENTRIES}
    named = set()
    for number in entry_numbers(spark, root):
        named.update(_names(read_entry(spark, root, number)))
    return sorted(found - named)


def _names(value: object) -> set[str]:
    if isinstance(value, dict):
        return set().union(*map(_names, value.values())) if value else set()
    if isinstance(value, list):
        return set().union(*map(_names, value)) if value else set()
    return {value} if isinstance(value, str) else set()
