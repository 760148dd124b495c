"""Helpers shared by the operators: columns by exact name, code for workers, work tables, tree sums."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

import catalogsync
from catalogsync.session import stage

__all__ = ["WORD", "crc_mod", "map_batches", "once", "pick", "prepare", "stage", "sum_vectors"]

# A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

# Rows of an Arrow batch: bounds what a worker holds of long texts.
BATCH_ROWS = 512


def prepare(spark: SparkSession) -> None:
    """Send this package's code to the executors once per application and bound Arrow batches."""
    context = spark.sparkContext
    if not getattr(context, "_catalogsync_sent", False):
        root = os.path.dirname(os.path.abspath(catalogsync.__file__))
        path = os.path.join(tempfile.mkdtemp(prefix="catalogsync-code-"), "catalogsync.zip")
        with zipfile.ZipFile(path, "w") as archive:
            for folder, _, names in os.walk(root):
                for name in names:
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        archive.write(full, os.path.join("catalogsync", os.path.relpath(full, root)))
        context.addPyFile(path)
        context._catalogsync_sent = True
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def pick(df: DataFrame, **wanted: str) -> DataFrame:
    """Columns under new names, ``new="old"``; found by exact name, whatever other columns are called."""
    names = df.columns
    placed = df.toDF(*[f"_c{k}" for k in range(len(names))])
    return placed.select([F.col(f"_c{names.index(old)}").alias(new) for new, old in wanted.items()])


def crc_mod(column: str, modulus: int) -> Column:
    """crc32 of a column as text, modulo; 0 for null."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % modulus, F.lit(0))


def map_batches(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    """``mapInArrow`` after ``prepare``."""
    prepare(df.sparkSession)
    return df.mapInArrow(function, schema)


_KEPT: dict = {}


def once(key: object, make: Callable[[], object]) -> object:
    """A value that a worker makes once and keeps while its process lives; the last three keys are kept."""
    if key not in _KEPT:
        while len(_KEPT) >= 3:
            _KEPT.pop(next(iter(_KEPT)))
        _KEPT[key] = make()
    return _KEPT[key]


def sum_vectors(rows: DataFrame, keys: list[str], groups: int = 128) -> DataFrame:
    """Sum the packed float64 vectors in ``vec`` by key.

    One vector comes from each input partition (``part``) and key. They are
    added in two levels, first in ``groups`` groups of partitions, so that no
    task adds all of a key.
    """
    prepare(rows.sparkSession)
    kinds = dict(rows.dtypes)

    def adder(names: list[str]) -> Callable[[tuple, pa.Table], pa.Table]:
        def add(key: tuple, table: pa.Table) -> pa.Table:
            total = 0
            for packed in table.column("vec"):
                total = total + np.frombuffer(packed.as_py(), dtype=np.float64)
            arrays = [pa.array([k.as_py()], k.type) for k in key]
            return pa.table([*arrays, pa.array([total.tobytes()], pa.binary())], names=[*names, "vec"])

        return add

    def summed(frame: DataFrame, names: list[str]) -> DataFrame:
        schema = ", ".join(f"{k} {kinds.get(k, 'int')}" for k in names) + ", vec binary"
        return frame.select(*names, "vec").groupBy(*names).applyInArrow(adder(names), schema)

    near = rows.withColumn("part", F.pmod(F.col("part"), F.lit(groups)).cast("int"))
    kinds["part"] = "int"
    return summed(summed(near, [*keys, "part"]), keys)
