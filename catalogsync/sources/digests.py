"""Digests of files of any size, combined from their byte ranges.

A range's digest is a polynomial in the digests of its lines, which are taken in
the scan; two neighbours combine to that of both by the number of lines in the
second. So a file has one digest whatever ranges it is read in, no task holds more
of it than a line, and a change of bytes, of their order or of the end of the file
shows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogsync.sources.paths import below

# The prime modulus and the base of the polynomial: changing them changes all digests on record.
MODULUS = (1 << 127) - 1
BASE = 0x2545F4914F6CDD1D_9E3779B97F4A7C15


def _ranges() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    modulus, base = MODULUS, BASE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list[int]] = {}
        for batch in batches:
            for file, size, at, line in zip(*(batch.column(c).to_pylist() for c in ("file", "size", "at", "line"))):
                state = held.setdefault((file, size, at), [0, 0])
                state[0] += 1
                state[1] = (state[1] * base + int.from_bytes(line) + 1) % modulus
        if held:
            files, sizes, ats = zip(*held)
            lines, digests = zip(*held.values())
            columns = [pa.array(files, pa.string()), pa.array(sizes, pa.int64()), pa.array(ats, pa.int64()), pa.array(lines, pa.int64())]
            columns.append(pa.array([d.to_bytes(16) for d in digests], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=["file", "size", "at", "lines", "digest"])

    return run


def _roots() -> Callable[[tuple, pa.Table], pa.Table]:
    modulus, base = MODULUS, BASE

    def combine(key: tuple, ranges: pa.Table) -> pa.Table:
        total = 0
        for row in ranges.sort_by("at").to_pylist():
            total = (total * pow(base, row["lines"], modulus) + int.from_bytes(row["digest"])) % modulus
        return pa.table({"file": pa.array([key[0].as_py()]), "size": pa.array([key[1].as_py()], pa.int64()), "root": pa.array([f"{total:032x}"])})

    return combine


def range_digests(spark: SparkSession, path: str) -> DataFrame:
    """``(name, length, md5)`` of each file below a folder, as ``file_digests`` names them, from byte ranges.

    The digest is one of this library, of the length of an MD5; ``changed_sources``
    compares them. A range's share is a row, so combining takes a row for every
    128 MB of a file. Any bytes will do; a stretch without a line feed has to fit
    a row (2 GB). Empty files have no row, as nothing of them is read.
    """
    text = spark.read.option("lineSep", "\n").option("recursiveFileLookup", True).text(path)
    meta = {"file": "file_path", "size": "file_size", "at": "file_block_start"}
    lines = text.select(*[F.col(f"_metadata.{m}").alias(c) for c, m in meta.items()], F.unhex(F.md5(F.col("value").cast("binary"))).alias("line"))
    ranges = lines.mapInArrow(_ranges(), "file string, size long, at long, lines long, digest binary")
    whole = ranges.groupBy("file", "size").applyInArrow(_roots(), "file string, size long, root string")
    # The length tells a file that ends with a line feed from one that does not.
    return whole.select(below("file", path).alias("name"), F.col("size").alias("length"), F.md5(F.concat_ws(":", "size", "root")).alias("md5"))
