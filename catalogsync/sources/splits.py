"""Records of CSV files whose fields may hold line breaks, read in byte ranges.

Whether a line begins inside a quoted field depends on all lines before it. A first
pass reads every range once and tells, for both ways it may begin, how it ends;
composing these answers along a file gives each range its true beginning. A second
pass cuts every range into records. What a range holds of a record that goes on
beyond it is joined with the pieces in the next ranges. So a file is read by as
many tasks as it has ranges, and only pieces at range ends are shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# What a piece of text is: a record, the end of one, the begin of one, a range amid one, or the begin of a header.
WHOLE, HEAD, TAIL, MIDDLE, TITLE = range(5)


def _lines(spark: SparkSession, path: str, cp1252: bool) -> DataFrame:
    """Lines as they stand, without the line feed, with the file and the range that they are in, in the order of each range."""
    text = spark.read.option("lineSep", "\n").option("recursiveFileLookup", True).text(path)
    value = F.decode(F.col("value").cast("binary"), "ISO-8859-1") if cp1252 else F.col("value")
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), value.alias("line"))


def _quotes() -> Callable[[str, bool], bool]:
    """How a line ends: inside a quoted field or not. Made here so that workers get the code along with the task."""
    import re

    # A quoted field goes on to a quote that is not doubled; what follows up to the comma belongs to the field.
    quoted = re.compile(r'(?:[^"]++|"")*+')

    def ends_inside(line: str, inside: bool) -> bool:
        at, size = 0, len(line)
        if '"' not in line:
            return inside
        while True:
            if not inside:
                if line.startswith('"', at):
                    at += 1
                else:
                    at = line.find(",", at) + 1
                    if not at:
                        return False
                    continue
            at = quoted.match(line, at).end()
            if at >= size:
                return True
            # The quote at this place ends the field.
            inside, at = False, line.find(",", at) + 1
            if not at:
                return False

    return ends_inside


def _passes() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    make = _quotes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends_inside, ends = make(), {}
        for batch in batches:
            for file, at, line in zip(*(batch.column(c).to_pylist() for c in ("file", "at", "line"))):
                outside, inside = ends.get((file, at), (False, True))
                if '"' in line:
                    same = outside == inside
                    outside = ends_inside(line, outside)
                    inside = outside if same else ends_inside(line, inside)
                ends[file, at] = (outside, inside)
        if ends:
            files, ats = zip(*ends)
            outside, inside = zip(*ends.values())
            columns = [pa.array(files, pa.string()), pa.array(ats, pa.int64()), pa.array(outside, pa.bool_()), pa.array(inside, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, names=["file", "at", "outside", "inside"])

    return run


def range_states(lines: DataFrame) -> DataFrame:
    """``file``, ``at`` and ``begins_inside`` of every byte range: a row per range."""
    ends = lines.mapInArrow(_passes(), "file string, at long, outside boolean, inside boolean")
    along = W.partitionBy("file").orderBy("at")
    # A range that ends the same way however it begins settles what the next one begins with; after it, ranges that
    # change nothing keep that and others swap it. So the state is that of the last settled range and the swaps since.
    settled = ends.withColumn("fixed", F.when(F.col("outside") == F.col("inside"), F.col("outside")))
    before = along.rowsBetween(W.unboundedPreceding, -1)
    settled = settled.withColumn("run", F.count("fixed").over(along)).withColumn("swap", (F.col("outside") & ~F.col("inside")).cast("int"))
    since = W.partitionBy("file", "run").orderBy("at").rowsBetween(W.unboundedPreceding, 0)
    state = F.when((F.coalesce(F.first("fixed").over(since), F.lit(False)).cast("int") + F.sum("swap").over(since)) % 2 == 1, True).otherwise(False)
    after = settled.withColumn("after", state)
    return after.select("file", "at", F.coalesce(F.last("after").over(before), F.lit(False)).alias("begins_inside"))


def _cuts() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    make, whole, head, tail, middle, title = _quotes, WHOLE, HEAD, TAIL, MIDDLE, TITLE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends_inside = make()
        key, held, inside, begun, header, out = None, [], False, True, False, []

        def rest() -> None:
            """What a range ends with belongs to a record that goes on, or to one that began before it."""
            if held:
                out.append((*key, title if header else tail if begun else middle, "\n".join(held)))

        def made() -> pa.RecordBatch:
            types = [pa.string(), pa.int64(), pa.int32(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=["file", "at", "kind", "record"])

        for batch in batches:
            for file, at, line, first in zip(*(batch.column(c).to_pylist() for c in ("file", "at", "line", "begins_inside"))):
                if (file, at) != key:
                    rest()
                    key, held, inside, begun, header = (file, at), [], first, not first, at == 0
                held.append(line)
                inside = ends_inside(line, inside)
                if not inside:
                    if not header:
                        out.append((file, at, whole if begun else head, "\n".join(held)))
                    held, begun, header = [], True, False
            if out:
                yield made()
                out = []
        rest()
        if out:
            yield made()

    return run


def read_records(spark: SparkSession, path: str, cp1252: bool = True) -> DataFrame:
    """``file`` and ``record``: the text of every record of the files at ``path``, line breaks in quoted fields included.

    Records end with a line feed, or a carriage return and one. The first record
    of each file, its header, and empty lines are left out. A record that no quote
    ends goes on to the end of its file.
    """
    lines = _lines(spark, path, cp1252)
    # A row per byte range, a hundred bytes for every 128 MB read.
    states = range_states(lines)
    marked = lines.join(F.broadcast(states), ["file", "at"])
    pieces = marked.select("file", "at", "line", "begins_inside").mapInArrow(_cuts(), "file string, at long, kind int, record string")
    return _joined(pieces)


def _joined(pieces: DataFrame) -> DataFrame:
    """Records from pieces: those within a range as they are, the others from the range that begins them to the one that ends them."""
    split = pieces.where(F.col("kind") != WHOLE)
    # A range has one piece of a record that began before it, and then one of a record that goes on.
    begins = F.col("kind").isin(TAIL, TITLE).cast("int")
    chain = F.sum(begins).over(W.partitionBy("file").orderBy("at", begins))
    chained = split.withColumn("begins", begins).withColumn("chain", chain).groupBy("file", "chain")
    parts = chained.agg(F.sort_array(F.collect_list(F.struct("at", "begins", "kind", "record"))).alias("parts"))
    crossing = parts.where(F.col("parts")[0]["kind"] != TITLE).select("file", F.array_join("parts.record", "\n").alias("record"))
    records = pieces.where(F.col("kind") == WHOLE).select("file", "record").unionByName(crossing)
    return records.select("file", F.regexp_replace("record", "\r$", "").alias("record")).where("record <> ''")
