"""A store of file contents under their digests, filled by tasks that copy.

A task streams a file to a temporary name, digests it on the way and renames it
to its digest only if that is the one the scan saw. So a file under a digest is
whole, whoever wrote it, and a task that runs twice does no harm. What a run has
stored becomes visible by one published entry; its temporary names go with it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogsync.session import stage
from catalogsync.sources.published import _files, publish, read_entry, write_part

_CONTENT = "content"
_DRAFTS = "drafts-"
# Bytes that a task holds of a file.
CHUNK = 8 << 20

STORED, CHANGED, GONE = "stored", "changed", "gone"
_HELD = "md5 string, length long"


def _copier(root: str, drafts: str, chunk: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    content = f"{root}/{_CONTENT}"
    stored, changed, gone = STORED, CHANGED, GONE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib
        import uuid

        from pyarrow import fs

        def opened(path: str) -> tuple[fs.FileSystem, str]:
            if path.startswith("file:"):  # one slash or three
                path = "/" + path[5:].lstrip("/")
            return (fs.LocalFileSystem(), path) if path.startswith("/") else fs.FileSystem.from_uri(path)

        def copy(path: str, md5: str, length: int) -> str:
            target, final = opened(f"{content}/{md5[:2]}/{md5}")
            there = target.get_file_info(final)
            if there.type == fs.FileType.File and there.size == length:
                return stored  # by a run that was not published, or an earlier try of this task
            origin, name = opened(path)
            if origin.get_file_info(name).type != fs.FileType.File:
                return gone
            _, draft = opened(f"{drafts}/{uuid.uuid4().hex}")
            digest, size = hashlib.md5(), 0
            with origin.open_input_stream(name) as source, target.open_output_stream(draft) as sink:
                while piece := source.read(chunk):
                    digest.update(piece)
                    size += len(piece)
                    sink.write(piece)
            if (digest.hexdigest(), size) != (md5, length):
                target.delete_file(draft)
                return changed
            target.create_dir(final.rsplit("/", 1)[0], recursive=True)
            target.move(draft, final)
            return stored

        drafts_on, folder = opened(drafts)
        drafts_on.create_dir(folder, recursive=True)
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("path", "md5", "length")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("path"), batch.column("md5"), batch.column("length"), pa.array([copy(*r) for r in rows], pa.string())],
                names=["path", "md5", "length", "outcome"],
            )

    return run


def held_contents(spark: SparkSession, root: str) -> DataFrame:
    """``(md5, length)`` of all contents that published runs have stored."""
    parts = (read_entry(spark, root) or {}).get("parts", [])
    rows = spark.read.schema(_HELD).parquet(*[f"{root}/{p}" for p in parts]) if parts else spark.createDataFrame([], _HELD)
    return rows


def content_path(root: str, md5: str = "md5"):
    """Where the content of a digest lies: a column."""
    return F.concat_ws("/", F.lit(f"{root}/{_CONTENT}"), F.left(F.col(md5), F.lit(2)), md5)


def store_contents(files: DataFrame, root: str, chunk: int = CHUNK) -> DataFrame:
    """Copy files below ``root``, one for each digest not held yet, and publish them.

    ``files`` has ``path`` (absolute), ``length`` and ``md5``, as a scan found
    them; rows with a null in any of these are skipped. Paths are those of the
    file systems that Arrow opens by address, local and shared folders among them.
    Returns a row per file that was tried: ``path``, ``md5``, ``length`` and
    ``outcome``: stored, changed since the scan (nothing is stored) or gone. Of
    several files of one digest the smallest path is tried, so contents are lost
    only until the next run if that one has changed. Nothing is published where
    nothing is new.
    """
    spark = files.sparkSession
    entry = read_entry(spark, root) or {"number": 0, "parts": []}
    wanted = files.where(F.col("path").isNotNull() & F.col("md5").isNotNull() & F.col("length").isNotNull())
    wanted = wanted.groupBy("md5").agg(F.min(F.struct("path", "length")).alias("_f")).select("_f.path", "md5", "_f.length")
    fresh = wanted.join(held_contents(spark, root).select("md5"), "md5", "left_anti").select("path", "md5", "length")
    drafts = f"{root}/{_DRAFTS}{uuid.uuid4().hex}"
    try:
        # Written before anything is published: files are copied once, whatever reads the outcome.
        done = stage(fresh.mapInArrow(_copier(root, drafts, chunk), "path string, md5 string, length long, outcome string"), "copied")
    finally:
        fs, path = _files(spark, root)
        fs.delete(path(drafts), True)
    part = write_part(done.where(F.col("outcome") == STORED).select("md5", "length"), root, "held")
    if part:
        publish(spark, root, {"parts": [*entry["parts"], part]}, entry["number"])
    return done


def drop_drafts(spark: SparkSession, root: str) -> list[str]:
    """Delete what drivers that died have left under temporary names. No writer may be at work."""
    fs, path = _files(spark, root)
    if not fs.exists(path(root)):
        return []
    left = sorted(s.getPath().getName() for s in fs.listStatus(path(root)) if s.getPath().getName().startswith(_DRAFTS))
    for name in left:
        fs.delete(path(f"{root}/{name}"), True)
    return left
