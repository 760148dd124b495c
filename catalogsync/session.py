"""Session settings the library is written for, and its shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context

from pyspark.sql import DataFrame, SparkSession

# Left to the cluster: master, memory, executors. Everything below only states
# how plans should adapt to the data they meet.
CONF = {
    "spark.sql.session.timeZone": "UTC",
    # Plans here are made of many small expressions; tracing each to a source line takes most of their build time.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Hot join keys are split at run time, also where that costs a shuffle.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def build_session(app: str, master: str | None = None, extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_dirs: dict[str, str] = {}


def work_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local master, where driver and executors are one machine, may fall
    back to a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="catalogsync-")
    return _local_dirs[app]


# Narrow rows that one task takes into a hash table or a sort.
ROWS_OF_A_TASK = 500_000


def spread(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """Deal many narrow rows by key over tasks of about ROWS_OF_A_TASK; left as it is where Spark's own tasks are no larger.

    Adaptive execution merges partitions by their compressed bytes, of which a link
    has few, so tasks of a large table get millions of rows. It leaves partitions
    alone whose number was given. A join moves rows once more that lie in fewer
    partitions than shuffles have by default, so there are at least as many. ``rows``
    is an estimate.
    """
    parts, spark = -(-rows // ROWS_OF_A_TASK), df.sparkSession
    if parts <= spark.sparkContext.defaultParallelism:
        return df
    return df.repartition(max(parts, int(spark.conf.get("spark.sql.shuffle.partitions"))), *keys)


def spread_by_range(df: DataFrame, rows: int, key: str) -> DataFrame:
    """Deal rows over tasks by ranges of ``key``; more than ROWS_OF_A_TASK of them over tasks that are not merged by their bytes."""
    if rows <= ROWS_OF_A_TASK:
        return df.repartitionByRange(key)
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(max(-(-rows // ROWS_OF_A_TASK), parts), key)


# Rows of a table that may pass through the driver, which gathers and hashes what is broadcast.
ROWS_OF_A_BROADCAST = 100_000


def by_merge(df: DataFrame, rows: int | None = None) -> DataFrame:
    """A side of a join that grows with the store: joined by sorting, unless it is known to have few ``rows``.

    Before a join runs, Spark tells sizes by the bytes of compressed files, and 10 MB
    of these hold millions of ids, or of issues, which are a few texts that repeat.
    """
    return df if rows is not None and rows <= ROWS_OF_A_BROADCAST else df.hint("merge")


_staged: ContextVar[set[str]] = ContextVar("staged", default=set())


@contextmanager
def own_staging() -> Iterator[None]:
    """Within it, ``staged_paths`` and ``release`` know only of what is staged there, not by callers or other threads."""
    outer, token = _staged.get(), _staged.set(set())
    try:
        yield
    finally:
        outer.update(_staged.get())
        _staged.reset(token)


def staged_paths() -> set[str]:
    """Where the tables staged so far and not released are."""
    return set(_staged.get())


def release(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete staged tables that nothing reads any more."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    staged = _staged.get()
    for path in staged.intersection(paths):
        folder = hadoop.Path(path).getParent()
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
        staged.discard(path)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate as a parquet table in the work folder and read it back.

    Cuts the lineage and fixes the rows, so that everything derived from the
    table sees the same ones, also after an executor is lost.
    """
    spark = df.sparkSession
    path = f"{work_dir(spark)}/stage-{uuid.uuid4().hex}/{name}"
    df.write.option("compression", "zstd").parquet(path)
    _staged.get().add(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_all(frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Stage tables that do not depend on each other, as jobs that run side by side."""
    with ThreadPoolExecutor(max_workers=len(frames)) as pool:
        jobs = [pool.submit(copy_context().run, stage, df, name) for name, df in frames.items()]
        return {name: job.result() for name, job in zip(frames, jobs)}
