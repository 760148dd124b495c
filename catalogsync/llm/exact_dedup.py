"""Exact dedup over an extendible-hash index kept as shared files. DataFrame functions only.

Keys are the leading bits of a text's SHA-256. A directory of 2^g entries sends
each prefix of g bits to a bucket. It starts with one entry and doubles while a
bucket holds more keys than its capacity: an overfull bucket is split by one more
bit, the others keep their depth. Key ranges are then dealt to owner tasks by
bucket. Texts under one key form a chain with an entry per distinct text, told
apart by their bytes; equal texts are counted before they leave the task that
reads them, so a text with a third of all rows is one row per task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from catalogsync.llm.common import pick, stage

# Keys of a bucket; one bucket is read by one owner task.
CAPACITY = 1_000_000
# Bits of a key and of the deepest directory: a prefix more keys share than fit a bucket stays one longer bucket.
KEY_BITS = 60
MOST_DEPTH = 16


def key_of(sha: str, bits: int = KEY_BITS) -> Column:
    """The leading ``bits`` (60 at most, a multiple of 4) of a hex digest as a long."""
    return F.conv(F.substring(sha, 1, bits // 4), 16, 10).cast("long")


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def hashed(docs: DataFrame, doc_id: str, text: str, bits: int, digest: Callable[[Column], Column]) -> DataFrame:
    rows = pick(docs, doc_id=doc_id, text=text).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return rows.withColumn("text_sha256", digest(F.col("text"))).withColumn("key", key_of("text_sha256", bits))


def build_directory(keys: DataFrame, capacity: int = CAPACITY, bits: int = KEY_BITS) -> DataFrame:
    """Split buckets until none is overfull: ``prefix`` (of MOST_DEPTH bits), ``bucket`` (its first prefix), ``depth``.

    Works on the number of keys per deepest prefix, 65,536 rows at most, from
    one pass over the keys; every doubling is a sum over these rows.
    """
    deepest = min(MOST_DEPTH, bits)
    entries = keys.groupBy(F.shiftright("key", bits - deepest).alias("prefix")).agg(F.count(F.lit(1)).alias("n"))
    split = entries.withColumn("depth", F.lit(0))
    for depth in range(deepest):
        # Buckets at this depth that are overfull get one more bit; the sum is over the bucket's prefixes.
        bucket = W.partitionBy("depth", F.shiftright("prefix", deepest - depth))
        split = split.withColumn(
            "depth",
            F.when((F.col("depth") == depth) & (F.sum("n").over(bucket) > capacity), depth + 1).otherwise(F.col("depth")),
        )
        if depth == 0 or depth % 4 == 3:
            split = stage(split, "directory")
            if not split.where(F.col("depth") > depth).take(1):
                break
    first = F.expr(f"shiftleft(shiftright(prefix, {deepest} - depth), {deepest} - depth)")
    return split.select("prefix", first.alias("bucket"), "depth")


def build_index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, bits: int = KEY_BITS, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """The chains of all texts, kept as files sorted by bucket and key.

    A row per distinct text: ``bucket``, ``key``, ``chain`` (its place among the
    texts of the key, by ``keep_id``), ``text_sha256``, ``keep_id`` (the largest
    id), ``group_size``, and ``twin``, the text itself where two texts of a key
    share a whole digest.
    """
    rows = hashed(docs, doc_id, text, bits, digest)
    equal = rows.groupBy("key", "text_sha256", "text").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    chains = stage(equal.drop("text"), "chains")
    if chains.groupBy("key", "text_sha256").count().where("count > 1").take(1):
        # Different texts with one digest: all their links carry the text.
        chains = stage(equal, "chains")
        twins = F.count(F.lit(1)).over(W.partitionBy("key", "text_sha256"))
        chains = chains.withColumn("twin", F.when(twins > 1, F.col("text"))).drop("text")
    else:
        chains = chains.withColumn("twin", F.lit(None).cast("string"))
    chains = chains.withColumn("chain", F.row_number().over(W.partitionBy("key").orderBy("keep_id", "text_sha256", "twin")))
    directory = build_directory(chains.where(F.col("chain") == 1).select("key"), capacity, bits)
    deepest = min(MOST_DEPTH, bits)
    # 65,536 rows of three numbers at most, whatever the size of the corpus.
    placed = chains.withColumn("prefix", F.shiftright("key", bits - deepest)).join(F.broadcast(directory), "prefix").drop("prefix", "depth")
    owned = placed.repartitionByRange("bucket", "key").sortWithinPartitions("bucket", "key", "chain")
    return stage(owned, "index")


def exact_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, bits: int = KEY_BITS, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """Which rows hold equal texts, and which of them stays.

    Returns a row per row of ``docs``: ``doc_id``, ``keep_id`` (the largest id of
    the equal texts), ``group_size`` (their rows), ``kept`` (is it that row) and
    ``text_sha256``. Texts are compared by their bytes as they are; null counts
    as empty, so null and empty texts are one group. A null id is never the
    largest one unless all of a group are null; then ``keep_id`` is null and all
    of them stay, as nothing tells them apart. Rows that repeat an id with its
    text are one document: all say that they are kept. An empty table gives an
    empty one. Other columns are ignored, whatever their names. Long texts are
    moved once for each task that reads them, never gathered.
    """
    index = build_index(docs, doc_id, text, capacity, bits, digest).drop("bucket", "chain")
    rows = hashed(docs, doc_id, text, bits, digest)
    if index.where("twin is not null").take(1):
        found = rows.join(index, ["key", "text_sha256"]).where(F.col("twin").isNull() | (F.col("twin") == F.col("text")))
    else:  # every digest stands for one text, so the texts can stay where they are
        found = rows.drop("text").join(index.drop("twin"), ["key", "text_sha256"])
    return found.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; of rows that repeat an id with its text, one."""
    names = docs.columns
    decided = stage(exact_dedup(docs, doc_id, text).where("kept").select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha")), "kept")
    rows = docs.toDF(*[f"_c{k}" for k in range(len(names))])
    own_id, own_text = F.col(f"_c{names.index(doc_id)}"), F.coalesce(F.col(f"_c{names.index(text)}"), F.lit(""))
    kept = decided.distinct()
    found = rows.join(kept, own_id.eqNullSafe(kept["_id"]) & (F.sha2(own_text, 256) == kept["_sha"]), "left_semi")
    if decided.groupBy("_id", "_sha").count().where("count > 1").take(1):
        found = found.dropDuplicates([f"_c{names.index(doc_id)}", f"_c{names.index(text)}"])
    return found.toDF(*names)
