"""Exact top-k search by integer inner product over an impact-ordered index.

Vectors are dealt into blocks. In a block every component's values are cut into
levels: a posting segment holds the vectors of one level of one component, with
the smallest and largest value, its impact. For a query, segments are processed
score at a time, by falling impact; what a vector has not met yet is bounded by
the best segment left of each component. A query stops when the bounds prove that
no vector outside a small set can be among its best; these are scored exactly.
A batch of queries adds the impacts of a round's segments to all accumulators at
once, as a product with the 0/1 matrix of postings.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from catalogsync.llm.common import map_batches, pick, stage

SCALE = 256
# Vectors of an index block, queries of a query block, queries of a batch.
BLOCK = 4096
QUERY_BLOCK = 2048
BATCH = 128
LEVELS = 8
# Shares of the segments, by impact, after which the proof is tried.
ROUNDS = (0.75, 1.0)
# Stop early where no more than this share of a block is left to score.
LEFT = 1 / 8
# The largest double that is a long.
LONGEST = float((1 << 63) - 1024)
# Bounds are taken in single precision; impacts beyond this are scaled down first.
LARGEST_IMPACT = 1e30
# Index blocks that meet a query block under one shuffle key.
TOGETHER = 64


def quantised(vectors: list[list[float]]) -> np.ndarray:
    """floor(256 * x) as whole numbers; shorter vectors are filled up with zeros.

    Values that don't fit a long are held at its ends.
    """
    width = max(map(len, vectors), default=0)
    if all(len(v) == width for v in vectors):
        real = np.array(vectors, dtype=np.float64).reshape(len(vectors), width)
    else:
        real = np.zeros((len(vectors), width))
        for k, v in enumerate(vectors):
            real[k, : len(v)] = v
    return np.clip(np.floor(SCALE * real), -LONGEST, LONGEST).astype(np.int64)


def inner_products(values: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Exact inner products of rows with a query; those that don't fit a long are held at its ends."""
    found = values @ query
    largest = float(np.abs(values).max(initial=0)) * float(np.abs(query).max(initial=0)) * max(1, len(query))
    if largest >= 1 << 62:
        # Sums may leave the range of a long: those that could are taken in whole numbers of any size.
        size = np.abs(values).astype(np.float64) @ np.abs(query).astype(np.float64)
        for row in np.flatnonzero(size >= 1 << 62):
            exact = sum(int(a) * int(b) for a, b in zip(values[row], query))
            found[row] = min(max(exact, -(1 << 63)), (1 << 63) - 1)
    return found


class Block:
    """Postings of a block of vectors."""

    def __init__(self, ids: np.ndarray, values: np.ndarray):
        self.ids, self.values = ids, values
        n, width = values.shape
        order = np.argsort(values, axis=0, kind="stable")
        cuts = np.unique(np.linspace(0, n, min(LEVELS, n) + 1).astype(int))
        self.levels = len(cuts) - 1
        ranked = np.take_along_axis(values, order, axis=0).T
        self.low, self.high = ranked[:, cuts[:-1]].astype(np.float64), ranked[:, cuts[1:] - 1].astype(np.float64)
        level = np.repeat(np.arange(self.levels), np.diff(cuts))
        self.postings = np.zeros((width * self.levels, n), dtype=np.float32)
        for d in range(width):
            self.postings[d * self.levels + level, order[:, d]] = 1

    def search(self, ids: np.ndarray, queries: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each query its ``k`` best of the block: (query id, vector ids, scores)."""
        width = min(queries.shape[1], self.values.shape[1])
        values, queries = self.values[:, :width], queries[:, :width]
        low, high = self.low[:width], self.high[:width]
        postings = self.postings[: width * self.levels]
        for start in range(0, len(ids), BATCH):
            left = np.arange(start, min(start + BATCH, len(ids)))
            for share in ROUNDS:
                if len(left):
                    left = yield from self._round(left, share, ids, queries, values, low, high, postings, k)

    def _round(self, left, share, ids, queries, values, low, high, postings, k):
        """Process the segments of most impact; yield the queries that are proven, return the others."""
        n = len(self.ids)
        q = queries[left].astype(np.float64)[:, :, None]
        up = np.maximum(q * low, q * high)
        scale = np.maximum(1.0, np.abs(up).max(axis=(1, 2), initial=0.0) / LARGEST_IMPACT)
        up = up / scale[:, None, None]
        impact = (up - up.min(axis=2, keepdims=True)).reshape(len(left), -1)
        done = np.ones_like(impact, dtype=bool)
        if share < 1:
            kept = max(1, math.ceil(share * impact.shape[1]))
            done = impact >= -np.partition(-impact, kept - 1, axis=1)[:, kept - 1 : kept]
        done = done.reshape(up.shape)
        ahead = np.where(done, -np.inf, up).max(axis=2, keepdims=True)
        ahead[np.isinf(ahead)] = 0.0  # all segments of the component are processed
        weights = np.where(done, up - ahead, 0.0).reshape(len(left), -1)
        bound = weights.astype(np.float32) @ postings + ahead.sum(axis=1).astype(np.float32)
        # What single precision may have lost.
        bound += (np.abs(up).max(axis=2).sum(axis=1, keepdims=True) * 4e-6 * up.shape[1] ** 0.5 + 1).astype(np.float32)
        bound[self.ids[None, :] == ids[left][:, None]] = -np.inf
        tops = np.argpartition(-bound, min(n - 1, 4 * k), axis=1)[:, : 4 * k]
        unproven = []
        for row, query in enumerate(left):
            first = tops[row][np.isfinite(bound[row][tops[row]])]
            scores = np.sort(inner_products(values[first], queries[query]))
            # A score held at the lower end says nothing about bounds below it.
            enough = len(scores) >= k and scores[-k] > -(1 << 63)
            possible = np.flatnonzero(bound[row] >= scores[-k] / scale[row]) if enough else np.flatnonzero(np.isfinite(bound[row]))
            if share < 1 and len(possible) > max(LEFT * n, 4 * k):
                unproven.append(query)
                continue
            exact = inner_products(values[possible], queries[query])
            # The complement reverses the order without leaving the range of a long.
            order = np.lexsort((self.ids[possible], ~exact))[:k]
            yield int(ids[query]), self.ids[possible[order]], exact[order]
        return np.array(unproven, dtype=int)


def packed(rows: DataFrame, size: int, count: int, name: str) -> DataFrame:
    """Blocks of about ``size`` vectors: ``block``, ``width``, ``ids``, ``vectors`` (packed 64-bit and 32-bit integers)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, values = [], []
        for batch in batches:
            ids += batch.column("vec_id").to_pylist()
            values += batch.column("vector").to_pylist()
            while len(ids) >= 2 * size:
                yield block(ids[:size], values[:size])
                ids, values = ids[size:], values[size:]
        if ids:
            yield block(ids, values)

    def block(ids: list[int], values: list[list[float]]) -> pa.RecordBatch:
        whole = quantised(values)
        small = np.abs(whole).max(initial=0) < 1 << 31
        return pa.RecordBatch.from_arrays(
            [
                pa.array([whole.shape[1]], pa.int32()), pa.array([small], pa.bool_()),
                pa.array([np.array(ids, dtype="<i8").tobytes()], pa.binary()), pa.array([whole.astype("<i4" if small else "<i8").tobytes()], pa.binary()),
            ],
            names=["width", "small", "ids", "vectors"],
        )

    dealt = rows.repartition(max(1, math.ceil(count / size)))
    return stage(map_batches(dealt, run, "width int, small boolean, ids binary, vectors binary"), name)


def _unpack(ids: bytes, vectors: bytes, width: int, small: bool) -> tuple[np.ndarray, np.ndarray]:
    places = np.frombuffer(ids, "<i8")
    return places, np.frombuffer(vectors, "<i4" if small else "<i8").reshape(len(places), width).astype(np.int64)


def top_k(vectors: DataFrame, is_query: str, k: int = 5, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """The ``k`` highest inner products of every query with all other rows.

    ``is_query``: a SQL condition on ``vec_id`` that picks the queries among the
    rows. Returns ``query_id``, ``rank`` (from 1), ``vec_id`` and ``score``, ties
    to the smaller ``vec_id``; all rows if there are fewer than ``k``.

    Vectors (or ids) that are null, and vectors that hold null or a number that
    isn't finite, take no part. Vectors of different lengths are compared as if
    filled up with zeros, empty ones score 0. Scores are exact; one that doesn't
    fit a long is held at its ends, as is a component. Rows that repeat an id are
    candidates each, and none of them is a candidate for the query of that id;
    of repeated query ids with different vectors the smallest vector asks. An
    empty table gives an empty one. Other columns are ignored. Every query block
    meets every index block once, and only the best of each block are merged.
    """
    rows = pick(vectors, vec_id=vec_id, vector=embedding)
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("vector").cast("array<double>").alias("vector"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & finite)
    asked = rows.where(is_query).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    index = packed(rows, BLOCK, rows.count(), "topk-index")
    queries = packed(asked, QUERY_BLOCK, asked.count(), "topk-queries")
    # Blocks are numbered by a digest of their ids, which no two share: only digests are sorted.
    keyed = queries.withColumn("digest", F.sha2("ids", 256))
    numbers = keyed.select("digest", (F.row_number().over(W.orderBy("digest")) - 1).alias("block"))
    blocks, index_blocks = queries.count(), index.count()
    # A query block goes to every group of index blocks, so no key gathers the whole index.
    groups = -(-index_blocks // TOGETHER) or 1
    numbered = keyed.join(numbers, "digest").select(
        "block", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("part"),
        F.col("width").alias("q_width"), F.col("small").alias("q_small"), F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"),
    )
    spread = index.withColumn("part", F.pmod(F.xxhash64("ids"), F.lit(groups)).cast("int")).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(max(0, blocks - 1))))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(*_unpack(row["ids"], row["vectors"], row["width"], row["small"]))
                found = list(block.search(*_unpack(row["q_ids"], row["q_vectors"], row["q_width"], row["q_small"]), k))
                if found:
                    asked_by = np.repeat([q for q, *_ in found], [len(v) for _, v, _ in found])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(asked_by), pa.array(np.concatenate([v for _, v, _ in found])), pa.array(np.concatenate([s for *_, s in found]))],
                        names=["query_id", "vec_id", "score"],
                    )

    met = spread.join(numbered, ["block", "part"]).drop("block", "part").repartition(max(1, blocks * index_blocks))
    best = map_batches(met, run, "query_id long, vec_id long, score long")
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
