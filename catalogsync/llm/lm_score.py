"""Documents scored by masked pseudo-likelihood.

A small network predicts every byte of a text from the bytes on both sides: each
place of the window has its own table of input vectors, their sum goes through
tanh, a softmax layer gives the byte. The score of a document is the sum of the
logarithms of the probabilities of all its bytes.

The network is trained in numpy on the whole corpus: every partition counts the
windows of all its texts and descends on these counts, starting from the common
network; the networks are averaged by the bytes they have seen, and the next
round starts from the average. Windows repeat a lot, so a network is evaluated
once for each distinct window of a block of text, not for each byte.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogsync.llm.common import map_batches, pick, sum_vectors

SIDE = 2  # bytes on each side
HIDDEN = 32
ROUNDS = 2
RATE = 0.08
PASSES = 2  # over the counts that a partition has gathered
STEP = 2048  # distinct windows of a step
BLOCK = 4_000_000  # bytes counted or scored at once
DISTINCT = 2_000_000  # distinct windows and bytes that are held before they are learnt from
EDGE = 256  # what stands beyond the ends of a text
INPUTS = 257
PLACES = tuple(k for k in range(-SIDE, SIDE + 1) if k)


class Network:
    """Parameters in one vector, with views of its parts."""

    SHAPES = ((len(PLACES), INPUTS, HIDDEN), (HIDDEN,), (HIDDEN, 256), (256,))

    def __init__(self, values: np.ndarray):
        self.values, self.parts, at = values, [], 0
        for shape in self.SHAPES:
            size = int(np.prod(shape))
            self.parts.append(values[at : at + size].reshape(shape))
            at += size

    @classmethod
    def size(cls) -> int:
        return sum(int(np.prod(s)) for s in cls.SHAPES)

    @classmethod
    def start(cls, seed: int = 3) -> Network:
        values = np.zeros(cls.size(), np.float32)
        net, random = cls(values), np.random.Generator(np.random.PCG64(seed))
        net.parts[0][:] = random.normal(0, 0.3, net.parts[0].shape)
        net.parts[2][:] = random.normal(0, 0.3, net.parts[2].shape)
        return net

    def hidden(self, windows: np.ndarray) -> np.ndarray:
        tables, bias, *_ = self.parts
        total = tables[0][windows[:, 0]]
        for k in range(1, len(PLACES)):
            total = total + tables[k][windows[:, k]]
        return np.tanh(total + bias)

    def log_probabilities(self, windows: np.ndarray) -> np.ndarray:
        logits = self.hidden(windows) @ self.parts[2] + self.parts[3]
        logits -= logits.max(axis=1, keepdims=True)
        return logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))


def window_codes(data: bytes, start: int, end: int) -> np.ndarray:
    """A number for each byte of ``data[start:end]``: nine bits for each place of its window, then eight for itself."""
    low, high = max(0, start - SIDE), min(len(data), end + SIDE)
    row = np.full(end - start + 2 * SIDE, EDGE, np.int64)
    row[low - (start - SIDE) : high - (start - SIDE)] = np.frombuffer(data, np.uint8, high - low, low)
    n = end - start
    code = np.zeros(n, np.int64)
    for k in PLACES:
        code = (code << 9) | row[SIDE + k : SIDE + k + n]
    return (code << 8) | row[SIDE : SIDE + n]


def windows_of(codes: np.ndarray) -> np.ndarray:
    """The bytes around, a row per code without its own byte."""
    return np.stack([(codes >> (9 * (len(PLACES) - 1 - k))) & 511 for k in range(len(PLACES))], axis=1)


def blocks(texts: list[bytes | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places of texts, codes) of all bytes of all texts, in blocks; long texts in slices."""
    owners, codes, size = [], [], 0
    for place, data in enumerate(texts):
        for start in range(0, len(data or b""), BLOCK):
            some = window_codes(data, start, min(len(data), start + BLOCK))
            if size and size + len(some) > BLOCK:
                yield np.concatenate(owners), np.concatenate(codes)
                owners, codes, size = [], [], 0
            owners.append(np.full(len(some), place, np.int32))
            codes.append(some)
            size += len(some)
    if size:
        yield np.concatenate(owners), np.concatenate(codes)


class Trainer:
    """Adagrad over the distinct windows of a partition, weighted by their counts."""

    def __init__(self, values: np.ndarray):
        self.net = Network(values.astype(np.float32).copy())
        self.seen = np.full(Network.size(), 1e-6, np.float32)
        self.bytes = 0
        self.random = np.random.Generator(np.random.PCG64(11))
        self.codes, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def count(self, codes: np.ndarray) -> None:
        """Add the windows of a block; learns from what is held when that gets too much."""
        self.bytes += len(codes)
        used, counts = np.unique(codes, return_counts=True)
        self.codes, where = np.unique(np.concatenate((self.codes, used)), return_inverse=True)
        self.counts = np.bincount(where, weights=np.concatenate((self.counts, counts))).astype(np.int64)
        if len(self.codes) >= DISTINCT:
            self.learn()

    def learn(self) -> None:
        used, counts = self.codes, self.counts
        self.codes, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if not len(used):
            return
        around = used >> 8
        fresh = np.concatenate(([True], around[1:] != around[:-1]))
        starts = np.flatnonzero(fresh)
        windows, sizes = windows_of(around[starts]), np.diff(np.append(starts, len(used)))
        for _ in range(PASSES):
            order = self.random.permutation(len(starts))
            for at in range(0, len(order), STEP):
                some = np.sort(order[at : at + STEP])
                row = np.repeat(np.arange(len(some)), sizes[some])
                places = np.arange(len(row)) - np.repeat(np.cumsum(sizes[some]) - sizes[some], sizes[some]) + starts[some][row]
                self.step(windows[some], row, used[places] & 255, counts[places])

    def step(self, windows: np.ndarray, row: np.ndarray, byte: np.ndarray, count: np.ndarray) -> None:
        tables, _, out, _ = self.net.parts
        weight = np.sqrt(count).astype(np.float32)  # frequent windows lead, but don't drown the others
        wanted = np.bincount(row * 256 + byte, weights=weight, minlength=len(windows) * 256).reshape(-1, 256).astype(np.float32)
        hidden = self.net.hidden(windows)
        logits = hidden @ out + self.net.parts[3]
        logits -= logits.max(axis=1, keepdims=True)
        chance = np.exp(logits)
        chance /= chance.sum(axis=1, keepdims=True)
        total = wanted.sum(axis=1, keepdims=True)
        wrong = (chance * total - wanted) / total.sum()
        back = (wrong @ out.T) * (1 - hidden * hidden)
        slope = Network(np.zeros_like(self.net.values))
        for k in range(len(PLACES)):
            hot = np.zeros((len(windows), INPUTS), np.float32)
            hot[np.arange(len(windows)), windows[:, k]] = 1
            slope.parts[0][k] = hot.T @ back
        slope.parts[1][:] = back.sum(axis=0)
        slope.parts[2][:] = hidden.T @ wrong
        slope.parts[3][:] = wrong.sum(axis=0)
        self.seen += slope.values * slope.values
        self.net.values -= RATE * slope.values / np.sqrt(self.seen)


def train(docs: DataFrame, text: str = "text", rounds: int = ROUNDS) -> np.ndarray:
    """Parameters trained on all texts. Null and empty texts teach nothing; without any text they are as at the start.

    A partition sends one network a round, so what is gathered grows with the
    corpus; networks are added in two levels, and only their sum reaches the
    driver.
    """
    rows = pick(docs, text=text).where(F.length("text") > 0)
    rows = rows.select(F.col("text").cast("binary").alias("text"), F.spark_partition_id().alias("part"), F.lit(0).alias("all"))
    values = Network.start().values
    for _ in range(rounds):
        sent = docs.sparkSession.sparkContext.broadcast(values)

        def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            trainer, part = Trainer(sent.value), 0
            held, size = [], 0
            for batch in batches:
                part = batch.column("part")[0].as_py() if batch.num_rows else part
                for data in batch.column("text").to_pylist():
                    held.append(data)
                    size += len(data)
                    if size >= BLOCK:
                        for _, codes in blocks(held):
                            trainer.count(codes)
                        held, size = [], 0
            for _, codes in blocks(held):
                trainer.count(codes)
            trainer.learn()
            if trainer.bytes:
                vector = np.append(trainer.net.values.astype(np.float64), 1.0) * trainer.bytes
                yield pa.RecordBatch.from_arrays(
                    [pa.array([0], pa.int32()), pa.array([part], pa.int32()), pa.array([vector.tobytes()], pa.binary())], names=["all", "part", "vec"]
                )

        found = sum_vectors(map_batches(rows, learn, "all int, part int, vec binary"), ["all"]).collect()
        if not found:
            break
        total = np.frombuffer(found[0]["vec"], dtype=np.float64)
        values = (total[:-1] / total[-1]).astype(np.float32)
    return values


def score_texts(texts: list[bytes | None], net: Network) -> np.ndarray:
    """Sums of the log-probabilities of all bytes of each text."""
    sums = np.zeros(len(texts))
    for owners, codes in blocks(texts):
        used, where = np.unique(codes, return_inverse=True)
        around, own = used >> 8, used & 255
        starts = np.flatnonzero(np.concatenate(([True], around[1:] != around[:-1])))
        row = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(used))))
        windows, value = windows_of(around[starts]), np.empty(len(used))
        for at in range(0, len(starts), STEP):
            first = starts[at]
            last = starts[at + STEP] if at + STEP < len(starts) else len(used)
            table = net.log_probabilities(windows[at : at + STEP])
            value[first:last] = table[row[first:last] - at, own[first:last]]
        sums += np.bincount(owners, weights=value[where], minlength=len(texts))
    return sums


def score(docs: DataFrame, values: np.ndarray, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Pseudo-likelihood of every whole text: ``doc_id``, ``n_tokens`` (bytes), ``log_likelihood``, ``per_token``.

    A null or empty text has no tokens, a sum of 0 and a null mean. A row per row
    of ``docs``: null ids stay null, repeated rows each get their row, an empty
    table gives an empty one, other columns are ignored. Long texts are scored in
    slices that see beyond their ends, so the sum is that of the whole.
    """
    rows = pick(docs, doc_id=doc_id, text=text).select("doc_id", F.col("text").cast("binary").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    sent = rows.sparkSession.sparkContext.broadcast(values)

    def scored(net: Network, held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Score batches together: the more text, the more windows repeat."""
        texts = [t for batch in held for t in batch.column("text").to_pylist()]
        sums, at = score_texts(texts, net), 0
        for batch in held:
            own, some = sums[at : at + batch.num_rows], [len(t or b"") for t in texts[at : at + batch.num_rows]]
            at += batch.num_rows
            means = [s / n if n else None for s, n in zip(own, some)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(some, pa.int64()), pa.array(own), pa.array(means, pa.float64())],
                names=["doc_id", "n_tokens", "log_likelihood", "per_token"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net, held = Network(sent.value), []
        for batch in batches:
            held.append(batch)
            if sum(b.nbytes for b in held) >= BLOCK:
                yield from scored(net, held)
                held = []
        if held:
            yield from scored(net, held)

    return map_batches(rows, run, f"doc_id {kind}, n_tokens long, log_likelihood double, per_token double")


def train_and_score(docs: DataFrame) -> DataFrame:
    return score(docs, train(docs))
