"""A quality classifier on supervised subword embeddings.

Words and their character n-grams are hashed to buckets, each with a learnt
vector. A text is the average of the vectors of all its words and n-grams;
a softmax layer on it gives the probability of the label. Vectors and layer are
trained together by stochastic gradient descent in numpy. As everything before
the softmax is linear, scoring adds one number a word, which workers remember.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogsync.llm.common import crc_mod, map_batches, once, pick

BUCKETS = 1 << 16
DIMENSIONS = 16
NGRAMS = (3, 4)
# Passes over the sample; small samples are passed until there are so many steps.
EPOCHS = 5
LEAST_STEPS = 20_000
RATE = 0.5
# Bounds of the sample that the model is fitted on.
FIT_ROWS = 6_000
FIT_BYTES = 24_000_000
# Words that a worker remembers, and the bytes of the longest of them.
WORDS_KEPT = 200_000
LONGEST_KEPT = 64
# Words of a long text, and bytes of short ones, whose unknown words are learnt at once.
WORDS_AT_ONCE = 50_000
BYTES_AT_ONCE = 500_000


@dataclass
class Model:
    vectors: np.ndarray  # a row per bucket
    weights: np.ndarray  # dimensions x 2
    bias: np.ndarray  # 2


def features(word: bytes, buckets: int = BUCKETS) -> np.ndarray:
    """Buckets of a word and of the n-grams of its characters between marks."""
    marked = "<" + word.decode("utf-8", "replace") + ">"
    if marked.isascii():
        grams, step = marked.encode(), 1
    else:
        grams, step = marked.encode("utf-32-le"), 4
    found = [crc32(word, 7) % buckets]
    for n in NGRAMS:
        size = n * step
        found += [crc32(grams[k : k + size]) % buckets for k in range(0, len(grams) - size + 1, step)]
    return np.array(found, dtype=np.uint32)


# The table that CRC-32 goes by, from its values for single bytes.
_CRC_TABLE = np.array([crc32(bytes([255 ^ b])) ^ 0xFF000000 for b in range(256)], dtype=np.uint32)
_ALL_BITS = np.uint32(0xFFFFFFFF)


def window_hashes(letters: np.ndarray, size: int, step: int = 1) -> np.ndarray:
    """The CRC-32 of ``size`` bytes from every ``step``-th position on, as of ``zlib``; ``letters`` are bytes as uint32."""
    count = max(0, (len(letters) - size) // step + 1)
    value = np.full(count, _ALL_BITS)
    for k in range(size):
        value = _CRC_TABLE[(value ^ letters[k : k + count * step : step][:count]) & np.uint32(0xFF)] ^ (value >> np.uint32(8))
    return value ^ _ALL_BITS


def text_features(text: bytes, known: dict[bytes, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and their shares of all its features."""
    found = []
    for word in text.split():
        buckets = known.get(word)
        if buckets is None:
            buckets = features(word)
            if len(word) <= LONGEST_KEPT:
                if len(known) >= WORDS_KEPT // 4:
                    known.clear()
                known[word] = buckets
        found.append(buckets)
    if not found:
        return np.zeros(0, np.uint32), np.zeros(0, np.float32)
    used, counts = np.unique(np.concatenate(found), return_counts=True)
    return used, (counts / counts.sum()).astype(np.float32)


def train(samples: list[tuple[np.ndarray, np.ndarray]], labels: list[int], rate: float = RATE, seed: int = 1) -> Model:
    """Stochastic gradient descent, a text a step; the rate falls to zero."""
    epochs = max(EPOCHS, -(-LEAST_STEPS // max(1, len(samples))))
    random = np.random.Generator(np.random.PCG64(seed))
    vectors = random.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS)).astype(np.float32)
    weights, bias = np.zeros((DIMENSIONS, 2), np.float32), np.zeros(2, np.float32)
    steps, done = max(1, epochs * len(samples)), 0
    for _ in range(epochs):
        for k in random.permutation(len(samples)):
            used, shares = samples[k]
            now = np.float32(rate * (1 - done / steps))
            done += 1
            hidden = shares @ vectors[used] if len(used) else np.zeros(DIMENSIONS, np.float32)
            wrong = softmax(hidden @ weights + bias)
            wrong[labels[k]] -= 1
            back = weights @ wrong
            weights -= now * np.outer(hidden, wrong)
            bias -= now * wrong
            # A feature's share is tiny in a long text; the square root keeps rare ones learning.
            vectors[used] -= now * np.sqrt(shares)[:, None] * back
    return Model(vectors, weights, bias)


def softmax(values: np.ndarray) -> np.ndarray:
    powers = np.exp(values - values.max())
    return powers / powers.sum()


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = FIT_ROWS, size: int = FIT_BYTES) -> Model:
    """Fit on a bounded sample of labelled rows: at most ``rows`` of them and ``size`` bytes of text.

    The sample is the labelled documents with the smallest hashes of their ids,
    so it is the same at every run. Only its ids are sent to the scan of the
    texts. Null labels, ids and texts teach nothing; of several labels of a
    document each counts. Without any labelled text all scores are 0.5.
    """
    marks = pick(labels, doc_id="doc_id", label=label).where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1))
    chosen = marks.orderBy(F.xxhash64("doc_id"), "label").limit(rows)
    texts = pick(docs, doc_id="doc_id", text="text").where(F.col("text").isNotNull())
    sample = texts.join(F.broadcast(chosen), "doc_id").select(
        F.col("doc_id").cast("string").alias("doc_id"), F.col("label").cast("int").alias("label"), F.col("text").cast("binary").alias("text")
    )

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, np.ndarray] = {}
        taken, left = [], size
        for batch in batches:
            for doc_id, mark, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "label", "text"))):
                if len(text) <= left:
                    left -= len(text)
                    taken.append((crc32(doc_id.encode()), doc_id, mark, *text_features(text, known)))
        taken.sort(key=lambda t: t[:3])
        known.clear()
        model = train([t[3:] for t in taken], [t[2] for t in taken])
        packed = [a.astype(np.float32).tobytes() for a in (model.vectors, model.weights, model.bias)]
        yield pa.RecordBatch.from_arrays([pa.array([p], pa.binary()) for p in packed], names=["vectors", "weights", "bias"])

    ordered = sample.repartition(1).sortWithinPartitions(F.xxhash64("doc_id"), "label")
    made = map_batches(ordered, learn, "vectors binary, weights binary, bias binary").collect()
    if not made:
        return train([], [])
    vectors, weights, bias = (np.frombuffer(made[0][c], dtype=np.float32) for c in ("vectors", "weights", "bias"))
    return Model(vectors.reshape(BUCKETS, DIMENSIONS), weights.reshape(DIMENSIONS, 2), bias)


class Scorer(dict):
    """For each word the sum of its features' shares of the margin, and their number."""

    def __init__(self, margins: np.ndarray, bias: float):
        self.margins, self.bias = margins, bias

    def __missing__(self, word: bytes) -> complex:
        buckets = features(word)
        value = complex(float(self.margins[buckets].sum()), len(buckets))
        if len(word) <= LONGEST_KEPT:
            if len(self) >= WORDS_KEPT:
                self.clear()
            self[word] = value
        return value

    def learn(self, words: Iterable[bytes]) -> None:
        """Take in the short words that are not known yet, by passes over the bytes of all of them.

        Words of one length are the rows of a matrix; its sums are those of single words to the last bit.
        """
        words = {w for w in words if len(w) <= LONGEST_KEPT}
        fresh = [w for w in words if w not in self]
        if len(self) + len(fresh) > WORDS_KEPT:
            self.clear()
            fresh = list(words)
        plain = [w for w in fresh if w.isascii()]
        self._learn(plain, [b"<" + w + b">" for w in plain], 1)
        other = [w for w in fresh if not w.isascii()]
        self._learn(other, [f"<{w.decode('utf-8', 'replace')}>".encode("utf-32-le") for w in other], 4)

    def _learn(self, words: list[bytes], marked: list[bytes], step: int) -> None:
        if not words:
            return
        letters = np.frombuffer(b"".join(marked), dtype=np.uint8).astype(np.uint32)
        lengths = np.array([len(m) // step for m in marked], dtype=np.int64)
        starts = np.cumsum(lengths) - lengths
        whole = self.margins[np.array([crc32(w, 7) for w in words], dtype=np.uint32) % np.uint32(BUCKETS)]
        grams = [self.margins[window_hashes(letters, n * step, step) % np.uint32(BUCKETS)] for n in NGRAMS]
        for length in set(lengths.tolist()):
            at = np.flatnonzero(lengths == length)
            parts = [whole[at][:, None]]
            for n, values in zip(NGRAMS, grams):
                if length >= n:
                    parts.append(values[starts[at][:, None] + np.arange(length - n + 1)])
            rows = np.concatenate(parts, axis=1)
            count = rows.shape[1]
            self.update((words[k], complex(value, count)) for k, value in zip(at.tolist(), rows.sum(axis=1).tolist()))

    def scores(self, texts: Iterable[bytes]) -> Iterator[float]:
        """Scores in the order of the texts; the words of several short texts are learnt together."""
        some, size = [], 0
        for text in texts:
            if some and size + len(text) > BYTES_AT_ONCE:
                yield from self._together(some)
                some, size = [], 0
            some.append(text)
            size += len(text)
        yield from self._together(some)

    def _together(self, texts: list[bytes]) -> Iterator[float]:
        split = [text.split() for text in texts]
        if len(split) > 1:
            self.learn(chain.from_iterable(split))
        for words in split:
            total = 0j
            for k in range(0, len(words), WORDS_AT_ONCE):
                part = words[k : k + WORDS_AT_ONCE]
                if len(split) == 1:
                    self.learn(part)
                total = sum(map(self.__getitem__, part), total)  # both sums at once
            yield self._probability(total)

    def score(self, text: bytes) -> float:
        return next(self.scores([text]))

    def _probability(self, total: complex) -> float:
        margin = self.bias + (total.real / total.imag if total.imag else 0.0)
        return float(1 / (1 + np.exp(-margin)))


def score_quality(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.3) -> DataFrame:
    """Probability of label 1 for every whole text: ``doc_id``, ``score``, ``predicted`` (score >= threshold).

    An empty, blank or null text has no features and gets the score of the bias.
    A row per row of ``docs``: null ids stay null, repeated rows each get their
    row, an empty table gives an empty one, other columns are ignored. Texts of
    any length are scored whole.
    """
    margins = model.vectors.astype(np.float64) @ (model.weights[:, 1] - model.weights[:, 0]).astype(np.float64)
    rows = pick(docs, doc_id=doc_id, text=text).select("doc_id", F.col("text").cast("binary").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    sent = rows.sparkSession.sparkContext.broadcast((margins, float(model.bias[1] - model.bias[0])))
    key = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = once(("quality", key), lambda: Scorer(*sent.value))
        for batch in batches:
            scores = np.array(list(scorer.scores(t or b"" for t in batch.column("text").to_pylist())), dtype=np.float64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores), pa.array((scores >= threshold).astype(np.int32))],
                names=["doc_id", "score", "predicted"],
            )

    return map_batches(rows, run, f"doc_id {kind}, score double, predicted int")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learn from the labels outside the held-out fifth, score all documents: adds ``held_out``."""
    model = fit_quality(docs, labels.where(crc_mod("doc_id", 5) != 0))
    return score_quality(docs, model).withColumn("held_out", crc_mod("doc_id", 5) == 0)
