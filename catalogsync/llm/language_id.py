"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. The vector of a letter trigram
binds those of its letters, the first two permuted by their place, by
multiplication. A text's vector bundles (adds) those of all its trigrams, a
language's profile those of its training texts. A text gets the language whose
profile has the largest cosine with its vector.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogsync.llm.common import crc_mod, map_batches, once, pick, sum_vectors

DIMENSIONS = 1024
SEED = 20_417
# Bounds of what a worker holds at once: characters and texts of a block, trigrams of a product.
BLOCK_CHARS = 400_000
BLOCK_TEXTS = 64
BLOCK_TRIGRAMS = 4096
LETTERS_KEPT = 4096
# More values than this in the language column are a mistake, not languages.
MOST_LANGUAGES = 2_000

SPACE = 32


@dataclass
class Profiles:
    names: list[str]
    vectors: np.ndarray  # a row per language, of unit length


class Space:
    """Letter vectors, and the sums of trigram vectors for blocks of texts."""

    def __init__(self, dimensions: int):
        self.dimensions = dimensions
        self.letters: dict[int, np.ndarray] = {}
        alpha = np.zeros(0x110000, dtype=bool)
        alpha[[c for c in range(0x110000) if chr(c).isalpha()]] = True
        self.alpha = alpha

    def letter(self, code: int) -> np.ndarray:
        vector = self.letters.get(code)
        if vector is None:
            if len(self.letters) >= LETTERS_KEPT:
                self.letters.clear()
            bits = np.random.Generator(np.random.PCG64([SEED, code])).integers(0, 2, self.dimensions, dtype=np.int8)
            vector = self.letters[code] = bits * np.int8(2) - np.int8(1)
        return vector

    def trigrams(self, codes: np.ndarray) -> np.ndarray:
        """The vectors of trigram codes, a row each."""
        parts = [(codes >> np.uint64(shift)) & np.uint64(0x1FFFFF) for shift in (42, 21, 0)]
        bound = None
        for place, part in zip((2, 1, 0), parts):
            used, where = np.unique(part, return_inverse=True)
            vectors = np.stack([np.roll(self.letter(int(c)), place) for c in used])[where]
            bound = vectors if bound is None else bound * vectors
        return bound

    def codes(self, text: str) -> Iterator[np.ndarray]:
        """Trigrams of lower-cased letters, in slices; runs of anything else, and both ends of the text, are one space.

        The last two signs of a slice go on to the next, so slices make no difference.
        """
        text, row, inside = text.lower(), np.array([SPACE], np.uint64), False
        for start in range(0, len(text), BLOCK_CHARS):
            points = np.frombuffer(text[start : start + BLOCK_CHARS].encode("utf-32-le", "replace"), dtype=np.uint32)
            letter = self.alpha[points]
            kept = np.where(letter, points, SPACE)[letter | np.concatenate(([inside], letter[:-1]))]
            inside = bool(letter[-1])
            ends = inside and start + BLOCK_CHARS >= len(text)
            row = np.concatenate((row[-2:], kept, [SPACE] if ends else [])).astype(np.uint64)
            yield (row[:-2] << np.uint64(42)) | (row[1:-1] << np.uint64(21)) | row[2:]

    def blocks(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(place of the text, trigram code) arrays over all texts, in blocks; long texts in slices."""
        owners, codes, size = [], [], 0
        for place, text in enumerate(texts):
            for found in self.codes(text or ""):
                if size and (size + len(found) > BLOCK_CHARS or len(owners) >= BLOCK_TEXTS):
                    yield np.concatenate(owners), np.concatenate(codes)
                    owners, codes, size = [], [], 0
                owners.append(np.full(len(found), place))
                codes.append(found)
                size += len(found)
        if size:
            yield np.concatenate(owners), np.concatenate(codes)

    def bundle(self, texts: list[str | None]) -> np.ndarray:
        """The vector of each text, a row each; zeros for texts without a letter."""
        out = np.zeros((len(texts), self.dimensions), dtype=np.float32)
        for owners, codes in self.blocks(texts):
            rows, row = np.unique(owners, return_inverse=True)
            used, where = np.unique(codes, return_inverse=True)
            for start in range(0, len(used), BLOCK_TRIGRAMS):
                end = min(len(used), start + BLOCK_TRIGRAMS)
                inside = (where >= start) & (where < end)
                counts = np.bincount(row[inside] * (end - start) + where[inside] - start, minlength=len(rows) * (end - start))
                vectors = self.trigrams(used[start:end]).astype(np.float32)
                out[rows] += counts.reshape(len(rows), -1).astype(np.float32) @ vectors
        return out


def _space(dimensions: int) -> Space:
    return once(("language space", dimensions), lambda: Space(dimensions))


def language_profiles(docs: DataFrame, text: str = "text", lang: str = "lang", dimensions: int = DIMENSIONS) -> Profiles:
    """Learn a profile for each non-null value of ``lang`` from all rows of ``docs``.

    Every partition bundles its texts by language; the bundles are added in two
    levels. Only one vector a language comes to the driver. Rows with a null
    text or language, or without a letter, teach nothing.
    """
    rows = pick(docs, text=text, lang=lang).where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    rows = rows.withColumn("part", F.spark_partition_id())

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space, sums, part = _space(dimensions), {}, 0
        for batch in batches:
            texts, langs = batch.column("text").to_pylist(), np.array(batch.column("lang").to_pylist(), dtype=object)
            part = batch.column("part")[0].as_py() if batch.num_rows else part
            for owners, codes in space.blocks(texts):
                of = langs[owners]
                for name in set(langs[np.unique(owners)]):
                    used, counts = np.unique(codes[of == name], return_counts=True)
                    total = sums.setdefault(name, np.zeros(dimensions))
                    for start in range(0, len(used), BLOCK_TRIGRAMS):
                        some = slice(start, start + BLOCK_TRIGRAMS)
                        total += counts[some].astype(np.float32) @ space.trigrams(used[some]).astype(np.float32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.string()), pa.array([part] * len(sums), pa.int32()), pa.array([v.tobytes() for v in sums.values()], pa.binary())],
            names=["lang", "part", "vec"],
        )

    found = sum_vectors(map_batches(rows, learn, "lang string, part int, vec binary"), ["lang"]).limit(MOST_LANGUAGES + 1).collect()
    if len(found) > MOST_LANGUAGES:
        raise ValueError(f"{lang} has more than {MOST_LANGUAGES} values")
    profiles = {r["lang"]: np.frombuffer(r["vec"], dtype=np.float64) for r in found}
    profiles = {name: vector for name, vector in sorted(profiles.items()) if vector.any()}
    vectors = np.array([v / np.linalg.norm(v) for v in profiles.values()], dtype=np.float32).reshape(len(profiles), dimensions)
    return Profiles(list(profiles), vectors)


def predict_language(docs: DataFrame, profiles: Profiles, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The most similar profile of every text: ``doc_id``, ``lang_pred`` and ``score``.

    ``score`` is the cosine with the profile, 0 where it is negative. A text that
    is null or has no letter, or any text where no profile was learnt, gives
    ``und`` with score 0. Of equal cosines the first name wins. A row per row of
    ``docs``: null ids stay null, repeated rows each get their row, an empty
    table gives an empty one, other columns are ignored. Long texts are bundled
    in slices.
    """
    rows = pick(docs, doc_id=doc_id, text=text)
    kind = rows.schema["doc_id"].dataType.simpleString()
    sent = rows.sparkSession.sparkContext.broadcast(profiles)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        space = _space(known.vectors.shape[1])
        for batch in batches:
            vectors = space.bundle(batch.column("text").to_pylist())
            lengths = np.linalg.norm(vectors, axis=1)
            names, scores = ["und"] * len(lengths), np.zeros(len(lengths))
            if known.names:
                cosines = (vectors @ known.vectors.T) / np.maximum(lengths, 1e-9)[:, None]
                best = cosines.argmax(axis=1)
                scores = np.where(lengths > 0, np.clip(cosines[np.arange(len(best)), best], 0, 1), 0.0)
                names = [known.names[b] if n > 0 else "und" for b, n in zip(best, lengths)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(names, pa.string()), pa.array(scores.astype(np.float64))],
                names=["doc_id", "lang_pred", "score"],
            )

    return map_batches(rows, predict, f"doc_id {kind}, lang_pred string, score double")


def identify(docs: DataFrame) -> DataFrame:
    """Learn from the documents outside the held-out quarter, predict all: adds ``held_out``."""
    rows = pick(docs, doc_id="doc_id", text="text", lang="lang")
    profiles = language_profiles(rows.where(crc_mod("doc_id", 4) != 2))
    return predict_language(rows, profiles).withColumn("held_out", crc_mod("doc_id", 4) == 2)


def keep_identified(docs: DataFrame, profiles: Profiles, least: float = 0.0, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text has a language: not ``und``, and a cosine above ``least``. All columns stay; nothing is shuffled.

    Null, empty and letterless texts go, and texts whose best cosine is not above
    ``least``; where no profile was learnt, all rows. Repeated rows and null ids
    are judged each by their text.
    """
    names, place = docs.columns, docs.columns.index(text)
    rows = docs.toDF(*[f"_c{k}" for k in range(len(names))])
    sent = docs.sparkSession.sparkContext.broadcast(profiles)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        space = _space(known.vectors.shape[1])
        for batch in batches:
            vectors = space.bundle(batch.column(place).to_pylist())
            lengths = np.linalg.norm(vectors, axis=1)
            best = (vectors @ known.vectors.T).max(axis=1, initial=-1) / np.maximum(lengths, 1e-9)
            yield batch.filter(pa.array((lengths > 0) & (best > least)))

    return map_batches(rows, keep, rows.schema).toDF(*names)
