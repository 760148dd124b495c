"""Token counts by a two-tier lookup on the map side.

Texts are split into pre-tokens where they are read. The first tier is a
broadcast table of the corpus's frequent pre-tokens and their token counts, the second a
cache in each worker that the tokenizer library fills on a miss. Pre-tokens are
never shuffled with the texts; after a pass that tallies them, in which only bounded
lists of each partition are merged, counting is one narrow pass over the texts.
"""

from __future__ import annotations

import json
import uuid
from collections import Counter
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogsync.llm.common import map_batches, once, pick, stage

# Bounds of the broadcast table: entries and bytes of an entry.
FREQUENT = 50_000
LONGEST = 48
# Entries of a worker's cache; it starts anew when full.
CACHE = 200_000
# Steps of a doubling of the counts by which the table is cut. It only saves time: token counts don't depend on it.
STEPS = 16

# The split of byte-level tokenizers.
SPLIT = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
# Characters whose classes are the same in every Unicode version of the last ten years, so that regular
# expressions here and in the tokenizer libraries agree on them. Texts with others go through the library whole.
SETTLED = "\x00-ԯḀ-᾿‐-⁞₠-₿ぁ-ゖァ-ヺ一-龥가-힣"
UNSETTLED = regex.compile(f"[^{SETTLED}]")


def pieces(text: str, size: int = 100_000) -> Iterator[list[str]]:
    """The pre-tokens of a text, in lists of bounded length."""
    if len(text) <= size:
        yield SPLIT.findall(text)
        return
    found = SPLIT.finditer(text)
    while some := [m.group() for m in islice(found, size)]:
        yield some


class Counted(dict):
    """Counts of pre-tokens: misses are encoded by the library and kept."""

    def __init__(self, path: str, frequent: dict[str, int]):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.frequent = frequent
        self.added = []
        for token in self.tokenizer.get_added_tokens_decoder().values():
            if token.lstrip or token.rstrip or token.single_word or token.normalized:
                raise ValueError("added tokens that take white space or depend on words are not handled")
            self.added.append(token.content)
        self.specials = regex.compile("|".join(map(regex.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        check_split(self.tokenizer)
        super().__init__(frequent)

    def library(self, text: str) -> int:
        return len(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def __missing__(self, piece: str) -> int:
        n = self.library(piece)
        if len(piece) <= LONGEST:
            if len(self) >= CACHE + len(self.frequent):
                self.clear()
                self.update(self.frequent)
            self[piece] = n
        return n

    def count(self, text: str) -> int:
        if UNSETTLED.search(text):
            return self.library(text)
        total, parts = 0, [text]
        if self.specials:
            parts = self.specials.split(text)
            total = len(parts) - 1
        for part in parts:
            for some in pieces(part):
                total += sum(map(self.__getitem__, some))
        return total


def check_split(tokenizer: object) -> None:
    """Only byte-level tokenizers without a normalizer split texts as SPLIT does."""
    spec = json.loads(tokenizer.to_str())
    split = spec["pre_tokenizer"] or {}
    if spec["normalizer"] or split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex", True):
        raise ValueError("a byte-level tokenizer without normalizer or prefix space is needed")


def frequent_counts(docs: DataFrame, path: str, text: str = "text", entries: int = FREQUENT) -> dict[str, int]:
    """Token counts of the most frequent pre-tokens of all rows; at most ``entries`` of LONGEST characters.

    Each partition gives its ``entries`` most frequent ones; these lists are
    merged by pre-token. The merged list is cut where a step of its counts would
    exceed ``entries``, so it is never sorted by one task.
    """

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for value in batch.column("text").to_pylist():
                for some in pieces(value):
                    seen.update(p for p in some if len(p) <= LONGEST)
                if len(seen) > 20 * entries:
                    seen = Counter(dict(seen.most_common(entries)))
        top = seen.most_common(entries)
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())], names=["piece", "n"])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted = Counted(path, {})
        for batch in batches:
            n = [counted.library(p) for p in batch.column("piece").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("piece"), pa.array(n, pa.int32())], names=["piece", "n"])

    rows = pick(docs, text=text).where(F.col("text").isNotNull())
    tops = map_batches(rows, tally, "piece string, n long")
    merged = tops.groupBy("piece").agg(F.sum("n").alias("n")).where("n > 1")
    merged = stage(merged.withColumn("step", F.floor(F.log2("n") * STEPS).cast("int")), "frequent")
    least, total = None, 0
    for r in sorted(merged.groupBy("step").count().collect(), key=lambda r: -r["step"]):
        total += r["count"]
        if total > entries:
            break
        least = r["step"]
    if least is None:
        return {}
    return {r["piece"]: r["n"] for r in map_batches(merged.where(F.col("step") >= least).select("piece"), measure, "piece string, n int").collect()}


def token_counts(docs: DataFrame, path: str, limit: int = 512, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Count the tokens of every text as the tokenizers library does, without added tokens.

    ``path``: a tokenizers file on every machine, of a byte-level tokenizer.
    Returns a row per row of ``docs``: ``doc_id``, ``n_bytes``, ``n_tokens`` and
    ``over_limit`` (more than ``limit`` tokens). A null text counts as empty: no
    bytes, no tokens. A null id stays null; repeated rows each get their row;
    an empty table gives an empty one. Other columns are ignored, whatever
    their names. Texts of any length are counted in pieces of bounded size.
    """
    frequent = frequent_counts(docs, path, text)
    joined = "".join(frequent)
    lengths = np.fromiter(map(len, frequent), np.uint8, len(frequent))
    counts = np.fromiter(frequent.values(), np.uint8, len(frequent))  # LONGEST characters have fewer than 256 bytes
    table, key = docs.sparkSession.sparkContext.broadcast((joined, lengths, counts)), uuid.uuid4().hex

    def unpack() -> Counted:
        text_of, sizes, n = table.value
        ends = np.cumsum(sizes, dtype=np.int64).tolist()
        starts = [0, *ends[:-1]] if ends else []
        return Counted(path, {text_of[a:b]: c for a, b, c in zip(starts, ends, n.tolist())})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted = once(("token counts", key), unpack)
        for batch in batches:
            tokens = [counted.count(v) if v else 0 for v in batch.column("text").to_pylist()]
            n = pa.array(tokens, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), n, pa.array([t > limit for t in tokens], pa.bool_())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    rows = pick(docs, doc_id=doc_id, text=text)
    kind = rows.schema["doc_id"].dataType.simpleString()
    rows = rows.select("doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    return map_batches(rows, count, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
