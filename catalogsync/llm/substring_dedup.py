"""Removal of passages that an earlier document holds, by prefix-partitioned suffix trees over words.

Only suffixes that begin at an anchor are kept: of the short prefixes (SEED words)
inside a window the one with the smallest hash, the first of them if it repeats.
Equal windows have equal anchors at equal places, so no repeat is lost, and a fifth
of the suffixes is left. A prefix that occurs in one text alone cannot repeat; its
suffixes are never moved.

The others are split by their prefix into groups that fit a task. A prefix that is
too frequent for one group is made longer, up to whole windows. A group builds the
tree of its suffixes, and that of the words before the anchors read backwards: sorted
rows, where the internal nodes of a depth are the runs of rows that agree so far. A
window is a node of the one tree at the depth of its words from the anchor on, and a
node of the other at the depth of the rest; the smallest document below such a pair
of nodes keeps the passage. Every task first settles its own suffixes that way, so of
a passage in a third of all documents each task passes on one row.

Equal texts are one text from the start: only the smallest document among them is
compared, and the others lose all words that a window covers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from catalogsync.llm.common import map_batches, once, pick, prepare, stage

# Words of a window and of the shortest prefix.
WINDOW = 13
SEED = 5
# Suffixes in a group of subtrees, suffixes that a task settles at once, and anchors it compares at once.
GROUP = 60_000
SETTLE = 60_000
ANCHORS = 1_000_000
# A document without an id comes after all others.
LAST = (1 << 63) - 1

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


class _Codes(dict):
    """Hashes of words, remembered while they are few."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 400_000:
            self.clear()
        code = self[word] = xxhash.xxh3_64_intdigest(word)
        return code


def split(text: str) -> list[bytes]:
    """Words of a text: ``bytes.split`` ends them at ASCII white space only, which is what is asked for."""
    return text.encode().split()


def anchors(words: list[bytes], window: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash and place of each anchor, and the first window and the one after the last that have it."""
    if len(words) < window:
        return np.zeros(0, np.int64), *[np.zeros(0, np.intp)] * 3
    codes = np.fromiter(map(once("word-codes", _Codes).__getitem__, words), np.uint64, len(words))
    n = len(words) - seed + 1
    grams = np.zeros(n, np.uint64)
    for k in range(seed):
        grams = grams * _ODD + codes[k : k + n]
    grams = (grams ^ (grams >> np.uint64(29))) * _MIX
    grams ^= grams >> np.uint64(32)
    wide = window - seed + 1
    place = np.lib.stride_tricks.sliding_window_view(grams, wide).argmin(1) + np.arange(n - wide + 1)
    cut = np.flatnonzero(place[1:] != place[:-1]) + 1
    first, stop = np.concatenate([[0], cut]), np.concatenate([cut, [len(place)]])
    return grams[place[first]].view(np.int64), place[first], first, stop


def _prefixes(window: int, seed: int, size: int):
    """Texts and their anchors; what several texts of a task share is known to repeat and sent on by two of them only."""

    def settled(texts: list[np.ndarray], found: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        text, anchor = np.concatenate(texts), np.concatenate(found)
        order = np.lexsort((text, anchor))
        text, anchor = text[order], anchor[order]
        fresh = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])])
        text, anchor = text[fresh], anchor[fresh]
        low = np.concatenate([[True], anchor[1:] != anchor[:-1]])
        high = np.concatenate([low[1:], [True]])
        shared = ~(low & high)
        ask = low | high
        key = np.concatenate([anchor[ask], text[shared]])
        columns = [key, np.concatenate([anchor[ask], anchor[shared]]), np.concatenate([text[ask], text[shared]])]
        known = np.concatenate([np.zeros(ask.sum(), bool), np.ones(shared.sum(), bool)])
        for k in range(0, len(key), 50_000):
            yield pa.RecordBatch.from_arrays([*[pa.array(c[k : k + 50_000]) for c in columns], pa.array(known[k : k + 50_000])], names=["key", "anchor", "h1", "known"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, found, held = [], [], 0
        for batch in batches:
            for h1, text in zip(batch.column("h1").to_pylist(), batch.column("text")):
                hashes = np.unique(anchors(split(text.as_py()), window, seed)[0])
                if len(hashes):
                    found.append(hashes)
                    texts.append(np.full(len(hashes), h1, np.int64))
                    held += len(hashes)
            if held >= size:
                yield from settled(texts, found)
                texts, found, held = [], [], 0
        if held:
            yield from settled(texts, found)

    return run


class _Ids(dict):
    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def _depths(rows: np.ndarray) -> list[np.ndarray]:
    """The tree of the rows: for every depth, the node that each row passes there."""
    if not rows.shape[1]:
        return [np.zeros(len(rows), np.int64)]
    order = np.lexsort(rows.T[::-1])
    differ = rows[order[1:]] != rows[order[:-1]]
    alike = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
    nodes = []
    for depth in range(rows.shape[1] + 1):
        node = np.empty(len(rows), np.int64)
        node[order] = np.concatenate([[0], np.cumsum(alike < depth)])
        nodes.append(node)
    return nodes


def repeated(slices: list[list[bytes]], left: np.ndarray, rank: np.ndarray, window: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of the slices, and whether a slice of smaller rank has them too.

    A slice is the words of one document around an anchor, ``left`` of them
    before it. Returns the slice, the window's start in it, and the verdict.
    """
    ids, n = _Ids(), len(slices)
    length = np.fromiter(map(len, slices), np.int64, n)
    words = np.fromiter((ids[w] for s in slices for w in s), np.int64, int(length.sum()))
    at = np.concatenate([[0], np.cumsum(length)[:-1]]) + left

    def around(places: np.ndarray) -> np.ndarray:
        there = (left[:, None] + places >= 0) & (left[:, None] + places < length[:, None])
        return np.where(there, words[np.where(there, at[:, None] + places, 0)], -1)

    after = _depths(around(np.arange(window)))
    before = _depths(around(-1 - np.arange(window - seed)))
    rows, starts, verdicts = [], [], []
    for back in range(window - seed + 1):
        has = np.flatnonzero((left >= back) & (length - left + back >= window))
        if not len(has):
            continue
        node = after[window - back][has] * n + before[back][has]
        order = np.lexsort((rank[has], node))
        node, ranks = node[order], rank[has][order]
        top = np.concatenate([[True], node[1:] != node[:-1]])
        smallest = ranks[top][np.cumsum(top) - 1]
        rows.append(has[order])
        starts.append((left - back)[has[order]])
        verdicts.append(ranks > smallest)
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    return np.concatenate(rows), np.concatenate(starts), np.concatenate(verdicts)


_RUNS = ["h1", "h2", "start", "stop"]


def _runs(h1: np.ndarray, h2: np.ndarray, start: np.ndarray) -> list[np.ndarray]:
    """Starts of windows, joined to runs of windows that follow each other in a text."""
    order = np.lexsort((start, h2, h1))
    h1, h2, start = h1[order], h2[order], start[order]
    if not len(start):
        return [h1, h2, start, start]
    new = np.concatenate([[True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1]) | (start[1:] > start[:-1] + 1)])
    last = np.concatenate([new[1:], [True]])
    return [h1[new], h2[new], start[new], start[last] + 1]


DONE, TEXT, ASK, RUN = range(4)
_SCHEMA = "kind int, doc_id long, h1 long, h2 long, n_words long, n_removed long, kept string, text string, anchor long, rank long, left_words int, start long, stop long"
_TYPES = {"kind": pa.int32(), "kept": pa.string(), "text": pa.string(), "left_words": pa.int32()}
_NAMES = [part.split()[0] for part in _SCHEMA.split(", ")]


def _rows(kind: int, size: int, **columns: object) -> pa.RecordBatch:
    made = {"kind": np.full(size, kind, np.int32), **columns}
    return pa.RecordBatch.from_arrays([pa.array(made[c], _TYPES.get(c, pa.int64())) if c in made else pa.nulls(size, _TYPES.get(c, pa.int64())) for c in _NAMES], names=_NAMES)


def _left(words: list[bytes], digest: bool) -> str:
    kept = b" ".join(words)
    return hashlib.sha256(kept).hexdigest() if digest else kept.decode()


def _suffixes(window: int, seed: int, size: int, digest: bool):
    """Documents to results where nothing can repeat, else to texts, runs settled here and suffixes to ask about."""

    def settled(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        slices, anchor, left, rank, h1, h2, start = zip(*held)
        anchor, left, rank, h1, h2, start = (np.array(c, np.int64) for c in (anchor, left, rank, h1, h2, start))
        row, inside, late = repeated(list(slices), left, rank, window, seed)
        runs = _runs(h1[row[late]], h2[row[late]], (start[row] + inside)[late])
        if len(runs[0]):
            yield _rows(RUN, len(runs[0]), **dict(zip(_RUNS, runs)))
        ask = np.unique(row[~late])
        for some in (ask[k : k + 10_000] for k in range(0, len(ask), 10_000)):
            joined = [b" ".join(slices[k]).decode() for k in some]
            yield _rows(ASK, len(some), text=joined, anchor=anchor[some], left_words=left[some].astype(np.int32), rank=rank[some], h1=h1[some], h2=h2[some], start=start[some])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            done, texts = [], []
            for doc_id, text, h1, h2, first, shared in zip(*(batch.column(c) for c in ("doc_id", "text", "h1", "h2", "first", "anchors"))):
                doc_id, text, h1, h2 = doc_id.as_py(), text.as_py(), h1.as_py(), h2.as_py()
                words = split(text)
                if not first.as_py():
                    gone = len(words) >= window
                    done.append((doc_id, len(words), len(words) if gone else 0, _left([] if gone else words, digest)))
                    continue
                if shared.is_valid:
                    hashes, place, low, stop = anchors(words, window, seed)
                    at = np.flatnonzero(np.isin(hashes, shared.values.to_numpy()))
                else:
                    at = ()
                if not len(at):
                    done.append((doc_id, len(words), 0, _left(words, digest)))
                    continue
                texts.append((doc_id, h1, h2, text))
                rank = LAST if doc_id is None else doc_id
                for k in at:
                    held.append((words[low[k] : stop[k] + window - 1], hashes[k], place[k] - low[k], rank, h1, h2, low[k]))
                if len(held) >= size:
                    yield from settled(held)
                    held = []
            if done:
                yield _rows(DONE, len(done), **dict(zip(["doc_id", "n_words", "n_removed", "kept"], map(list, zip(*done)))))
            if texts:
                yield _rows(TEXT, len(texts), **dict(zip(["doc_id", "h1", "h2", "text"], map(list, zip(*texts)))))
        if held:
            yield from settled(held)

    return run


def _subtrees(window: int, seed: int):
    def settle(table: pa.Table) -> pa.Table:
        slices = [text.as_py().encode().split() for text in table.column("text")]
        left, rank, h1, h2, start = (table.column(c).to_numpy().astype(np.int64) for c in ("left_words", "rank", "h1", "h2", "start"))
        row, inside, late = repeated(slices, left, rank, window, seed)
        runs = _runs(h1[row[late]], h2[row[late]], (start[row] + inside)[late])
        return pa.table([pa.array(c, pa.int64()) for c in runs], names=_RUNS)

    return settle


def _longer(window: int):
    """Suffixes of too frequent prefixes to their windows, which are their own prefixes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, left, rank, h1, h2, start in zip(*(batch.column(c).to_pylist() for c in ("text", "left_words", "rank", "h1", "h2", "start"))):
                words = text.split(" ")
                for k in range(len(words) - window + 1):
                    out.append((" ".join(words[k : k + window]), left - k, rank, h1, h2, start + k))
            for some in (out[k : k + 20_000] for k in range(0, len(out), 20_000)):
                types = [pa.string(), pa.int32(), *[pa.int64()] * 4]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some), types)], names=["text", "left_words", "rank", "h1", "h2", "start"])

    return run


_ASKED = ["text", "left_words", "rank", "h1", "h2", "start"]


def _settled_by_group(asked: DataFrame, window: int, seed: int, group: int) -> DataFrame:
    """Runs of repeated windows among the suffixes ``asked``, by groups of prefixes."""
    frequent = stage(asked.groupBy("anchor").count().where(F.col("count") > group).select("anchor"), "frequent")
    trees = _subtrees(window, seed)

    def grouped(rows: DataFrame, prefix: str, n: int) -> DataFrame:
        bins = max(1, -(-n // group))
        dealt = rows.withColumn("bin", F.expr(f"pmod(xxhash64({prefix}), {bins})"))
        return dealt.groupBy("bin").applyInArrow(trees, "h1 long, h2 long, start long, stop long")

    total = asked.count()
    if not frequent.take(1):
        return grouped(asked, "anchor", total)
    # At most one row for every GROUP suffixes.
    rare = asked.join(frequent, "anchor", "left_anti")
    windows = stage(map_batches(asked.join(frequent, "anchor", "left_semi").select(*_ASKED), _longer(window), asked.select(*_ASKED).schema), "windows")
    return grouped(rare, "anchor", total).unionByName(grouped(windows, "text", windows.count()))


def _cut(window: int, digest: bool):
    """Texts without the words of their runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, text, runs in zip(*(batch.column(c) for c in ("doc_id", "text", "runs"))):
                words = split(text.as_py())
                change = np.zeros(len(words) + 1, np.int64)
                for found in runs.as_py() or ():
                    change[found["start"]] += 1
                    change[found["stop"] + window - 1] -= 1
                stays = np.cumsum(change[:-1]) == 0
                kept = [w for w, s in zip(words, stays.tolist()) if s]
                out.append((doc_id.as_py(), len(words), len(words) - len(kept), _left(kept, digest)))
            if out:
                types = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=["doc_id", "n_words", "n_removed", "kept"])

    return run


def drop_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, seed: int = SEED, digest: bool = False, group: int = GROUP, settle: int = SETTLE, compare: int = ANCHORS) -> DataFrame:
    """Documents without the words that a window shared with an earlier document covers.

    A window is ``window`` words in a row; it goes if the same words in a row also
    stand in a document with a smaller id. All windows are judged on the texts as
    they come. Returns a row per row of ``docs``: ``doc_id``, ``n_words``,
    ``n_removed`` and ``kept``, the words left, joined by single blanks, or with
    ``digest`` their SHA-256. Words end at ASCII white space and are compared by
    their bytes. Null counts as empty; texts shorter than a window keep all words.
    Repeats within one document stay, also between rows that share an id. Rows
    without an id come after all others (as the largest long does) and lose
    nothing to each other. Repeated rows come out alike. An empty table gives an
    empty one. Other columns are ignored, whatever their names. A task holds one
    text and some ten thousand suffixes at a time, however long the text.
    """
    spark = docs.sparkSession
    prepare(spark)
    rows = pick(docs, doc_id=doc_id, text=text).select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("h1", F.xxhash64("text")).withColumn("h2", F.xxhash64(F.lit(1), "text"))
    first = rows.groupBy("h1", "h2").agg(F.min("doc_id").alias("least"))
    sent = map_batches(rows.select("h1", "text"), _prefixes(window, seed, compare), "key long, anchor long, h1 long, known boolean")
    # Under an anchor there are two rows for every task's million anchors at most; what is known comes under its text.
    same = W.partitionBy("key")
    met = sent.withColumn("least", F.min("h1").over(same)).withColumn("most", F.max("h1").over(same)).where("known or (key = anchor and least < most)")
    hits = met.groupBy("h1").agg(F.collect_set("anchor").alias("anchors"))
    first = first.join(hits, "h1", "left").select(F.col("h1").alias("f1"), F.col("h2").alias("f2"), "least", "anchors")
    marked = rows.join(first, (F.col("h1") == F.col("f1")) & (F.col("h2") == F.col("f2")) & F.col("doc_id").eqNullSafe(F.col("least")), "left")
    marked = marked.select("doc_id", "text", "h1", "h2", F.col("f1").isNotNull().alias("first"), "anchors")
    parts = stage(map_batches(marked, _suffixes(window, seed, settle, digest), _SCHEMA), "suffixes")
    asked = parts.where(F.col("kind") == ASK).select("anchor", *_ASKED)
    runs = parts.where(F.col("kind") == RUN).select(*_RUNS).unionByName(_settled_by_group(asked, window, seed, group))
    by_text = runs.groupBy("h1", "h2").agg(F.collect_list(F.struct("start", "stop")).alias("runs"))
    texts = parts.where(F.col("kind") == TEXT).select("doc_id", "h1", "h2", "text").join(by_text, ["h1", "h2"], "left").select("doc_id", "text", "runs")
    cut = map_batches(texts, _cut(window, digest), "doc_id long, n_words long, n_removed long, kept string")
    return parts.where(F.col("kind") == DONE).select("doc_id", "n_words", "n_removed", "kept").unionByName(cut)
