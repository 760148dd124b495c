"""Which terms set a source apart within its language, and how far sources differ from each other.

Counts first, then cells: the terms of a group (language and source) that share
their count in the group and their count in the language form one cell, and a
divergence is evaluated once per cell, however many terms it has. Cells with equal
values are merged, the best values are found by the cumulative number of their
terms, and only the cells of these values are expanded into terms again, in UTF-8
order. All numbers are whole: shares are in units of 1e-9, rounded down.

Sources are compared in blocks of terms: a task holds the counts of some terms in
some sources as a matrix and adds up its part of every pair's sum. Nothing is
emitted per term and pair.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from catalogsync.llm.common import map_batches, pick, prepare, stage

# A term is a run of ASCII letters and of characters beyond ASCII; every other byte ends it.
_BLANK = bytes(c if c >= 0x80 or chr(c).isalpha() else 0x20 for c in range(256)).lower()
# Bytes of a text that are split at once, and terms (by group) that a task holds before it hands them on.
PIECE = 1 << 20
HELD = 1_500_000
# Counts in a block of terms, sources in a tile, and cells of a matrix that a task makes at once.
BLOCK = 400_000
TILE = 512
CELLS = 2_000_000

_PART = "lang string, source string, item string, value long, seen long"


def _pieces(text: str) -> Iterator[list[bytes]]:
    """The terms of a text, some at a time."""
    clean = text.encode().translate(_BLANK)
    start = 0
    while len(clean) - start > PIECE:
        stop = clean.find(b" ", start + PIECE)
        if stop < 0:
            break
        yield clean[start:stop].split()
        start = stop
    yield clean[start:].split()


def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of the terms of every group, added up per task; a group without terms has the term ''."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    room = HELD

    def flush() -> Iterator[pa.RecordBatch]:
        for (lang, source), (occurrences, documents) in held.items():
            for terms in _slices(list(occurrences)):
                yield _batch(lang, source, terms, [occurrences[t] for t in terms], [documents[t] for t in terms])
            yield _batch(lang, source, [b""], [0], [0])
        held.clear()

    for batch in batches:
        for text, lang, source in zip(*(batch.column(c).to_pylist() for c in ("text", "lang", "source"))):
            occurrences, documents = held.setdefault((lang, source), (Counter(), Counter()))
            distinct: set[bytes] = set()
            for terms in _pieces(text):
                occurrences.update(terms)
                distinct.update(terms)
            documents.update(distinct)
            room -= len(distinct)
            if room <= 0:
                room = HELD - sum(len(n) for n, _ in held.values())
                if room <= HELD // 4:
                    yield from flush()
                    room = HELD
    yield from flush()


def _slices(terms: list[bytes], size: int = 50_000) -> Iterator[list[bytes]]:
    return (terms[k : k + size] for k in range(0, len(terms), size))


def _batch(lang: str, source: str, terms: list[bytes], n: list[int], docs: list[int]) -> pa.RecordBatch:
    size = len(terms)
    columns = [pa.array([lang] * size, pa.string()), pa.array([source] * size, pa.string()), pa.array(terms, pa.binary()).cast(pa.string())]
    return pa.RecordBatch.from_arrays([*columns, pa.array(n, pa.int64()), pa.array(docs, pa.int64())], names=["lang", "source", "term", "n", "docs"])


def term_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", min_docs: int = 10) -> DataFrame:
    """``lang``, ``term``, ``source``, ``n`` and ``lang_n`` of the terms in at least ``min_docs`` documents of their language.

    ``lead`` marks one row of every term of a language. Every group also has a
    row with the term '' and no occurrences.
    """
    rows = pick(docs, text=text, lang=lang, source=source).select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")])
    partial = map_batches(rows, _tally, "lang string, source string, term string, n long, docs long")
    # One shuffle by language and term serves the sums by source and those over all sources.
    dealt = partial.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    same = W.partitionBy("lang", "term")
    whole = dealt.select(
        "lang", "term", "source", "n", F.sum("n").over(same).alias("lang_n"), F.sum("docs").over(same).alias("lang_docs"),
        (F.col("source") == F.min("source").over(same)).cast("long").alias("lead"),
    )
    return whole.where((F.col("lang_docs") >= min_docs) | (F.col("term") == "")).drop("lang_docs")


def share(count: str, total: str) -> Column:
    """``1 + floor(1e9 * (count + 2) / total)`` by long division, three digits at a time, exact to totals of 9e15."""
    rest, out = f"({count} + 2)", f"(({count} + 2) div {total})"
    for _ in range(3):
        rest = f"(({rest} % {total}) * 1000)"
        out = f"({out} * 1000 + {rest} div {total})"
    return F.expr(f"1 + {out}")


def distance(p: str, q: str) -> Column:
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


def group_sizes(counts: DataFrame) -> DataFrame:
    """A row per group: smoothed totals of the group and its language, kept terms of the language, their counts."""
    groups = counts.groupBy("lang", "source").agg(F.sum("n").alias("group_total"))
    langs = counts.groupBy("lang").agg(
        F.sum("n").alias("lang_total"),
        F.sum(F.when(F.col("term") != "", F.col("lead")).otherwise(0)).alias("terms"),
        F.sum((F.col("term") != "").cast("long")).alias("counts"),
    )
    both = groups.join(langs, "lang")
    return both.select(
        "lang", "source", "terms", "counts",
        F.expr("nullif(group_total + 2 * terms, 0)").alias("group_total"), F.expr("nullif(lang_total + 2 * terms, 0)").alias("lang_total"),
    )


def top_terms(counts: DataFrame, sizes: DataFrame, top: int = 10) -> DataFrame:
    """The terms of each group that are most above their language's share, by cells of equal counts."""
    terms = counts.where("term <> ''")
    cells = terms.groupBy("lang", "source", "n", "lang_n").agg(F.count(F.lit(1)).alias("members")).join(sizes, ["lang", "source"])
    cells = cells.withColumn("p", share("n", "group_total")).withColumn("q", share("lang_n", "lang_total")).where("p > q")
    cells = stage(cells.select("lang", "source", "n", "lang_n", "members", distance("p", "q").alias("value")), "cells")
    # A value has a term at least, so the best values by number hold the best terms by number.
    values = cells.groupBy("lang", "source", "value").agg(F.sum("members").alias("members"))
    falling = W.partitionBy("lang", "source").orderBy(F.desc("value"))
    best = values.withColumn("place", F.row_number().over(falling)).where(F.col("place") <= top)
    before = F.coalesce(F.sum("members").over(falling.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    best = best.withColumn("before", before).where(F.col("before") < top).select("lang", "source", "value")
    chosen = cells.join(best, ["lang", "source", "value"]).drop("members")
    expanded = terms.join(chosen, ["lang", "source", "n", "lang_n"])
    ranked = expanded.withColumn("rank", F.row_number().over(W.partitionBy("lang", "source").orderBy(F.desc("value"), "term")))
    return ranked.where(F.col("rank") <= top).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")


def _pair_sums(cells: int) -> Callable[[pa.Table], pa.Table]:
    def add(table: pa.Table) -> pa.Table:
        tile, slot, p = (table.column(c).to_numpy() for c in ("tile", "slot", "p"))
        terms = table.column("term").combine_chunks().dictionary_encode()
        is_source = np.array([t == "" for t in terms.dictionary.to_pylist()], dtype=bool)[terms.indices.to_numpy()]
        lang, names = table.column("lang")[0].as_py(), table.column("source").to_pylist()
        first, second = table.column("first")[0].as_py(), table.column("second")[0].as_py()
        rows = np.flatnonzero(is_source)
        rows = rows[np.lexsort((slot[rows], tile[rows]))]
        # Columns of the matrix: the sources of both tiles; every cell starts with the share of a term that does not occur.
        column = {(tile[r], slot[r]): k for k, r in enumerate(rows)}
        absent = p[rows]
        left = [k for k, r in enumerate(rows) if tile[r] == first]
        right = np.array([k for k, r in enumerate(rows) if tile[r] == second], dtype=np.int64)
        found = np.flatnonzero(~is_source)
        _, line = np.unique(terms.indices.to_numpy()[found], return_inverse=True)
        at = np.array([column[key] for key in zip(tile[found], slot[found])], dtype=np.int64)
        order = np.argsort(line, kind="stable")
        line, at, value = line[order], at[order], p[found][order]
        seen = int(line[-1]) + 1 if len(line) else 0
        sums = np.zeros((len(left), len(rows)), dtype=np.int64)
        height = max(1, cells // max(1, len(rows)))
        for low in range(0, seen, height):
            high = min(seen, low + height)
            matrix = np.repeat(absent[None, :], high - low, axis=0)
            some = slice(*np.searchsorted(line, [low, high]))
            matrix[line[some] - low, at[some]] = value[some]
            for k, own in enumerate(left):
                others = right[right > own] if first == second else right
                gap = matrix[:, others] - matrix[:, [own]]
                sums[k, others] += (gap * gap // (matrix[:, others] + matrix[:, [own]])).sum(axis=0)
        out = [(lang, names[rows[own]], names[rows[other]], int(sums[k, other]), seen) for k, own in enumerate(left) for other in right if first != second or other > own]
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 5, [pa.string()] * 3 + [pa.int64()] * 2)], names=["lang", "source", "item", "value", "seen"])

    return add


def source_pairs(counts: DataFrame, sizes: DataFrame, block: int = BLOCK, tile: int = TILE, cells: int = CELLS) -> DataFrame:
    """How far each source is from every other source of its language, summed over all kept terms."""
    prepare(counts.sparkSession)
    place = F.row_number().over(W.partitionBy("lang").orderBy("source")) - 1
    spread = sizes.withColumn("place", place).select(
        "lang", "source", "group_total", "terms", F.expr(f"cast(place div {tile} as int)").alias("tile"), F.expr(f"place % {tile}").alias("slot"),
        F.expr(f"cast(greatest(1, (counts + {block - 1}) div {block}) as int)").alias("parts"),
    )
    spread = stage(spread.withColumn("tiles", F.max("tile").over(W.partitionBy("lang")) + 1).withColumn("absent", share("0", "group_total")), "sources")
    terms = counts.where("term <> ''").join(spread, ["lang", "source"])
    terms = terms.select("lang", "source", "tile", "slot", "tiles", F.expr("pmod(xxhash64(term), parts)").alias("part"), "term", share("n", "group_total").alias("p"))
    sources = spread.select(
        "lang", "source", "tile", "slot", "tiles", F.explode(F.expr("sequence(0L, parts - 1L)")).alias("part"), F.lit("").alias("term"), F.coalesce("absent", F.lit(1)).alias("p")
    )
    # A count goes to every pair of tiles with its own; up to TILE sources that is one.
    dealt = terms.unionByName(sources).withColumn("other", F.explode(F.expr("sequence(0, tiles - 1)")))
    dealt = dealt.withColumn("first", F.least("tile", "other")).withColumn("second", F.greatest("tile", "other"))
    sums = dealt.groupBy("lang", "first", "second", "part").applyInArrow(_pair_sums(cells), _PART)
    sums = sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"), F.sum("seen").alias("seen"))
    own = spread.select("lang", "source", "terms", F.col("absent").alias("p"))
    other = spread.select("lang", F.col("source").alias("item"), F.col("absent").alias("q"))
    # Terms that occur in no source of the two tiles are one cell.
    whole = sums.join(own, ["lang", "source"]).join(other, ["lang", "item"])
    whole = stage(whole.withColumn("value", F.col("value") + F.coalesce((F.col("terms") - F.col("seen")) * distance("p", "q"), F.lit(0))).select("lang", "source", "item", "value"), "pairs")
    both = whole.unionByName(whole.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))
    ranked = both.withColumn("rank", F.row_number().over(W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")))
    return ranked.select("lang", "source", F.lit("pair").alias("part"), "item", "value", "rank")


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", min_docs: int = 10, top: int = 10, block: int = BLOCK, tile: int = TILE, cells: int = CELLS) -> DataFrame:
    """Distances of each source from the others of its language, and the terms that set it apart.

    Returns ``lang``, ``source``, ``part``, ``item``, ``value``, ``rank``. With
    ``part`` = 'pair' the item is another source of the language and all are
    ranked; with 'term' it is a term more frequent here than in the language, and
    the best ``top`` are given. Ranks fall by value; equal values go by the UTF-8
    bytes of the item. Null texts, languages and sources count as ''. Every row is
    a document, rows that repeat one as well. A group without a kept term still
    has its pairs; in a language without any kept term their value is 0. A
    language of one source has no pairs. An empty table gives no row. Other
    columns are ignored, whatever their names. Long texts are split in pieces, so
    a task holds their distinct terms only.
    """
    counts = stage(term_counts(docs, text, lang, source, min_docs), "counts")
    sizes = stage(group_sizes(counts), "groups")
    return top_terms(counts, sizes, top).unionByName(source_pairs(counts, sizes, block, tile, cells))
