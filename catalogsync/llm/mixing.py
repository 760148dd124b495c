"""Mixing sources to target weights by weighted sampling without replacement. DataFrame functions only.

Every document gets an exponential key, -ln(u) / weight, with u drawn from a hash
of its id and the weight its quality: the order of the keys is a weighted sample
without replacement, the best documents early. A source first gives its whole
epochs; what is left of its target is filled with the documents of smallest keys,
by prefix sums of their sizes, until none is left that fits. Prefix sums are taken in two levels, over blocks of
neighbouring keys and within them, so a source with a third of all rows is summed
by many tasks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from catalogsync.llm.common import WORD, pick, stage

SEED = "mix"
# Documents of a block of neighbouring keys, about.
BLOCK_ROWS = 5_000
MOST_TIMES = 3


def word_count(text: str = "text") -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quality_weight(text: str = "text") -> Column:
    """How much a text looks like prose, 0.05 to 1: its share of lower-case letters and blanks."""
    plain = F.length(F.regexp_replace(text, "[^a-zà-ÿ ]+", ""))
    share = plain.cast("double") / F.greatest(F.length(text), F.lit(1))
    return F.greatest(F.coalesce(share * share, F.lit(0.0)), F.lit(0.05))


def uniform(column: str, seed: str = SEED) -> Column:
    """A number above 0, up to 1, from the MD5 of a column as text; the same at every run. Null draws as the empty text."""
    text = F.concat(F.coalesce(F.col(column).cast("string"), F.lit("")), F.lit(":" + seed))
    return (F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("double") + 1) / F.lit(float(1 << 48))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = MOST_TIMES) -> DataFrame:
    """Targets of sources from ``source`` and ``source_size``: ``source``, ``source_size``, ``target``.

    Sources in code point order, null last, weigh ``weights`` in turn and share
    the total size. A target stops at ``most`` times its source's size; what is
    over goes to the others by weight until none is above. That is a level: each
    source gets the smaller of ``most * size`` and ``level * weight``, and the
    sources that stop are those of the smallest size per weight. One row per
    source is sorted; documents are not.
    """
    in_order = W.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(in_order) - 1) % len(weights) + 1).cast("int"))
    rows = sizes.withColumn("weight", weight.cast("long"))
    every = W.partitionBy()
    rows = rows.withColumn("total", F.sum("source_size").over(every))
    # Ratios are compared exactly, as a fraction of whole numbers brought to one denominator.
    denominator = 1
    for w in set(weights):
        denominator *= w
    ratio = F.col("source_size") * F.lit(denominator) / F.col("weight")
    rows = rows.withColumn("ratio", ratio.cast("long"))
    before = W.orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumn("stopped_size", F.coalesce(F.sum("source_size").over(before), F.lit(0))).withColumn(
        "stopped_weight", F.coalesce(F.sum("weight").over(before), F.lit(0))
    )
    rows = rows.withColumn("weights_left", F.sum("weight").over(every) - F.col("stopped_weight"))
    # With all smaller ratios stopped, would this one be above its limit too?
    left = F.col("total") - most * F.col("stopped_size")
    rows = rows.withColumn("stops", left * F.col("weight") >= most * F.col("source_size") * F.col("weights_left"))
    rows = rows.withColumn("open_weight", F.sum(F.when(~F.col("stops"), F.col("weight")).otherwise(0)).over(every))
    rows = rows.withColumn("open_size", F.col("total") - most * F.sum(F.when(F.col("stops"), F.col("source_size")).otherwise(0)).over(every))
    target = F.when(F.col("stops"), (most * F.col("source_size")).cast("double")).otherwise(
        (F.col("open_size") * F.col("weight")).cast("double") / F.col("open_weight")
    )
    return rows.select("source", "source_size", target.alias("target"))


def prefix_sums(rows: DataFrame, value: str) -> DataFrame:
    """Add ``before``: the sum of ``value`` over the source's rows of smaller ``key`` (ties by id), in two levels.

    Blocks cut the range of the keys' ranks evenly: 1 - exp(-key) is near
    uniform, and there is a block for every BLOCK_ROWS rows of the source.
    """
    rows = rows.withColumn("block", F.floor((1 - F.exp(-F.col("key") * F.col("scale"))) * F.col("blocks")).cast("long"))
    same = F.col("a.source").eqNullSafe(F.col("b.source")) & (F.col("a.block") == F.col("b.block"))
    by_block = rows.groupBy("source", "block").agg(F.sum(value).alias("block_sum"))
    earlier = W.partitionBy("source").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    offsets = by_block.select("source", "block", F.coalesce(F.sum("block_sum").over(earlier), F.lit(0)).alias("offset"))
    inside = W.partitionBy("source", "block").orderBy("key", F.col("doc_id").asc_nulls_last(), "size").rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumn("within", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return (
        rows.alias("a")
        .join(offsets.alias("b"), same)
        .select("a.*", (F.col("within") + F.col("b.offset")).alias("before"))
        .drop("within", "block")
    )


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """How often the mix takes each document.

    Returns a row per row of ``docs``: ``doc_id``, ``size`` (words),
    ``source_size``, ``target`` (words, of its source), ``times`` and ``taken``
    (``times * size``). All documents of a source are taken for its whole epochs,
    the target divided by its size. The rest of the target is filled in key
    order: each pass takes the documents whose running sum still fits, and looks
    only at those that are no larger than what is left. Passes go on until no
    document fits what its source has left, so the outcome is that of going
    through the documents one by one in key order and taking each that fits; a
    source stays below its target by less than its smallest document not taken.

    A null source is a source of its own, last in order. Null and blank texts
    have size 0: they follow the rule for times and take no words. Null ids and
    repeated rows draw the same key; ties go by id, then size, and rows equal in
    all of these are taken in any order. An empty table gives an empty one.
    Other columns are ignored, whatever their names; long texts only count.
    """
    rows = pick(docs, doc_id=doc_id, text=text, source=source)
    rows = rows.select(
        "doc_id", "source", word_count().alias("size"), (-F.log(uniform("doc_id")) / quality_weight()).alias("key")
    )
    rows = stage(rows, "mix")
    totals = rows.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"), F.avg("key").alias("mean")
    )
    totals = stage(totals, "mix-sources")
    targets = source_targets(totals.select("source", "source_size"))
    targets = (
        targets.alias("t")
        .join(totals.alias("s"), F.col("t.source").eqNullSafe(F.col("s.source")))
        .select(
            F.col("t.source").alias("of"), "t.source_size", "t.target",
            F.ceil(F.col("s.rows") / BLOCK_ROWS).alias("blocks"),
            (F.lit(1.0) / F.greatest("s.mean", F.lit(1e-9))).alias("scale"),
            F.coalesce(F.floor(F.col("t.target") / F.nullif("t.source_size", F.lit(0))), F.lit(0)).cast("long").alias("epochs"),
        )
    )
    targets = stage(targets.withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size")), "mix-targets")
    rows = rows.join(targets, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    rows, settled = rows.withColumn("extra", F.lit(0)), []
    # What a pass may take: documents not taken yet that fit what is left.
    open_rows = (F.col("extra") == 0) & (F.col("rest") > 0) & (F.col("size") <= F.col("rest"))
    while True:
        rows = prefix_sums(rows.withColumn("open", F.when(open_rows, F.col("size")).otherwise(0)), "open")
        fits = open_rows & (F.col("before") + F.col("size") <= F.col("rest"))
        rows = rows.withColumns({"extra": F.when(fits, 1).otherwise(F.col("extra")), "filled": F.when(fits, F.col("size")).otherwise(0)})
        rows = stage(rows.drop("before", "open"), "mix-pass")
        filled = rows.groupBy("source").agg(F.sum("filled").alias("sum")).withColumnRenamed("source", "of")
        rows = rows.drop("filled").join(filled, F.col("source").eqNullSafe(F.col("of"))).drop("of")
        rows = rows.withColumn("rest", F.col("rest") - F.col("sum")).drop("sum")
        settled.append(rows.where(~open_rows))
        # What the next pass looks at; every pass takes one document at least of each source that has any.
        rows = rows.where(open_rows)
        if rows.isEmpty():
            break
    rows = reduce(DataFrame.unionByName, settled)
    times = F.col("epochs") + F.col("extra")
    return rows.select("doc_id", "size", "source_size", "target", times.alias("times"), (times * F.col("size")).alias("taken"))


def apply_mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, with all their columns.

    Rows that agree in id and size are taken alike, as often as the one of them
    that is taken most.
    """
    names = docs.columns
    taken = mix(docs, doc_id, text, source).where("times > 0")
    taken = taken.groupBy(F.col("doc_id").alias("_id"), F.col("size").alias("_size")).agg(F.max("times").alias("_times"))
    rows = docs.toDF(*[f"_c{k}" for k in range(len(names))])
    own_id, own_size = F.col(f"_c{names.index(doc_id)}"), word_count(f"_c{names.index(text)}")
    found = rows.join(taken, own_id.eqNullSafe(F.col("_id")) & (own_size == F.col("_size")))
    copies = found.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times").cast("int"))))
    return copies.select(*[f"_c{k}" for k in range(len(names))]).toDF(*names)
