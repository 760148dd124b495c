"""Skipping below file level: key ranges of products in which nothing can come of a comparison are not compared.

A range is a residue of the key's hash. The live side of the product diff is kept
in a folder per range, with a digest of each; a feed is digested in its scan. A pair
of contents, of feed and of store, that was compared before with nothing noteworthy
is on record, and as long as both stay the same the range is left out: its feed rows
are not shuffled and its live rows not read. Open ranges are matched by digests of
texts first, and texts of the feeds are only moved for keys that came to something
in that. The outcome is that of the whole diff.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalogsync.functions.keys import canonical_key
from catalogsync.operators.merge import merge_product_feeds
from catalogsync.plans import products as P
from catalogsync.session import stage
from catalogsync.settings import Settings
from catalogsync.sources.published import publish, read_entry, write_part
from catalogsync.sources.store import Store

RANGES = 1024
# What tells loud keys from others in the scan of a feed: 16 bits a key, in rows of as many as Spark's bitmaps have,
# 8 MB at most.
BITS, BITS_OF_A_KEY, MOST_ROWS = 32_768, 16, 2_048
# What no rule of the product diff reads; the placements phase may change it.
_UNCOMPARED = ("master_categories_id", "products_date_added", "products_date_available")

_SUM = T.DecimalType(38, 0)
_DIGEST = ["rows", "sum_1", "sum_2"]
_PAIR = [f"{side}_{c}" for side in ("feed", "live") for c in _DIGEST]
_PAIRS = T.StructType(
    [T.StructField("key_range", T.IntegerType())]
    + [T.StructField(c, T.LongType() if c.endswith("rows") else _SUM) for c in _PAIR]
)


def key_range(key: Column, ranges: int) -> Column:
    # NULL has a range too: it leaves the hash at its seed.
    return F.pmod(F.xxhash64(key), F.lit(ranges)).cast("int")


def _hashed(rows: DataFrame, seed: int) -> Column:
    """A hash of a row in which NULL differs from every value."""
    parts = [p for c in rows.columns if c != "key_range" for p in (F.col(c).isNull(), F.col(c))]
    return F.xxhash64(F.lit(seed), *parts).cast(_SUM)


def _digests(rows: DataFrame, prefix: str) -> DataFrame:
    """``rows`` and two sums of row hashes per range: equal for equal rows in any order, with repeats counted."""
    sums = [F.sum(_hashed(rows, s)).cast(_SUM).alias(f"{prefix}_sum_{s}") for s in (1, 2)]
    return rows.groupBy("key_range").agg(F.count("*").alias(f"{prefix}_rows"), *sums)


@dataclass(frozen=True)
class RangedDiff:
    """The noteworthy part of the product diff, the ranges it was taken from, and what ``settle`` records."""

    diff: DataFrame
    opened: list[int]
    pairs: DataFrame
    entry: dict


def _rule(settings: Settings) -> str:
    """What else decides on the diff: a record made under other settings does not count."""
    used = ("product_id_bound", "language_id", "collation", "fold", "quarantine_description_only")
    return "rule:" + ",".join(f"{name}={getattr(settings, name)!r}" for name in used)


def _ranged_live(
    products: DataFrame, description: DataFrame, settings: Settings, ranges: int, short: DataFrame | None = None
) -> DataFrame:
    if settings.collation is not None:
        raise ValueError("ranges go by plain keys: set fold in place of a collation")
    live = P.live_digests(products, description, settings, short).drop(*_UNCOMPARED)
    return live.withColumn("key_range", key_range(F.col("match_key"), ranges))


def _write(live: DataFrame, root: str, entry: dict, held: dict[str, list[int]]) -> int:
    """Write ranges of the live side and publish them in place of those that ``held`` does not list any more."""
    spark, part = live.sparkSession, f"live-{uuid.uuid4().hex}"
    live = stage(live, "ranged_live")
    fields = [{"name": f.name, "type": f.dataType.simpleString()} for f in live.schema if f.name != "key_range"]
    by_range = live.repartition("key_range").sortWithinPartitions("key_range", "match_key")
    by_range.write.partitionBy("key_range").parquet(f"{root}/{part}")
    # At most one row a range.
    written = sorted(r[0] for r in live.select("key_range").distinct().collect())
    digests = _digests(live, "live")
    if entry.get("digests"):
        stay = [r for ranges in held.values() for r in ranges]
        before = spark.read.parquet(f"{root}/{entry['digests']}").where(F.col("key_range").isin(stay))
        digests = digests.unionByName(before)
    named = write_part(digests, root, "digests")
    parts = held | ({part: written} if written else {})
    fresh = {
        "ranges": entry["ranges"], "rule": entry["rule"], "digests": named, "quiet": entry.get("quiet"),
        "live": [{"part": p, "held": r} for p, r in parts.items() if r], "fields": fields,
    }
    return publish(spark, root, fresh, entry["number"])


def first_ranges(store: Store, root: str, settings: Settings, ranges: int = RANGES) -> int:
    """Lay the live side of a store out by range. ``root`` must have no published entry yet."""
    live = _ranged_live(store.products, store.products_description, settings, ranges)
    return _write(live, root, {"number": 0, "ranges": ranges, "rule": _rule(settings)}, {})


def _entry(spark: SparkSession, root: str, settings: Settings) -> dict:
    entry = read_entry(spark, root)
    if entry is None:
        raise FileNotFoundError(f"no ranges are published under {root}")
    if entry["rule"] != _rule(settings):
        raise ValueError(f"the ranges under {root} were laid out under {entry['rule']}")
    return entry


def read_ranges(spark: SparkSession, root: str, entry: dict, wanted: list[int] | None = None) -> DataFrame:
    """Live rows of the wanted ranges, by default of all; other folders are not opened."""
    names = ", ".join(f"`{f['name']}` {f['type']}" for f in entry["fields"])
    schema = T.StructType.fromDDL(f"{names}, `key_range` int")
    asked = None if wanted is None else set(wanted)
    parts = []
    for part in entry["live"]:
        held = part["held"] if asked is None else sorted(asked.intersection(part["held"]))
        if held:
            folders = [f"{root}/{part['part']}/key_range={r}" for r in held]
            parts.append(spark.read.schema(schema).option("basePath", f"{root}/{part['part']}").parquet(*folders))
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], schema)


def _code(settings: Settings) -> Column:
    return canonical_key(F.col("prod_code")) if settings.fold else F.col("prod_code")


def _key(diff: DataFrame) -> Column:
    return F.coalesce("live_match_key", "feed_match_key" if "feed_match_key" in diff.columns else "feed_products_model")


def _feed_ranges(feeds: list[DataFrame], entry: dict, settings: Settings) -> list[DataFrame]:
    return [feed.withColumn("key_range", key_range(_code(settings), entry["ranges"])) for feed in feeds]


def _loud_diff(live: DataFrame, feeds: list[DataFrame], settings: Settings) -> DataFrame:
    """``P.noteworthy`` of the product diff, with texts shuffled of loud keys only.

    A match by digests finds these: a description of which the merge could take
    another is that of a repeated code, which is noteworthy in any case. Rows are
    picked by hashes of keys; what a hash picks besides is found to be nothing
    again. The more keys there are for the bits, the more rows are picked in vain.
    """
    by_digest = merge_product_feeds(*feeds, fold=settings.fold, short=lambda text: P.digest(text, settings.fold))
    found = P.noteworthy(P.product_diff(live, by_digest, settings))
    keys = stage(found.select(F.xxhash64(_key(found)).alias("_key")), "loud_keys")
    size = max(1, min(MOST_ROWS, -(-keys.count() * BITS_OF_A_KEY // BITS)))

    def place(key: Column) -> tuple[Column, Column]:
        at = F.pmod(key, F.lit(size * BITS))
        return F.floor(at / BITS), at % BITS

    row, bit = place(F.col("_key"))
    marks = F.broadcast(keys.groupBy(row.alias("_row")).agg(F.bitmap_construct_agg(bit).alias("_bits")))

    def loud(rows: DataFrame, key: Column) -> DataFrame:
        row, bit = place(F.xxhash64(key))
        byte = F.conv(F.hex(F.substring("_bits", F.floor(bit / 8).cast("int") + 1, 1)), 16, 10).cast("int")
        return rows.join(marks, row == F.col("_row")).where(F.getbit(byte, (bit % 8).cast("int")) == 1).select(rows.columns)

    few = [loud(feed, _code(settings)) for feed in feeds]
    merged = merge_product_feeds(*few, fold=settings.fold)
    return P.noteworthy(P.product_diff(loud(live, F.col("match_key")), merged, settings))


def ranged_diff(
    spark: SparkSession, root: str, complete: DataFrame, stock: DataFrame, descriptions: DataFrame, settings: Settings
) -> RangedDiff:
    """``P.noteworthy`` of the product diff, taken only where something can come of it.

    Feeds are scanned once for their digests, a sum per range and task; only rows
    of open ranges are merged and matched, by digests first. Columns that no feed rule reads count
    as content too, so a range may be opened for nothing, never left out wrongly.
    Digests are two sums of 64-bit hashes; they tell changes, not forgeries.
    """
    entry = _entry(spark, root, settings)
    feeds = _feed_ranges([complete, stock, descriptions], entry, settings)
    tagged = [_digests(feed.withColumn("_feed", F.lit(k)), "feed") for k, feed in enumerate(feeds)]
    of_feed = reduce(DataFrame.unionByName, tagged).groupBy("key_range")
    of_feed = of_feed.agg(*[F.sum(f"feed_{c}").cast(_PAIRS[f"feed_{c}"].dataType).alias(f"feed_{c}") for c in _DIGEST])
    none = spark.createDataFrame([], T.StructType([_PAIRS[0], *[_PAIRS[c] for c in _PAIR if c.startswith("live")]]))
    of_live = spark.read.parquet(f"{root}/{entry['digests']}") if entry["digests"] else none
    zero = {c: F.coalesce(c, F.lit(0)).cast(_PAIRS[c].dataType) for c in _PAIR}
    pairs = stage(of_feed.join(of_live, "key_range", "full_outer").withColumns(zero).select(*_PAIRS.names), "pairs")
    fresh = pairs
    if entry["quiet"]:
        fresh = pairs.join(spark.read.schema(_PAIRS).parquet(f"{root}/{entry['quiet']}"), _PAIRS.names, "left_anti")
    opened = sorted(r[0] for r in fresh.select("key_range").collect())  # at most one row a range
    few = [feed.where(F.col("key_range").isin(opened)).drop("key_range") for feed in feeds]
    live = read_ranges(spark, root, entry, opened).drop("key_range")
    return RangedDiff(stage(_loud_diff(live, few, settings), "ranged_diff"), opened, pairs, entry)


def settle(
    found: RangedDiff,
    root: str,
    store: Store | None = None,
    settings: Settings | None = None,
    short: DataFrame | None = None,
) -> int:
    """Record which pairs came to nothing, and lay out anew the ranges a run has changed in ``store``.

    A range of a noteworthy row is not recorded. Where a run followed, ``store``
    is its outcome: live rows of those ranges are replaced, others stay in their
    folders. Live rows elsewhere must be unchanged: what else changes them, such
    as edits by the store's owner, needs ``first_ranges`` under a new root.
    ``short`` has digests of the texts of ``store``, if known.
    """
    spark, entry = found.pairs.sparkSession, found.entry
    loud = sorted(r[0] for r in found.diff.select(key_range(_key(found.diff), entry["ranges"]).alias("r")).distinct().collect())
    quiet = found.pairs.where(~F.col("key_range").isin(loud)) if loud else found.pairs
    entry = entry | {"quiet": write_part(quiet.coalesce(1), root, "quiet")}
    held = {p["part"]: [r for r in p["held"] if store is None or r not in set(loud)] for p in entry["live"]}
    if store is None or not loud:
        return publish(spark, root, {k: v for k, v in entry.items() if k != "number"}, entry["number"])
    live = _ranged_live(store.products, store.products_description, settings, entry["ranges"], short)
    return _write(live.where(F.col("key_range").isin(loud)), root, entry, held)
