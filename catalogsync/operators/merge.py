"""Merging of overlapping inputs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalogsync.functions.image import image_path
from catalogsync.functions.keys import canonical_key
from catalogsync.functions.text import prefer_nonempty
from catalogsync.schemas import MONEY
from catalogsync.settings import PRODUCT_NAME_WIDTH


def first_wins(df: DataFrame, key: list[str], order: list[Column] | None = None) -> DataFrame:
    """Keep one row per key: the first by ``order``, by default by all other columns.

    Where ``order`` does not decide, any of the rows may stay. The limit on the
    rank is applied in each map task already, so copies of a hot key never meet
    in one task, and the result is partitioned and sorted by key for a join that
    follows. Columns nobody asks for are not carried along.
    """
    rest = [F.col(c) for c in df.columns if c not in key]
    if not rest:
        return df.distinct()
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*(order or rest)))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def first_wins_counted(df: DataFrame, key: list[str], order: list[Column], count: str) -> DataFrame:
    """As ``first_wins`` with ties decided by all columns, plus the number of rows each key had.

    An aggregation, which reduces hot keys before the shuffle; for narrow rows.
    """
    rest = [c for c in df.columns if c not in key]
    rank = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], *rest)
    kept = df.groupBy(*key).agg(F.min_by(F.struct(*rest), rank).alias("_row"), F.count("*").alias(count))
    return kept.select(*[F.col(c) if c in key else F.col(f"_row.{c}").alias(c) for c in df.columns], count)


def upsert(base: DataFrame, change: DataFrame, key: str) -> DataFrame:
    """Merge two change sets, each unique by key.

    Where both have the key, every column that ``change`` carries takes its
    value, NULL included; the others keep the value of ``base``.
    """
    columns = base.columns + [c for c in change.columns if c not in base.columns]
    left = base.select(F.col(key).alias("_bk"), *[F.col(c).alias(f"_b_{c}") for c in base.columns if c != key])
    right = change.select(F.col(key).alias("_ck"), *[F.col(c).alias(f"_c_{c}") for c in change.columns if c != key])

    def merged(name: str) -> Column:
        if name == key:
            return F.coalesce("_ck", "_bk").alias(name)
        if name not in change.columns:
            return F.col(f"_b_{name}").alias(name)
        if name not in base.columns:
            return F.col(f"_c_{name}").alias(name)
        return F.when(F.col("_ck").isNotNull(), F.col(f"_c_{name}")).otherwise(F.col(f"_b_{name}")).alias(name)

    return left.join(right, F.col("_bk") == F.col("_ck"), "full_outer").select(*[merged(c) for c in columns])


_VITAL_COLUMNS = ("prod_desc", "units_qty", "weight", "price", "prod_image", "cantsell")


def merge_product_feeds(
    complete: DataFrame,
    stock: DataFrame,
    descriptions: DataFrame,
    fold: bool = False,
    short: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """One row per product code out of three feeds, keyed ``products_model``.

    Stock beats complete for everything but the description; a row in
    descriptions beats the description whatever it holds; a code that only
    descriptions knows gets defaults. Codes repeated within a feed keep the
    smallest row, and ``*_rows`` tells how many there were.

    The feeds are stacked and aggregated once: one shuffle does the removal of
    repeats and the merge, with repeats reduced before it. Texts are kept in an
    aggregate of their own, so a question about vitals does not read them.

    With ``fold`` codes of one canonical key are one code: that key is the extra
    column ``match_key``, and ``products_model`` the spelling of the feed named
    first above that has it, the smallest if it has several.

    With ``short`` no text is shuffled: descriptions are taken through it in the
    scan, and the column ``text_digest`` stands for them. Of a code repeated within
    a feed it may be that of another of its rows; all other columns are the same.
    """

    code = ["prod_code", canonical_key(F.col("prod_code")).alias("match_key")] if fold else ["prod_code"]

    def tagged(feed: DataFrame, source: str) -> DataFrame:
        have = [c for c in (*_VITAL_COLUMNS, "narrative") if c in feed.columns]
        if short and "narrative" in have:
            text = F.col("narrative")
            own = prefer_nonempty(text, F.col("prod_desc")) if source == "complete" else text
            feed = feed.withColumn("narrative", short(own))
        return feed.select(*code, F.lit(source).alias("_source"), *have)

    stacked = (
        tagged(complete, "complete")
        .unionByName(tagged(stock, "stock"), allowMissingColumns=True)
        .unionByName(tagged(descriptions, "description"), allowMissingColumns=True)
    )

    def smallest(source: str, *columns: str) -> Column:
        return F.min(F.when(F.col("_source") == source, F.struct(*columns)))

    def rows(source: str) -> Column:
        return F.count(F.when(F.col("_source") == source, 1)).alias(f"{source}_rows")

    spelled = [F.min(F.when(F.col("_source") == s, F.col("prod_code"))) for s in ("complete", "stock", "description")]
    key = F.col("match_key") if fold else F.col("prod_code").alias("products_model")
    merged = stacked.groupBy(key).agg(
        *([F.coalesce(*spelled).alias("products_model")] if fold else []),
        smallest("complete", *_VITAL_COLUMNS).alias("complete"),
        smallest("complete", *_VITAL_COLUMNS, "narrative").alias("complete_text"),
        smallest("stock", *_VITAL_COLUMNS).alias("stock"),
        smallest("description", "narrative").alias("description"),
        rows("complete"),
        rows("stock"),
        rows("description"),
    )

    has_complete = F.col("complete_rows") > 0
    has_stock = F.col("stock_rows") > 0
    has_description = F.col("description_rows") > 0

    def vital(name: str, default: Column) -> Column:
        return F.when(has_stock, F.col(f"stock.{name}")).when(has_complete, F.col(f"complete.{name}")).otherwise(default)

    cantsell = vital("cantsell", F.lit(1))
    status = F.when(cantsell == 1, 0).when(cantsell.isNotNull(), 1)  # an unreadable mark says nothing
    own_text = F.col("complete_text.narrative")
    if not short:
        own_text = prefer_nonempty(own_text, F.col("complete_text.prod_desc"))
    return merged.select(
        *(["match_key"] if fold else []),
        "products_model",
        image_path(vital("prod_image", F.lit(None).cast("string"))).alias("products_image"),
        vital("price", F.lit(0)).cast(MONEY).alias("products_price"),
        vital("units_qty", F.lit(0)).cast(T.FloatType()).alias("products_quantity"),
        vital("weight", F.lit(0)).cast(T.FloatType()).alias("products_weight"),
        status.alias("products_status"),
        F.left(vital("prod_desc", F.lit("")), F.lit(PRODUCT_NAME_WIDTH)).alias("products_name"),
        F.when(has_stock, F.col("stock.prod_desc"))
        .when(has_complete, F.col("products_model"))
        .otherwise("")
        .alias("products_title"),
        F.when(has_description, F.col("description.narrative"))
        .when(has_complete, own_text)
        .alias("text_digest" if short else "products_description"),
        "complete_rows",
        "stock_rows",
        "description_rows",
    )


def description_only() -> Column:
    """Merged rows that neither the complete feed nor the stock feed has."""
    return (F.col("complete_rows") == 0) & (F.col("stock_rows") == 0)
