"""Comparison of a feed with the live snapshot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalogsync.functions.compare import same
from catalogsync.session import spread


def snapshot_diff(
    live: DataFrame, feed: DataFrame, live_key: str, feed_key: str | None = None, compare: list[str] | None = None
) -> DataFrame:
    """Match two snapshots, each unique by key, in one full outer join.

    The result has ``live_<column>`` and ``feed_<column>`` for all columns of
    either side, the presence flags ``in_live`` and ``in_feed``, and
    ``change_kind``: new, dropped, unchanged (all of ``compare`` known and
    equal on both sides) or changed. All change sets are filters over it, so a
    run joins the snapshots once, and a single change set lets the optimizer
    narrow the join to the rows it needs.
    """
    feed_key = feed_key or live_key
    left = live.select(F.lit(True).alias("in_live"), *[F.col(c).alias(f"live_{c}") for c in live.columns])
    right = feed.select(F.lit(True).alias("in_feed"), *[F.col(c).alias(f"feed_{c}") for c in feed.columns])
    joined = left.join(right, F.col(f"live_{live_key}") == F.col(f"feed_{feed_key}"), "full_outer")
    return joined.withColumn("change_kind", change_kind(compare or []))


def change_kind(compare: list[str]) -> Column:
    equal = F.lit(True)
    for name in compare:
        equal = equal & same(F.col(f"feed_{name}"), F.col(f"live_{name}"))
    return (
        F.when(F.col("in_live").isNull(), "new")
        .when(F.col("in_feed").isNull(), "dropped")
        .when(equal, "unchanged")
        .otherwise("changed")
    )


def only_in_feed() -> Column:
    return F.col("in_feed").isNotNull() & F.col("in_live").isNull()


def only_in_live() -> Column:
    return F.col("in_live").isNotNull() & F.col("in_feed").isNull()


def in_both() -> Column:
    return F.col("in_live").isNotNull() & F.col("in_feed").isNotNull()


def link_diff(live: DataFrame, feed: DataFrame, key: list[str], rows: int = 0) -> DataFrame:
    """Match two sets of links by all their columns: ``key`` with both presence flags.

    Links are small and have nothing to compare, so the sets are stacked and
    aggregated: repeats collapse before the one shuffle, whichever link is hot.
    Of very many links, ``rows`` on either side, a task gets no more than it can hold.
    """
    stacked = live.select(*key, F.lit(1).alias("in_live"), F.lit(0).alias("in_feed")).unionByName(
        feed.select(*key, F.lit(0).alias("in_live"), F.lit(1).alias("in_feed"))
    )
    return spread(stacked, 2 * rows, key[0]).groupBy(*key).agg(F.max("in_live").alias("in_live"), F.max("in_feed").alias("in_feed"))
