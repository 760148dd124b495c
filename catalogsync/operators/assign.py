"""Surrogate ids and choice by priority."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogsync.session import spread_by_range, stage

_ROW_BITS = 33  # monotonically_increasing_id keeps the row number of a partition in these


def allocate_ids(
    new: DataFrame, key: str, id_column: str, start: int, bound: int | None = None, rows: int = 0
) -> DataFrame:
    """Number rows ``start + 1, start + 2, …`` in the order of their unique key; none may reach ``bound``.

    Rows are range-partitioned by key and staged with their place in their
    partition; only the row count of each partition goes through the driver.
    No task sees more than one range, and since the places are stored, the ids
    do not depend on how a range is recomputed. ``rows`` says how many there are,
    where they may be very many.
    """
    placed = stage(
        spread_by_range(new.drop(id_column), rows, key)
        .sortWithinPartitions(key)
        .withColumn("_place", F.monotonically_increasing_id()),
        "placed",
    )
    partition = F.shiftright("_place", _ROW_BITS)
    counts = {r["p"]: r["n"] for r in placed.groupBy(partition.alias("p")).agg(F.count("*").alias("n")).collect()}
    offsets, total = [], start
    for p in sorted(counts):
        offsets.append((p, total))
        total += counts[p]
    if bound is not None and total >= bound:
        raise ValueError(f"{total - start} new ids after {start} do not fit below {bound}")
    if not offsets:
        return placed.drop("_place").withColumn(id_column, F.lit(None).cast("int"))
    # One row per partition: bounded by spark.sql.shuffle.partitions.
    lookup = new.sparkSession.createDataFrame(offsets, "_part int, _offset long")
    row = F.col("_place") - F.shiftleft(partition.cast("long"), _ROW_BITS)
    return (
        placed.withColumn("_part", partition.cast("int"))
        .join(F.broadcast(lookup), "_part")
        .withColumn(id_column, (F.col("_offset") + row + 1).cast("int"))
        .drop("_part", "_offset", "_place")
    )


def max_id(df: DataFrame, id_column: str, bound: int) -> int:
    """The largest id below the bound, 0 for none."""
    return df.where(F.col(id_column) < bound).agg(F.max(id_column)).first()[0] or 0


def assign_by_priority(links: DataFrame, owner: str, member: str, priority: tuple[int, ...], excluded: int) -> DataFrame:
    """For each owner its best linked member: the first in the priority list, else the smallest other.

    The list is a parameter of the run and travels as literals of a broadcast
    table. Both picks are partial aggregates, so an owner with many links is
    reduced before the shuffle.
    """
    others = links.where(F.col(member) != excluded)
    ranks = links.sparkSession.createDataFrame(
        [(m, rank) for rank, m in enumerate(dict.fromkeys(priority))], "_member int, _rank int"
    )
    ranked = others.join(F.broadcast(ranks), F.col(member) == F.col("_member"), "left")
    return ranked.groupBy(owner).agg(
        F.coalesce(F.min_by(member, "_rank"), F.min(member)).alias(member),
    )
