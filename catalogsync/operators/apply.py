"""Copy-on-write changes: each takes a table and returns its next version."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalogsync.operators.merge import first_wins


def insert_ignore(
    target: DataFrame,
    new: DataFrame,
    key: list[str],
    defaults: dict[str, Column] | None = None,
    unique: bool = False,
    before: DataFrame | None = None,
) -> DataFrame:
    """Add rows whose key is not there yet; columns that ``new`` lacks take a default or NULL.

    Of new rows with one key the first stays, unless ``unique`` says that there are none.
    ``before`` is the table that ``target`` was made from by changes that keep
    its keys: looking keys up there saves making those changes twice.
    """
    return target.unionByName(missing_rows(target, new, key, defaults, unique, before))


def missing_rows(
    target: DataFrame,
    new: DataFrame,
    key: list[str],
    defaults: dict[str, Column] | None = None,
    unique: bool = False,
    before: DataFrame | None = None,
) -> DataFrame:
    """The rows that ``insert_ignore`` adds, laid out as the table."""
    defaults = defaults or {}
    filled = new.select(
        *[
            (F.col(f.name) if f.name in new.columns else defaults.get(f.name, F.lit(None))).cast(f.dataType).alias(f.name)
            for f in target.schema
        ]
    )
    single = filled if unique else first_wins(filled, key)
    taken = (target if before is None else before).select(*key)
    return single.join(taken, key, "left_anti")


def _matched(target: DataFrame, change: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    renamed = change.select(
        *[F.col(k).alias(f"_k_{k}") for k in key], *[F.col(c).alias(f"_n_{c}") for c in columns], F.lit(True).alias("_hit")
    )
    on = [F.col(k) == F.col(f"_k_{k}") for k in key]
    return target.join(renamed, on, "left")


def update(target: DataFrame, change: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """Overwrite columns of matching rows, with NULL too. ``change`` is unique by key."""
    joined = _matched(target, change, key, columns)
    return joined.select(
        *[
            F.when(F.col("_hit"), F.col(f"_n_{f.name}")).otherwise(F.col(f.name)).cast(f.dataType).alias(f.name)
            if f.name in columns
            else F.col(f.name)
            for f in target.schema
        ]
    )


def sparse_update(target: DataFrame, change: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """Overwrite columns of matching rows where the change has a value. ``change`` is unique by key."""
    joined = _matched(target, change, key, columns)
    return joined.select(
        *[
            F.coalesce(F.col(f"_n_{f.name}"), F.col(f.name)).cast(f.dataType).alias(f.name)
            if f.name in columns
            else F.col(f.name)
            for f in target.schema
        ]
    )


def delete(target: DataFrame, gone: DataFrame, key: list[str]) -> DataFrame:
    return target.join(gone.select(*key), key, "left_anti")


def override(target: DataFrame, where: Column, column: str, value: object) -> DataFrame:
    """Set a column on all rows that meet a condition."""
    kind = target.schema[column].dataType
    return target.withColumn(column, F.when(where, F.lit(value)).otherwise(F.col(column)).cast(kind))
