"""Change predicates and collation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def differs(new: Column, old: Column) -> Column:
    """True when both are known and unequal; NULL on either side is no change."""
    return F.coalesce(new != old, F.lit(False))


def same(new: Column, old: Column) -> Column:
    """True when both are known and equal."""
    return F.coalesce(new == old, F.lit(False))


def changed_to(new: Column, old: Column) -> Column:
    """The new value, or NULL where it equals the old one."""
    return F.nullif(new, old)


def in_stock(quantity: Column) -> Column:
    return quantity > 0


def with_collation(df: DataFrame, collation: str | None, columns: list[str] | None = None) -> DataFrame:
    """Give text columns (all by default) a collation, so that joins and compares follow it."""
    if collation is None:
        return df
    return df.select(
        *[
            F.collate(F.col(f.name), collation).alias(f.name)
            if isinstance(f.dataType, T.StringType) and (columns is None or f.name in columns)
            else F.col(f.name)
            for f in df.schema
        ]
    )
