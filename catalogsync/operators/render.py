"""Patch statements as rows ``(phase, step, sort_key, statement)``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalogsync.functions.text import float_text, quoted, time_text


def literal(column: Column, kind: T.DataType) -> Column:
    """A value as it stands in a statement; NULL stays NULL."""
    if isinstance(kind, T.StringType):
        return quoted(column.cast("string"))  # whatever its collation
    if isinstance(kind, T.FloatType):
        return float_text(column)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return quoted(time_text(column))
    return column.cast("string")


def assignments(df: DataFrame, columns: dict[str, str | Column], glue: str = ",") -> Column:
    """``\\`name\\`=value`` for each target column, in order; those with NULL are left out."""
    kinds = {f.name: f.dataType for f in df.schema}

    def text(value: str | Column) -> Column:
        return literal(F.col(value), kinds[value]) if isinstance(value, str) else value

    return F.concat_ws(glue, *[F.concat(F.lit(f"`{name}`="), text(v)) for name, v in columns.items()])


def insert_statement(df: DataFrame, table: str, columns: dict[str, str | Column]) -> Column:
    return F.concat(F.lit(f"INSERT IGNORE INTO `{table}` SET "), assignments(df, columns), F.lit(";"))


def values_statement(df: DataFrame, table: str, columns: list[str]) -> Column:
    names = ",".join(f"`{c}`" for c in columns)
    kinds = {f.name: f.dataType for f in df.schema}
    values = F.concat_ws(",", *[literal(F.col(c), kinds[c]) for c in columns])
    return F.concat(F.lit(f"INSERT IGNORE INTO `{table}` ({names}) VALUES ("), values, F.lit(");"))


def update_statement(
    df: DataFrame, table: str, columns: dict[str, str | Column], where: dict[str, str | Column]
) -> Column:
    return F.concat(
        F.lit(f"UPDATE `{table}` SET "),
        assignments(df, columns),
        F.lit(" WHERE "),
        assignments(df, where, " AND "),
        F.lit(" LIMIT 1;"),
    )


def delete_statement(df: DataFrame, table: str, where: dict[str, str | Column]) -> Column:
    return F.concat(F.lit(f"DELETE FROM `{table}` WHERE "), assignments(df, where, " AND "), F.lit(";"))


def patch_rows(df: DataFrame, phase: int, sort_key: Column, statements: dict[int, Column]) -> DataFrame:
    """One row for each step's statement that is not NULL, in one pass over ``df``."""
    steps = F.array(*[F.struct(F.lit(step).alias("step"), text.alias("text")) for step, text in statements.items()])
    return (
        df.select(sort_key.cast("string").alias("sort_key"), F.explode(steps).alias("_s"))
        .where(F.col("_s.text").isNotNull())
        .select(F.lit(phase).alias("phase"), F.col("_s.step").alias("step"), "sort_key", F.col("_s.text").alias("statement"))
    )


def id_key(*columns: str) -> Column:
    """A text key that sorts like the numbers it is made of."""
    return F.concat_ws("/", *[F.lpad(F.col(c).cast("string"), 10, "0") for c in columns])


def id_list_rows(ids: DataFrame, id_column: str, table: str, setting: str, phase: int, step: int, span: int) -> DataFrame:
    """Bulk updates over id lists, one statement for each span of ids that has any.

    Ids are unique, so a list never holds more than ``span`` of them.
    """
    start = (F.floor(F.col(id_column) / span) * span).cast("bigint")
    lists = (
        ids.groupBy(start.alias("_start"))
        .agg(F.array_join(F.array_sort(F.collect_set(id_column)).cast("array<string>"), ",").alias("_ids"))
    )
    statement = F.concat(F.lit(f"UPDATE `{table}` SET {setting} WHERE `{id_column}` IN ("), F.col("_ids"), F.lit(");"))
    return patch_rows(lists, phase, id_key("_start"), {step: statement})
