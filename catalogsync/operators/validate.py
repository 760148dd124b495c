"""Checks that feed the issue logs. Every log row has the issue's name and two notes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalogsync.functions.compare import differs
from catalogsync.operators.merge import first_wins
from catalogsync.session import by_merge

# Names of the issues.
NAME_TOO_LONG = "Name too long"
INVALID_PARENT = "Invalid parent_id"
INACTIVE_PARENT = "Inactive parent"
MISSING_DESCRIPTION = "Missing Description"
MISSING_NAME = "Missing Name"
NON_LEAF = "Non-leaf category placement"
UNASSIGNED = "No category assigned"
DUPLICATE_KEY = "Duplicate key"
UNKNOWN_PRODUCT = "Unknown product"
REJECTED_ROW = "Rejected row"


def issue_case(found: Column, issue: str, note_1: Column | None = None, note_2: Column | None = None) -> Column:
    """The log entry of a row where ``found`` holds, else NULL."""

    def note(value: Column | None) -> Column:
        return (F.lit(None) if value is None else value).cast("string")

    entry = F.struct(F.lit(issue).alias("issue"), note(note_1).alias("note_1"), note(note_2).alias("note_2"))
    return F.when(found, entry)


def issue_rows(df: DataFrame, schema: T.StructType, cases: list[Column]) -> DataFrame:
    """One log entry for each case that a row meets, in one pass. Other columns of the log are taken from ``df``."""
    made = ("issue", "note_1", "note_2")
    own = [f.name for f in schema if f.name not in made]
    entries = df.select(*own, F.explode(F.array_compact(F.array(*cases))).alias("_e"))
    return entries.select(
        *[(F.col(f"_e.{f.name}") if f.name in made else F.col(f.name)).cast(f.dataType).alias(f.name) for f in schema]
    )


def too_long(name: Column, full: Column) -> Column:
    """A name that was cut differs from the full text."""
    return issue_case(differs(name, full), NAME_TOO_LONG, name, full)


def missing_text(text: Column, issue: str, applies: Column) -> Column:
    return issue_case(applies & (text.isNull() | (text == "")), issue)


def append_issues(log: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Extend a log; for each key the entry written first stays. Keys may hold NULL, which equals itself."""
    fresh = first_wins(new.select(*log.columns), key)
    known = by_merge(log.select(*[F.col(k).alias(f"_{k}") for k in key]))
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in key])
    return log.unionByName(fresh.join(known, same, "left_anti"))
