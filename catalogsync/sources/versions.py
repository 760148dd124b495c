"""Versions of the store as a base and the changes since, published by one entry.

A run writes, per table, the rows that its keys have anew and the keys that are
gone, so what it writes grows with what it changes. A version is read as the base
without the keys that changed, plus their last rows. The changes are folded into a
new base once there are many of them or they are large beside it.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalogsync.schemas import STORE
from catalogsync.sources.published import part_size, publish, read_entry, write_part
from catalogsync.sources.store import TABLES, Store

KEYS = {
    "categories": ["categories_id"],
    "categories_description": ["categories_id", "language_id"],
    "meta_tags_categories_description": ["categories_id", "language_id"],
    "products": ["products_id"],
    "products_description": ["products_id", "language_id"],
    "meta_tags_products_description": ["products_id", "language_id"],
    "products_to_categories": ["products_id", "categories_id"],
}

# Change files of a table that are folded into its base, and their share of its bytes from which they are.
MOST_CHANGES = 20
MOST_SHARE = 0.25


def _typed(rows: DataFrame, table: str) -> DataFrame:
    return rows.select(*[F.col(f.name).cast(f.dataType) for f in STORE[table]])


def _change_schema(table: str) -> T.StructType:
    return T.StructType([*STORE[table], T.StructField("gone", T.BooleanType()), T.StructField("version", T.IntegerType())])


def _compared(prefix: str, names: list[str], kinds: dict[str, T.DataType]) -> Column:
    """Values of a row to tell it by, with digests for long texts. No short text equals one: they are longer."""
    values = []
    for name in names:
        value = F.col(f"{prefix}{name}")
        if isinstance(kinds[name], T.StringType):
            value = F.when(F.octet_length(value) > 64, F.concat(F.lit("="), F.sha2(value, 256))).otherwise(value)
        values.append(value.alias(name))
    return F.struct(F.lit(True), *values)


def table_changes(before: DataFrame, after: DataFrame, table: str) -> DataFrame:
    """Rows of ``after`` that are new or differ, and the keys that it lacks, marked ``gone``. Both are unique by key.

    Of ``before``, long texts are only compared, so digests from its scan stand for them.
    """
    key = KEYS[table]
    rest, kinds = [f.name for f in STORE[table] if f.name not in key], {f.name: f.dataType for f in STORE[table]}
    old = _typed(before, table).select(*[F.col(k).alias(f"_{k}") for k in key], _compared("", rest, kinds).alias("_old"))
    new = _typed(after, table).select(*key, F.struct(F.lit(True), *rest).alias("_new"))
    same = reduce(Column.__and__, [F.col(k) == F.col(f"_{k}") for k in key])
    known = F.when(F.col("_new").isNotNull(), _compared("_new.", rest, kinds))
    found = new.join(old, same, "full_outer").where(~known.eqNullSafe(F.col("_old")))
    columns = [F.coalesce(k, f"_{k}").alias(k) if k in key else F.col(f"_new.{k}").alias(k) for k in STORE[table].names]
    return found.select(*columns, F.col("_new").isNull().alias("gone"))


def last_changes(changes: DataFrame, table: str) -> DataFrame:
    """Of several changes to a key the one of the last version."""
    key = KEYS[table]
    rest = [c for c in changes.columns if c not in key and c != "version"]
    last = changes.groupBy(*key).agg(F.max_by(F.struct(*rest), "version").alias("_last"))
    return last.select(*[F.col(c) if c in key else F.col(f"_last.{c}").alias(c) for c in changes.columns if c != "version"])


def _read(spark: SparkSession, root: str, entry: dict, table: str) -> DataFrame:
    state = entry[table]
    base = spark.read.schema(STORE[table]).parquet(f"{root}/{state['base']}") if state["base"] else spark.createDataFrame([], STORE[table])
    if not state["changes"]:
        return base
    changes = last_changes(spark.read.schema(_change_schema(table)).parquet(*[f"{root}/{c}" for c in state["changes"]]), table)
    kept = base.join(changes.select(*KEYS[table]), KEYS[table], "left_anti").select(*STORE[table].names)
    return kept.unionByName(changes.where("not gone").select(*STORE[table].names))


def _entry(spark: SparkSession, root: str, number: int | None) -> dict:
    entry = read_entry(spark, root, number)
    if entry is None:
        raise FileNotFoundError(f"no version of a store was published under {root}")
    return entry


def read_version(spark: SparkSession, root: str, number: int | None = None) -> Store:
    """A published version, by default the newest. Where none was published it is an error, whatever files there are."""
    entry = _entry(spark, root, number)
    return Store(**{table: _read(spark, root, entry, table) for table in TABLES})


def changes_of(spark: SparkSession, root: str, table: str, number: int | None = None) -> DataFrame:
    """What a version changed in a table: the rows it wrote and, marked ``gone``, the keys it took away."""
    entry = _entry(spark, root, number)
    names = [c for c in entry[table]["written"] if c]
    schema = _change_schema(table)
    rows = spark.read.schema(schema).parquet(*[f"{root}/{c}" for c in names]) if names else spark.createDataFrame([], schema)
    return rows.drop("version")


def first_version(store: Store, root: str) -> int:
    """Publish a whole store as the base of all later versions."""
    spark = store.products.sparkSession
    entry = {}
    for table in TABLES:
        entry[table] = {"base": write_part(_typed(getattr(store, table), table), root, table), "changes": [], "written": []}
    return publish(spark, root, entry, 0)


def next_version(store: Store, root: str, most_changes: int = MOST_CHANGES, most_share: float = MOST_SHARE) -> int:
    """Publish what ``store`` changes over the newest version; returns the new number, or the old one for no change.

    Tables that a run leaves alone are not written. A run that dies before the end
    leaves the newest version as it was.
    """
    spark = store.products.sparkSession
    entry = _entry(spark, root, None)
    number = entry["number"] + 1
    found = {t: table_changes(_read(spark, root, entry, t), getattr(store, t), t).withColumn("version", F.lit(number)) for t in TABLES}
    # The parts are the only copy of the changes; no entry names them yet. Tables do not depend on each other.
    with ThreadPoolExecutor(max_workers=len(TABLES)) as pool:
        written = pool.map(lambda t: write_part(found[t].select(*_change_schema(t).names), root, f"{t}-changes"), TABLES)
        parts = dict(zip(TABLES, written))
    out, changed = {}, False
    for table in TABLES:
        state, part = entry[table], parts[table]
        changes = [*state["changes"], *([part] if part else [])]
        changed |= part is not None
        out[table] = {"base": state["base"], "changes": changes, "written": [part] if part else []}
        if changes and _is_large(spark, root, state["base"], changes, most_changes, most_share):
            base = write_part(_read(spark, root, out, table), root, table)
            out[table] = {"base": base, "changes": [], "written": out[table]["written"]}
    return publish(spark, root, out, entry["number"]) if changed else entry["number"]


def _is_large(spark: SparkSession, root: str, base: str | None, changes: list[str], most: int, share: float) -> bool:
    if len(changes) > most:
        return True
    size = part_size(spark, root, base)[1] if base else 0
    return sum(part_size(spark, root, c)[1] for c in changes) > max(share * size, 1 << 20)
