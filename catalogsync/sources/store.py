"""The store's tables and the control categories a run relies on."""

from __future__ import annotations

from dataclasses import dataclass, fields, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogsync.operators.apply import insert_ignore
from catalogsync.schemas import STORE
from catalogsync.settings import LANGUAGE_ID


@dataclass(frozen=True)
class Store:
    """One version of the tables that a run reads and changes."""

    categories: DataFrame
    categories_description: DataFrame
    meta_tags_categories_description: DataFrame
    products: DataFrame
    products_description: DataFrame
    meta_tags_products_description: DataFrame
    products_to_categories: DataFrame

    def with_(self, **tables: DataFrame) -> Store:
        return replace(self, **tables)


TABLES = tuple(f.name for f in fields(Store))


def empty_store(spark: SparkSession) -> Store:
    return Store(**{t: spark.createDataFrame([], STORE[t]) for t in TABLES})


def read_live(spark: SparkSession, table: str, root: str) -> DataFrame:
    """One store table as parquet under ``root``."""
    return spark.read.schema(STORE[table]).parquet(f"{root}/{table}")


def read_store(spark: SparkSession, root: str) -> Store:
    return Store(**{t: read_live(spark, t, root) for t in TABLES})


def write_store(store: Store, root: str) -> None:
    """Write a new version of all tables. ``root`` must be a new folder: a version is never changed."""
    for table in TABLES:
        rows = getattr(store, table)
        rows.select(*[F.col(f.name).cast(f.dataType) for f in STORE[table]]).write.parquet(f"{root}/{table}")


def control_category_id(description: DataFrame, name: str, language_id: int = LANGUAGE_ID) -> int | None:
    """Look up a control category by its name: a scalar of the run."""
    row = (
        description.where((F.col("language_id") == language_id) & (F.col("categories_name") == name))
        .agg(F.min("categories_id"))
        .first()
    )
    return row[0]


def seed_control_categories(
    store: Store,
    imports: tuple[int, str, str],
    issues: tuple[int, str, str],
    language_id: int = LANGUAGE_ID,
) -> Store:
    """Add the two control categories ``(id, name, description)`` where they are not there yet.

    They are inactive top categories. Their ids have to be at or above the id
    bound, where no run touches them.
    """
    spark = store.categories.sparkSession
    rows = spark.createDataFrame([imports, issues], "categories_id int, categories_name string, text string")
    language = F.lit(language_id).alias("language_id")
    return store.with_(
        categories=insert_ignore(
            store.categories,
            rows.select("categories_id", F.lit(0).alias("parent_id"), F.lit(0).alias("categories_status")),
            ["categories_id"],
        ),
        categories_description=insert_ignore(
            store.categories_description,
            rows.select("categories_id", language, "categories_name", F.col("text").alias("categories_description")),
            ["categories_id", "language_id"],
        ),
        meta_tags_categories_description=insert_ignore(
            store.meta_tags_categories_description,
            rows.select(
                "categories_id",
                language,
                F.col("categories_name").alias("metatags_title"),
                F.col("text").alias("metatags_keywords"),
                F.col("text").alias("metatags_description"),
            ),
            ["categories_id", "language_id"],
        ),
    )
