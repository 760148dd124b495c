"""Tables laid out by key: written in buckets, so that a match with a feed moves only the feed."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalogsync.plans import products as P
from catalogsync.settings import Settings
from catalogsync.sources.store import Store


def write_by_key(rows: DataFrame, path: str, key: str, buckets: int) -> None:
    """Write a table in ``buckets`` files by the hash of ``key``, each sorted by it. ``path`` must be new.

    ``buckets`` belongs to the layout: at least as many as a shuffle of the feed
    has partitions, so that Spark keeps them, and few enough that a bucket is
    worth a task.
    """
    name = f"laid_{uuid.uuid4().hex}"
    writer = rows.repartition(buckets, key).write.format("parquet").option("path", path)
    writer.bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    # The catalogue is only how Spark writes buckets; the files are the table.
    rows.sparkSession.sql(f"DROP TABLE {name}")


def read_by_key(spark: SparkSession, path: str, schema: T.StructType, key: str, buckets: int) -> DataFrame:
    """A table that ``write_by_key`` wrote with this schema, key and number of buckets."""
    name = f"laid_{uuid.uuid4().hex}"
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    place = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({fields}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{place}'")
    rows = spark.table(name)
    rows.schema  # resolved: from here on the files are what it refers to
    spark.sql(f"DROP TABLE {name}")
    return rows


def write_live(store: Store, path: str, buckets: int, settings: Settings) -> T.StructType:
    """The live side of the product diff, by the key it is matched by, with digests for texts. Returns its schema."""
    live = P.live_digests(store.products, store.products_description, settings)
    write_by_key(live, path, "match_key", buckets)
    return live.schema


def update_live(live: DataFrame, store: Store, changed: DataFrame, path: str, buckets: int, settings: Settings) -> None:
    """The next layout after a run: ``live`` without the products in ``changed`` (``products_id``), plus their rows in ``store``.

    ``changed`` lists the new products and those that a run has changed; runs
    take no product away and change no model. Rows that stay are read and written
    by bucket; only changed ones are moved.
    """
    ids = changed.select("products_id").distinct()
    kept = live.join(ids, "products_id", "left_anti").select(*live.columns)
    touched = store.products.join(ids, "products_id", "left_semi")
    text = store.products_description.join(ids, "products_id", "left_semi")
    fresh = P.live_digests(touched, text, settings).select(*live.columns)
    # Of a model that two products have, the smaller id stays, as everywhere.
    both = kept.unionByName(fresh).groupBy("match_key").agg(F.min_by(F.struct(*live.columns), "products_id").alias("_row")).select("_row.*")
    write_by_key(both, path, "match_key", buckets)
