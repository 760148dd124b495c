"""A third of all rows on one key: the hot part is reduced early or split, and results stay whole."""

import pytest
from pyspark.sql import functions as F

from catalogsync.operators.apply import delete
from catalogsync.plans import categories as C
from catalogsync.plans import placements as L
from tests.helpers import SETTINGS

ROWS = 30_000


@pytest.fixture
def no_broadcast(spark):
    """Sort-merge joins, and partitions of some kilobytes count as large."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _hot(spark, key):
    """ROWS rows; ``key`` is 7 for a third of them and else one of 5000 values."""
    value = F.when(F.col("id") % 3 == 0, 7).otherwise(1000 + F.col("id") % 5000)
    return spark.range(0, ROWS, 1, 16).withColumn(key, value.cast("int"))


def _final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    rows = df.collect()
    return rows, df._jdf.queryExecution().executedPlan().toString()


def test_links_to_a_hot_category_are_split(spark, no_broadcast):
    feed = _hot(spark, "dept_code").select(F.md5(F.col("id").cast("string")).alias("prod_code"), "dept_code")
    categories = spark.range(0, 4000).select((F.col("id") + 1000).cast("int").alias("categories_id")).union(
        spark.range(7, 8).select(F.col("id").cast("int"))
    )
    got, plan = _final_plan(L.import_links(feed, categories, SETTINGS))
    assert "skewed" in plan
    expect = sum(1 for i in range(ROWS) if i % 3 == 0 or i % 5000 < 4000)
    assert len(got) == expect


def test_children_of_a_hot_parent_are_split(spark, no_broadcast):
    children = _hot(spark, "parent_id").select(
        (F.col("id") + 10_000).cast("int").alias("categories_id"), "parent_id",
        F.md5(F.col("id").cast("string")).alias("categories_description"), F.lit(1).alias("categories_status"),
    )
    feed = children.select("*", F.lit(1).alias("feed_rows"))
    live = children.where("false").select(
        "categories_id", F.lit("").alias("categories_image"), "parent_id",
        F.lit(None).cast("timestamp_ntz").alias("last_modified"), "categories_status", "categories_description",
    )
    got, plan = _final_plan(C.category_issues(C.category_diff(live, feed, SETTINGS)))
    assert "skewed" in plan
    # No parent exists.
    assert len(got) == ROWS and {r.issue for r in got} == {"Invalid parent_id"}


def test_repeated_links_collapse(spark):
    same = spark.range(0, ROWS).select(F.lit("hot").alias("prod_code"), F.lit(7).alias("dept_code"))
    categories = spark.range(7, 8).select(F.col("id").cast("int").alias("categories_id"))
    assert L.import_links(same, categories, SETTINGS).count() == 1


def test_deletes_on_a_hot_key(spark, no_broadcast):
    links = _hot(spark, "categories_id").select(F.col("id").alias("products_id"), "categories_id")
    gone = spark.range(7, 8).select(F.col("id").cast("int").alias("categories_id"))
    assert delete(links, gone, ["categories_id"]).count() == ROWS - ROWS // 3
