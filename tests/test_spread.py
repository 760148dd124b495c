"""Tasks over very many narrow rows, and texts that are moved once."""

import hashlib
import re

import pytest

from catalogsync import session
from catalogsync.plans import placements as L
from catalogsync.sources.patch import numbered_statements
from catalogsync.sources.versions import table_changes
from checks.queries import registry

from helpers import SETTINGS, rows


@pytest.fixture
def small_tasks(monkeypatch):
    monkeypatch.setattr(session, "ROWS_OF_A_TASK", 100)


def _tasks(df):
    return df.rdd.getNumPartitions()


def test_many_rows_are_dealt_over_tasks_that_are_not_merged(spark, small_tasks):
    links = spark.range(5000).selectExpr("cast(id as int) products_id", "cast(id % 7 as int) categories_id")
    feed = links.selectExpr("cast(products_id as string) prod_code", "categories_id dept_code")
    categories = spark.range(7).selectExpr("cast(id as int) categories_id")
    assert _tasks(L.import_links(feed, categories, SETTINGS, 5000)) == 50
    assert _tasks(L.changed_links(links, links.selectExpr("*", "false is_new").where("products_id > 3"), 5000)) == 100
    none = links.limit(0)
    after = L.apply_links(links, links.where("products_id < 10"), none, none, 5000)
    assert after.count() == 4990 and _tasks(after) >= 50


def test_few_rows_are_left_to_spark(spark):
    rows = spark.range(10)
    assert session.spread(rows, 10, "id") is rows


def test_dealt_rows_lie_in_no_fewer_partitions_than_shuffles_have(spark, small_tasks):
    """A join would move them once more."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        assert _tasks(session.spread(spark.range(2000), 2000, "id")) == 40
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_many_statements_are_numbered_in_tasks_that_are_not_merged(spark, small_tasks):
    few = spark.range(10)
    assert _tasks(session.spread_by_range(few, 10, "id")) == 1
    lines = spark.range(2000).selectExpr("3 as phase", "2 as step", "lpad(id, 6, '0') as sort_key", "concat('s', id) as statement")
    numbered = numbered_statements(lines)
    assert len(numbered.inputFiles()) >= 15
    assert rows(numbered, "number", "statement") == [(k + 1, f"s{k}") for k in range(2000)]


def test_links_of_the_views_are_dealt_by_rows(spark, sf_dir, small_tasks):
    plan = registry()["import_links"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\(pk#\d+L?, s_suppkey#\d+L?, \d+\), REPARTITION_BY_NUM", plan)


def test_stored_texts_are_compared_by_digests(spark):
    long = "x" * 100
    digest = "=" + hashlib.sha256(long.encode()).hexdigest()
    names = ["products_id", "language_id", "products_name", "products_description"]
    before = spark.createDataFrame([(1, 1, "a", long), (2, 1, "b", long), (3, 1, None, long), (4, 1, "d", digest), (5, 1, "e", long)], names)
    after = spark.createDataFrame([(1, 1, "a", long), (2, 1, "b", long + "y"), (3, 1, "", long), (4, 1, "d", long), (6, 1, None, None)], names)
    found = table_changes(before, after, "products_description")
    assert "sha2(products_description" in re.sub(r"#\d+|cast\(| as \w+\)", "", found._jdf.queryExecution().optimizedPlan().toString())
    assert rows(found, *names, "gone") == sorted(
        [(2, 1, "b", long + "y", False), (3, 1, "", long, False), (4, 1, "d", long, False), (5, 1, None, None, True), (6, 1, None, None, False)]
    )


@pytest.mark.parametrize("name", ["apply_product_meta", "apply_product_text"])
def test_texts_are_joined_once(spark, sf_dir, name):
    """The documents are read for the staged texts alone."""
    assert not any("documents.parquet" in path for path in registry()[name](spark, sf_dir).inputFiles())
