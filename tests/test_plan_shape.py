"""What the plans must look like to hold at scale."""

import re

import pytest

from catalogsync.plans import products as P
from catalogsync.plans.run import diff_products
from catalogsync.sources.store import read_store, write_store
from checks.queries import registry
from checks.views import SETTINGS, views

# Replay and whole runs are built from the others and end in a scan of staged tables.
NAMES = sorted(n for n in registry() if not n.startswith(("replay_", "run_", "issues_links", "patch_links")))


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark, sf_dir):
    """Plans for inputs too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield {name: _plan(registry()[name](spark, sf_dir)) for name in NAMES}
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", NAMES)
def test_no_cross_join_no_single_task_no_python(plans, name):
    plan = plans[name]
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "SinglePartition", "Python", "InPandas", "CollectLimit"):
        assert bad not in plan, plan


@pytest.mark.parametrize("name", NAMES)
def test_only_lists_of_the_run_are_broadcast(plans, name):
    """Priority list and id offsets come from the driver, and byte ranges have a row each; nothing else is broadcast by hint."""
    from_driver = re.findall(r"Scan ExistingRDD\[(?:_part|_member)", plans[name])
    by_range = re.findall(r"BroadcastHashJoin \[file#\d+, at#\d+L\]", plans[name])
    assert plans[name].count("BroadcastHashJoin") <= len(from_driver) + len(by_range)
    assert not by_range or name == "read_feed_split"


def test_vitals_do_not_read_texts(plans):
    assert "narrative" not in plans["products_vitals"]
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plans["products_vitals"])
    assert schemas and not any("text" in s for s in schemas)


def test_repeats_are_cut_before_the_shuffle(plans):
    plan = plans["live_products"]
    assert re.search(r"Final.*Exchange.*Partial", plan.replace("\n", " "))
    assert "WindowGroupLimit" in plans["first_wins"]


def test_merge_of_three_feeds_is_one_shuffle_on_the_code(plans):
    assert plans["merge_product_feeds"].count("Exchange hashpartitioning(prod_code") == 1
    assert "partial_min" in plans["merge_product_feeds"]


def test_diff_reuses_the_partitioning_of_both_sides(plans):
    """Live rows and merged feed come partitioned by key; the full match adds no shuffle."""
    plan = plans["products_residual"]
    assert plan.count("Exchange hashpartitioning(match_key") == 1
    assert plan.count("Exchange hashpartitioning(prod_code") == 1
    assert "hashpartitioning(live_match_key" not in plan and "hashpartitioning(feed_products_model" not in plan


def test_links_collapse_before_the_shuffle(plans):
    assert re.search(r"HashAggregate.*Exchange hashpartitioning.*HashAggregate", plans["import_links"].replace("\n", " "))


def test_id_bound_and_columns_reach_the_scan(spark, sf_dir, tmp_path):
    write_store(views(spark, sf_dir).store, str(tmp_path / "v1"))
    store = read_store(spark, str(tmp_path / "v1"))
    live = P.live_products(store.products, store.products_description, SETTINGS)
    plan = _plan(live.select("products_id", "products_model", "products_price"))
    assert "LessThan(products_id,1000000000)" in plan
    assert "products_image" not in plan and "products_description:" not in plan


def test_no_live_text_is_shuffled_in_a_run(spark, sf_dir, tmp_path):
    """Without a collation the scan of the live texts ends in digests."""
    given = views(spark, sf_dir)
    write_store(given.store, str(tmp_path / "v1"))
    store = read_store(spark, str(tmp_path / "v1"))
    diff = diff_products(store, given.feed_complete, given.feed_stock, given.feed_descriptions, SETTINGS)
    logical = diff._jdf.queryExecution().optimizedPlan().toString()
    assert "live_products_description" not in logical and "sha2" in logical
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = _plan(diff)
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    scan = re.search(r"products_description:string", plan)
    assert scan and re.search(r"sha2\(cast\(products_description#\d+ as binary\), 256\)", plan)
