"""What grows with the store does not pass through the driver as a broadcast table."""

from concurrent.futures import ThreadPoolExecutor

import pytest

from catalogsync import session
from catalogsync.operators.validate import NON_LEAF, append_issues
from catalogsync.plans import placements as L
from catalogsync.plans import products as P
from catalogsync.plans import run as R
from catalogsync.schemas import PLACEMENT_ISSUES, STORE
from catalogsync.sources.store import TABLES, Store

from helpers import IMPORTS, SETTINGS, rows, store

MANY = 150_000


def _stored(spark, path, columns, schema):
    """Many rows whose file is small, so Spark takes them for few; columns not given are NULL."""
    columns = [f"cast({columns.get(f.name, 'null')} as {f.dataType.simpleString()}) {f.name}" for f in schema]
    spark.range(0, MANY, 1, 2).selectExpr(*columns).write.parquet(path)
    return spark.read.schema(schema).parquet(path)


@pytest.fixture(scope="module")
def big(spark, tmp_path_factory):
    """A store of many products, and its placement log."""
    root, given = str(tmp_path_factory.mktemp("big")), store(spark)
    told = dict(products_id="id", language_id="1", products_name="'n'", products_description="'t'")
    columns = dict(
        products=dict(products_id="id", products_model="concat('P', id)", products_status="1", master_categories_id=str(IMPORTS)),
        products_description=told,
        meta_tags_products_description=dict(products_id="id", language_id="1", metatags_title="'n'"),
        products_to_categories=dict(products_id="id", categories_id="2"),
    )
    tables = {t: _stored(spark, f"{root}/{t}", columns[t], STORE[t]) if t in columns else getattr(given, t) for t in TABLES}
    entries = dict(categories_id="2", products_id="id", issue=f"'{NON_LEAF}'", products_model="concat('P', id)")
    return Store(**tables), _stored(spark, f"{root}/log", entries, PLACEMENT_ISSUES)


def _broadcasts(df):
    """Broadcasts in a plan, but for the priority list, which the driver has."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("BroadcastExchange") - plan.count("Scan ExistingRDD[_member")


def _diff(spark):
    kinds = ", ".join(f"{side}_{f.name} {f.dataType.simpleString()}" for side in ("live", "feed") for f in STORE["products"])
    texts = ", ".join(f"{side}_{c} string" for side in ("live", "feed") for c in ("products_name", "products_title", "products_description"))
    return spark.createDataFrame([], f"in_live boolean, in_feed boolean, {kinds}, {texts}, change_kind string")


def _new(products):
    """New products of a run, numbered."""
    columns = ["model", "image", "price", "quantity", "weight", "status"]
    texts = [f"'{c}' products_{c}" for c in ("name", "title", "description")]
    return products.selectExpr("products_id", *[f"products_{c}" for c in columns], *texts, "master_categories_id")


def test_tables_of_the_store_are_not_broadcast(spark, big):
    given, log = big
    diff = session.by_merge(_diff(spark))
    new = _new(given.products.where("products_id < 3"))
    links = given.products_to_categories
    changed = links.selectExpr("*", "1 in_live", "0 in_feed")
    texts = P.text_changes(given, diff, new, SETTINGS)
    found = {
        "live": P.live_digests(given.products, given.products_description, SETTINGS),
        "products": P.apply_to_products(given.products, diff, new, SETTINGS),
        "described": texts.described,
        "meta": texts.meta,
        "description table": P.apply_to_description(given.products_description, diff, new, SETTINGS),
        "meta table": P.apply_to_meta(given.meta_tags_products_description, diff, new, SETTINGS),
        "dropped": L.dropped_links(changed, log),
        "links": L.apply_links(links, changed, links, links),
        "waiting": L.assigned_masters(given.products, links, SETTINGS),
        "masters": L.apply_masters(given.products, links.selectExpr("products_id", "categories_id master_categories_id"), MANY),
        "log": append_issues(log, log, L.ISSUE_KEY),
    }
    assert {name: n for name, df in found.items() if (n := _broadcasts(df))} == {}


def test_few_changes_are_left_to_spark(spark, big):
    """So a large table of texts is not moved for them."""
    few = big[0].products.where("products_id < 3")
    assert session.by_merge(few, 3) is few
    told = big[0].products_description
    assert _broadcasts(told.join(session.by_merge(few, 3).select("products_id"), "products_id", "left_semi")) == 1


def test_a_staged_diff_of_many_rows_is_merged(spark, monkeypatch):
    """A run counts its changes; with many of them its next tables need no broadcast, and hold the same rows."""
    given = store(spark, products=[dict(products_id=1, products_model="a", products_price=1), dict(products_id=2, products_model="b", products_price=1)],
                  products_description=[dict(products_id=1, products_name="n", products_description="t")])
    side = dict(model="a", price="3", quantity="2", weight="1", status="1")
    values = dict(in_live="true", in_feed="true", change_kind="'changed'", live_products_id="1", feed_products_name="'new'", live_products_name="'n'",
                  feed_products_description="'t'", live_products_description="'t'", **{f"{s}_products_{c}": f"'{v}'" for s in ("feed", "live") for c, v in side.items()})
    values["live_products_price"] = "1"
    schema = _diff(spark).schema
    diff = session.stage(spark.range(1).selectExpr(*[f"cast({values.get(f.name, 'null')} as {f.dataType.simpleString()}) {f.name}" for f in schema]), "diff")
    none = _new(given.products.where("false"))
    expected = ["products_id", "products_name"]
    for most, merged in ((100, False), (0, True)):
        monkeypatch.setattr(session, "ROWS_OF_A_BROADCAST", most)
        held = session.by_merge(diff, diff.count())
        texts = P.text_changes(given, held, none, SETTINGS)
        after, texts, _ = R.stage_over(given, given, texts)
        assert (_broadcasts(after.products_description) == 0) == merged
        assert rows(after.products_description, *expected) == [(1, "new")]


def test_a_replay_knows_only_of_its_own_staged_tables(spark):
    """What callers or other threads stage meanwhile is not deleted by it."""
    outer = session.stage(spark.range(3), "outer")
    before = session.staged_paths()
    with session.own_staging():
        assert session.staged_paths() == set()
        session.stage_all({"a": spark.range(1), "b": spark.range(2)})
        assert len(mine := session.staged_paths()) == 2
        with ThreadPoolExecutor(1) as pool:
            other = pool.submit(session.stage, spark.range(5), "other").result()
        assert session.staged_paths() == mine
        session.release(spark, before | {next(iter(mine))})
    assert outer.count() == 3 and other.count() == 5
    assert session.staged_paths() >= before and len(session.staged_paths() & mine) == 1
