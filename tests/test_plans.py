from dataclasses import replace
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from catalogsync.operators.merge import merge_product_feeds
from catalogsync.plans import categories as C
from catalogsync.plans import placements as L
from catalogsync.plans import products as P
from catalogsync.plans import run as R
from catalogsync.sources.snapshots import archive_feed
from catalogsync.sources.store import empty_store
from tests.helpers import IMPORTS, SETTINGS, feed, one, rows, store

EDITED = datetime(2019, 2, 1)


# categories ----------------------------------------------------------------


def _categories(*given):
    """Store tables for categories: (id, parent, text, status, edited)."""
    return dict(
        categories=[
            dict(categories_id=i, parent_id=p, categories_status=s, last_modified=EDITED if e else None)
            for i, p, _, s, e in given
        ],
        categories_description=[
            dict(categories_id=i, categories_name=t[:32], categories_description=t) for i, _, t, _, _ in given
        ],
        meta_tags_categories_description=[dict(categories_id=i, metatags_title=t) for i, _, t, _, _ in given],
    )


def _departments(spark, *given):
    return feed(
        spark, "departments",
        *[dict(dept_code=i, parent_id=p, dept_name=t, dept_show=s, dept_deep=1) for i, p, t, s in given],
    )


def _category_diff(spark, live, given, settings=SETTINGS):
    base = store(spark, **_categories(*live))
    snapshot = C.live_categories(base.categories, base.categories_description, settings)
    return base, C.category_diff(snapshot, C.import_categories(_departments(spark, *given)), settings)


def test_live_categories_language_and_bound(spark):
    base = store(
        spark,
        categories=[dict(categories_id=i) for i in (1, 2, 3, 100001)],
        categories_description=[
            dict(categories_id=1, categories_description="one"),
            dict(categories_id=1, language_id=2, categories_description="eins"),
            dict(categories_id=2, language_id=2, categories_description="zwei"),
        ],
    )
    live = C.live_categories(base.categories, base.categories_description, SETTINGS)
    assert rows(live, "categories_id", "categories_description") == [(1, "one"), (3, "")]
    kept = C.live_categories(
        base.categories, base.categories_description, replace(SETTINGS, keep_other_language_rows=True)
    )
    assert rows(kept, "categories_id", "categories_description") == [(1, "one"), (2, ""), (3, "")]


def test_category_change_sets(spark):
    long = "a name that is longer than thirty-two characters"
    _, diff = _category_diff(
        spark,
        [(1, 0, "same", 1, False), (2, 1, "old", 1, False), (3, 1, "old", 1, True), (4, 1, "gone", 1, False)],
        [(1, 0, "same", 1), (2, 1, "new", 0), (3, 2, "new", 0), (5, 1, long, 0), (-1, 0, "sentinel", 1)],
    )
    assert rows(C.unchanged_categories(diff), "categories_id") == [(1,)]
    assert rows(C.new_categories(diff), "categories_id", "categories_name") == [(5, long[:32])]
    assert rows(C.dropped_categories(diff), "categories_id") == [(4,)]
    # The owner's edit stops the rename only.
    assert rows(C.renamed_categories(diff), "categories_id", "categories_name") == [(2, "new")]
    assert rows(C.reparented_categories(diff), "categories_id", "parent_id") == [(3, 2)]
    assert rows(C.category_status(diff), "categories_id", "categories_status") == [(2, 0), (3, 0), (4, 0)]


def test_category_issues(spark):
    _, diff = _category_diff(
        spark,
        [(1, 0, "top", 1, False), (2, 777, "stray", 1, False), (3, 0, "gone", 1, False), (4, 3, "child", 1, False),
         (6, 0, "off", 0, False), (8, 0, "goes off", 1, False), (9, 8, "moves", 1, False)],
        [(1, 0, "top", 1), (2, 777, "stray", 1), (4, 3, "child", 1), (5, 888, "new stray", 1), (6, 0, "off", 0),
         (7, 6, "under unchanged", 1), (8, 0, "goes off", 0), (9, 8, "moved", 1), (10, 8, "new", 1),
         (10, 8, "new again", 1)],
    )
    found = {(r.categories_id, r.issue, r.note_1) for r in C.category_issues(diff).collect()}
    assert found == {
        (2, "Invalid parent_id", "777"), (4, "Invalid parent_id", "3"), (5, "Invalid parent_id", "888"),
        # Parent and child both changed; the parent of 7 is inactive but unchanged and not reported.
        (9, "Inactive parent", "8"), (10, "Inactive parent", "8"), (10, "Duplicate key", "2"),
    }


def test_category_tables_and_patch(spark):
    live = [(1, 0, "top", 1, False), (2, 0, 'a "b"', 1, False), (29, 0, "fixed", 1, False)]
    base, diff = _category_diff(spark, live, [(1, 2, "top", 1), (2, 0, "new \\ name", 1), (29, 0, "fixed", 1),
                                              (5, 1, "fresh", 0)])
    after = C.apply_categories(base, diff, SETTINGS)
    assert rows(after.categories, "categories_id", "parent_id", "categories_status") == [
        (1, 2, 1), (2, 0, 1), (5, 1, 1), (29, 0, 0)
    ]
    assert one(after.categories, "categories_id", 5).date_added == SETTINGS.add_date
    fixed = C.apply_categories(base, diff, replace(SETTINGS, insert_status=True))
    assert one(fixed.categories, "categories_id", 5).categories_status == 0
    assert one(after.categories_description, "categories_id", 2).categories_name == "new \\ name"
    assert one(after.meta_tags_categories_description, "categories_id", 5).metatags_title == "fresh"
    patch = [r.statement for r in C.category_patch(diff, SETTINGS).orderBy("phase", "step", "sort_key").collect()]
    assert patch == [
        "INSERT IGNORE INTO `categories` SET `categories_id`=5,`parent_id`=1,`date_added`=\"2019-03-13 21:13:08\";",
        "INSERT IGNORE INTO `categories_description` SET `categories_id`=5,`categories_name`=\"fresh\","
        "`categories_description`=\"fresh\";",
        "INSERT IGNORE INTO `meta_tags_categories_description` SET `categories_id`=5,`metatags_title`=\"fresh\","
        "`metatags_keywords`=\"fresh\",`metatags_description`=\"fresh\";",
        "UPDATE `categories` SET `parent_id`=2 WHERE `categories_id`=1 LIMIT 1;",
        "UPDATE `categories_description` SET `categories_name`=\"new \\\\ name\","
        "`categories_description`=\"new \\\\ name\" WHERE `categories_id`=2 AND `language_id`=1 LIMIT 1;",
        "UPDATE `meta_tags_categories_description` SET `metatags_title`=\"new \\\\ name\","
        "`metatags_keywords`=\"new \\\\ name\",`metatags_description`=\"new \\\\ name\" WHERE `categories_id`=2 "
        "AND `language_id`=1 LIMIT 1;",
        "UPDATE `categories` SET `categories_status`=0 WHERE `categories_id` IN (29);",
    ]


@pytest.mark.parametrize("collation,renamed", [(None, [(1,), (2,)]), ("UTF8_LCASE", [(2,)]), ("UTF8_LCASE_RTRIM", [])])
def test_rename_follows_the_collation(spark, collation, renamed):
    settings = replace(SETTINGS, collation=collation)
    _, diff = _category_diff(
        spark, [(1, 0, "Box", 1, False), (2, 0, "Bag", 1, False)], [(1, 0, "BOX", 1), (2, 0, "Bag ", 1)], settings
    )
    assert rows(C.renamed_categories(diff), "categories_id") == renamed


# products ------------------------------------------------------------------


def _products(*given):
    """Store tables for products; each a dict of columns plus name, text and edited."""
    products, texts, metas = [], [], []
    for g in given:
        g = dict(g)
        name, text, edited = g.pop("name", "n"), g.pop("text", "t"), g.pop("edited", False)
        products.append({**g, "products_last_modified": EDITED if edited else None})
        texts.append(dict(products_id=g["products_id"], products_name=name, products_description=text))
        metas.append(dict(products_id=g["products_id"], metatags_title=name, metatags_keywords=text))
    return dict(products=products, products_description=texts, meta_tags_products_description=metas)


def _product(pid, model, **more):
    return dict(products_id=pid, products_model=model, **more)


def _stock(code, qty=1, **more):
    return dict(prod_code=code, prod_desc=more.pop("name", "n"), units_qty=qty, **more)


def _product_diff(spark, live, stock=(), descriptions=(), complete=(), settings=SETTINGS):
    base = store(spark, **_products(*live))
    merged = merge_product_feeds(
        feed(spark, "complete", *complete), feed(spark, "stockinfo", *stock), feed(spark, "descriptions", *descriptions)
    )
    snapshot = P.live_products(base.products, base.products_description, settings)
    return base, P.product_diff(snapshot, merged, settings)


def test_live_products_first_model_wins_and_missing_models_stay(spark):
    base = store(spark, **_products(
        _product(2, "a"), _product(1, "a"), _product(3, None), _product(4, None), _product(100001, "own")
    ))
    live = P.live_products(base.products, base.products_description, SETTINGS)
    assert rows(live, "products_id", "products_model") == [(1, "a"), (3, None), (4, None)]


def test_product_status(spark):
    _, diff = _product_diff(
        spark,
        [_product(1, "sold out"), _product(2, "cannot sell"), _product(3, "back", products_status=0),
         _product(4, "still out", products_status=0), _product(5, "gone"), _product(6, "gone off", products_status=0),
         _product(7, "fine"), _product(8, None)],
        stock=[_stock("sold out", 0), _stock("cannot sell", 5, cantsell=1), _stock("back", 3), _stock("still out", 0),
               _stock("fine"), _stock("new out", 0), _stock("new", 2)],
    )
    assert rows(P.inactive_products(diff), "products_id") == [(1,), (2,), (5,), (8,)]
    assert rows(P.dropped_products(diff), "products_id") == [(5,), (8,)]
    assert rows(P.active_products(diff), "products_id") == [(3,)]
    assert rows(P.new_products(diff), "products_model", "products_status") == [("new", 1), ("new out", 0)]


def test_vitals_are_sparse_and_ignore_edits(spark):
    base, diff = _product_diff(
        spark,
        [_product(1, "a", products_quantity=2, products_price=5, products_weight=1, edited=True), _product(2, "b",
         products_quantity=1)],
        stock=[_stock("a", 2, price=6.5, weight=1), _stock("b", 1)],
    )
    vitals = P.vitals(diff).collect()
    assert [(v.products_id, v.products_quantity, v.products_weight, float(v.products_price)) for v in vitals] == [
        (1, None, None, 6.5)
    ]
    assert [r.statement for r in P.vitals_patch(diff).collect()] == [
        "UPDATE `products` SET `products_price`=6.5000,`products_price_sorter`=6.5000 WHERE `products_id`=1 LIMIT 1;"
    ]
    new = P.with_ids(P.new_products(diff), base.products, SETTINGS)
    after = one(P.apply_products(base, diff, new, SETTINGS).products, "products_id", 1)
    assert (float(after.products_price), float(after.products_price_sorter), after.products_quantity) == (6.5, 6.5, 2)


def test_quantity_change_sets_the_sorter_to_the_live_price(spark):
    base, diff = _product_diff(
        spark, [_product(1, "a", products_quantity=2, products_price=5, products_price_sorter=4)],
        stock=[_stock("a", 3, price=5)],
    )
    new = P.with_ids(P.new_products(diff), base.products, SETTINGS)
    after = one(P.apply_products(base, diff, new, SETTINGS).products, "products_id", 1)
    assert (float(after.products_price_sorter), after.products_quantity) == (5.0, 3.0)


def test_info_edits_and_missing_text(spark):
    base, diff = _product_diff(
        spark,
        [_product(1, "both", name="old", text="old"), _product(2, "edited", name="old", text="old", edited=True),
         _product(3, "text", name="n", text="old"), _product(4, "unknown", text="kept"), _product(5, "same")],
        stock=[_stock("both", name="new"), _stock("edited", name="new"), _stock("text"), _stock("unknown"),
               _stock("same")],
        descriptions=[dict(prod_code=c, narrative="new") for c in ("both", "edited", "text")]
        + [dict(prod_code="same", narrative="t")],
    )
    assert rows(P.info(diff), "products_id", "products_label", "products_title", "products_narrative") == [
        (1, "new", "new", "new"), (3, None, None, "new")
    ]
    assert rows(P.residual_products(diff), "products_id") == [(1,), (2,), (3,), (4,)]
    issues = P.product_issues(diff, SETTINGS)
    # No text in the feed is no change, but it is reported.
    assert rows(issues, "products_model", "issue") == [("unknown", "Missing Description")]
    new = P.with_ids(P.new_products(diff), base.products, SETTINGS)
    after = P.apply_products(base, diff, new, SETTINGS)
    assert rows(after.products_description, "products_id", "products_name", "products_description") == [
        (1, "new", "new"), (2, "old", "old"), (3, "n", "new"), (4, "n", "kept"), (5, "n", "t")
    ]
    assert rows(after.meta_tags_products_description, "products_id", "metatags_title", "metatags_keywords") == [
        (1, "new", "new"), (2, "old", "old"), (3, "n", "new"), (4, "n", "kept"), (5, "n", "t")
    ]


def test_rows_without_consequences_are_left_out(spark):
    same = dict(products_quantity=1, products_weight=0, products_price=0)
    base, diff = _product_diff(
        spark,
        [_product(1, "same", **same), _product(2, "off", products_status=0), _product(3, "gone"),
         _product(4, "price", **same), _product(5, "twice", **same), _product(6, "switch", products_quantity=1,
         products_status=0), _product(7, "text", **same), _product(8, "no text", **same)],
        stock=[_stock("same"), _stock("price", price=1), _stock("twice"), _stock("twice"), _stock("switch"),
               _stock("text"), _stock("no text"), _stock("new")],
        descriptions=[dict(prod_code=c, narrative="t") for c in ("same", "price", "twice", "switch")]
        + [dict(prod_code="text", narrative="other")],
    )
    kept = P.noteworthy(diff)
    models = {r.live_products_model or r.feed_products_model for r in kept.collect()}
    assert models == {"gone", "price", "twice", "switch", "text", "no text", "new"}
    for change_set in (P.vitals, P.info, P.inactive_products, P.active_products, P.new_products, P.residual_products):
        assert rows(change_set(kept), *change_set(diff).columns) == rows(change_set(diff), *change_set(diff).columns)
    whole, part = P.product_issues(diff, SETTINGS), P.product_issues(kept, SETTINGS)
    assert rows(part, *whole.columns) == rows(whole, *whole.columns)


def test_description_only_products(spark):
    live = [_product(1, "d", products_quantity=4, products_price=2, name="old")]
    given = dict(descriptions=[dict(prod_code="d", narrative="t")])
    _, diff = _product_diff(spark, live, **given)
    vital = P.vitals(diff).first()
    assert (vital.products_quantity, float(vital.products_price)) == (0.0, 0.0)
    assert rows(P.inactive_products(diff), "products_id") == [(1,)]
    assert rows(P.product_issues(diff, SETTINGS), "issue") == [("Missing Name",)]
    _, kept = _product_diff(spark, live, settings=replace(SETTINGS, quarantine_description_only=True), **given)
    assert P.vitals(kept).count() == 0 and rows(P.dropped_products(kept), "products_id") == [(1,)]


def test_product_issues_on_new_rows(spark):
    _, diff = _product_diff(
        spark, [], complete=[dict(prod_code="c", prod_desc="name"), dict(prod_code="same", prod_desc="same")],
        stock=[_stock("long", name="x" * 70), _stock("twice"), _stock("twice", 2)],
    )
    # A product that only the complete feed has carries its code as title.
    assert rows(P.product_issues(diff, SETTINGS), "products_model", "issue") == [
        ("c", "Name too long"), ("long", "Name too long"), ("twice", "Duplicate key")
    ]
    checked = P.product_issues(diff, replace(SETTINGS, check_new_text=True)).where("issue = 'Missing Description'")
    assert rows(checked, "products_model") == [("c",), ("long",), ("same",), ("twice",)]


def test_new_products_get_ids_and_statements(spark):
    base, diff = _product_diff(
        spark, [_product(7, "live")],
        stock=[_stock("live"), _stock("B", 2, price=1, prod_image="Bb.jpg"), _stock("A", 0)],
        descriptions=[dict(prod_code="B", narrative='say "x"')],
    )
    new = P.with_ids(P.new_products(diff), base.products, SETTINGS)
    assert rows(new, "products_model", "products_id", "master_categories_id") == [("A", 8, IMPORTS), ("B", 9, IMPORTS)]
    got = [r.statement for r in P.new_products_patch(new, SETTINGS).orderBy("step", "sort_key").collect()]
    assert got[1] == (
        "INSERT IGNORE INTO `products` SET `products_id`=9,`products_quantity`=2,`products_model`=\"B\","
        "`products_image`=\"bb/bb.jpg\",`products_price`=1.0000,`products_date_added`=\"2019-03-13 21:13:08\","
        "`products_date_available`=\"2019-03-14 08:00:00\",`products_weight`=0,`products_status`=1,"
        "`manufacturers_id`=1,`products_price_sorter`=1.0000,`master_categories_id`=100001;"
    )
    # A missing image or text leaves its column out.
    assert "`products_image`" not in got[0] and "`products_description`=\"" not in got[2]
    assert got[3].endswith("`products_description`=\"say \\\"x\\\"\";")


def test_case_and_trailing_blanks_in_codes(spark):
    live, stock = [_product(1, "A6 ")], [_stock("a6")]
    _, exact = _product_diff(spark, live, stock)
    assert P.new_products(exact).count() == 1
    settings = replace(SETTINGS, collation="UTF8_LCASE_RTRIM")
    base = store(spark, **_products(*live))
    feeds = (feed(spark, "complete"), feed(spark, "stockinfo", *stock), feed(spark, "descriptions"))
    phase = R.run_products(base, R.stage(R.diff_products(base, *feeds, settings), "diff"), settings)
    assert phase.new.count() == 0
    assert rows(phase.store.products, "products_id", "products_quantity") == [(1, 1.0)]
    assert phase.patch.count() > 0
    links = feed(spark, "product_department", *_links(("A6", 1), ("a6  ", 1)))
    categories = store(spark, categories=[dict(categories_id=1)]).categories
    resolved = L.resolve_links(L.import_links(links, categories, settings), phase.live, phase.new)
    assert rows(resolved, "categories_id", "products_id") == [(1, 1)]


def _folded(spark):
    """A store and feeds whose codes and texts differ in case, accents and trailing blanks only, but for b."""
    live = [
        {**_product(1, "Café "), "name": "Größe", "text": "Blau"},
        {**_product(2, "b"), "name": "old", "text": "t"},
    ]
    stock = [_stock("CAFE", name="GROSE  "), _stock("café", name="grosE"), _stock("B ", name="new")]
    return store(spark, **_products(*live)), (
        feed(spark, "complete"), feed(spark, "stockinfo", *stock), feed(spark, "descriptions", dict(prod_code="cafè", narrative="BLÄU"))
    )


def test_codes_and_texts_fold_as_in_the_database(spark):
    settings = replace(SETTINGS, fold=True)
    base, feeds = _folded(spark)
    diff = R.stage(R.diff_products(base, *feeds, settings), "diff")
    assert P.new_products(diff).count() == 0 and P.dropped_products(diff).count() == 0
    # Three spellings of one code are one product: its text is known, and the code is logged as repeated.
    assert rows(P.renamed_products(diff), "products_id") == [(2,)]
    assert rows(P.redescribed_products(diff).where("products_id = 1"), "products_id") == []
    assert ("CAFE", "Duplicate key") in rows(P.product_issues(diff, settings), "products_model", "issue")
    # The store's own spelling stays.
    phase = R.run_products(base, diff, settings)
    assert rows(phase.store.products, "products_id", "products_model") == [(1, "Café "), (2, "b")]
    links = feed(spark, "product_department", *_links(("CAFÉ", 1), ("cafe  ", 1), ("ü", 1)))
    categories = store(spark, categories=[dict(categories_id=1)]).categories
    resolved = L.resolve_links(L.import_links(links, categories, settings), phase.live, phase.new, fold=True)
    assert rows(resolved, "products_model", "categories_id", "products_id") == [("CAFÉ", 1, 1), ("ü", 1, None)]


def test_category_names_fold(spark):
    settings = replace(SETTINGS, fold=True)
    base, diff = _category_diff(
        spark, [(1, 0, "Möbel", 1, False), (2, 0, "Bag", 1, False)], [(1, 0, "MOBEL ", 1), (2, 0, "Bags", 1)], settings
    )
    assert rows(C.renamed_categories(diff), "categories_id", "categories_description") == [(2, "Bags")]
    assert rows(C.unchanged_categories(diff), "categories_id") == [(1,)]


def test_folded_match_keeps_plain_keys(spark):
    """No collated key: aggregates by hash, one shuffle a side, and the match adds none."""
    settings = replace(SETTINGS, fold=True)
    base, feeds = _folded(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        diff = R.diff_products(base, *feeds, settings)
        plan = diff._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "collat" not in plan.lower() and plan.count("Exchange hashpartitioning(match_key") == 2
    assert "hashpartitioning(feed_match_key" not in plan and "hashpartitioning(live_match_key" not in plan


# placements ----------------------------------------------------------------


def _placement_store(spark):
    tables = _products(_product(1, "p1", master_categories_id=56), _product(2, "p2", master_categories_id=56),
                       _product(3, "p3", master_categories_id=IMPORTS))
    tables |= _categories(
        (10, 0, "parent", 1, False), (56, 10, "leaf", 1, False), (57, 10, "leaf", 1, False),
        (234, 10, "leaf", 1, False), (58, 10, "leaf", 1, False),
    )
    tables["products_to_categories"] = [
        dict(products_id=p, categories_id=c) for p, c in [(1, 56), (1, 57), (2, 56), (2, 57), (3, IMPORTS), (3, 58)]
    ]
    return store(spark, **tables)


def _links(*given):
    return [dict(prod_code=p, dept_code=c) for p, c in given]


def test_placements(spark):
    base = _placement_store(spark)
    live = P.live_products(base.products, base.products_description, SETTINGS).select("products_id", "products_model")
    new = spark.createDataFrame([("n1", 4), ("n2", 5)], "products_model string, products_id int")
    with_new = base.with_(
        products=base.products.unionByName(
            store(spark, **_products(_product(4, "n1", master_categories_id=IMPORTS),
                                     _product(5, "n2", master_categories_id=IMPORTS))).products
        ),
        products_description=base.products_description.unionByName(
            store(spark, **_products(_product(4, "n1", name="first"), _product(5, "n2", name="second")))
            .products_description
        ),
    )
    log = R.empty_issues(spark).placements.unionByName(
        spark.createDataFrame(
            [(10, 2, "Non-leaf category placement", "p2", None, None)], R.schemas.PLACEMENT_ISSUES
        )
    )
    given = feed(spark, "product_department", *_links(
        ("p1", 56), ("p1", 58), ("p1", 10), ("p1", 999), ("p2", 56), ("n1", 234), ("n1", 56), ("n1", 10),
        ("nobody", 56), ("n1", 56), ("p3", 58),
    ))
    after, patch, issues = R.run_placements(
        with_new, given, live, new, base.products_to_categories, log, SETTINGS
    )
    assert rows(after.products_to_categories, "products_id", "categories_id") == [
        # p1 loses 57 and gains the leaf 58, not the parent; p2 keeps 57, excused by the log.
        (1, 56), (1, 58), (2, 56), (2, 57), (3, 58), (3, 100001),
        # New products may sit on a parent, and are linked to the import category.
        (4, 10), (4, 56), (4, 234), (4, 100001), (5, 100001),
    ]
    assert rows(after.products, "products_id", "master_categories_id") == [
        (1, 56), (2, 56), (3, 58), (4, 56), (5, IMPORTS)
    ]
    assert rows(issues, "categories_id", "products_id", "issue", "products_model", "note_1") == [
        (10, 4, "Non-leaf category placement", "n1", None),
        (56, 0, "Unknown product", "nobody", None),
        (100001, 5, "No category assigned", "n2", "second"),
    ]
    got = [r.statement for r in patch.orderBy("phase", "step", "sort_key").collect()]
    assert got[0] == "DELETE FROM `products_to_categories` WHERE `products_id`=1 AND `categories_id`=57;"
    assert got[1] == "INSERT IGNORE INTO `products_to_categories` (`products_id`,`categories_id`) VALUES (1,58);"
    assert got[2] == "INSERT IGNORE INTO `products_to_categories` SET `products_id`=4,`categories_id`=10;"
    assert got[-2:] == [
        "UPDATE `products` SET `master_categories_id`=58 WHERE `products_id`=3 LIMIT 1;",
        "UPDATE `products` SET `master_categories_id`=56 WHERE `products_id`=4 LIMIT 1;",
    ]


# whole runs ----------------------------------------------------------------


def _feeds(spark, departments=(), stock=(), descriptions=(), complete=(), links=()):
    return dict(
        departments=_departments(spark, *departments),
        complete=feed(spark, "complete", *complete),
        stockinfo=feed(spark, "stockinfo", *stock),
        descriptions=feed(spark, "descriptions", *descriptions),
        product_department=feed(spark, "product_department", *_links(*links)),
    )


_DAY_1 = dict(
    departments=[(1, 0, "top", 1), (2, 1, "leaf", 1), (56, 1, "wanted", 1)],
    complete=[dict(prod_code="a", prod_desc="n")],
    stock=[_stock("a", 2, price=3), _stock("b", 1), _stock("c", 0)],
    descriptions=[dict(prod_code="a", narrative="about a")],
    links=[("a", 2), ("a", 56), ("b", 2), ("x", 2)],
)
_DAY_2 = dict(
    departments=[(1, 0, "top", 1), (2, 1, "leaf renamed", 0), (7, 2, "deeper", 1)],
    stock=[_stock("a", 5, price=4, name="n2"), _stock("c", 3), _stock("d", 1)],
    descriptions=[dict(prod_code="a", narrative="more about a"), dict(prod_code="d", narrative="d")],
    links=[("a", 7), ("d", 7), ("c", 2)],
)


def test_run_then_rerun_changes_nothing(spark):
    settings = replace(SETTINGS, insert_status=True, always_inactive=(), check_new_text=True)
    feeds = _feeds(spark, **_DAY_1)
    first = R.run(empty_store(spark), feeds, R.empty_issues(spark), settings)
    assert first.patch.count() > 0
    again = R.run(R.stage_store(first.store), feeds, first.issues, settings)
    assert [r.statement for r in again.patch.collect()] == []
    for log in ("categories", "products", "placements"):
        before, after = getattr(first.issues, log), getattr(again.issues, log)
        assert before.count() == after.count()


def test_skipped_runs(spark):
    nothing = spark.createDataFrame([], "name string")
    changed = spark.createDataFrame([("stockinfo",)], "name string")
    feeds, log = _feeds(spark, **_DAY_1), R.empty_issues(spark)
    base = empty_store(spark)
    assert R.run_if_changed(nothing, base, feeds, log, SETTINGS) is None
    short = {k: v for k, v in feeds.items() if k != "stockinfo"}
    assert R.run_if_changed(changed, base, short, log, SETTINGS) is None
    assert R.run_if_changed(changed, base, feeds, log, SETTINGS) is not None


def test_store_rows_are_never_touched(spark):
    own = store(
        spark,
        **(_products(_product(100001, "a", products_quantity=9, name="own", text="own"))
           | _categories((100005, 0, "own category", 1, False))
           | dict(products_to_categories=[dict(products_id=100001, categories_id=100005)])),
    )
    after = R.run(own, _feeds(spark, **_DAY_1), R.empty_issues(spark), SETTINGS).store
    for table, key in (("products", "products_id"), ("products_description", "products_id"),
                       ("categories", "categories_id"), ("products_to_categories", "products_id")):
        before, now = (getattr(s, table).where(F.col(key) >= 100001) for s in (own, after))
        assert rows(now, *before.columns) == rows(before, *before.columns), table
    ids = [r[0] for r in after.products.where("products_id < 100001").select("products_id").collect()]
    assert sorted(ids) == [1, 2, 3]


def test_replay_ends_where_one_run_on_the_last_day_does(spark, tmp_path):
    root = str(tmp_path)
    days = [date(2019, 3, 13), date(2019, 3, 14)]
    for day, given in zip(days, (_DAY_1, _DAY_2)):
        for name, df in _feeds(spark, **given).items():
            archive_feed(df.withColumn("snapshot_date", F.lit(day)), name, root)
    # On the last day one feed brings nothing of its own: the one before counts.
    archive_feed(
        feed(spark, "stockinfo", *_DAY_2["stock"]).withColumn("snapshot_date", F.lit(date(2019, 3, 15))), "stockinfo",
        root,
    )
    days.append(date(2019, 3, 15))
    kept = []
    replayed, _ = R.replay(
        empty_store(spark), days, lambda d: R.feeds_as_of(spark, root, d), R.empty_issues(spark), SETTINGS,
        lambda day, result: kept.append((day, result.patch.count())),
    )
    assert [k[0] for k in kept] == days and kept[0][1] > 0
    once = R.run(empty_store(spark), R.feeds_as_of(spark, root, days[-1]), R.empty_issues(spark), SETTINGS).store
    vital = ["products_model", "products_price", "products_quantity", "products_weight", "products_status"]
    last = replayed.products.join(once.products.select("products_model"), "products_model", "left_semi")
    assert rows(last, *vital) == rows(once.products, *vital)
    first = one(replayed.products, "products_model", "a")
    assert first.products_date_added == R.REPLAY_BASE_DATE
    assert first.products_date_available == datetime(2019, 3, 13, 21, 13, 8)
    # Sold no longer, so inactive; never removed.
    assert one(replayed.products, "products_model", "b").products_status == 0


def test_a_replay_writes_of_texts_what_the_days_change(spark, tmp_path):
    own = _products(_product(1, "a", name="n", text="t"), _product(2, "e", name="e", text="stays"))
    start = store(spark, **own)
    told = [dict(prod_code="a", narrative="again"), dict(prod_code="c", narrative="c told")]
    days = {date(2019, 3, 13): _feeds(spark, **_DAY_1), date(2019, 3, 14): _feeds(spark, **(_DAY_2 | dict(descriptions=told)))}
    written = set()
    replayed, _ = R.replay(
        start, days, days.get, R.empty_issues(spark), SETTINGS, lambda day, result: written.update(R.staged_paths())
    )
    chained, log = start, R.empty_issues(spark)
    for day, feeds in days.items():
        dated = replace(SETTINGS, add_date=R.REPLAY_BASE_DATE, new_date=R.replay_time(day))
        result = R.run(chained, feeds, log, dated)
        chained, log = R.stage_store(result.store), result.issues
    for table in R.TABLES:
        expected = getattr(chained, table)
        assert rows(getattr(replayed, table), *expected.columns) == rows(expected, *expected.columns), table
    assert {"again", "c told", "stays"} <= {r[0] for r in replayed.products_description.select("products_description").collect()}
    assert not any(path.endswith("products_description") for path in written)


def test_days_without_all_feeds_are_skipped(spark, tmp_path):
    feeds = _feeds(spark, **_DAY_1)
    day = date(2019, 3, 13)
    archive_feed(feeds["stockinfo"].withColumn("snapshot_date", F.lit(day)), "stockinfo", str(tmp_path))
    final, _ = R.replay(
        empty_store(spark), [day], lambda d: R.feeds_as_of(spark, str(tmp_path), d), R.empty_issues(spark), SETTINGS
    )
    assert final.products.count() == 0
