"""Key ranges that are known to be quiet are left out, and nothing else is."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from catalogsync.plans import products as P
from catalogsync.plans import run as R
from catalogsync.sources import published, ranges
from tests.helpers import SETTINGS, feed, rows, store

N = 16
SHOWN = ("change_kind", "live_products_id", "feed_products_model", "feed_products_price")


def _store(spark):
    ids = range(1, 200)
    return store(
        spark,
        products=[dict(products_id=k, products_model=f"M{k}" if k != 7 else None, products_price=k, products_quantity=1) for k in ids],
        products_description=[dict(products_id=k, products_name=f"name {k}", products_description=f"text {k}") for k in ids],
    )


def _feeds(spark, prices=(), more=()):
    given = {k: k for k in range(1, 200)} | dict(prices)
    stock = [dict(prod_code=f"M{k}", prod_desc=f"name {k}", units_qty=1, price=p, cantsell=0) for k, p in given.items()]
    text = [dict(prod_code=f"M{k}", narrative=f"text {k}") for k in given]
    return feed(spark, "complete"), feed(spark, "stockinfo", *stock, *more), feed(spark, "descriptions", *text)


def _first_day(spark, root, settings=SETTINGS):
    base = _store(spark)
    ranges.first_ranges(base, root, settings, N)
    found = ranges.ranged_diff(spark, root, *_feeds(spark), settings)
    phase = R.run_products(base, found.diff, settings)
    after = R.stage_store(phase.store)
    ranges.settle(found, root, after, settings)
    return found, after


def _same_as_whole(spark, found, after, feeds, settings=SETTINGS):
    whole = R.diff_products(after, *feeds, settings)
    assert rows(found.diff, *SHOWN) == rows(whole, *SHOWN)


def test_one_changed_product_opens_one_range(spark, tmp_path):
    root = str(tmp_path / "r")
    first, after = _first_day(spark, root)
    assert len(first.opened) == N
    again = ranges.ranged_diff(spark, root, *_feeds(spark), SETTINGS)
    # Only where something came of the first day is compared again: the product without a model, and the new one.
    assert 1 <= len(again.opened) <= 2 and again.diff.count() == 0
    ranges.settle(again, root)
    feeds = _feeds(spark, {50: 51})
    one = ranges.ranged_diff(spark, root, *feeds, SETTINGS)
    assert len(one.opened) == 1
    _same_as_whole(spark, one, after, feeds)
    assert rows(P.vitals(one.diff), "products_id", "products_price") == [(50, 51)]
    opened = ranges.read_ranges(spark, root, one.entry, one.opened)
    assert len({f.split("key_range=")[1].split("/")[0] for f in opened.inputFiles()}) == 1


def test_order_and_files_do_not_matter_repeats_and_nulls_do(spark, tmp_path):
    root = str(tmp_path / "r")
    _first_day(spark, root)
    ranges.settle(ranges.ranged_diff(spark, root, *_feeds(spark), SETTINGS), root)
    complete, stock, text = _feeds(spark)
    shuffled = stock.orderBy(F.desc("prod_code")).repartition(3)
    assert ranges.ranged_diff(spark, root, complete, shuffled, text, SETTINGS).opened == []
    twice = stock.unionByName(stock.where("prod_code = 'M9'"))
    found = ranges.ranged_diff(spark, root, complete, twice, text, SETTINGS)
    assert len(found.opened) == 1 and found.diff.where("feed_stock_rows = 2").count() == 1
    for column in ("prod_image", "prod_desc"):
        nulled = stock.withColumn(column, F.when(F.col("prod_code") == "M9", None).otherwise(F.coalesce(column, F.lit("")) if column == "prod_desc" else F.lit("")))
        assert ranges.ranged_diff(spark, root, complete, nulled, text, SETTINGS).opened
    nobody = ranges.ranged_diff(spark, root, complete, stock.withColumn("prod_code", F.lit(None).cast("string")), text, SETTINGS)
    assert len(nobody.opened) == N


def test_days_follow_each_other(spark, tmp_path):
    """Three days of changes: each outcome equals that of the whole diff, and the ranges equal a fresh layout."""
    root = str(tmp_path / "r")
    _, after = _first_day(spark, root)
    extra = dict(prod_code="NEW", prod_desc="new", units_qty=3, price=9, cantsell=0)
    for feeds in (_feeds(spark, {3: 4, 90: 91}), _feeds(spark, {3: 4}, [extra]), _feeds(spark, {3: 5, 120: 1}, [extra])):
        found = ranges.ranged_diff(spark, root, *feeds, SETTINGS)
        assert 0 < len(found.opened) < N
        _same_as_whole(spark, found, after, feeds)
        after = R.stage_store(R.run_products(after, found.diff, SETTINGS).store)
        ranges.settle(found, root, after, SETTINGS)
    kept = ranges.read_ranges(spark, root, published.read_entry(spark, root))
    fresh = ranges._ranged_live(after.products, after.products_description, SETTINGS, N)
    assert rows(kept, *fresh.columns) == rows(fresh, *fresh.columns)


def test_a_run_takes_the_ranged_diff(spark, tmp_path):
    root, base = str(tmp_path / "r"), _store(spark)
    complete, stock, text = _feeds(spark, {5: 8})
    feeds = dict(complete=complete, stockinfo=stock, descriptions=text, departments=feed(spark, "departments"),
                 product_department=feed(spark, "product_department"))
    ranges.first_ranges(base, root, SETTINGS, N)
    found = ranges.ranged_diff(spark, root, complete, stock, text, SETTINGS)
    got = R.run(base, feeds, R.empty_issues(spark), SETTINGS, product_diff=found.diff)
    want = R.run(base, feeds, R.empty_issues(spark), SETTINGS)
    assert rows(got.store.products, "products_id", "products_price") == rows(want.store.products, "products_id", "products_price")
    assert rows(got.patch, *want.patch.columns) == rows(want.patch, *want.patch.columns)


def test_other_settings_missing_entry_two_writers_and_empty_tables(spark, tmp_path):
    root = str(tmp_path / "r")
    with pytest.raises(FileNotFoundError):
        ranges.ranged_diff(spark, root, *_feeds(spark), SETTINGS)
    found, after = _first_day(spark, root)
    with pytest.raises(ValueError):
        ranges.ranged_diff(spark, root, *_feeds(spark), replace(SETTINGS, fold=True))
    with pytest.raises(published.Conflict):
        ranges.settle(found, root, after, SETTINGS)
    with pytest.raises(ValueError):
        ranges.first_ranges(after, str(tmp_path / "c"), replace(SETTINGS, collation="UTF8_LCASE"))
    empty, nothing = str(tmp_path / "e"), (feed(spark, "complete"), feed(spark, "stockinfo"), feed(spark, "descriptions"))
    ranges.first_ranges(store(spark), empty, SETTINGS, N)
    found = ranges.ranged_diff(spark, empty, *nothing, SETTINGS)
    assert found.opened == [] and found.diff.count() == 0
    ranges.settle(found, empty, store(spark), SETTINGS)


def test_folded_codes_share_a_range(spark, tmp_path):
    root, settings = str(tmp_path / "r"), replace(SETTINGS, fold=True)
    _, after = _first_day(spark, root, settings)
    complete, stock, text = _feeds(spark)
    lower = stock.withColumn("prod_code", F.concat(F.lower("prod_code"), F.lit(" ")))
    found = ranges.ranged_diff(spark, root, complete, lower, text, settings)
    _same_as_whole(spark, found, after, (complete, lower, text), settings)
    assert found.diff.count() == 0


def _odd_feeds(spark):
    """Codes that come twice with other texts, a code that is unknown, empty and unknown texts and names."""
    complete, stock, text = _feeds(spark, {50: 51})
    codes = [f"M{k}" for k in range(30, 60)]
    named = [dict(prod_code=c, prod_desc=f"name {c}" if c != "M31" else None, narrative=("", None, "own text")[k % 3], units_qty=1, price=k)
             for k, c in enumerate([*codes, None, "ONLY", "EMPTY"])]
    again = [dict(named[k], narrative=t) for k, t in ((3, "other text"), (4, ""), (5, "aaa"), (6, None))]
    complete = complete.unionByName(feed(spark, "complete", *named, *again))
    told = [dict(prod_code="M9", narrative="another text"), dict(prod_code=None, narrative="nobody's"), dict(prod_code="M12", narrative=None)]
    return complete, stock.where("prod_code <> 'M30'"), text.where("prod_code not in ('M32', 'M33', 'M34', 'M35')").unionByName(
        feed(spark, "descriptions", *told))


@pytest.mark.parametrize("bits", [4, ranges.BITS])
@pytest.mark.parametrize("fold", [False, True])
def test_matching_by_digests_first_changes_nothing(spark, tmp_path, monkeypatch, bits, fold):
    """All columns of the diff, texts too, also where there are too few bits to tell keys apart."""
    monkeypatch.setattr(ranges, "BITS", bits)
    monkeypatch.setattr(ranges, "MOST_ROWS", 2 if bits == 4 else ranges.MOST_ROWS)
    root, settings = str(tmp_path / "r"), replace(SETTINGS, fold=fold)
    _, after = _first_day(spark, root, settings)
    feeds = _odd_feeds(spark)
    found = ranges.ranged_diff(spark, root, *feeds, settings)
    whole = R.diff_products(after, *feeds, settings)
    shown = [c for c in whole.columns if c in found.diff.columns]
    assert {"feed_products_description", "feed_products_title", "feed_complete_rows", "live_text_digest"} <= set(shown)
    assert found.diff.count() > 10 and rows(found.diff, *shown) == rows(whole, *shown)


def test_only_texts_of_loud_keys_are_merged(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "r")
    _first_day(spark, root)
    merged, merge = [], ranges.merge_product_feeds

    def noted(*feeds, **how):
        if not how.get("short"):
            merged.append([f.count() for f in feeds])
        return merge(*feeds, **how)

    monkeypatch.setattr(ranges, "merge_product_feeds", noted)
    again = ranges.ranged_diff(spark, root, *_feeds(spark), SETTINGS)
    ranges.settle(again, root)
    one = ranges.ranged_diff(spark, root, *_feeds(spark, {50: 51}), SETTINGS)
    assert again.opened and again.diff.count() == 0 and one.diff.count() == 1
    assert merged == [[0, 0, 0], [0, 1, 1]]


def test_digests_of_a_feed_are_taken_before_it_is_shuffled(spark):
    merged = ranges.merge_product_feeds(*_odd_feeds(spark), short=lambda text: P.digest(text, False))
    whole = ranges.merge_product_feeds(*_odd_feeds(spark)).withColumn("text_digest", P.digest(F.col("products_description"), False))
    shown = [c for c in merged.columns if c != "text_digest"]
    assert rows(merged, *shown) == rows(whole, *shown)
    once = "complete_rows < 2 and description_rows < 2"
    assert rows(merged.where(once), "products_model", "text_digest") == rows(whole.where(once), "products_model", "text_digest")


def test_a_store_is_settled_without_writing_its_texts(spark, tmp_path):
    root, base = str(tmp_path / "r"), _store(spark)
    extra = dict(prod_code="NEW", prod_desc="new", units_qty=3, price=9, cantsell=0)
    complete, stock, text = _feeds(spark, {3: 4}, [extra])
    text = text.withColumn("narrative", F.when(F.col("prod_code") == "M5", "told anew").otherwise(F.col("narrative")))
    ranges.first_ranges(base, root, SETTINGS, N)
    found = ranges.ranged_diff(spark, root, complete, stock, text, SETTINGS)
    phase = R.run_products(base, found.diff, SETTINGS)
    after, texts, _ = R.stage_over(base, phase.store, phase.texts)
    # The second new product is M7, as the store's product 7 has no model.
    assert texts.info.count() == 1 and texts.described.count() == texts.meta.count() == 2
    ranges.settle(found, root, after, SETTINGS, P.changed_digests(base.products_description, texts, SETTINGS.fold))
    for table in ("products", "products_description", "meta_tags_products_description"):
        want = getattr(phase.store, table)
        assert rows(getattr(after, table), *want.columns) == rows(want, *want.columns)
    kept = ranges.read_ranges(spark, root, published.read_entry(spark, root))
    fresh = ranges._ranged_live(phase.store.products, phase.store.products_description, SETTINGS, N)
    assert rows(kept, *fresh.columns) == rows(fresh, *fresh.columns)
