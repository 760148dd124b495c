"""The registered queries: one for each operator or composition, over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import date
from functools import cached_property, wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from catalogsync.functions.text import CP1252_BYTES, CP1252_CHARS, clean_text
from catalogsync.operators import media as M
from catalogsync.operators.diff import only_in_feed
from catalogsync.operators.merge import first_wins, merge_product_feeds, upsert
from catalogsync.operators.validate import MISSING_DESCRIPTION, append_issues
from catalogsync.plans import categories as C
from catalogsync.plans import placements as L
from catalogsync.plans import products as P
from catalogsync.plans.run import Issues, diff_products, empty_issues, feeds_as_of, replay, run, run_products as products_phase, stage_over
from catalogsync.schemas import FEEDS
from catalogsync.session import by_merge, stage, stage_all, work_dir
from catalogsync.sources import intervals, issue_log as logs, versions
from catalogsync.sources import layout, media_store, ranges
from catalogsync.sources.digests import range_digests
from catalogsync.sources.feeds import read_feed, rejected_rows
from catalogsync.sources.media import scan_media
from catalogsync.sources.patch import numbered_statements, write_patch
from catalogsync.sources.snapshots import archive_feed, changed_sources, read_snapshot, recorded_days, snapshot_days
from catalogsync.sources.store import Store, read_live, seed_control_categories, write_store
from checks.views import IMPORT_CATEGORY, SETTINGS, SNAPSHOT_DAYS, Views, views

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}


def _query(name: str | None = None) -> Callable[[Callable[[Views], DataFrame]], Callable[[Views], DataFrame]]:
    """Register a query under its name, by default that of the function."""

    def register(build: Callable[[Views], DataFrame]) -> Callable[[Views], DataFrame]:
        @wraps(build)
        def run_on(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(views(spark, sf_dir))

        _REGISTRY[name or build.__name__] = run_on
        return build

    return register


def registry() -> dict[str, Query]:
    return {name: _comparable(query) for name, query in _REGISTRY.items()}


def _comparable(query: Query) -> Query:
    """Money as text in what a query shows, as in the oracles, so that all its digits are compared."""

    @wraps(query)
    def shown(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = query(spark, sf_dir)
        money = [f.name for f in rows.schema if isinstance(f.dataType, DecimalType)]
        return rows.withColumns({c: F.col(c).cast("string") for c in money}) if money else rows

    return shown


# snapshots -----------------------------------------------------------------


@_query()
def live_categories(v: Views) -> DataFrame:
    store = v.mixed_store
    rows = C.live_categories(store.categories, store.categories_description, SETTINGS)
    edited = F.col("last_modified").isNotNull().alias("edited")
    return rows.select("categories_id", "parent_id", "categories_status", "categories_description", edited)


@_query()
def live_products(v: Views) -> DataFrame:
    store = v.mixed_store
    rows = P.live_products(store.products, store.products_description, SETTINGS)
    return rows.select(
        "products_id", "products_model", "products_image", "products_price", "products_quantity", "products_weight",
        "products_status", F.col("products_last_modified").isNotNull().alias("edited"), "master_categories_id",
        "products_name", "products_description",
    )


@_query()
def live_links(v: Views) -> DataFrame:
    store = v.mixed_store
    live = P.live_products(store.products, store.products_description, SETTINGS)
    return L.live_links(store.products_to_categories, live, SETTINGS).select(
        "products_id", "categories_id", "products_model"
    )


@_query("seed_control_categories")
def control_categories(v: Views) -> DataFrame:
    seeded = seed_control_categories(
        v.store,
        (IMPORT_CATEGORY, "Feed imports", "Products brought in by the feed"),
        (IMPORT_CATEGORY + 1, "Feed issues", "Products with errors found in the feed"),
    )
    return seeded.categories_description



# categories ----------------------------------------------------------------


def _category_diff(v: Views) -> DataFrame:
    return C.category_diff(v.live_categories, C.import_categories(v.feed_categories), SETTINGS)


@_query()
def import_categories(v: Views) -> DataFrame:
    return C.import_categories(v.feed_categories).drop("feed_rows")


@_query()
def categories_new(v: Views) -> DataFrame:
    return C.new_categories(_category_diff(v))


@_query()
def categories_dropped(v: Views) -> DataFrame:
    return C.dropped_categories(_category_diff(v))


@_query()
def categories_unchanged(v: Views) -> DataFrame:
    return C.unchanged_categories(_category_diff(v))


@_query()
def categories_reparented(v: Views) -> DataFrame:
    return C.reparented_categories(_category_diff(v))


@_query()
def categories_renamed(v: Views) -> DataFrame:
    return C.renamed_categories(_category_diff(v))


@_query()
def categories_status(v: Views) -> DataFrame:
    return C.category_status(_category_diff(v)).drop("stored")


@_query()
def issues_categories(v: Views) -> DataFrame:
    return C.category_issues(_category_diff(v))


@_query()
def apply_categories(v: Views) -> DataFrame:
    return C.apply_to_categories(v.store.categories, _category_diff(v), SETTINGS).drop("categories_image")


@_query()
def apply_category_text(v: Views) -> DataFrame:
    return C.apply_categories(v.store, _category_diff(v), SETTINGS).categories_description


@_query()
def apply_category_meta(v: Views) -> DataFrame:
    return C.apply_categories(v.store, _category_diff(v), SETTINGS).meta_tags_categories_description


@_query()
def patch_categories(v: Views) -> DataFrame:
    return C.category_patch(_category_diff(v), SETTINGS)


# products ------------------------------------------------------------------


def _merged(v: Views) -> DataFrame:
    return merge_product_feeds(v.feed_complete, v.feed_stock, v.feed_descriptions)


def _product_diff(v: Views) -> DataFrame:
    live = P.live_products(v.store.products, v.store.products_description, SETTINGS)
    return P.product_diff(live, _merged(v), SETTINGS)


def _staged_diff(v: Views) -> DataFrame:
    """The part of the diff that has consequences, staged as in a run: new products and changed texts are both read off it."""
    return stage(diff_products(v.store, v.feed_complete, v.feed_stock, v.feed_descriptions, SETTINGS), "product_diff")


def _numbered(v: Views, diff: DataFrame) -> DataFrame:
    return P.with_ids(P.new_products(diff), v.store.products, SETTINGS)


@_query("merge_product_feeds")
def merge_feeds(v: Views) -> DataFrame:
    return _merged(v).drop("complete_rows", "stock_rows", "description_rows")



@_query()
def products_new(v: Views) -> DataFrame:
    return P.new_products(_product_diff(v)).drop("master_categories_id")


@_query()
def products_dropped(v: Views) -> DataFrame:
    return P.dropped_products(_product_diff(v))


@_query()
def products_vitals(v: Views) -> DataFrame:
    return P.vitals(_product_diff(v))


def _folded(v: Views, codes: dict[str, Column]) -> list[DataFrame]:
    """The product feeds with codes that the database takes for those of the store, spelled otherwise in each."""
    feeds = {"complete": v.feed_complete, "stock": v.feed_stock, "descriptions": v.feed_descriptions}
    return [feed.withColumn("prod_code", codes[name]) for name, feed in feeds.items()]


@_query()
def products_vitals_folded(v: Views) -> DataFrame:
    """Vitals by canonical keys: store and feeds differ in case, accents and trailing blanks of a code."""
    code, settings = F.col("prod_code"), replace(SETTINGS, fold=True)
    feeds = _folded(v, {
        "complete": F.concat(code, F.lit("é  ")),
        "stock": F.concat(F.lower(code), F.lit("E")),
        "descriptions": F.concat(F.lower(code), F.lit("Ê ")),
    })
    products = v.store.products.withColumn("products_model", F.concat("products_model", F.lit("È")))
    live = P.live_digests(products, v.store.products_description, settings)
    return P.vitals(P.product_diff(live, merge_product_feeds(*feeds, fold=True), settings))


@_query()
def products_vitals_laid_out(v: Views) -> DataFrame:
    """The same against a live side that was written by key: only the feed is shuffled."""
    path, buckets = f"{work_dir(v.spark)}/live-{uuid.uuid4().hex}", 64
    schema = layout.write_live(v.store, path, buckets, SETTINGS)
    live = layout.read_by_key(v.spark, path, schema, "match_key", buckets)
    return P.vitals(P.product_diff(live, _merged(v), SETTINGS))


@_query()
def products_vitals_ranged(v: Views) -> DataFrame:
    """The day after a run: a few prices differ, and only key ranges that are not known to be quiet are compared."""
    v = v.texts_at_rest
    root, feeds = f"{work_dir(v.spark)}/ranges-{uuid.uuid4().hex}", (v.feed_complete, v.feed_stock, v.feed_descriptions)
    ranges.first_ranges(v.store, root, SETTINGS, 64)
    first = ranges.ranged_diff(v.spark, root, *feeds, SETTINGS)
    phase = products_phase(v.store, first.diff, SETTINGS)
    store, texts, _ = stage_over(v.store, phase.store, phase.texts)
    ranges.settle(first, root, store, SETTINGS, P.changed_digests(v.store.products_description, texts, SETTINGS.fold))
    # The same feeds once more come to nothing, which is put on record.
    ranges.settle(ranges.ranged_diff(v.spark, root, *feeds, SETTINGS), root)
    raised = F.when(F.substring("prod_code", 2, 10).cast("long") % 40 == 1, 1).otherwise(0)
    stock = v.feed_stock.withColumn("price", (F.col("price") + raised).cast(v.feed_stock.schema["price"].dataType))
    later = ranges.ranged_diff(v.spark, root, v.feed_complete, stock, v.feed_descriptions, SETTINGS)
    return P.vitals(later.diff).drop("products_id")


@_query()
def products_inactive(v: Views) -> DataFrame:
    return P.inactive_products(_product_diff(v))


@_query()
def products_active(v: Views) -> DataFrame:
    return P.active_products(_product_diff(v))


@_query()
def products_residual(v: Views) -> DataFrame:
    return P.residual_products(_product_diff(v)).select(
        "products_id", "products_model", "products_name", "products_description"
    )


@_query()
def products_info(v: Views) -> DataFrame:
    return P.info(_product_diff(v))


@_query()
def upsert_info(v: Views) -> DataFrame:
    diff = _product_diff(v)
    return upsert(P.renamed_products(diff), P.redescribed_products(diff), "products_id")


@_query()
def issues_products(v: Views) -> DataFrame:
    return P.product_issues(_product_diff(v), SETTINGS)


def _seen_before(v: Views) -> DataFrame:
    return v.feed_descriptions.select(
        F.col("prod_code").alias("products_model"),
        F.lit(MISSING_DESCRIPTION).alias("issue"),
        F.lit("seen before").alias("note_1"),
        F.lit(None).cast("string").alias("note_2"),
    )


@_query("append_issues")
def issue_log(v: Views) -> DataFrame:
    return append_issues(_seen_before(v), P.product_issues(_product_diff(v), SETTINGS), P.ISSUE_KEY)


@_query()
def issue_log_two_runs(v: Views) -> DataFrame:
    """The product log on disk after an earlier run, a run, and the same run once more, which adds nothing."""
    root, empty = f"{work_dir(v.spark)}/log-{uuid.uuid4().hex}", empty_issues(v.spark)
    logs.extend_log(replace(empty, products=_seen_before(v)), root)
    found = replace(empty, products=P.product_issues(_product_diff(v), SETTINGS))
    for _ in range(2):
        logs.extend_log(found, root)
    return logs.read_entries(v.spark, root, "products")



@_query("first_wins")
def first_sale(v: Views) -> DataFrame:
    items = v.table("lineitem").select("l_partkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_quantity")
    return first_wins(items, ["l_partkey"])



@_query()
def allocate_ids(v: Views) -> DataFrame:
    new = P.new_products(_product_diff(v)).select("products_model")
    return P.with_ids(new, v.store.products, SETTINGS).select("products_id", "products_model")


@_query()
def apply_products(v: Views) -> DataFrame:
    diff = _product_diff(v)
    new = P.new_products(diff).drop("products_name", "products_title", "products_description")
    rows = P.apply_to_products(v.store.products, diff, P.with_ids(new, v.store.products, SETTINGS), SETTINGS)
    return rows.drop(
        "products_date_added", "products_last_modified", "products_date_available", "manufacturers_id"
    )


@_query()
def apply_product_text(v: Views) -> DataFrame:
    v = v.texts_at_rest
    diff = _staged_diff(v)
    return P.apply_to_description(v.store.products_description, diff, _numbered(v, diff), SETTINGS)


@_query()
def apply_product_meta(v: Views) -> DataFrame:
    v = v.texts_at_rest
    diff = _staged_diff(v)
    return P.apply_to_meta(v.store.meta_tags_products_description, diff, _numbered(v, diff), SETTINGS)


@_query()
def patch_status_list(v: Views) -> DataFrame:
    return P.status_patch(_product_diff(v), SETTINGS)


@_query()
def patch_info(v: Views) -> DataFrame:
    return P.info_patch(_product_diff(v))


@_query()
def patch_vitals(v: Views) -> DataFrame:
    return P.vitals_patch(_product_diff(v))


@_query()
def patch_new_products(v: Views) -> DataFrame:
    return P.new_products_patch(_numbered(v, _product_diff(v)), SETTINGS)


# placements ----------------------------------------------------------------


class _Links:
    """The link part of a run. Who is who among products, and the categories, are staged as in a run."""

    def __init__(self, v: Views, numbered: bool):
        v = v.at_rest
        who = ["in_live", "in_feed", "live_products_id", "live_products_model", "feed_products_model"]
        categories = C.apply_to_categories(v.store.categories, _category_diff(v), SETTINGS)
        staged = stage_all(
            {"who": _product_diff(v).select(*who), "categories": categories.select("categories_id", "parent_id")}
        )
        self.v, self.numbered, self.categories = v, numbered, staged["categories"]
        fresh = staged["who"].where(only_in_feed()).selectExpr("feed_products_model products_model")
        if numbered:
            self.new = P.with_ids(fresh, v.store.products, SETTINGS)
        else:
            self.new = fresh.withColumn("products_id", F.lit(None).cast("int"))
        live = staged["who"].where("in_live").selectExpr(
            "live_products_id products_id", "live_products_model products_model"
        )
        self.rows = v.links.count()  # at rest, so footers tell it
        links = L.import_links(v.feed_links, self.categories, SETTINGS, self.rows)
        resolved = L.resolve_links(links, live, self.new)
        self.resolved = stage(resolved, "resolved_links") if numbered else resolved

    @cached_property
    def _changed(self) -> DataFrame:
        changed = L.changed_links(self.v.live_links, self.resolved, self.rows)
        return stage(changed, "changed_links") if self.numbered else changed

    def dropped(self) -> DataFrame:
        return L.dropped_links(self._changed, self.v.placement_log)

    def added(self) -> DataFrame:
        return L.added_links(self._changed, self.categories)

    def fresh(self) -> DataFrame:
        return L.new_links(self.resolved, self.new, SETTINGS)


@_query()
def import_links(v: Views) -> DataFrame:
    categories = C.apply_to_categories(v.store.categories, _category_diff(v), SETTINGS)
    return L.import_links(v.feed_links, categories, SETTINGS)


@_query()
def links_dropped(v: Views) -> DataFrame:
    return _Links(v, numbered=False).dropped()


@_query()
def links_added(v: Views) -> DataFrame:
    return _Links(v, numbered=False).added()


@_query()
def links_folded(v: Views) -> DataFrame:
    """Feed links with their products' ids, where every link comes in two spellings of its code."""
    settings = replace(SETTINGS, fold=True)
    again = v.feed_links.withColumn("prod_code", F.concat(F.lower("prod_code"), F.lit(" ")))
    links = L.import_links(v.feed_links.unionByName(again), v.store.categories, settings)
    live = P.live_products(v.store.products, v.store.products_description, settings)
    none_new = live.where(F.lit(False))
    return L.resolve_links(links, live, none_new, fold=True).select("products_model", "categories_id", "products_id")


@_query()
def links_new(v: Views) -> DataFrame:
    return _Links(v, numbered=True).fresh()


@_query()
def apply_links(v: Views) -> DataFrame:
    links = _Links(v, numbered=True)
    before = links.v.store.products_to_categories
    return L.apply_links(before, links.dropped(), links.added(), links.fresh(), links.rows)


@_query()
def assign_master(v: Views) -> DataFrame:
    return L.assigned_masters(v.store.products, v.store.products_to_categories, SETTINGS)


def _repeated(v: Views) -> dict[str, DataFrame]:
    """The product feeds with codes that come again: with another name, exactly, with a longer text. The first row stays."""
    pk = F.substring("prod_code", 2, 10).cast("long")
    stock = v.feed_stock.where(pk % 6 == 1)
    again = [stock.withColumn("prod_desc", F.concat("prod_desc", F.lit(more))) for more in (" zz", " zzz")]
    told = v.feed_descriptions.where(pk % 7 == 1)
    return dict(
        complete=v.feed_complete.unionByName(v.feed_complete.where(pk % 5 == 0)),
        stockinfo=v.feed_stock.unionByName(again[0]).unionByName(again[1]),
        descriptions=v.feed_descriptions.unionByName(told.withColumn("narrative", F.concat("narrative", F.lit(" more")))),
    )


@_query()
def issues_products_dirty(v: Views) -> DataFrame:
    """Product issues of feeds that repeat codes: each such code is named, all else is as without the repeats."""
    feeds = _repeated(v)
    live = P.live_products(v.store.products, v.store.products_description, SETTINGS)
    merged = merge_product_feeds(feeds["complete"], feeds["stockinfo"], feeds["descriptions"])
    return P.product_issues(P.product_diff(live, merged, SETTINGS), SETTINGS)


@_query()
def run_dirty(v: Views) -> DataFrame:
    """What a whole run logs about products when feeds repeat codes and rows were rejected."""
    v = v.at_rest.texts_at_rest
    feeds = dict(_repeated(v), departments=v.feed_categories, product_department=v.feed_links)
    rejected_stock = rejected_rows(v.spark, "stockinfo", _dirty_stock(v))
    return run(v.store, feeds, empty_issues(v.spark), SETTINGS, rejected=rejected_stock).issues.products.select("products_model", "issue")


def _run(v: Views):
    v, empty = v.at_rest.texts_at_rest, empty_issues(v.spark)
    feeds = dict(
        departments=v.feed_categories,
        complete=v.feed_complete,
        stockinfo=v.feed_stock,
        descriptions=v.feed_descriptions,
        product_department=v.feed_links,
    )
    return run(v.store, feeds, Issues(empty.categories, empty.products, v.placement_log), SETTINGS)


@_query()
def patch_links(v: Views) -> DataFrame:
    return _run(v).patch.where(F.col("phase") == L.PHASE)


@_query()
def run_patch(v: Views) -> DataFrame:
    return _run(v).patch


@_query()
def issues_links(v: Views) -> DataFrame:
    """The placement log of a whole run, without what an earlier run had logged."""
    log = _run(v).issues.placements
    return log.join(v.placement_log, L.ISSUE_KEY, "left_anti").select(*log.columns)


_DATES = ("products_date_added", "products_last_modified", "products_date_available", "manufacturers_id")


@_query()
def run_products(v: Views) -> DataFrame:
    """The product table after a whole run, master categories included."""
    return _run(v).store.products.drop(*_DATES)


@_query()
def run_descriptions(v: Views) -> DataFrame:
    return _run(v).store.products_description


@_query()
def run_links(v: Views) -> DataFrame:
    return _run(v).store.products_to_categories


@_query()
def run_categories(v: Views) -> DataFrame:
    return _run(v).store.categories.drop("categories_image")


@_query()
def run_issues_categories(v: Views) -> DataFrame:
    return _run(v).issues.categories


@_query()
def run_issues_products(v: Views) -> DataFrame:
    return _run(v).issues.products


@_query()
def patch_file(v: Views) -> DataFrame:
    """A patch written as files and read back."""
    path = f"{work_dir(v.spark)}/patch-{uuid.uuid4().hex}"
    write_patch(P.vitals_patch(_product_diff(v)), path)
    return v.spark.read.text(path).select(F.col("value").alias("statement"))


@_query()
def patch_numbered(v: Views) -> DataFrame:
    """The statements of a whole run with their place in it."""
    return numbered_statements(_run(v).patch)


@_query()
def store_files(v: Views) -> DataFrame:
    """The product table of a store written as a version and read back."""
    root = f"{work_dir(v.spark)}/store-{uuid.uuid4().hex}"
    write_store(v.at_rest.store, root)
    return read_live(v.spark, "products", root).select(
        "products_id", "products_model", "products_image", "products_price", "products_quantity", "products_weight",
        "products_status",
    )


def _two_versions(v: Views) -> str:
    """A store and what a run makes of it, published as a base and the changes."""
    root = f"{work_dir(v.spark)}/versions-{uuid.uuid4().hex}"
    versions.first_version(v.at_rest.texts_at_rest.store, root)
    versions.next_version(_run(v).store, root)
    return root


@_query()
def store_changes(v: Views) -> DataFrame:
    """The product table of the newest version: the base, and over it what the run has changed."""
    return versions.read_version(v.spark, _two_versions(v)).products.drop(*_DATES)


@_query()
def store_change_links(v: Views) -> DataFrame:
    """The change files of the links: nothing but what the run adds and takes away."""
    return versions.changes_of(v.spark, _two_versions(v), "products_to_categories")


@_query()
def issues_new_text(v: Views) -> DataFrame:
    """Product issues with the texts of new products checked as well."""
    return P.product_issues(_product_diff(v), replace(SETTINGS, check_new_text=True))


@_query()
def new_quarantined(v: Views) -> DataFrame:
    """New products without those that only the descriptions know."""
    settings = replace(SETTINGS, quarantine_description_only=True)
    live = P.live_products(v.store.products, v.store.products_description, settings)
    return P.new_products(P.product_diff(live, _merged(v), settings)).select("products_model", "products_price")


# text, media, sources ------------------------------------------------------


@_query("clean_text")
def clean_documents(v: Views) -> DataFrame:
    return v.table("documents").select("doc_id", clean_text(F.col("text")).alias("text"))


@_query()
def media_keys(v: Views) -> DataFrame:
    return M.canonical_media(v.media).groupBy("key", "prefix").agg(F.max("length").alias("length"))


def _largest(v: Views) -> DataFrame:
    return M.keep_largest(M.canonical_media(v.media))


@_query()
def media_keep_largest(v: Views) -> DataFrame:
    return _largest(v)


@_query()
def media_new(v: Views) -> DataFrame:
    return M.new_media(_largest(v), v.media_current)


@_query()
def media_missing(v: Views) -> DataFrame:
    return M.missing_media(v.products, v.media_current)


@_query()
def media_candidates(v: Views) -> DataFrame:
    return M.resolve_candidates(M.missing_media(v.products, v.media_current), v.media_inventory)


@_query()
def media_manifest(v: Views) -> DataFrame:
    current = v.media_current.select(
        "key",
        F.left("key", F.lit(2)).alias("prefix"),
        F.lit("").alias("dir"),
        F.substring_index("key", "/", -1).alias("name"),
        "length",
        "md5",
        F.lit("before").alias("run"),
    )
    return M.media_manifest(current, M.new_media(_largest(v), v.media_current), "now")


@_query()
def media_found_manifest(v: Views) -> DataFrame:
    """Files found for missing images take their place in the manifest."""
    candidates = M.resolve_candidates(M.missing_media(v.products, v.media_current), v.media_inventory)
    found = M.found_media(candidates, v.media_inventory)
    return found.select("key", "prefix", "name", "length")


@_query()
def media_unresolved(v: Views) -> DataFrame:
    missing = M.missing_media(v.products, v.media_current)
    return M.unresolved_media(missing, M.resolve_candidates(missing, v.media_inventory.where("length % 3 = 0")))


@_query("changed_sources")
def changed_pages(v: Views) -> DataFrame:
    name, page = F.col("page_id").cast("string").alias("name"), F.col("page_id")
    pages = v.table("pages")
    before = F.when(page % 5 == 1, F.concat("html", F.lit("x"))).otherwise(F.col("html"))
    active = pages.where(page % 3 != 0).select(name, F.md5(before).alias("md5"))
    return changed_sources(pages.select(name, F.md5("html").alias("md5")), active)


def _in_ranges(spark: SparkSession) -> SparkSession:
    """The same settings in a session of its own, but files are read in byte ranges of 64 KB."""
    session = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if name.startswith("spark.sql.") and session.conf.isModifiable(name):
            session.conf.set(name, value)
    session.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    return session


@_query()
def media_contents(v: Views) -> DataFrame:
    """Files of pages, stored under their digests by two runs that share most of them, and hashed anew where they lie."""
    root, folder = (f"{work_dir(v.spark)}/{kind}-{uuid.uuid4().hex}" for kind in ("contents", "files"))
    pages = v.table("pages").withColumn("g", F.col("page_id") % 24).repartition(24, "g").sortWithinPartitions("g", "page_id")
    pages.select("g", "html").write.partitionBy("g").text(folder)
    path = F.concat_ws("/", F.lit(folder), "dir", "name")
    files = scan_media(v.spark, folder).where("dir like 'g=%'").withColumn("path", path)
    for some in (files.where("md5 < '8'"), files):
        media_store.store_contents(some, root)
    there = scan_media(v.spark, f"{root}/content")
    return there.join(media_store.held_contents(v.spark, root), ["md5", "length"]).select("md5", "length", (F.col("name") == F.col("md5")).alias("named"))


@_query()
def changed_files(v: Views) -> DataFrame:
    """Files of pages against an older set: one lacks a page, one has them in another order, one is not there."""
    session, group, page = _in_ranges(v.spark), F.col("page_id") % 12, F.col("page_id")
    pages = v.table("pages").withColumn("g", group)
    older = pages.where((group != 9) & ((group != 5) | (page > 5))).withColumn("page_id", F.when(group == 7, -page).otherwise(page))

    def written(rows: DataFrame) -> DataFrame:
        path = f"{work_dir(v.spark)}/files-{uuid.uuid4().hex}"
        sorted_rows = rows.repartition(12, "g").sortWithinPartitions("g", "page_id").select("g", "html")
        sorted_rows.write.partitionBy("g").text(path)
        # A folder has one file here, whose own name Spark makes up.
        return range_digests(session, path).where("name like 'g=%'").withColumn("name", F.substring_index("name", "/", 1))

    return changed_sources(written(pages), written(older)).select("name")


def _replayed(v: Views) -> Store:
    """The store after three recorded days, read back from the record."""
    v, root = v.at_rest.texts_at_rest, f"{work_dir(v.spark)}/record-{uuid.uuid4().hex}"
    for number, day in enumerate(SNAPSHOT_DAYS, start=1):
        for name, rows in v.feeds_of(number).items():
            full = rows.select(*[
                (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                for f in FEEDS[name].schema
            ])
            archive_feed(full.withColumn("snapshot_date", F.lit(day)), name, root)
    recorded = recorded_days(v.spark, root)
    # Feeds without rows leave no record of their own; they are the same on every day.
    recorded = {name: days or SNAPSHOT_DAYS for name, days in recorded.items()}

    def feeds_for(day: date) -> dict[str, DataFrame]:
        held = feeds_as_of(v.spark, root, day, {n: d for n, d in recorded.items() if n not in ("complete", "descriptions")})
        return v.feeds_of(1) | held

    return replay(v.store, SNAPSHOT_DAYS, feeds_for, empty_issues(v.spark), SETTINGS)[0]


def _recorded_intervals(v: Views) -> str:
    root = f"{work_dir(v.spark)}/intervals-{uuid.uuid4().hex}"
    for number, day in enumerate(SNAPSHOT_DAYS, start=1):
        rows = v.snapshot(number)
        full = rows.select(*[(F.col(f.name) if f.name in rows.columns else F.lit(None)).alias(f.name) for f in FEEDS["stockinfo"].schema])
        intervals.record_day(full, "stockinfo", root, day)
    return root


@_query()
def interval_record(v: Views) -> DataFrame:
    """How many recorded days each stored row of the stock feed stood, and from which on."""
    found = intervals.intervals(v.spark, "stockinfo", _recorded_intervals(v))
    days = F.array(*[F.lit(d) for d in SNAPSHOT_DAYS])
    first = F.array_position(days, F.col("valid_from"))
    last = F.coalesce(F.nullif(F.array_position(days, F.col("valid_to")), F.lit(0)), F.lit(len(SNAPSHOT_DAYS) + 1))
    return found.select("prod_code", "units_qty", "price", "copies", first.cast("int").alias("k"), (last - first).cast("int").alias("days"))


@_query()
def interval_day(v: Views) -> DataFrame:
    """The second recorded day, read back from intervals."""
    day = intervals.read_day(v.spark, "stockinfo", _recorded_intervals(v), SNAPSHOT_DAYS[1])
    return day.select("prod_code", "prod_desc", "units_qty", "price")


@_query()
def replay_snapshots(v: Views) -> DataFrame:
    final = _replayed(v)
    names = final.products_description.select("products_id", "products_name")
    return final.products.join(by_merge(names), "products_id").select(
        "products_id", "products_model", "products_price", "products_quantity", "products_weight", "products_status",
        "products_name",
    )


@_query()
def replay_links(v: Views) -> DataFrame:
    return _replayed(v).products_to_categories


@_query()
def replay_categories(v: Views) -> DataFrame:
    return _replayed(v).categories.select("categories_id", "parent_id", "categories_status")


def _as_file(rows: DataFrame, name: str) -> str:
    """Write a feed the way the supplier does: quoted CSV with a header, Windows-1252 bytes."""
    path = f"{work_dir(rows.sparkSession)}/feed-{uuid.uuid4().hex}"

    def field(column: str, kind: str) -> Column:
        if column not in rows.columns:
            return F.lit(None).cast(kind).alias(column)
        value = F.col(column)
        return (F.translate(value, CP1252_CHARS, CP1252_BYTES) if kind == "string" else value).alias(column)

    columns = [field(f.name, f.dataType.simpleString()) for f in FEEDS[name].schema]
    rows.select(*columns).write.option("header", True).option("escape", '"').option("encoding", "ISO-8859-1").option(
        "ignoreLeadingWhiteSpace", False
    ).option("ignoreTrailingWhiteSpace", False).csv(path)
    return path


def _roundtrip(name: str, feed: Callable[[Views], DataFrame]) -> None:
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = _as_file(feed(views(spark, sf_dir)), name)
        return read_feed(spark, name, path).drop("snapshot_date")

    _REGISTRY[f"read_feed_{name}"] = build


def _broken(text: Column, number: Column) -> Column:
    """The text with a line break inside, of each kind in turn."""
    kind = F.element_at(F.array(F.lit("\n"), F.lit("\r"), F.lit("\r\n")), (number % 3 + 1).cast("int"))
    return F.concat(text, F.lit(" in"), kind, F.lit("two"))


def _spiced(v: Views) -> DataFrame:
    spiced = F.concat("prod_desc", F.lit(" ‘n’ “x” €"))
    return v.feed_stock.withColumn("prod_desc", _broken(spiced, F.length("prod_desc")))


_roundtrip("complete", lambda v: v.feed_complete)
_roundtrip("stockinfo", _spiced)
_roundtrip("descriptions", lambda v: v.feed_descriptions)
_roundtrip("product_department", lambda v: v.feed_links)
_roundtrip("departments", lambda v: v.feed_categories.withColumn("dept_name", _broken(F.col("dept_name"), F.col("dept_code") + 3)))


@_query()
def read_feed_split(v: Views) -> DataFrame:
    """One file with breaks in its fields, read by several tasks: each takes a byte range of 64 KB."""
    path = _as_file(_spiced(v).repartition(1), "stockinfo")
    return read_feed(_in_ranges(v.spark), "stockinfo", path, in_splits=True).drop("snapshot_date")


@_query()
def read_feed_long_codes(v: Views) -> DataFrame:
    """Codes that share their first 40 characters stay apart."""
    path = _as_file(v.feed_stock.withColumn("prod_code", F.concat(F.lit("0" * 40), "prod_code")), "stockinfo")
    return read_feed(v.spark, "stockinfo", path).select("prod_code", "units_qty")


def _dirty_stock(v: Views) -> str:
    """A stock feed as text where every seventh price is none and every eleventh row lacks its last four fields."""
    path = f"{work_dir(v.spark)}/dirty-{uuid.uuid4().hex}"
    pk = F.substring("prod_code", 2, 10).cast("long")
    price = F.when(pk % 7 == 0, F.lit('"1,234.50"')).otherwise(F.col("price").cast("string"))
    head = F.concat_ws(",", "prod_code", F.concat(F.lit('"'), "prod_desc", F.lit('"')), "units_qty", "weight", price)
    row = F.when(pk % 11 == 0, head).otherwise(F.concat_ws(",", head, F.lit(""), F.lit("0"), "prod_image", "cantsell"))
    v.feed_stock.select(row.alias("value")).write.option("header", True).option("quote", "\x01").option("escapeQuotes", False).option(
        "sep", "\x02"
    ).csv(path)
    return path


@_query("rejected_rows")
def rejected(v: Views) -> DataFrame:
    return rejected_rows(v.spark, "stockinfo", _dirty_stock(v)).select("key", "kept")


@_query()
def products_dropped_dirty(v: Views) -> DataFrame:
    """A bad price or missing fields drop no product."""
    stock = read_feed(v.spark, "stockinfo", _dirty_stock(v))
    nothing = {n: v.spark.createDataFrame([], FEEDS[n].schema) for n in ("complete", "descriptions")}
    live = P.live_products(v.store.products, v.store.products_description, SETTINGS)
    merged = merge_product_feeds(nothing["complete"], stock, nothing["descriptions"])
    return P.dropped_products(P.product_diff(live, merged, SETTINGS))


@_query()
def archive_roundtrip(v: Views) -> DataFrame:
    """A delivery of many files is one day of the record."""
    root = f"{work_dir(v.spark)}/record-{uuid.uuid4().hex}"
    archive_feed(read_feed(v.spark, "stockinfo", _as_file(v.feed_stock, "stockinfo")), "stockinfo", root)
    (day,) = snapshot_days(v.spark, "stockinfo", root)
    return read_snapshot(v.spark, "stockinfo", root, day).select("prod_code", "units_qty", "price")
