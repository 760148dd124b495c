"""Placements: which product is linked to which category, and its master category."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogsync.functions.compare import with_collation
from catalogsync.functions.keys import canonical_key
from catalogsync.operators.apply import delete, insert_ignore, update
from catalogsync.operators.assign import assign_by_priority
from catalogsync.operators.diff import link_diff
from catalogsync.operators.merge import first_wins
from catalogsync.operators.render import (
    delete_statement,
    id_key,
    insert_statement,
    patch_rows,
    update_statement,
    values_statement,
)
from catalogsync.operators.validate import NON_LEAF, UNASSIGNED, UNKNOWN_PRODUCT, issue_case, issue_rows
from catalogsync.schemas import PLACEMENT_ISSUES
from catalogsync.session import by_merge, spread
from catalogsync.settings import Settings

PHASE = 3
LINK = ["products_id", "categories_id"]
# An unknown product has no id, so its model tells its entries apart.
ISSUE_KEY = ["categories_id", "products_id", "issue", "products_model"]


def own_links(links: DataFrame, settings: Settings) -> DataFrame:
    """Links between own products and own categories, so none to the control categories."""
    return links.where(
        (F.col("categories_id") < settings.category_id_bound) & (F.col("products_id") < settings.product_id_bound)
    )


def live_links(links: DataFrame, live: DataFrame, settings: Settings) -> DataFrame:
    """Own links with the product's model."""
    return own_links(links, settings).join(live.select("products_id", "products_model"), "products_id", "left")


def import_links(feed: DataFrame, categories: DataFrame, settings: Settings, rows: int = 0) -> DataFrame:
    """Distinct feed links to categories that exist: ``(products_model, categories_id)``.

    Repeats collapse before anything is joined; with ``settings.fold`` so do
    codes of one canonical key, to their smallest spelling. ``rows`` says about
    how many there are: very many are dealt by code, as the match with products needs them.
    """
    links = with_collation(
        feed.select(F.col("prod_code").alias("products_model"), F.col("dept_code").alias("categories_id")),
        settings.collation,
    )
    if settings.fold:
        keyed = links.withColumn("_key", canonical_key(F.col("products_model")))
        by_key = spread(keyed, rows, "_key").groupBy("_key", "categories_id")
        links = by_key.agg(F.min("products_model").alias("products_model")).drop("_key")
    else:
        links = spread(links, rows, "products_model").distinct()
    return links.join(categories.select("categories_id"), "categories_id", "left_semi").select(
        "products_model", "categories_id"
    )


def resolve_links(links: DataFrame, live: DataFrame, new: DataFrame, fold: bool = False) -> DataFrame:
    """Feed links with the id of their product, ``is_new`` for this run's products; both NULL where unknown."""
    ids = live.select(F.col("products_model").alias("_model"), "products_id", F.lit(False).alias("is_new")).unionByName(
        new.select(F.col("products_model").alias("_model"), "products_id", F.lit(True).alias("is_new"))
    )
    key = canonical_key if fold else (lambda model: model)
    return links.join(ids, key(F.col("products_model")) == key(F.col("_model")), "left").drop("_model")


def new_links(resolved: DataFrame, new: DataFrame, settings: Settings) -> DataFrame:
    """Links of new products, plus one to the import category for each of them."""
    by_feed = resolved.where("is_new").select("products_model", "categories_id", "products_id")
    to_import = new.select("products_model", F.lit(settings.import_category_id).alias("categories_id"), "products_id")
    return by_feed.unionByName(to_import).distinct()


def changed_links(live: DataFrame, resolved: DataFrame, rows: int = 0) -> DataFrame:
    """Links of known products that only the store or only the feed has."""
    known = resolved.where(~F.col("is_new"))
    return link_diff(live, known, LINK, rows).where(F.col("in_live") != F.col("in_feed"))


def parent_ids(categories: DataFrame) -> DataFrame:
    return categories.select(F.col("parent_id").alias("categories_id")).distinct()


def dropped_links(changed: DataFrame, log: DataFrame) -> DataFrame:
    """Links the feed no longer has, but for products the log lists as placed on a non-leaf category."""
    excused = log.where(F.col("issue") == NON_LEAF).select("products_id").distinct()
    return changed.where(F.col("in_live") == 1).join(by_merge(excused), "products_id", "left_anti").select(*LINK)


def added_links(changed: DataFrame, categories: DataFrame) -> DataFrame:
    """Links only the feed has, to leaf categories."""
    return changed.where(F.col("in_feed") == 1).join(parent_ids(categories), "categories_id", "left_anti").select(*LINK)


def apply_links(links: DataFrame, dropped: DataFrame, added: DataFrame, new: DataFrame, rows: int = 0) -> DataFrame:
    """Links, about ``rows`` of them, without the dropped ones, which are never among the added or new ones, and with those."""
    links = spread(links, rows, *LINK)
    more = added.unionByName(new.select(*LINK))
    return insert_ignore(delete(links, by_merge(dropped), LINK), more, LINK, unique=True, before=by_merge(links))


def assigned_masters(products: DataFrame, links: DataFrame, settings: Settings, rows: int = 0) -> DataFrame:
    """``(products_id, master_categories_id)`` for products waiting in the import category that have another link.

    Few products wait as a rule, so their links are picked out before anything is grouped.
    """
    waiting = products.where(F.col("master_categories_id") == settings.import_category_id).select("products_id")
    best = assign_by_priority(
        spread(links, rows, "products_id").join(by_merge(waiting), "products_id", "left_semi"),
        "products_id",
        "categories_id",
        settings.priority,
        settings.import_category_id,
    )
    return best.select("products_id", F.col("categories_id").alias("master_categories_id"))


def apply_masters(products: DataFrame, masters: DataFrame, rows: int | None = None) -> DataFrame:
    """Products with the masters assigned to them, of which there are ``rows``, if known."""
    return update(products, by_merge(masters, rows), ["products_id"], ["master_categories_id"])


def placement_issues(
    links: DataFrame,
    products: DataFrame,
    description: DataFrame,
    categories: DataFrame,
    resolved: DataFrame,
    settings: Settings,
) -> DataFrame:
    """Links to parents, products still in the import category, links of products nobody knows."""
    models = products.select("products_id", "products_model")
    on_parent = links.join(parent_ids(categories), "categories_id", "left_semi").join(by_merge(models), "products_id")
    waiting = products.where(F.col("master_categories_id") == settings.import_category_id).select(
        "products_id", "products_model", F.col("master_categories_id").alias("categories_id")
    )
    named = waiting.join(description.select("products_id", "language_id", "products_name"), "products_id")
    unassigned = first_wins(named, ["products_id"], [F.col("language_id")])
    unknown = resolved.where(F.col("products_id").isNull()).withColumn("products_id", F.lit(0))
    return (
        issue_rows(on_parent, PLACEMENT_ISSUES, [issue_case(F.lit(True), NON_LEAF)])
        .unionByName(
            issue_rows(unassigned, PLACEMENT_ISSUES, [issue_case(F.lit(True), UNASSIGNED, F.col("products_name"))])
        )
        .unionByName(issue_rows(unknown, PLACEMENT_ISSUES, [issue_case(F.lit(True), UNKNOWN_PRODUCT)]))
    )


def placement_patch(dropped: DataFrame, added: DataFrame, new: DataFrame, masters: DataFrame) -> DataFrame:
    table, both = "products_to_categories", {c: c for c in LINK}
    by_model = F.concat_ws("/", "products_model", id_key("categories_id"))
    master, by_id = {"master_categories_id": "master_categories_id"}, {"products_id": "products_id"}
    return (
        patch_rows(dropped, PHASE, id_key(*LINK), {1: delete_statement(dropped, table, both)})
        .unionByName(patch_rows(added, PHASE, id_key(*LINK), {2: values_statement(added, table, LINK)}))
        .unionByName(patch_rows(new, PHASE, by_model, {3: insert_statement(new, table, both)}))
        .unionByName(
            patch_rows(masters, PHASE, id_key("products_id"), {4: update_statement(masters, "products", master, by_id)})
        )
    )
