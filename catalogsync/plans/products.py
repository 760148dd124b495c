"""Products: live snapshot, merged feed, change sets, checks, next tables and patch."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalogsync.functions.compare import changed_to, differs, in_stock, with_collation
from catalogsync.functions.keys import canonical_key
from catalogsync.functions.text import or_empty, wall_clock
from catalogsync.operators.apply import insert_ignore, missing_rows, sparse_update
from catalogsync.operators.assign import allocate_ids, max_id
from catalogsync.operators.diff import in_both, only_in_feed, only_in_live, snapshot_diff
from catalogsync.operators.merge import description_only, first_wins
from catalogsync.operators.render import id_key, id_list_rows, insert_statement, patch_rows, update_statement
from catalogsync.operators.validate import (
    DUPLICATE_KEY,
    MISSING_DESCRIPTION,
    MISSING_NAME,
    issue_case,
    issue_rows,
    missing_text,
    too_long,
)
from catalogsync.plans.categories import in_language
from catalogsync.schemas import PRODUCT_ISSUES
from catalogsync.session import by_merge
from catalogsync.settings import STAGING_MASTER_CATEGORY, Settings
from catalogsync.sources.store import Store

PHASE = 2
ISSUE_KEY = ["products_model", "issue"]
_COMPARED_TEXT = ["match_key", "products_model", "products_name", "products_description"]


# Digests that stand for the compared texts.
_DIGESTS = {"products_name": "name_digest", "products_description": "text_digest"}


def digest(text: Column, fold: bool) -> Column:
    return F.sha2(canonical_key(text) if fold else text, 256)


def with_digests(rows: DataFrame, fold: bool = False) -> DataFrame:
    """Digests in place of the texts: what a table needs to tell whether a text has changed."""
    return rows.select(
        *[c for c in rows.columns if c not in _DIGESTS], *[digest(F.col(c), fold).alias(d) for c, d in _DIGESTS.items()]
    )


def live_digests(
    products: DataFrame, description: DataFrame, settings: Settings, short: DataFrame | None = None
) -> DataFrame:
    """``live_products`` with digests for texts, taken where the texts are read: no text is shuffled.

    ``short`` is ``with_digests`` of ``description`` where it was taken elsewhere.
    """
    if short is None:
        short = with_digests(description, settings.fold)
    short = short.withColumnsRenamed({d: c for c, d in _DIGESTS.items()})
    nothing = F.sha2(F.lit(""), 256)
    rows = live_products(products, short, settings)
    return rows.select(
        *[c for c in rows.columns if c not in _DIGESTS],
        *[F.coalesce(F.nullif(c, F.lit("")), nothing).alias(d) for c, d in _DIGESTS.items()],
    )


def live_products(products: DataFrame, description: DataFrame, settings: Settings) -> DataFrame:
    """Own products with their text; of a repeated model the smallest id.

    ``match_key`` is the model, or for products without one a value of their
    own that no feed code can equal. With ``settings.fold`` it is the canonical
    key of the model. Deduplication and the later match with the
    feed both go by it and share one shuffle.
    """
    own = products.where(F.col("products_id") < settings.product_id_bound)
    model = canonical_key(F.col("products_model")) if settings.fold else F.col("products_model")
    no_model = F.concat(F.lit("\x00"), F.col("products_id").cast("string"))
    rows = in_language(own, by_merge(description), "products_id", settings).select(
        F.coalesce(model, no_model).alias("match_key"),
        "products_id",
        "products_model",
        "products_image",
        "products_price",
        "products_quantity",
        "products_date_added",
        "products_last_modified",
        "products_date_available",
        "products_weight",
        "products_status",
        "master_categories_id",
        or_empty(F.col("products_name")).alias("products_name"),
        or_empty(F.col("products_description")).alias("products_description"),
    )
    return first_wins(with_collation(rows, settings.collation, _COMPARED_TEXT), ["match_key"], [F.col("products_id")])


def product_diff(live: DataFrame, feed: DataFrame, settings: Settings) -> DataFrame:
    """The match of store and feed; a feed merged with ``short`` brings the digest of its description along."""
    if settings.quarantine_description_only:
        feed = feed.where(~description_only())
    compare = ["products_name", "products_description"]
    if "text_digest" in live.columns:
        compare = list(_DIGESTS.values())
        taken = {d: digest(F.col(c), settings.fold) for c, d in _DIGESTS.items() if d not in feed.columns}
        feed = feed.withColumns(taken)
    return snapshot_diff(live, feed, "match_key", "match_key" if settings.fold else "products_model", compare)


def _differs_in(diff: DataFrame, text: str) -> Column:
    """Whether a text differs between feed and store, by digests where the diff has them."""
    column = _DIGESTS[text] if f"live_{_DIGESTS[text]}" in diff.columns else text
    return differs(F.col(f"feed_{column}"), F.col(f"live_{column}"))


_FEED = [
    "products_model", "products_image", "products_price", "products_quantity", "products_weight", "products_status",
    "products_name", "products_title", "products_description",
]


def _feed_side(rows: DataFrame) -> DataFrame:
    return rows.select(*[F.col(f"feed_{c}").alias(c) for c in _FEED])


def new_products(diff: DataFrame) -> DataFrame:
    """Products only the feed has; without stock, or with numbers that can't be read, they start inactive."""
    rows = _feed_side(diff.where(only_in_feed()))
    unknown = reduce(Column.__or__, [F.col(v).isNull() for v in [*_VITALS, "products_status"]])
    rows = rows.withColumn("products_status", F.when(unknown, 0).otherwise(F.col("products_status"))).withColumns(
        {v: F.coalesce(v, F.lit(0).cast(rows.schema[v].dataType)) for v in _VITALS}
    )
    status = F.when(~in_stock(F.col("products_quantity")), 0).otherwise(F.col("products_status"))
    return rows.withColumn("products_status", status).withColumn(
        "master_categories_id", F.lit(STAGING_MASTER_CATEGORY)
    )


def with_ids(new: DataFrame, products: DataFrame, settings: Settings) -> DataFrame:
    """New products with their ids and the import category as master. Materialises them."""
    start = max_id(products, "products_id", settings.product_id_bound)
    numbered = allocate_ids(new, "products_model", "products_id", start, settings.product_id_bound)
    return numbered.withColumn("master_categories_id", F.lit(settings.import_category_id))


def _id() -> Column:
    return F.col("live_products_id").alias("products_id")


def dropped_products(diff: DataFrame) -> DataFrame:
    return diff.where(only_in_live() & (F.col("live_products_status") == 1)).select(_id())


def _vital(name: str) -> Column:
    return changed_to(F.col(f"feed_{name}"), F.col(f"live_{name}"))


_VITALS = ["products_quantity", "products_weight", "products_price"]


def _any_vital() -> Column:
    return reduce(Column.__or__, [differs(F.col(f"feed_{v}"), F.col(f"live_{v}")) for v in _VITALS])


def vitals(diff: DataFrame) -> DataFrame:
    """Sparse changes of quantity, weight and price; edits by the store's owner do not stop them."""
    return diff.where(in_both() & _any_vital()).select(
        _id(), F.col("feed_products_model").alias("products_model"), *[_vital(v).alias(v) for v in _VITALS]
    )


def _goes_inactive() -> Column:
    unsellable = (F.col("feed_products_status") == 0) | ~in_stock(F.col("feed_products_quantity"))
    return (F.col("live_products_status") == 1) & (only_in_live() | (in_both() & unsellable))


def _goes_active() -> Column:
    sellable = (F.col("feed_products_status") == 1) & in_stock(F.col("feed_products_quantity"))
    return in_both() & (F.col("live_products_status") == 0) & sellable


def inactive_products(diff: DataFrame) -> DataFrame:
    return diff.where(_goes_inactive()).select(_id())


def active_products(diff: DataFrame) -> DataFrame:
    return diff.where(_goes_active()).select(_id())


def noteworthy(diff: DataFrame) -> DataFrame:
    """Rows of the diff that any change set, check or patch looks at.

    Most products do not change from one day to the next, so this is what a
    run stages.
    """
    gone = only_in_live() & (F.col("live_products_status") == 1)
    text = in_both() & (F.col("change_kind") == "changed")
    repeated = reduce(Column.__or__, [F.col(f"feed_{c}_rows") > 1 for c in ("complete", "stock", "description")])
    switched = in_both() & (_goes_active() | _goes_inactive())
    vital = in_both() & _any_vital()
    return diff.where(only_in_feed() | gone | text | vital | switched | F.coalesce(repeated, F.lit(False)))


def residual_products(diff: DataFrame) -> DataFrame:
    """Feed rows of known products whose name and text are not both known to be the same."""
    rows = diff.where(in_both() & (F.col("change_kind") == "changed"))
    return rows.select(_id(), *[F.col(f"feed_{c}").alias(c) for c in _FEED])


def renamed_products(diff: DataFrame) -> DataFrame:
    renamed = _differs_in(diff, "products_name")
    return diff.where(in_both() & F.col("live_products_last_modified").isNull() & renamed).select(
        _id(), F.col("feed_products_name").alias("products_label"), F.col("feed_products_title").alias("products_title")
    )


def redescribed_products(diff: DataFrame) -> DataFrame:
    retold = _differs_in(diff, "products_description")
    return diff.where(in_both() & F.col("live_products_last_modified").isNull() & retold).select(
        _id(), F.col("feed_products_description").alias("products_narrative")
    )


def info(diff: DataFrame) -> DataFrame:
    """Sparse text changes of products that the store's owner has not edited.

    The union by id of ``renamed_products`` and ``redescribed_products``, read
    off one row each instead of joining the two.
    """
    renamed = _differs_in(diff, "products_name")
    retold = _differs_in(diff, "products_description")
    return diff.where(in_both() & F.col("live_products_last_modified").isNull() & (renamed | retold)).select(
        _id(),
        F.when(renamed, F.col("feed_products_name")).alias("products_label"),
        F.when(renamed, F.col("feed_products_title")).alias("products_title"),
        F.when(retold, F.col("feed_products_description")).alias("products_narrative"),
    )


def product_issues(diff: DataFrame, settings: Settings) -> DataFrame:
    """Cut names of new products, missing texts of known ones, repeated codes."""
    new = only_in_feed()
    checked = in_both() & (F.col("change_kind") == "changed")
    if settings.check_new_text:
        checked = checked | new
    name, title, text = (F.col(f"feed_products_{c}") for c in ("name", "title", "description"))
    most = F.greatest(*[F.col(f"feed_{c}_rows") for c in ("complete", "stock", "description")])
    return issue_rows(
        diff.where(F.col("in_feed").isNotNull()).withColumn("products_model", F.col("feed_products_model")),
        PRODUCT_ISSUES,
        [
            too_long(F.when(new, name), title),
            missing_text(text, MISSING_DESCRIPTION, checked),
            missing_text(name, MISSING_NAME, checked),
            issue_case(most > 1, DUPLICATE_KEY, most),
        ],
    )


def apply_to_products(products: DataFrame, diff: DataFrame, new: DataFrame, settings: Settings) -> DataFrame:
    """The next ``products`` table: status and vitals in one sparse update, then the new rows."""
    status = F.when(_goes_active(), 1).when(_goes_inactive(), 0)
    has_vitals = in_both() & _any_vital()
    price = F.when(has_vitals, F.coalesce(_vital("products_price"), F.col("live_products_price")))
    changes = diff.where(has_vitals | status.isNotNull()).select(
        _id(),
        status.alias("products_status"),
        *[F.when(has_vitals, _vital(v)).alias(v) for v in _VITALS],
        price.alias("products_price_sorter"),
    )
    changed = sparse_update(
        products, changes, ["products_id"], ["products_status", *_VITALS, "products_price_sorter"]
    )
    return insert_ignore(changed, store_rows(new, settings), ["products_id"], unique=True, before=by_merge(products))


def store_rows(new: DataFrame, settings: Settings) -> DataFrame:
    """New products with the columns that only the store has."""
    return new.select(
        "*",
        wall_clock(settings.add_date).alias("products_date_added"),
        wall_clock(settings.new_date).alias("products_date_available"),
        F.lit(settings.manufacturer_id).alias("manufacturers_id"),
        F.col("products_price").alias("products_price_sorter"),
    )


def _described(new: DataFrame, settings: Settings) -> DataFrame:
    return new.select(
        "products_id", F.lit(settings.language_id).alias("language_id"), "products_name", "products_description"
    )


def _meta(new: DataFrame, settings: Settings) -> DataFrame:
    return new.select(
        "products_id",
        F.lit(settings.language_id).alias("language_id"),
        F.col("products_title").alias("metatags_title"),
        F.col("products_description").alias("metatags_keywords"),
        F.col("products_description").alias("metatags_description"),
    )


def _info_text(changes: DataFrame) -> DataFrame:
    return changes.select(
        "products_id",
        F.col("products_label").alias("products_name"),
        F.col("products_narrative").alias("products_description"),
    )


def _info_meta(changes: DataFrame) -> DataFrame:
    return changes.select(
        "products_id",
        F.col("products_title").alias("metatags_title"),
        F.col("products_narrative").alias("metatags_keywords"),
        F.col("products_narrative").alias("metatags_description"),
    )


@dataclass(frozen=True)
class TextChanges:
    """What was changed in the text tables: sparse changes by product, and the rows that each table has anew."""

    info: DataFrame
    described: DataFrame
    meta: DataFrame


def text_changes(store: Store, diff: DataFrame, new: DataFrame, settings: Settings) -> TextChanges:
    """What a run changes in the text tables of ``store``; over those it makes the tables of ``apply_products``."""
    told, meta, key = store.products_description, store.meta_tags_products_description, ["products_id", "language_id"]
    return TextChanges(
        info(diff),
        missing_rows(by_merge(told), _described(new, settings), key, unique=True),
        missing_rows(by_merge(meta), _meta(new, settings), key, unique=True),
    )


def later_changes(before: TextChanges, now: TextChanges) -> TextChanges:
    """Changes and then those of a later run as one. New products have new ids, so no earlier change meets their rows."""
    columns = before.info.columns[1:]
    later = now.info.select(F.col("products_id").alias("_id"), *[F.col(c).alias(f"_n_{c}") for c in columns])
    both = before.info.join(later, F.col("products_id") == F.col("_id"), "full_outer")
    return TextChanges(
        both.select(F.coalesce("products_id", "_id").alias("products_id"), *[F.coalesce(f"_n_{c}", c).alias(c) for c in columns]),
        before.described.unionByName(now.described),
        before.meta.unionByName(now.meta),
    )


def changed_description(table: DataFrame, changes: TextChanges) -> DataFrame:
    rows = table.unionByName(changes.described)
    return sparse_update(rows, _info_text(changes.info), ["products_id"], ["products_name", "products_description"])


def changed_meta(table: DataFrame, changes: TextChanges) -> DataFrame:
    return sparse_update(table.unionByName(changes.meta), _info_meta(changes.info), ["products_id"], _META_COLUMNS)


def changed_digests(table: DataFrame, changes: TextChanges, fold: bool = False) -> DataFrame:
    """``with_digests`` of ``changed_description``, but taken before the match: no text is shuffled."""
    short = with_digests(table.unionByName(changes.described), fold)
    return sparse_update(short, with_digests(_info_text(changes.info), fold), ["products_id"], list(_DIGESTS.values()))


def apply_to_description(table: DataFrame, diff: DataFrame, new: DataFrame, settings: Settings) -> DataFrame:
    """Text changes reach all languages of a product; new rows get the feed's language."""
    changed = sparse_update(table, _info_text(info(diff)), ["products_id"], ["products_name", "products_description"])
    key = ["products_id", "language_id"]
    return insert_ignore(changed, _described(new, settings), key, unique=True, before=by_merge(table))


def apply_to_meta(table: DataFrame, diff: DataFrame, new: DataFrame, settings: Settings) -> DataFrame:
    changed = sparse_update(table, _info_meta(info(diff)), ["products_id"], _META_COLUMNS)
    return insert_ignore(changed, _meta(new, settings), ["products_id", "language_id"], unique=True, before=by_merge(table))


def apply_products(store: Store, diff: DataFrame, new: DataFrame, settings: Settings) -> Store:
    return store.with_(
        products=apply_to_products(store.products, diff, new, settings),
        products_description=apply_to_description(store.products_description, diff, new, settings),
        meta_tags_products_description=apply_to_meta(store.meta_tags_products_description, diff, new, settings),
    )


def status_patch(diff: DataFrame, settings: Settings) -> DataFrame:
    span = settings.ids_per_statement
    on = id_list_rows(active_products(diff), "products_id", "products", "`products_status`=1", PHASE, 1, span)
    off = id_list_rows(inactive_products(diff), "products_id", "products", "`products_status`=0", PHASE, 2, span)
    return on.unionByName(off)


_BY_ID = {"products_id": "products_id"}
_META_COLUMNS = ["metatags_title", "metatags_keywords", "metatags_description"]


def info_patch(diff: DataFrame) -> DataFrame:
    changes = info(diff)
    text = {"products_name": "products_label", "products_description": "products_narrative"}
    meta = dict(zip(_META_COLUMNS, ("products_title", "products_narrative", "products_narrative")))
    return patch_rows(
        changes,
        PHASE,
        id_key("products_id"),
        {
            3: update_statement(changes, "products_description", text, _BY_ID),
            4: update_statement(changes, "meta_tags_products_description", meta, _BY_ID),
        },
    )


def vitals_patch(diff: DataFrame) -> DataFrame:
    changes = vitals(diff)
    columns = {**{v: v for v in _VITALS}, "products_price_sorter": "products_price"}
    return patch_rows(
        changes, PHASE, id_key("products_id"), {5: update_statement(changes, "products", columns, _BY_ID)}
    )


_INSERTED = [
    "products_id", "products_quantity", "products_model", "products_image", "products_price", "products_date_added",
    "products_date_available", "products_weight", "products_status", "manufacturers_id", "products_price_sorter",
    "master_categories_id",
]


def new_products_patch(new: DataFrame, settings: Settings) -> DataFrame:
    rows = store_rows(new, settings)
    language = {"language_id": F.lit(str(settings.language_id))}
    text = {"products_name": "products_name", "products_description": "products_description"}
    meta = dict(zip(_META_COLUMNS, ("products_title", "products_description", "products_description")))
    return patch_rows(
        rows,
        PHASE,
        id_key("products_id"),
        {
            6: insert_statement(rows, "products", {c: c for c in _INSERTED}),
            7: insert_statement(rows, "products_description", {**_BY_ID, **language, **text}),
            8: insert_statement(rows, "meta_tags_products_description", {**_BY_ID, **language, **meta}),
        },
    )


def product_patch(diff: DataFrame, new: DataFrame, settings: Settings) -> DataFrame:
    return (
        status_patch(diff, settings)
        .unionByName(info_patch(diff))
        .unionByName(vitals_patch(diff))
        .unionByName(new_products_patch(new, settings))
    )
