"""Categories: live snapshot, feed, change sets, checks, next tables and patch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalogsync.functions.compare import differs, with_collation
from catalogsync.functions.keys import canonical_key
from catalogsync.functions.text import or_empty, wall_clock
from catalogsync.operators.apply import insert_ignore, override, update
from catalogsync.operators.diff import in_both, only_in_feed, only_in_live, snapshot_diff
from catalogsync.operators.merge import first_wins_counted
from catalogsync.operators.render import id_key, insert_statement, patch_rows, update_statement
from catalogsync.operators.validate import (
    DUPLICATE_KEY,
    INACTIVE_PARENT,
    INVALID_PARENT,
    issue_case,
    issue_rows,
    too_long,
)
from catalogsync.schemas import CATEGORY_ISSUES
from catalogsync.settings import CATEGORY_NAME_WIDTH, META_TITLE_WIDTH, Settings
from catalogsync.sources.store import Store

PHASE = 1
ISSUE_KEY = ["categories_id", "issue"]


def _short_name() -> Column:
    return F.left(F.col("categories_description"), F.lit(CATEGORY_NAME_WIDTH)).alias("categories_name")


def in_language(rows: DataFrame, description: DataFrame, key: str, settings: Settings) -> DataFrame:
    """Rows with their description in the feed's language, or without any description.

    By default a row described in other languages only takes no part.
    """
    wanted = F.col("language_id") == settings.language_id
    if settings.keep_other_language_rows:
        return rows.join(description.where(wanted), key, "left")
    return rows.join(description, key, "left").where(wanted | F.col("language_id").isNull())


def live_categories(categories: DataFrame, description: DataFrame, settings: Settings) -> DataFrame:
    own = categories.where(F.col("categories_id") < settings.category_id_bound)
    text = description.select("categories_id", "language_id", "categories_description")
    return in_language(own, text, "categories_id", settings).select(
        "categories_id",
        "categories_image",
        "parent_id",
        "date_added",
        "last_modified",
        "categories_status",
        or_empty(F.col("categories_description")).alias("categories_description"),
    )


def import_categories(feed: DataFrame) -> DataFrame:
    """Departments as categories, without sentinels; of repeated codes the one loaded first by depth and parent."""
    kept = first_wins_counted(
        feed.where(F.col("dept_code") >= 0).select("dept_code", "dept_deep", "parent_id", "dept_name", "dept_show"),
        ["dept_code"],
        [F.col("dept_deep"), F.col("parent_id")],
        "feed_rows",
    )
    return kept.select(
        F.col("dept_code").alias("categories_id"),
        "parent_id",
        F.col("dept_name").alias("categories_description"),
        F.col("dept_show").alias("categories_status"),
        "feed_rows",
    )


def category_diff(live: DataFrame, feed: DataFrame, settings: Settings) -> DataFrame:
    text, compared = ["categories_description"], "categories_description"
    if settings.fold:
        compared = "text_key"
        live, feed = (side.withColumn(compared, canonical_key(F.col(text[0]))) for side in (live, feed))
    return snapshot_diff(
        with_collation(live, settings.collation, text),
        with_collation(feed, settings.collation, text),
        "categories_id",
        compare=[compared, "parent_id", "categories_status"],
    )


def new_categories(diff: DataFrame) -> DataFrame:
    rows = diff.where(only_in_feed()).select(
        F.col("feed_categories_id").alias("categories_id"),
        F.col("feed_parent_id").alias("parent_id"),
        F.col("feed_categories_description").alias("categories_description"),
        F.col("feed_categories_status").alias("categories_status"),
    )
    return rows.select(
        "categories_id", "parent_id", _short_name(), "categories_description", "categories_status"
    )


def dropped_categories(diff: DataFrame) -> DataFrame:
    return diff.where(only_in_live()).select(F.col("live_categories_id").alias("categories_id"))


def unchanged_categories(diff: DataFrame) -> DataFrame:
    return diff.where(in_both() & (F.col("change_kind") == "unchanged")).select(
        F.col("live_categories_id").alias("categories_id")
    )


def reparented_categories(diff: DataFrame) -> DataFrame:
    """Moves; an edit by the store's owner does not stop them."""
    return diff.where(in_both() & differs(F.col("feed_parent_id"), F.col("live_parent_id"))).select(
        F.col("live_categories_id").alias("categories_id"), F.col("feed_parent_id").alias("parent_id")
    )


def renamed_categories(diff: DataFrame) -> DataFrame:
    """New texts of categories that the store's owner has not edited."""
    text = "text_key" if "live_text_key" in diff.columns else "categories_description"
    changed = differs(F.col(f"feed_{text}"), F.col(f"live_{text}"))
    rows = diff.where(in_both() & changed & F.col("live_last_modified").isNull()).select(
        F.col("live_categories_id").alias("categories_id"),
        F.col("feed_categories_description").alias("categories_description"),
    )
    return rows.select("categories_id", _short_name(), "categories_description")


def category_status(diff: DataFrame) -> DataFrame:
    """Status by the feed where it differs, and 0 for all dropped ones; ``stored`` is the live status."""
    changed = in_both() & differs(F.col("feed_categories_status"), F.col("live_categories_status"))
    return diff.where(only_in_live() | changed).select(
        F.col("live_categories_id").alias("categories_id"),
        F.when(F.col("in_feed").isNull(), 0).otherwise(F.col("feed_categories_status")).alias("categories_status"),
        F.col("live_categories_status").alias("stored"),
    )


def category_issues(diff: DataFrame) -> DataFrame:
    """Cut names, parents that are gone or unknown, inactive parents of active children, repeated codes.

    All three parent checks look the parent up in the diff itself: every known
    category has one row there. Children are listed once for what the feed
    says and once for what the store has.
    """
    new = only_in_feed()
    moved = new | (in_both() & (F.col("change_kind") == "changed"))
    children = diff.select(
        F.explode(
            F.array(
                F.struct(
                    F.when(moved, F.col("feed_categories_id")).alias("categories_id"),
                    F.col("feed_parent_id").alias("parent_id"),
                    new.alias("check_parent"),
                    (F.col("feed_categories_status") == 1).alias("active"),
                ),
                F.struct(
                    F.col("live_categories_id").alias("categories_id"),
                    F.col("live_parent_id").alias("parent_id"),
                    F.lit(True).alias("check_parent"),
                    F.lit(False).alias("active"),
                ),
            )
        ).alias("c")
    ).select("c.*").where(F.col("categories_id").isNotNull())
    parents = diff.select(
        F.coalesce("feed_categories_id", "live_categories_id").alias("_id"),
        only_in_live().alias("_dropped"),
        (moved & (F.col("feed_categories_status") == 0)).alias("_inactive"),
    )
    looked_up = children.join(parents, F.col("parent_id") == F.col("_id"), "left")
    unknown = F.col("_id").isNull() & (F.col("parent_id") != 0)
    invalid = F.col("check_parent") & (F.coalesce("_dropped", F.lit(False)) | unknown)
    inactive = F.col("active") & F.col("_inactive")
    note = F.col("parent_id")
    text = F.col("feed_categories_description")
    feed_rows = diff.where(F.col("in_feed").isNotNull()).withColumn("categories_id", F.col("feed_categories_id"))
    return issue_rows(
        feed_rows,
        CATEGORY_ISSUES,
        [
            too_long(F.when(new, F.left(text, F.lit(CATEGORY_NAME_WIDTH))), text),
            issue_case(F.col("feed_feed_rows") > 1, DUPLICATE_KEY, F.col("feed_feed_rows")),
        ],
    ).unionByName(
        issue_rows(
            looked_up,
            CATEGORY_ISSUES,
            [issue_case(invalid, INVALID_PARENT, note), issue_case(inactive, INACTIVE_PARENT, note)],
        )
    )


def _with_meta(rows: DataFrame) -> DataFrame:
    text = F.col("categories_description")
    return rows.withColumns(
        {
            "metatags_title": F.left(text, F.lit(META_TITLE_WIDTH)),
            "metatags_keywords": text,
            "metatags_description": text,
        }
    )


def apply_to_categories(categories: DataFrame, diff: DataFrame, settings: Settings) -> DataFrame:
    """The next ``categories`` table: one update for moves and status, new rows, then the fixed inactive list."""
    changes = diff.where(in_both() & (F.col("change_kind") == "changed") | only_in_live()).select(
        F.col("live_categories_id").alias("categories_id"),
        F.coalesce("feed_parent_id", "live_parent_id").alias("parent_id"),
        F.when(F.col("in_feed").isNull(), 0)
        .otherwise(F.coalesce("feed_categories_status", "live_categories_status"))
        .alias("categories_status"),
    )
    new = new_categories(diff).withColumn("date_added", wall_clock(settings.add_date))
    status = {"categories_status": F.lit(1)}
    if not settings.insert_status:
        new = new.drop("categories_status")
    moved = update(categories, changes, ["categories_id"], ["parent_id", "categories_status"])
    grown = insert_ignore(moved, new, ["categories_id"], status, unique=True, before=categories)
    return override(grown, F.col("categories_id").isin(list(settings.always_inactive)), "categories_status", 0)


def _apply_text(table: DataFrame, new: DataFrame, renamed: DataFrame, columns: list[str], language: int) -> DataFrame:
    key = ["categories_id", "language_id"]
    lang = F.lit(language)
    changed = update(table, renamed.withColumn("language_id", lang), key, columns)
    return insert_ignore(changed, new.withColumn("language_id", lang), key, unique=True, before=table)


def apply_categories(store: Store, diff: DataFrame, settings: Settings) -> Store:
    new, renamed, lang = new_categories(diff), renamed_categories(diff), settings.language_id
    return store.with_(
        categories=apply_to_categories(store.categories, diff, settings),
        categories_description=_apply_text(
            store.categories_description, new, renamed, ["categories_name", "categories_description"], lang
        ),
        meta_tags_categories_description=_apply_text(
            store.meta_tags_categories_description,
            _with_meta(new),
            _with_meta(renamed),
            ["metatags_title", "metatags_keywords", "metatags_description"],
            lang,
        ),
    )


def category_patch(diff: DataFrame, settings: Settings) -> DataFrame:
    same_id = {"categories_id": "categories_id"}
    in_lang = {**same_id, "language_id": F.lit(str(settings.language_id))}
    inserted = {"categories_id": "categories_id", "parent_id": "parent_id", "date_added": "date_added"}
    if settings.insert_status:
        inserted["categories_status"] = "categories_status"
    text = {"categories_name": "categories_name", "categories_description": "categories_description"}
    meta = {c: c for c in ("metatags_title", "metatags_keywords", "metatags_description")}
    moved, status = {"parent_id": "parent_id"}, {"categories_status": "categories_status"}
    texts, metas = "categories_description", "meta_tags_categories_description"

    new = _with_meta(new_categories(diff)).withColumn("date_added", wall_clock(settings.add_date))
    renamed = _with_meta(renamed_categories(diff))
    reparented = reparented_categories(diff)
    switched = category_status(diff).where(differs(F.col("stored"), F.col("categories_status")))

    key = id_key("categories_id")
    patch = (
        patch_rows(
            new,
            PHASE,
            key,
            {
                1: insert_statement(new, "categories", inserted),
                2: insert_statement(new, texts, {**same_id, **text}),
                3: insert_statement(new, metas, {**same_id, **meta}),
            },
        )
        .unionByName(
            patch_rows(reparented, PHASE, key, {4: update_statement(reparented, "categories", moved, same_id)})
        )
        .unionByName(
            patch_rows(
                renamed,
                PHASE,
                key,
                {
                    5: update_statement(renamed, texts, text, in_lang),
                    6: update_statement(renamed, metas, meta, in_lang),
                },
            )
        )
        .unionByName(patch_rows(switched, PHASE, key, {7: update_statement(switched, "categories", status, same_id)}))
    )
    if not settings.always_inactive:
        return patch
    ids = ",".join(map(str, settings.always_inactive))
    fixed = F.lit(f"UPDATE `categories` SET `categories_status`=0 WHERE `categories_id` IN ({ids});")
    return patch.unionByName(patch_rows(diff.sparkSession.range(1), PHASE, F.lit(""), {8: fixed}))
