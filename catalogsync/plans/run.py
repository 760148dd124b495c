"""A run over all three phases, and the replay of recorded days."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, fields, replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogsync import schemas
from catalogsync.functions.compare import with_collation
from catalogsync.operators.merge import merge_product_feeds
from catalogsync.operators.validate import REJECTED_ROW, append_issues, issue_case, issue_rows
from catalogsync.plans import categories as C
from catalogsync.plans import placements as L
from catalogsync.plans import products as P
from catalogsync.session import by_merge, own_staging, release, stage, stage_all, staged_paths
from catalogsync.settings import REPLAY_BASE_DATE, Settings
from catalogsync.sources.snapshots import read_snapshot, recorded_days, replay_time
from catalogsync.sources.store import TABLES, Store


@dataclass(frozen=True)
class Issues:
    """The three persistent logs."""

    categories: DataFrame
    products: DataFrame
    placements: DataFrame


LOGS = tuple(f.name for f in fields(Issues))


def empty_issues(spark: SparkSession) -> Issues:
    return Issues(
        spark.createDataFrame([], schemas.CATEGORY_ISSUES),
        spark.createDataFrame([], schemas.PRODUCT_ISSUES),
        spark.createDataFrame([], schemas.PLACEMENT_ISSUES),
    )


@dataclass(frozen=True)
class RunResult:
    """Next store tables, patch and logs: all still to be computed by whoever writes them.

    ``issues`` are the whole logs, ``found`` what this run alone has found, ``texts``
    what it changes in the text tables of products.
    """

    store: Store
    patch: DataFrame
    issues: Issues
    found: Issues
    texts: P.TextChanges


def diff_categories(store: Store, departments: DataFrame, settings: Settings) -> DataFrame:
    live = C.live_categories(store.categories, store.categories_description, settings)
    return C.category_diff(live, C.import_categories(departments), settings)


def diff_products(
    store: Store,
    complete: DataFrame,
    stock: DataFrame,
    descriptions: DataFrame,
    settings: Settings,
    short: DataFrame | None = None,
) -> DataFrame:
    """The part of the product diff that has consequences. ``short`` has digests of the store's texts, if known."""
    text = ["prod_code", "prod_desc", "narrative"]
    feeds = [with_collation(f, settings.collation, text) for f in (complete, stock, descriptions)]
    # Live texts are only compared, never shown, so without a collation their digests do.
    if settings.collation is None:
        live = P.live_digests(store.products, store.products_description, settings, short)
    else:
        live = P.live_products(store.products, store.products_description, settings)
    return P.noteworthy(P.product_diff(live, merge_product_feeds(*feeds, fold=settings.fold), settings))


def run_categories(store: Store, diff: DataFrame, settings: Settings) -> tuple[Store, DataFrame, DataFrame]:
    """Store, patch and issues of the first phase, from its staged diff."""
    return C.apply_categories(store, diff, settings), C.category_patch(diff, settings), C.category_issues(diff)


@dataclass(frozen=True)
class ProductPhase:
    store: Store
    patch: DataFrame
    issues: DataFrame
    live: DataFrame
    new: DataFrame
    texts: P.TextChanges


def run_products(store: Store, diff: DataFrame, settings: Settings) -> ProductPhase:
    """The second phase, from its staged diff. Stages the numbered new products."""
    new = P.with_ids(P.new_products(diff), store.products, settings)
    known = P.live_products(store.products, store.products_description, settings)
    return ProductPhase(
        P.apply_products(store, diff, new, settings),
        P.product_patch(diff, new, settings),
        P.product_issues(diff, settings),
        known.select("products_id", "products_model"),
        new,
        P.text_changes(store, diff, new, settings),
    )


def run_placements(
    store: Store,
    links: DataFrame,
    live: DataFrame,
    new: DataFrame,
    links_before: DataFrame,
    log: DataFrame,
    settings: Settings,
) -> tuple[Store, DataFrame, DataFrame]:
    """The third phase: store, patch and issues. ``log`` holds earlier placement issues."""
    # The feed has about as many links as the store.
    rows = links_before.count()
    resolved = stage(
        L.resolve_links(L.import_links(links, store.categories, settings, rows), live, new, settings.fold), "resolved_links"
    )
    rows = max(rows, resolved.count())
    changed = stage(L.changed_links(L.own_links(links_before, settings), resolved, rows), "changed_links")
    dropped, added = L.dropped_links(changed, log), L.added_links(changed, store.categories)
    fresh = L.new_links(resolved, new, settings)
    after = stage(L.apply_links(links_before, dropped, added, fresh, rows), "links")
    masters = stage(L.assigned_masters(store.products, after, settings, rows), "masters")
    products = L.apply_masters(store.products, masters, masters.count())
    issues = L.placement_issues(
        after, products, store.products_description, store.categories, resolved, settings
    )
    return (
        store.with_(products_to_categories=after, products=products),
        L.placement_patch(dropped, added, fresh, masters),
        issues,
    )


def rejected_issues(rejected: DataFrame) -> Issues:
    """Log entries for the rows that ``feeds.rejected_rows`` lists, in the log of the phase that reads the feed."""
    entry = issue_case(F.lit(True), REJECTED_ROW, F.col("file"), F.col("record"))
    number = F.coalesce(F.trim("key").try_cast("int"), F.lit(0))

    def of(*feeds: str) -> DataFrame:
        return rejected.where(F.col("feed").isin(*feeds))

    categories = of("departments").withColumn("categories_id", number)
    products = of("complete", "stockinfo", "descriptions").withColumn("products_model", F.col("key"))
    links = of("product_department").select(
        "*", F.lit(0).alias("categories_id"), F.lit(0).alias("products_id"), F.col("key").alias("products_model")
    )
    return Issues(
        issue_rows(categories, schemas.CATEGORY_ISSUES, [entry]),
        issue_rows(products, schemas.PRODUCT_ISSUES, [entry]),
        issue_rows(links, schemas.PLACEMENT_ISSUES, [entry]),
    )


def run(
    store: Store,
    feeds: dict[str, DataFrame],
    log: Issues,
    settings: Settings,
    rejected: DataFrame | None = None,
    product_diff: DataFrame | None = None,
    short: DataFrame | None = None,
) -> RunResult:
    """One run over a store. ``feeds`` has all of ``schemas.FEEDS`` by name, ``rejected`` their flawed rows.

    ``product_diff`` is the staged outcome of ``diff_products`` where it was taken
    elsewhere, as by ``sources.ranges``; ``short`` as for that function.
    """
    diffs = {"category_diff": diff_categories(store, feeds["departments"], settings)}
    if product_diff is None:
        diffs["product_diff"] = diff_products(
            store, feeds["complete"], feeds["stockinfo"], feeds["descriptions"], settings, short
        )
    diffs = {"product_diff": product_diff} | stage_all(diffs)
    with_categories, patch_1, issues_1 = run_categories(store, diffs["category_diff"], settings)
    diff = by_merge(diffs["product_diff"], diffs["product_diff"].count())
    phase = run_products(with_categories, diff, settings)
    # Both tables are read by several steps of the next phase.
    tables = stage_all({t: getattr(phase.store, t) for t in ("categories", "products")})
    with_products = phase.store.with_(**tables)
    final, patch_3, issues_3 = run_placements(
        with_products,
        feeds["product_department"],
        phase.live,
        phase.new,
        store.products_to_categories,
        log.placements,
        settings,
    )
    if rejected is not None:
        flawed = rejected_issues(rejected)
        issues_1, issues_3 = issues_1.unionByName(flawed.categories), issues_3.unionByName(flawed.placements)
        phase = replace(phase, issues=phase.issues.unionByName(flawed.products))
    return RunResult(
        final,
        # Sorted when it is written, which reads it more than once.
        stage(patch_1.unionByName(phase.patch).unionByName(patch_3), "patch"),
        Issues(
            append_issues(log.categories, issues_1, C.ISSUE_KEY),
            append_issues(log.products, phase.issues, P.ISSUE_KEY),
            append_issues(log.placements, issues_3, L.ISSUE_KEY),
        ),
        Issues(issues_1, phase.issues, issues_3),
        phase.texts,
    )


def run_if_changed(
    changed: DataFrame, store: Store, feeds: dict[str, DataFrame], log: Issues, settings: Settings
) -> RunResult | None:
    """Skip the run when no source file changed or a feed is missing."""
    if changed.isEmpty() or set(schemas.FEEDS) - set(feeds):
        return None
    return run(store, feeds, log, settings)


def stage_store(store: Store) -> Store:
    return Store(**stage_all({t: getattr(store, t) for t in TABLES}))


_TEXTS = ("products_description", "meta_tags_products_description")


def stage_over(
    start: Store, store: Store, texts: P.TextChanges, **more: DataFrame
) -> tuple[Store, P.TextChanges, dict[str, DataFrame]]:
    """Stage ``store`` without writing its text tables anew: they are read as those of ``start``, which must stay, with ``texts``.

    Also the staged changes, and the tables of ``more``, which are staged side by side with these.
    """
    staged = stage_all({
        **{t: getattr(store, t) for t in TABLES if t not in _TEXTS},
        **{f"text_{f.name}": getattr(texts, f.name) for f in fields(texts)},
        **more,
    })
    info = staged["text_info"]
    texts = P.TextChanges(by_merge(info, info.count()), staged["text_described"], staged["text_meta"])
    after = Store(
        **{t: staged[t] for t in TABLES if t not in _TEXTS},
        products_description=P.changed_description(start.products_description, texts),
        meta_tags_products_description=P.changed_meta(start.meta_tags_products_description, texts),
    )
    return after, texts, {name: staged[name] for name in more}


def feeds_as_of(
    spark: SparkSession, root: str, day: date, recorded: dict[str, list[date]] | None = None
) -> dict[str, DataFrame]:
    """For each feed its newest record that is not younger than ``day``; ``recorded`` saves listing the days anew."""
    feeds = {}
    for name, every in (recorded or recorded_days(spark, root)).items():
        days = [d for d in every if d <= day]
        if days:
            feeds[name] = read_snapshot(spark, name, root, days[-1])
    return feeds


@own_staging()
def replay(
    store: Store,
    days: Iterable[date],
    feeds_for: Callable[[date], dict[str, DataFrame]],
    log: Issues,
    settings: Settings,
    keep: Callable[[date, RunResult], None] | None = None,
) -> tuple[Store, Issues]:
    """Run recorded days one after the other, each on the staged outcome of the one before.

    Days on which a feed has no record yet are skipped. ``keep`` may write what a
    day produced; after it, the tables that the day has staged are deleted, but
    for the store and logs that the next day starts from. The text tables of
    products are not written anew: they are read as those of ``store``, which must
    stay, and what the days have changed in them.
    """
    spark, carried, start, texts = store.products.sparkSession, [], store, None
    for day in days:
        before = staged_paths()
        feeds = feeds_for(day)
        if set(schemas.FEEDS) - set(feeds):
            continue
        short = P.changed_digests(start.products_description, texts, settings.fold) if texts else None
        days_own = replace(settings, add_date=REPLAY_BASE_DATE, new_date=replay_time(day))
        result = run(store, feeds, log, days_own, short=short)
        used = staged_paths() - before
        texts = P.later_changes(texts, result.texts) if texts else result.texts
        logs = {f"log_{n}": getattr(result.issues, n) for n in LOGS}
        store, texts, logs = stage_over(start, result.store, texts, **logs)
        made = staged_paths() - before - used
        log = Issues(**{n: logs[f"log_{n}"] for n in LOGS})
        if keep:
            keep(day, replace(result, store=store, issues=log))
        release(spark, used.union(carried))
        carried = made
    return store, log
