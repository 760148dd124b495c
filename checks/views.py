"""Feeds, store tables and media derived from the given tables (see FIXTURES.md, part B).

Everything is a lazy DataFrame over whole tables, so it grows with them.
"""

from __future__ import annotations

from datetime import date, datetime
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogsync import session
from catalogsync.schemas import FEEDS, MONEY
from catalogsync.session import by_merge, spread, stage
from catalogsync.settings import Settings
from catalogsync.sources.store import Store

IMPORT_CATEGORY = 100001
# Own products lie below, the store's own products above.
PRODUCT_BOUND = 1_000_000_000
# Second products of a model, which lose to the first.
SECOND_COPY = 500_000_000

SETTINGS = Settings(
    add_date=datetime(2019, 3, 13, 21, 13, 8),
    new_date=datetime(2019, 3, 14, 21, 13, 8),
    import_category_id=IMPORT_CATEGORY,
    product_id_bound=PRODUCT_BOUND,
    priority=(1054, 1234, 1115, 1012, 1200, 1201, 1243, 1193),
    always_inactive=(1054, 1115, 107),
)
SNAPSHOT_DAYS = [date(2019, 3, 14), date(2019, 3, 15), date(2019, 3, 16)]

_c = F.col


def _float(value: Column) -> Column:
    return value.cast("float")


def _time(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def _leaf(brand: Column) -> Column:
    return F.lit(1000) + brand * 10 + _c("p_size") % 6


_views: dict[tuple, Views] = {}


def views(spark: SparkSession, sf_dir: str) -> Views:
    """The views of a folder, made once per application, and anew for other sizes of tasks: listing files and reading footers takes time."""
    sizes = (session.ROWS_OF_A_TASK, spark.conf.get("spark.sql.shuffle.partitions"))
    key = (spark.sparkContext.applicationId, sf_dir, *sizes)
    if key not in _views:
        _views[key] = Views(spark, sf_dir)
    return _views[key]


class Views:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._tables[name]

    @cached_property
    def parts(self) -> DataFrame:
        code = F.concat(F.lit("P"), F.lpad(_c("p_partkey").cast("string"), 10, "0"))
        return self.table("part").select(
            _c("p_partkey").alias("pk"),
            code.alias("code"),
            F.expr("cast(substr(p_brand, 7) as int)").alias("bn"),
            "p_brand",
            "p_size",
            "p_retailprice",
            F.concat_ws(" ", "p_name", "p_brand").alias("label"),
            F.concat(F.replace("p_name", F.lit(" "), F.lit("")), (_c("p_partkey") % 50).cast("string")).alias("stem"),
        )

    @cached_property
    def told_parts(self) -> DataFrame:
        """Parts with the text of the document of the same number."""
        text = self.table("documents").select(_c("doc_id").alias("pk"), "text")
        return self.parts.join(by_merge(text), "pk", "left")

    # categories ---------------------------------------------------------

    @cached_property
    def _leaves(self) -> DataFrame:
        return self.parts.select("bn", "p_brand", (_c("p_size") % 6).alias("cls")).distinct()

    def _leaf_name(self, between: str | Column) -> Column:
        between = F.lit(between) if isinstance(between, str) else between
        return F.concat(_c("p_brand"), between, _c("cls").cast("string"))

    @cached_property
    def live_categories(self) -> DataFrame:
        regions = self.table("region").select(
            (_c("r_regionkey") + 1).alias("categories_id"),
            F.lit(0).alias("parent_id"),
            _c("r_name").alias("categories_description"),
            F.lit(1).alias("categories_status"),
            F.lit(False).alias("edited"),
        )
        key = _c("n_nationkey")
        nations = (
            self.table("nation")
            .where(key % 9 != 4)
            .select(
                key + 100,
                _c("n_regionkey") + 1,
                "n_name",
                F.when(key % 6 == 0, 0).otherwise(1),
                key % 8 == 3,
            )
        )
        mix = _c("bn") + _c("cls")
        leaves = self._leaves.where(mix % 7 != 0).select(
            F.lit(1000) + _c("bn") * 10 + _c("cls"),
            F.lit(100) + _c("bn") % 25,
            self._leaf_name(" size class "),
            F.lit(1),
            mix % 5 == 0,
        )
        rows = regions.union(nations).union(leaves)
        return rows.select(
            "categories_id",
            F.lit(None).cast("string").alias("categories_image"),
            "parent_id",
            _time("2019-01-01 00:00:00").alias("date_added"),
            F.when(_c("edited"), _time("2019-02-01 00:00:00")).alias("last_modified"),
            "categories_status",
            "categories_description",
        )

    @cached_property
    def feed_categories(self) -> DataFrame:
        region = _c("r_regionkey")
        regions = self.table("region").where(region != 4).select(
            _c("r_name").alias("dept_name"),
            (region + 1).alias("dept_code"),
            F.lit(1).alias("dept_deep"),
            F.lit(1).alias("dept_show"),
            F.lit(0).alias("parent_id"),
        )
        key, parent = _c("n_nationkey"), _c("n_regionkey") + 1
        longer = F.concat("n_name", F.lit(" renamed and padded past thirty-two chars"))
        nations = self.table("nation").where(key % 11 != 7).select(
            F.when(key % 5 == 2, longer).otherwise(_c("n_name")),
            key + 100,
            F.lit(2),
            F.when((key % 6).isin(0, 1), 0).otherwise(1),
            F.when(key % 7 == 5, parent % 5 + 1).otherwise(parent),
        )
        bn = _c("bn")
        leaves = self._leaves.where((bn + _c("cls")) % 9 != 0).select(
            self._leaf_name(F.when(bn % 6 == 1, " size group ").otherwise(" size class ")),
            F.lit(1000) + bn * 10 + _c("cls"),
            F.lit(3),
            F.when(bn % 8 == 3, 0).otherwise(1),
            F.when(bn == 9, 777).otherwise(F.lit(100) + bn % 25),
        )
        # One sentinel row, as the feed has it.
        sentinel = self.table("region").where(region == 0).select(
            F.lit("sentinel"), F.lit(-1), F.lit(0), F.lit(1), F.lit(0)
        )
        return regions.union(nations).union(leaves).union(sentinel)

    # products -----------------------------------------------------------

    @cached_property
    def products(self) -> DataFrame:
        pk = _c("pk")
        image = F.lower(F.concat(F.left("stem", F.lit(2)), F.lit("/"), "stem", F.lit(".jpg")))
        price = _c("p_retailprice").cast(MONEY)
        return self.parts.where(pk % 10 != 0).select(
            (pk + 1).cast("int").alias("products_id"),
            _c("code").alias("products_model"),
            image.alias("products_image"),
            price.alias("products_price"),
            _float(_c("p_size")).alias("products_quantity"),
            _time("2019-01-01 00:00:00").alias("products_date_added"),
            F.when(pk % 13 == 0, _time("2019-02-01 00:00:00")).alias("products_last_modified"),
            _time("2019-01-02 00:00:00").alias("products_date_available"),
            _float(pk % 7 + 1).alias("products_weight"),
            F.when(pk % 9 == 0, 0).otherwise(1).alias("products_status"),
            F.lit(IMPORT_CATEGORY).alias("master_categories_id"),
            F.lit(1).alias("manufacturers_id"),
            price.alias("products_price_sorter"),
        )

    @cached_property
    def products_description(self) -> DataFrame:
        return self.told_parts.where(_c("pk") % 10 != 0).select(
            (_c("pk") + 1).cast("int").alias("products_id"),
            F.lit(1).alias("language_id"),
            F.left("label", F.lit(64)).alias("products_name"),
            F.coalesce("text", F.lit("")).alias("products_description"),
        )

    @cached_property
    def feed_complete(self) -> DataFrame:
        pk = _c("pk")
        ext = F.when(pk % 3 == 0, ".jpeg").otherwise(".jpg")
        return self.told_parts.where(pk % 11 != 3).select(
            _c("code").alias("prod_code"),
            F.when(pk % 12 == 5, F.concat("label", F.lit(" " + "x" * 60))).otherwise(_c("label")).alias("prod_desc"),
            F.when(pk % 14 == 6, "").otherwise(_c("text")).alias("narrative"),
            _float(F.when(pk % 8 == 1, 0).otherwise(_c("p_size"))).alias("units_qty"),
            _float(pk % 7 + 1).alias("weight"),
            (_c("p_retailprice") + F.when(pk % 7 == 2, 1).otherwise(0)).cast(MONEY).alias("price"),
            F.concat(F.replace("stem", F.lit("r"), F.lit(" r")), ext).alias("prod_image"),
            F.when(pk % 15 == 4, 1).otherwise(0).alias("cantsell"),
        )

    @cached_property
    def feed_stock(self) -> DataFrame:
        pk = _c("pk")
        more = F.when(pk % 5 == 1, 2).otherwise(0)
        return self.parts.where(
            ((pk % 6 != 0) & (pk % 11 != 3)) | ((pk % 11 == 3) & (pk % 3 == 0))
        ).select(
            _c("code").alias("prod_code"),
            F.when(pk % 16 == 7, F.concat("label", F.lit(" restocked"))).otherwise(_c("label")).alias("prod_desc"),
            _float(_c("p_size") + more).alias("units_qty"),
            _float(pk % 7 + 1 + F.when(pk % 17 == 8, 1).otherwise(0)).alias("weight"),
            (_c("p_retailprice") + more).cast(MONEY).alias("price"),
            F.concat("stem", F.lit(".jpg")).alias("prod_image"),
            F.when(pk % 19 == 9, 1).otherwise(0).alias("cantsell"),
        )

    @cached_property
    def feed_descriptions(self) -> DataFrame:
        pk = _c("pk")
        about = F.concat(F.lit("About "), _c("label"), F.lit(". "), F.coalesce("text", F.lit("")))
        return self.told_parts.where(
            ((pk % 4 == 1) & (pk % 11 != 3)) | ((pk % 11 == 3) & (pk % 3).isin(0, 1))
        ).select(_c("code").alias("prod_code"), F.when(pk % 18 == 1, "").otherwise(about).alias("narrative"))

    # links --------------------------------------------------------------

    @cached_property
    def links(self) -> DataFrame:
        """(pk, code, cid): own leaf, leaves by supplier, and for some the brand's category, which is no leaf.

        Live links and feed links are both cut from it; lazy, so that building a query runs no job but a count of footers.
        """
        rows = self.table("lineitem").count()
        own = self.parts.select("pk", "code", _leaf(_c("bn")).alias("cid"))
        # Pairs of part and nation first: a part may have any share of the line items.
        items = self.table("lineitem").select(_c("l_partkey").alias("pk"), _c("l_suppkey").alias("s_suppkey"))
        sold = (
            spread(items, rows, "pk", "s_suppkey")
            .distinct()
            .join(self.table("supplier").select("s_suppkey", "s_nationkey"), "s_suppkey")
            .select("pk", "s_nationkey")
        )
        sold = spread(sold, rows, "pk").distinct()
        by_supplier = by_merge(self.parts).join(sold, "pk").select("pk", "code", _leaf((_c("bn") + _c("s_nationkey")) % 25 + 1))
        upper = self.parts.where("pk % 20 = 0").select("pk", "code", F.lit(100) + _c("bn") % 25)
        return spread(own.union(by_supplier).union(upper), rows, "pk").distinct()

    @cached_property
    def at_rest(self) -> Views:
        """The same views with the link table staged, for queries that read it several times, as a run reads files."""
        return self._resting(links=stage(self.links, "links"))

    @cached_property
    def texts_at_rest(self) -> Views:
        """The same views with the parts and their texts staged: a run finds the texts of feeds and store in files."""
        return self._resting(told_parts=stage(self.told_parts, "told_parts"))

    def _resting(self, **staged: DataFrame) -> Views:
        other = Views(self.spark, self.sf_dir)
        other._tables = self._tables
        held = {name: self.__dict__[name] for name in ("links", "told_parts") if name in self.__dict__}
        other.__dict__.update(held | staged)
        return other

    @cached_property
    def feed_links(self) -> DataFrame:
        good = self.links.where((_c("pk") + _c("cid")) % 10 != 0).select(
            _c("code").alias("prod_code"), _c("cid").cast("int").alias("dept_code")
        )
        no_category = self.parts.where("pk % 33 = 0").select("code", F.lit(99999))
        no_product = self.parts.where("pk % 40 = 0").select(F.concat(F.lit("X"), "code"), _leaf(_c("bn")))
        return good.union(no_category).union(no_product)

    @cached_property
    def live_links(self) -> DataFrame:
        return self.links.where((_c("pk") % 10 != 0) & ((_c("pk") + _c("cid")) % 9 != 0)).select(
            (_c("pk") + 1).cast("int").alias("products_id"),
            _c("cid").cast("int").alias("categories_id"),
            _c("code").alias("products_model"),
        )

    @cached_property
    def placement_log(self) -> DataFrame:
        """Issues of an earlier run: some products on a category that is no leaf."""
        pk = _c("pk")
        return self.parts.where(pk % 14 == 3).select(
            (F.lit(100) + _c("bn") % 25).alias("categories_id"),
            (pk + 1).cast("int").alias("products_id"),
            F.lit("Non-leaf category placement").alias("issue"),
            _c("code").alias("products_model"),
            F.lit(None).cast("string").alias("note_1"),
            F.lit(None).cast("string").alias("note_2"),
        )

    # store --------------------------------------------------------------

    @cached_property
    def store(self) -> Store:
        """The seven store tables behind the live views, all rows in the feed's language."""
        categories, told = self.live_categories, self.products_description
        text = _c("categories_description")
        return Store(
            categories=categories.drop("categories_description"),
            categories_description=categories.select(
                "categories_id",
                F.lit(1).alias("language_id"),
                F.left(text, F.lit(32)).alias("categories_name"),
                text.alias("categories_description"),
            ),
            meta_tags_categories_description=categories.select(
                "categories_id",
                F.lit(1).alias("language_id"),
                F.left(text, F.lit(64)).alias("metatags_title"),
                text.alias("metatags_keywords"),
                text.alias("metatags_description"),
            ),
            products=self.products,
            products_description=told,
            meta_tags_products_description=told.select(
                "products_id",
                "language_id",
                _c("products_name").alias("metatags_title"),
                _c("products_description").alias("metatags_keywords"),
                _c("products_description").alias("metatags_description"),
            ),
            products_to_categories=self.live_links.select("products_id", "categories_id"),
        )

    @cached_property
    def mixed_store(self) -> Store:
        """The same with rows of the store's own, second languages, gaps, repeated models and control links."""
        base = self.store

        def languages(table: DataFrame, key: str, text: str) -> DataFrame:
            first = table.where(_c(key) % 10 != 7)
            second = (
                table.where(_c(key) % 3 == 0)
                .withColumn("language_id", F.lit(2))
                .withColumn(text, F.concat(text, F.lit(" (2)")))
            )
            return first.unionByName(second)

        def shifted(table: DataFrame, key: str, by: int) -> DataFrame:
            return table.withColumn(key, _c(key) + by)

        products = base.products
        copies = shifted(products.where("products_id % 50 = 1"), "products_id", SECOND_COPY)
        links = base.products_to_categories
        return base.with_(
            categories=base.categories.unionByName(shifted(base.categories, "categories_id", IMPORT_CATEGORY)),
            categories_description=languages(base.categories_description, "categories_id", "categories_description"),
            products=products.unionByName(copies).unionByName(shifted(products, "products_id", PRODUCT_BOUND)),
            products_description=languages(base.products_description, "products_id", "products_description"),
            products_to_categories=links.unionByName(shifted(links, "products_id", PRODUCT_BOUND)).unionByName(
                products.select("products_id", F.lit(IMPORT_CATEGORY).alias("categories_id"))
            ),
        )

    # media and snapshots ------------------------------------------------

    @cached_property
    def media(self) -> DataFrame:
        pk, v, stem = _c("pk"), _c("v"), _c("stem")
        kinds = self.parts.select("pk", "code", "stem", F.explode(F.array(*map(F.lit, (1, 2, 3, 4)))).alias("v"))
        name = (
            F.when(v == 1, F.concat(F.upper(stem), F.lit(".JPEG")))
            .when(v == 2, F.concat(stem, F.lit("_z.jpg")))
            .when(v == 3, F.concat(stem, F.lit("t.jpg")))
            .otherwise(F.concat(stem, F.lit("_a.jpg")))
        )
        return kinds.where((pk + v) % 5 != 0).select(
            F.when(v == 2, "large z").when(v == 3, "thumb t").otherwise("").alias("dir"),
            name.alias("name"),
            ((pk * 31 + v * 17) % 997 + 1000).cast("bigint").alias("length"),
            F.md5(F.concat("code", v.cast("string"))).alias("md5"),
        )

    @cached_property
    def media_current(self) -> DataFrame:
        path = F.lower(F.concat(F.left("stem", F.lit(2)), F.lit("/"), "stem", F.lit(".jpg")))
        return (
            self.parts.where("pk % 6 <> 0")
            .groupBy(path.alias("key"))
            .agg(
                F.min(F.when(_c("pk") % 4 == 0, 0).otherwise(1000)).cast("bigint").alias("length"),
                F.min(F.md5(F.concat("code", F.lit("2")))).alias("md5"),
            )
        )

    @cached_property
    def media_inventory(self) -> DataFrame:
        """The supplier's originals: the same names with an upper-case stem and a lower-case extension."""
        stem, ext = F.regexp_replace("name", r"\.[^.]*$", ""), F.regexp_extract("name", r"[^.]*$", 0)
        return self.media.select("dir", F.concat(F.upper(stem), F.lit("."), F.lower(ext)).alias("name"), "length", "md5")

    def feeds_of(self, number: int) -> dict[str, DataFrame]:
        """All feeds of a recorded day: categories and links stay, stock changes, the others are empty."""
        empty = {n: self.spark.createDataFrame([], FEEDS[n].schema) for n in ("complete", "descriptions")}
        return dict(
            empty, departments=self.feed_categories, stockinfo=self.snapshot(number), product_department=self.feed_links
        )

    def snapshot(self, number: int) -> DataFrame:
        """The stock feed of a recorded day."""
        pk = _c("pk")
        shift = pk + number
        price = _c("p_retailprice") + F.when(shift % 4 == 0, number).otherwise(0)
        marked = F.when(shift % 12 == 5, f" v{number}").otherwise("")
        return self.parts.where(shift % 10 != 0).select(
            _c("code").alias("prod_code"),
            F.concat(_c("label"), marked).alias("prod_desc"),
            _float((_c("p_size") + pk * number) % 6).alias("units_qty"),
            _float(F.lit(0)).alias("weight"),
            price.cast(MONEY).alias("price"),
            F.lit(None).cast("string").alias("prod_image"),
            F.lit(0).alias("cantsell"),
        )
