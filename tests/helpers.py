"""Small hand-made inputs in the declared layouts."""

from datetime import datetime
from decimal import Decimal

from pyspark.sql import types as T

from catalogsync.schemas import FEEDS, STORE
from catalogsync.settings import Settings
from catalogsync.sources.store import TABLES, Store

IMPORTS = 100001
SETTINGS = Settings(
    add_date=datetime(2019, 3, 13, 21, 13, 8),
    new_date=datetime(2019, 3, 14, 8, 0, 0),
    import_category_id=IMPORTS,
    priority=(56, 234),
    always_inactive=(29,),
)


def _frame(spark, schema, rows, fill):
    def value(field, row):
        given = row.get(field.name, fill.get(field.name))
        if isinstance(field.dataType, T.DecimalType) and given is not None:
            return Decimal(str(given))
        if isinstance(field.dataType, T.FloatType) and given is not None:
            return float(given)
        return given

    return spark.createDataFrame([tuple(value(f, r) for f in schema) for r in rows], schema)


def feed(spark, name, *rows):
    spec = FEEDS[name]
    return _frame(spark, spec.schema, rows, spec.defaults)


_FILL = {
    "categories": dict(parent_id=0, categories_status=1),
    "categories_description": dict(language_id=1),
    "meta_tags_categories_description": dict(language_id=1),
    "products": dict(
        products_price=0, products_quantity=0, products_weight=0, products_status=1, master_categories_id=0,
        products_price_sorter=0, manufacturers_id=1,
    ),
    "products_description": dict(language_id=1),
    "meta_tags_products_description": dict(language_id=1),
    "products_to_categories": {},
}


def store(spark, **tables):
    return Store(**{t: _frame(spark, STORE[t], tables.get(t, ()), _FILL[t]) for t in TABLES})


def rows(df, *columns):
    """Rows as tuples, in order."""
    found = [tuple(r) for r in df.select(*columns).collect()]
    return sorted(found, key=lambda t: [(v is not None, v) for v in t])


def one(df, key, value):
    found = [r for r in df.collect() if r[key] == value]
    assert len(found) == 1, found
    return found[0]
