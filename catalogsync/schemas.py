"""Declared layouts of feeds, store tables and issue logs. Nothing is inferred."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

MONEY = T.DecimalType(15, 4)


@dataclass(frozen=True)
class Feed:
    """A supplier file: positional columns, the one that names a row, values for missing fields, text widths.

    Only names and titles have a width, which the store's columns set. Codes are
    keys and stay whole.
    """

    name: str
    schema: T.StructType
    defaults: dict[str, object] = field(default_factory=dict)
    widths: dict[str, int] = field(default_factory=dict)

    @property
    def key(self) -> str:
        return "prod_code" if "prod_code" in self.schema.names else "dept_code"


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_INT, _TEXT, _FLOAT, _TIME = T.IntegerType(), T.StringType(), T.FloatType(), T.TimestampNTZType()

_STOCK_TAIL = dict(
    units_qty=_FLOAT, weight=_FLOAT, price=MONEY, del_date=_TEXT, discont=_INT, prod_image=_TEXT, cantsell=_INT
)
_STOCK_DEFAULTS = dict(prod_code="", prod_desc="", units_qty=0.0, weight=0.0, price=0, discont=0, cantsell=0)
_STOCK_WIDTHS = dict(prod_desc=255, del_date=20, prod_image=255)

FEEDS = {
    f.name: f
    for f in (
        Feed(
            "departments",
            _struct(dept_name=_TEXT, dept_code=_INT, dept_deep=_INT, dept_show=_INT, parent_id=_INT),
            dict(dept_name="", dept_code=0, dept_deep=0, dept_show=1, parent_id=0),
            dict(dept_name=255),
        ),
        Feed(
            "complete",
            _struct(prod_code=_TEXT, prod_desc=_TEXT, narrative=_TEXT, **_STOCK_TAIL),
            _STOCK_DEFAULTS,
            _STOCK_WIDTHS,
        ),
        Feed("stockinfo", _struct(prod_code=_TEXT, prod_desc=_TEXT, **_STOCK_TAIL), _STOCK_DEFAULTS, _STOCK_WIDTHS),
        Feed(
            "descriptions",
            _struct(prod_code=_TEXT, narrative=_TEXT),
            dict(prod_code=""),
        ),
        Feed(
            "product_department",
            _struct(prod_code=_TEXT, dept_code=_INT),
            dict(prod_code="", dept_code=0),
        ),
    )
}

STORE = {
    "categories": _struct(
        categories_id=_INT, categories_image=_TEXT, parent_id=_INT, date_added=_TIME, last_modified=_TIME,
        categories_status=_INT,
    ),
    "categories_description": _struct(
        categories_id=_INT, language_id=_INT, categories_name=_TEXT, categories_description=_TEXT
    ),
    "meta_tags_categories_description": _struct(
        categories_id=_INT, language_id=_INT, metatags_title=_TEXT, metatags_keywords=_TEXT,
        metatags_description=_TEXT,
    ),
    "products": _struct(
        products_id=_INT, products_model=_TEXT, products_image=_TEXT, products_price=MONEY, products_quantity=_FLOAT,
        products_date_added=_TIME, products_last_modified=_TIME, products_date_available=_TIME,
        products_weight=_FLOAT, products_status=_INT, master_categories_id=_INT, manufacturers_id=_INT,
        products_price_sorter=MONEY,
    ),
    "products_description": _struct(
        products_id=_INT, language_id=_INT, products_name=_TEXT, products_description=_TEXT
    ),
    "meta_tags_products_description": _struct(
        products_id=_INT, language_id=_INT, metatags_title=_TEXT, metatags_keywords=_TEXT, metatags_description=_TEXT
    ),
    "products_to_categories": _struct(products_id=_INT, categories_id=_INT),
}

CATEGORY_ISSUES = _struct(categories_id=_INT, issue=_TEXT, note_1=_TEXT, note_2=_TEXT)
PRODUCT_ISSUES = _struct(products_model=_TEXT, issue=_TEXT, note_1=_TEXT, note_2=_TEXT)
PLACEMENT_ISSUES = _struct(
    categories_id=_INT, products_id=_INT, issue=_TEXT, products_model=_TEXT, note_1=_TEXT, note_2=_TEXT
)
