"""Run parameters."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

# First id that belongs to the store's own rows, language of the
# feed, placeholder master category of merged feed rows, and the categories
# that stay inactive whatever the feed says.
ID_BOUND = 100001
LANGUAGE_ID = 1
STAGING_MASTER_CATEGORY = 5000
ALWAYS_INACTIVE_CATEGORIES = (29, 33, 250, 278, 524, 421, 6, 14, 124, 396, 619)

# Column widths that cut text short.
CATEGORY_NAME_WIDTH = 32
PRODUCT_NAME_WIDTH = 64
META_TITLE_WIDTH = 64

# Fixed value: wall-clock time given to a replayed day, and the created-date
# of rows that already existed when a catalogue is rebuilt by replay.
REPLAY_TIME = "21:13:08"
REPLAY_BASE_DATE = datetime(2018, 10, 31, 21, 13, 8)


@dataclass(frozen=True)
class Settings:
    """What a run needs to know besides its data.

    ``priority`` lists category ids from most to least wanted as a product's
    master category. ``collation`` names a Spark collation for all text
    compares; ``None`` compares bytes. ``fold`` compares codes and texts as the
    store's database does, by canonical keys in place of a collation: case,
    accents and trailing blanks make no difference, rows keep their spelling.
    """

    add_date: datetime
    new_date: datetime
    import_category_id: int
    category_id_bound: int = ID_BOUND
    product_id_bound: int = ID_BOUND
    language_id: int = LANGUAGE_ID
    manufacturer_id: int = 1
    priority: tuple[int, ...] = ()
    always_inactive: tuple[int, ...] = ALWAYS_INACTIVE_CATEGORIES
    collation: str | None = None
    fold: bool = False
    insert_status: bool = False
    quarantine_description_only: bool = False
    check_new_text: bool = False
    keep_other_language_rows: bool = False
    ids_per_statement: int = 1000
