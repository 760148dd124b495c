"""Keys and texts that are equal as the store's database sees them: without case, accents and trailing blanks."""

from __future__ import annotations

import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the database sorts this letter with s, though it has no decomposition.
_MORE = {"ß": "s"}


@cache
def _plain_letters() -> tuple[str, str]:
    """Letters of the basic plane that are a letter with marks, and that letter for each."""
    found = dict(_MORE)
    for code in range(0x80, 0x10000):
        base, *marks = unicodedata.normalize("NFD", chr(code))
        if marks and all(unicodedata.category(m) == "Mn" for m in marks):
            found[chr(code)] = base
    return "".join(found), "".join(found.values())


def canonical_key(text: Column) -> Column:
    """A text that two values share if and only if the database takes them for equal.

    Plain strings with binary equality, so joins, hash aggregates and buckets on
    it work as on any other. NULL stays NULL; marks that stand alone stay.
    """
    return F.rtrim(F.lower(F.translate(text, *_plain_letters())))
