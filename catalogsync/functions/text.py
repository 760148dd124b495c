"""Text clean-up and rendering of values."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# The 27 positions where Windows-1252 differs from ISO-8859-1.
# 81, 8D, 8F, 90 and 9D are undefined there and stay as they are.
CP1252_BYTES = "".join(
    map(
        chr,
        [0x80, 0x82, 0x83, 0x84, 0x85, 0x86, 0x87, 0x88, 0x89, 0x8A, 0x8B, 0x8C, 0x8E]
        + [0x91, 0x92, 0x93, 0x94, 0x95, 0x96, 0x97, 0x98, 0x99, 0x9A, 0x9B, 0x9C, 0x9E, 0x9F],
    )
)
CP1252_CHARS = "€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ"


def fix_cp1252(text: Column) -> Column:
    """Turn text that was read as ISO-8859-1 into what its Windows-1252 bytes meant."""
    return F.translate(text, CP1252_BYTES, CP1252_CHARS)


def clean_text(text: Column) -> Column:
    """Quotes become ``”``, runs of white space one blank, ends are trimmed."""
    quoted = F.replace(text, F.lit('"'), F.lit("”"))
    return F.trim(F.regexp_replace(quoted, r"[ \t\n\x0B\f\r]+", " "))


def prefer_nonempty(text: Column, other: Column) -> Column:
    """``other`` where the text is empty; an unknown text stays unknown."""
    return F.when(text == "", other).otherwise(text)


def or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def quoted(text: Column) -> Column:
    """A double-quoted SQL literal with backslash and quote escaped; NULL stays NULL."""
    escaped = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    escaped = F.replace(escaped, F.lit('"'), F.lit('\\"'))
    return F.concat(F.lit('"'), escaped, F.lit('"'))


def float_text(value: Column) -> Column:
    """The shortest decimal that is the float, without exponent and without a fraction of zero."""
    short = value.cast("string")
    plain = F.coalesce(short.try_cast("decimal(38,15)").cast("string"), short)
    return F.when(plain.contains("."), F.regexp_replace(plain, r"\.?0+$", "")).otherwise(plain)


def time_text(value: Column) -> Column:
    """A wall-clock time to the second, whatever the session's time zone."""
    return F.left(value.cast("string"), F.lit(19))


def wall_clock(moment: datetime) -> Column:
    """A time of the run as a value without time zone."""
    return F.lit(moment.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
