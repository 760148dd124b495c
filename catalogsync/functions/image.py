"""Image names: the path a product refers to, and the parts of a media file's name."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def tidy_image_name(name: Column) -> Column:
    """Drop blanks and settle on the short extensions. Case matters here, and it runs before folding."""
    for old, new in ((" ", ""), (".jpeg", ".jpg"), (".tiff", ".tif")):
        name = F.replace(name, F.lit(old), F.lit(new))
    return name


def prefixed(name: Column) -> Column:
    """``ab/abc.jpg`` for ``abc.jpg``."""
    return F.concat(F.left(name, F.lit(2)), F.lit("/"), name)


def image_path(raw_name: Column) -> Column:
    return F.lower(prefixed(tidy_image_name(raw_name)))


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def extension(name: Column) -> Column:
    return F.regexp_extract(name, r"\.([^.]*)$", 1)


def stem(name: Column) -> Column:
    return F.regexp_replace(name, r"\.[^.]*$", "")


def short_extension(ext: Column) -> Column:
    return F.when(ext == "jpeg", "jpg").when(ext == "tiff", "tif").otherwise(ext)


def long_extension(ext: Column) -> Column:
    """The other spelling of an extension, NULL where there is none."""
    return F.when(ext == "jpg", "jpeg").when(ext == "tif", "tiff")


def size_suffix(directory: Column) -> Column:
    """``t`` or ``z`` for a folder such as ``thumb t``; empty for the top folder."""
    return F.regexp_extract(base_name(directory), r".\s([tz])$", 1)


def without_mark(name_stem: Column) -> Column:
    """Drop a trailing underscore and the one character after it."""
    return F.regexp_replace(name_stem, r"_.$", "")
