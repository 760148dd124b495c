"""Names of files below a folder."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def below(path: Column | str, root: str) -> Column:
    """What remains of a file's path below ``root``, so that files of equal base names in different folders differ."""
    folder = "/" + re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(?://[^/]*)?", "", root).strip("/") + "/"
    at = F.locate(folder, F.col(path) if isinstance(path, str) else path)
    whole = F.col(path) if isinstance(path, str) else path
    # A root that names a file has nothing below it; then the base name is left.
    return F.when(at > 0, F.substr(whole, at + F.lit(len(folder)))).otherwise(F.substring_index(whole, "/", -1))
