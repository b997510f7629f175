from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: "Column | str") -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c: Column) -> Column:
    """Python ``str.strip()``: trims every kind of whitespace, not only spaces."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def nullif_blank(c: Column) -> Column:
    """``regexp_extract`` gives '' where Python's ``re`` gives None."""
    return F.when(c != "", c)
