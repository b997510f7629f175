"""Title and host normalisation."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import col, py_strip


def normalize_title(c: "Column | str", null_text: str | None = "nan") -> Column:
    """lower; every char outside ``[a-z0-9\\s]`` becomes a space (accents too);
    whitespace collapsed and stripped.  Callers of the reference stringify the
    column first, so null becomes the text ``nan`` (``null_text``); pass
    ``null_text=''`` for the direct-call behaviour."""
    c = col(c)
    src = c if null_text is None else F.coalesce(c, F.lit(null_text))
    s = F.regexp_replace(F.lower(src), r"[^a-z0-9\s]", " ")
    return py_strip(F.regexp_replace(s, r"\s+", " "))


def _fold_table() -> tuple[str, str]:
    """Single letters whose compatibility decomposition (NFKD) is one ASCII
    character plus combining marks, built by rule over the Latin blocks."""
    src, dst = [], []
    for cp in range(0x00C0, 0x0250):
        ch = chr(cp)
        base = "".join(x for x in unicodedata.normalize("NFKD", ch) if ord(x) < 128)
        if len(base) == 1 and base != ch:
            src.append(ch)
            dst.append(base)
    return "".join(src), "".join(dst)


FOLD_FROM, FOLD_TO = _fold_table()


def fold_title(c: "Column | str") -> Column:
    """lower, fold accents (NFKD for Latin letters), drop what is not ASCII,
    collapse whitespace; null gives ''.  Punctuation is kept."""
    s = F.translate(F.lower(F.coalesce(col(c), F.lit(""))), FOLD_FROM, FOLD_TO)
    s = F.regexp_replace(s, r"[^\x00-\x7F]", "")
    return py_strip(F.regexp_replace(s, r"\s+", " "))


def normalize_host(c: "Column | str", null_text: str | None = "nan") -> Column:
    """strip + lower; a null host (reachable only when the host is the
    platform column) becomes ``nan`` as the stringified reference does."""
    c = col(c)
    src = c if null_text is None else F.coalesce(c, F.lit(null_text))
    return F.lower(py_strip(src))
