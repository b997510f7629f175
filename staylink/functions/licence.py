"""Tourist-licence canonicalisation, as Column expressions.

``normalize_license`` cleans the raw text; ``canonical_license`` maps the
lettered block to its licence family.  Both are pure Catalyst expressions, so
they run inside whole-stage codegen.  Operators materialise the normalised
text as a column first so the canonical step reuses it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import col, nullif_blank, py_strip

# Patterns that define licence canonicalisation.
YEAR_SUFFIX = r"[,/]\s*(?:19|20)\d{2}"
REGISTRY_PREFIXED = r"ESFCTU\d+([A-Z]+)[/\s]*(\d+)"
L_NUMBER = r"L(\d+[A-Z]?\d*)"
LETTERS_THEN_DIGITS = r"([A-Z]+)(\d+)"
DIGITS_THEN_LETTERS = r"(\d+)([A-Z]+)"


def normalize_license(c: "Column | str") -> Column:
    """Upper-case, strip, drop a trailing year; then the registry-prefix rule,
    the ``L<digits>`` rule, or keep only ``[A-Z0-9]``.  Null gives ''."""
    raw = col(c)
    s = F.regexp_replace(py_strip(F.upper(raw)), YEAR_SUFFIX, "")
    l_part = F.regexp_extract(s, L_NUMBER, 1)
    l_tail = F.regexp_extract(l_part, r"(\d+)$", 1)
    return (F.when(raw.isNull(), F.lit(""))
            .when(s.rlike(REGISTRY_PREFIXED),
                  F.concat(F.regexp_extract(s, REGISTRY_PREFIXED, 1),
                           F.regexp_extract(s, REGISTRY_PREFIXED, 2)))
            .when(l_part != "",
                  F.concat(F.lit("L"), F.when(l_tail != "", l_tail)
                           .otherwise(F.regexp_replace(l_part, "[^0-9]", ""))))
            .otherwise(F.regexp_replace(s, "[^A-Z0-9]", "")))


def canonical_from_normalized(n: "Column | str") -> Column:
    """Family of an already-normalised licence: the first letters+digits block
    (else digits+letters, swapped) decides; A or H keeps it, E gives ETV, V and
    T give VT; no block keeps the normalised text."""
    n = col(n)
    fwd = n.rlike(LETTERS_THEN_DIGITS)
    rev = n.rlike(DIGITS_THEN_LETTERS)
    letters = (F.when(fwd, F.regexp_extract(n, LETTERS_THEN_DIGITS, 1))
               .otherwise(F.regexp_extract(n, DIGITS_THEN_LETTERS, 2)))
    num = (F.when(fwd, F.regexp_extract(n, LETTERS_THEN_DIGITS, 2))
           .otherwise(F.regexp_extract(n, DIGITS_THEN_LETTERS, 1)))
    block = F.concat(letters, num)
    return (F.when(n == "", F.lit(""))
            .when(~(fwd | rev), n)
            .when(letters.contains("A") | letters.contains("H"), block)
            .when(letters.contains("E"), F.concat(F.lit("ETV"), num))
            .when(letters.contains("V") & letters.contains("T"), F.concat(F.lit("VT"), num))
            .otherwise(block))


def canonical_license(c: "Column | str") -> Column:
    return canonical_from_normalized(normalize_license(c))


def with_canonical_license(df, licence: str = "licencia", out: str = "_license_norm",
                           keep_clean: "str | None" = None):
    """Staged form for DataFrames: each intermediate is its own column, so the
    optimiser keeps one copy of every regex instead of nesting the whole
    normalisation inside each branch of the canonical step."""
    d = (df.withColumn("_ls", F.regexp_replace(py_strip(F.upper(F.col(licence))), YEAR_SUFFIX, ""))
           .withColumn("_lp", F.regexp_extract("_ls", L_NUMBER, 1))
           .withColumn("_lx", F.regexp_extract("_lp", r"(\d+)$", 1))
           .withColumn("_lc", F.when(F.col(licence).isNull(), F.lit(""))
                       .when(F.col("_ls").rlike(REGISTRY_PREFIXED),
                             F.concat(F.regexp_extract("_ls", REGISTRY_PREFIXED, 1),
                                      F.regexp_extract("_ls", REGISTRY_PREFIXED, 2)))
                       .when(F.col("_lp") != "",
                             F.concat(F.lit("L"), F.when(F.col("_lx") != "", F.col("_lx"))
                                      .otherwise(F.regexp_replace("_lp", "[^0-9]", ""))))
                       .otherwise(F.regexp_replace("_ls", "[^A-Z0-9]", "")))
           .withColumn("_lf", F.col("_lc").rlike(LETTERS_THEN_DIGITS))
           .withColumn("_lr", F.col("_lc").rlike(DIGITS_THEN_LETTERS))
           .withColumn("_lt", F.when(F.col("_lf"), F.regexp_extract("_lc", LETTERS_THEN_DIGITS, 1))
                       .otherwise(F.regexp_extract("_lc", DIGITS_THEN_LETTERS, 2)))
           .withColumn("_ln", F.when(F.col("_lf"), F.regexp_extract("_lc", LETTERS_THEN_DIGITS, 2))
                       .otherwise(F.regexp_extract("_lc", DIGITS_THEN_LETTERS, 1))))
    lt, ln = F.col("_lt"), F.col("_ln")
    d = d.withColumn(out, F.when(F.col("_lc") == "", F.lit(""))
                     .when(~(F.col("_lf") | F.col("_lr")), F.col("_lc"))
                     .when(lt.contains("A") | lt.contains("H"), F.concat(lt, ln))
                     .when(lt.contains("E"), F.concat(F.lit("ETV"), ln))
                     .when(lt.contains("V") & lt.contains("T"), F.concat(F.lit("VT"), ln))
                     .otherwise(F.concat(lt, ln)))
    if keep_clean:
        d = d.withColumnRenamed("_lc", keep_clean)
    return d.drop("_ls", "_lp", "_lx", "_lc", "_lf", "_lr", "_lt", "_ln")


def licence_letters(canonical: "Column | str") -> Column:
    """Leading letters of the canonical licence, null when there are none."""
    return nullif_blank(F.regexp_extract(col(canonical), r"^([A-Za-z]+)", 1))


def licence_digits(canonical: "Column | str") -> Column:
    """Trailing digits of the canonical licence, null when there are none."""
    return nullif_blank(F.regexp_extract(col(canonical), r"(\d+)$", 1))


def split_licence_parts(canonical: "Column | str") -> tuple[Column, Column]:
    return licence_letters(canonical), licence_digits(canonical)
