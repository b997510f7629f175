"""Row filters and projections (all pushed into whole-stage codegen)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions._util import col

# Licence letter classes and property types that are not
# holiday rentals and leave the catalogue.
EXCLUDED_LICENCE_LETTERS = ["AG", "AT", "A", "H", "HA", "HT", "APM", "PM", "TI", "HPM"]
EXCLUDED_LICENCE_CONTAINS = "EDIFICI"
EXCLUDED_PROPERTY_TYPES = ["Hotel", "Apartahotel", "Agroturismo", "Hostal o pensión", "Apartotel",
                           "Complejo turístico", "Albergue", "Resort", "Suite", "Aparthotel", "Camping"]
RESELLER_HOSTS = "Vrbo|Booking.com"
NOT_PROVIDED = "No proporcionado"
# Fill tokens of the matcher's preprocessing.
UNKNOWN_HOST = "host_desconocido"
UNKNOWN_TYPE = "tipo_desconocido"
UNKNOWN_PLATFORM = "platform_desconocido"


def is_present(c: "Column | str") -> Column:
    """Not null and not blank (any whitespace counts as blank)."""
    return F.coalesce(col(c).rlike(r"\S"), F.lit(False))


def blank_sentinel(c: "Column | str", value: str = NOT_PROVIDED) -> Column:
    c = col(c)
    return F.when(c == value, F.lit("")).otherwise(c)


def drop_reseller_hosts(df: DataFrame, pattern: str = RESELLER_HOSTS, host: str = "anfitrion") -> DataFrame:
    """Drop rows whose host matches ``pattern``; a null host is kept."""
    return df.where(~F.coalesce(F.col(host).rlike(pattern), F.lit(False)))


def split_host_presence(df: DataFrame, host: str = "anfitrion", licence: str = "licencia"):
    """(host and licence present, host missing)."""
    return (df.where(is_present(host) & is_present(licence)), df.where(~is_present(host)))


def drop_missing(df: DataFrame, cols) -> DataFrame:
    return df.na.drop(subset=list(cols))


def drop_licence_classes(df: DataFrame, letters_col: str = "licencia_letras",
                         letters=EXCLUDED_LICENCE_LETTERS, contains: str = EXCLUDED_LICENCE_CONTAINS) -> DataFrame:
    """Remove non-rental licence classes; null letters are kept."""
    c = F.col(letters_col)
    bad = F.coalesce(c.isin(list(letters)), F.lit(False)) | F.coalesce(
        F.upper(c).contains(contains.upper()), F.lit(False))
    return df.where(~bad)


def drop_property_types(df: DataFrame, types=EXCLUDED_PROPERTY_TYPES, tipo: str = "tipo") -> DataFrame:
    """Remove hotel-like property types (exact match); null types are kept."""
    return df.where(~F.coalesce(F.col(tipo).isin(list(types)), F.lit(False)))


def exclude_anchored(df: DataFrame, group: str = "group_id") -> DataFrame:
    """Drop rows of anchored licence groups (they are not clean training labels)."""
    return df.where(~F.coalesce(F.col(group).contains("ANCH"), F.lit(False)))


def fill_defaults(df: DataFrame, missing: str = "exclude") -> DataFrame:
    """Fill tokens of the matcher.  ``missing='origin'`` also fills capacity
    with -1 and null coordinates with (0, 0) as the scoring step does."""
    fills = {"habitaciones": -1, "anfitrion": UNKNOWN_HOST, "tipo": UNKNOWN_TYPE,
             "plataforma": UNKNOWN_PLATFORM}
    if missing == "origin":
        fills.update({"capacidad": -1, "lat": 0.0, "lng": 0.0})
    elif missing != "exclude":
        raise ValueError("missing must be 'exclude' or 'origin'")
    return df.na.fill({k: v for k, v in fills.items() if k in df.columns})


def derive_type(nombre: "Column | str") -> Column:
    """First word of the card title; 'Casa' and 'Apto.' mapped; blank -> ''."""
    first = F.element_at(F.split(F.regexp_replace(col(nombre), r"^\s+", ""), r"\s+"), 1)
    first = F.when(col(nombre).isNull(), F.lit("")).otherwise(F.coalesce(first, F.lit("")))
    return (F.when(first == "Casa", F.lit("Casa rural"))
            .when(first == "Apto.", F.lit("Apartamento")).otherwise(first))


# Public listing URL patterns.
URL_PATTERNS = {
    "booking": ("https://www.booking.com/hotel/es/", ".es.html"),
    "holidu": ("https://www.holidu.es/d/", ""),
}


def listing_url(platform: str, listing_id: "Column | str") -> Column:
    prefix, suffix = URL_PATTERNS[platform]
    return F.concat(F.lit(prefix), col(listing_id), F.lit(suffix))


def clean_url(url: "Column | str") -> Column:
    """Drop the query string."""
    return F.substring_index(col(url), "?", 1)


def url_listing_id(url: "Column | str") -> Column:
    """Last path segment of the cleaned URL."""
    return F.substring_index(clean_url(url), "/", -1)


def stamp_snapshot(df: DataFrame, fecha: str, isla: "str | None" = None, kind: "str | None" = None) -> DataFrame:
    """Add the run date (a parameter, never the wall clock), island and kind."""
    out = df.withColumn("fecha", F.to_date(F.lit(fecha)))
    if isla is not None:
        out = out.withColumn("isla", F.lit(isla))
    if kind is not None:
        out = out.withColumn("alojamiento", F.lit(kind))
    return out


def parse_result_count(text: "Column | str") -> Column:
    """Results heading -> count: 'Más de' -> 1000; digits with '.' thousands
    separators; no digits or a no-match banner -> 0; no heading -> -1."""
    t = col(text)
    digits = F.regexp_extract(t, r"(\d[\d.]*)", 1)
    return (F.when(t.isNull(), F.lit(-1))
            .when(t.contains("Más de"), F.lit(1000))
            .when(digits != "", F.regexp_replace(digits, r"[.\s]", "").cast("long"))
            .otherwise(F.lit(0)).cast("long"))
