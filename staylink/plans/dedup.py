"""Composed flows: within-platform de-duplication, cross-platform catalogue.

All platforms are processed in one job: the platform is part of every
grouping key, so there is no per-platform loop on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions._util import py_strip
from ..functions.text import normalize_host, normalize_title
from ..operators import filters as flt
from ..operators import grouping as grp
from ..operators.graph import cluster_seeded
from ..operators.joins import merge_numeric_letter
from ..operators.ordering import union_listings
from ..operators.similarity import title_similarity_edges
from ..operators.survivors import hostless_groups, platform_catalogue, split_groups_by_distance

LISTING_COLS = ["row_id", "property_id", "plataforma", "anfitrion", "licencia", "lat", "lng",
                "capacidad", "habitaciones", "nombre", "tipo"]
OUT_COLS = LISTING_COLS + ["group_id", "_license_norm", "licencia_letras", "licencia_numeros"]


def holidu_cleanup(df: DataFrame, platform: str = "holidu") -> DataFrame:
    """Holidu only: 'No proporcionado' licences blanked, reseller hosts dropped."""
    is_p = F.col("plataforma") == platform
    d = df.withColumn("licencia", F.when(is_p, flt.blank_sentinel("licencia")).otherwise(F.col("licencia")))
    return d.where(~is_p | ~F.coalesce(F.col("anfitrion").rlike(flt.RESELLER_HOSTS), F.lit(False)))


def licensed_survivors(d: DataFrame) -> DataFrame:
    """Hosted and licensed rows grouped by (platform, canonical licence, host);
    first row per group."""
    hl = grp.with_licence_columns(d.where(flt.is_present("anfitrion") & flt.is_present("licencia")))
    hl = hl.withColumn("_host_norm", normalize_host("anfitrion"))
    g = grp.group_by_licence_host(hl, by=["plataforma"])
    return grp.first_per_group(g, ["plataforma", "group_id"])


def title_clusters(d: DataFrame, metric: str = "ratio") -> DataFrame:
    """(row_id, dup_group_id) for rows with coordinates: seeded clustering over
    200 m / same configuration / title ratio >= 0.7 edges, per platform."""
    t = d.where(F.col("lat").isNotNull() & F.col("lng").isNotNull()) \
         .withColumn("title_norm", normalize_title("nombre"))
    edges = title_similarity_edges(t, metric=metric)
    return cluster_seeded(t.select("row_id"), edges)


def platform_parts(df: DataFrame, metric: str = "ratio") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(licensed survivors, unlicensed survivors, rows without a host) of every
    platform."""
    d = holidu_cleanup(df.select(*LISTING_COLS))
    lic = licensed_survivors(d)
    cl = title_clusters(d, metric)
    th = d.join(cl, "row_id").where(flt.is_present("anfitrion"))
    th = th.withColumn("_license_norm", F.upper(py_strip(F.col("dup_group_id").cast("string")))) \
           .withColumn("_host_norm", normalize_host("anfitrion"))
    g2 = grp.group_by_licence_host(th, by=["plataforma"], row_suffix=False)
    g2 = grp.drop_lone_unlicensed(g2, ["plataforma", "group_id"])
    unl = grp.unlicensed_survivors(g2, by=["plataforma"])
    nohost = d.where(~flt.is_present("anfitrion"))
    cols = LISTING_COLS + ["group_id"]
    return lic.select(*cols), unl.select(*cols), nohost.select(*LISTING_COLS)


def within_platform_dedup(df: DataFrame, metric: str = "ratio") -> DataFrame:
    return catalogue_filters(platform_catalogue(*platform_parts(df, metric)))


def catalogue_filters(df: DataFrame) -> DataFrame:
    """Canonical licence parts for every row, then the licence-class,
    property-type and missing-capacity filters."""
    d = grp.with_licence_columns(df)
    d = flt.drop_licence_classes(d)
    d = flt.drop_property_types(d)
    return flt.drop_missing(d, ["capacidad"]).select(*OUT_COLS)


def cross_platform_dedup(df: DataFrame) -> DataFrame:
    """Lone-unlicensed drop on the incoming groups -> unlicensed survivors;
    licence/platform groups with medoid anchors -> numeric/lettered merge ->
    2 km split -> first per group; no-host rows whose licence is known leave;
    union."""
    nh = hostless_groups(df)
    unl = grp.drop_lone_unlicensed(df, "group_id")
    unl = grp.first_per_group(unl.where(F.col("licencia").isNull()), "group_id")
    lic = df.where(flt.is_present("plataforma") & flt.is_present("licencia")).drop(
        "_license_norm", "licencia_letras", "licencia_numeros", "group_id")
    g = grp.group_by_licence_platform(grp.with_licence_columns(lic))
    g = merge_numeric_letter(g)
    g = split_groups_by_distance(g, 2.0)
    surv = grp.first_per_group(g, "group_id")
    nh = grp.drop_hostless_known(nh, surv)
    # row ids are unique in each part and group ids differ between the parts, so no two rows are equal
    cols = OUT_COLS
    return union_listings(surv.select(*cols), unl.select(*cols), nh.select(*cols))


def catalogue(*dfs: DataFrame) -> DataFrame:
    """Final de-duplicated union of catalogue parts."""
    return union_listings(*dfs).distinct()
