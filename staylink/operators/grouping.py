"""Licence/host grouping, anchors, group flags and survivor selection.

Every per-key decision is taken on a pre-aggregated (key, host) table and
joined back on the key, so no window ever holds a whole licence group: a
licence shared by a third of all rows costs one map-side partial aggregate
and one skew-split join, not one task holding that third.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geo import EARTH_KM, haversine_km
from ..functions.licence import licence_digits, licence_letters, with_canonical_license
from ..functions.text import normalize_host
from ..session import store_rows
from .filters import is_present
from .spatial import least_sum_candidates


def with_licence_columns(df: DataFrame, licence: str = "licencia", materialize: bool = True) -> DataFrame:
    """Add ``_license_norm`` (canonical licence), ``licencia_letras`` and
    ``licencia_numeros``.

    The rows are written once (``materialize``) as Parquet into the checkpoint
    folder: later filters and joins scan plain columns, pruned.  Without the cut,
    Catalyst pushes every filter on a derived key (including the inferred
    ``isnotnull`` of a join key) down through the staged projections and
    inlines each regex as many times as it is referenced, which multiplies the
    per-row work and overflows whole-stage code generation.
    """
    out = (with_canonical_license(df, licence)
           .withColumn("licencia_letras", licence_letters("_license_norm"))
           .withColumn("licencia_numeros", licence_digits("_license_norm")))
    return store_rows(out, "licence-keys") if materialize else out


def _by(by) -> list:
    return [by] if isinstance(by, str) else list(by or [])


def host_counts(df: DataFrame, key: str, host: str, by=()) -> DataFrame:
    """Per (key, host): number of rows and first row (min ``row_id``)."""
    return df.groupBy(*_by(by), key, host).agg(F.count(F.lit(1)).alias("host_rows"),
                                     F.min("row_id").alias("first_row"))


def key_summary(df: DataFrame, key: str, host: str, by=()) -> DataFrame:
    """Per key: max host repetition, number of hosts, dominant host (most
    rows; ties go to the host seen first) and that host's first row."""
    hc = host_counts(df, key, host, by)
    order = F.struct(F.negative("host_rows"), F.col("first_row"))
    return hc.groupBy(*_by(by), key).agg(
        F.max("host_rows").alias("max_rep"),
        F.count(F.lit(1)).alias("n_hosts"),
        F.min_by(F.col(host), order).alias("dom_host"),
        F.min_by(F.col("first_row"), order).alias("dom_first_row"))


def medoid_anchor(df: DataFrame, key: str, host: str, lat: str = "lat", lng: str = "lng",
                  summary: "DataFrame | None" = None, earth_km: float = EARTH_KM, by=(), exact: int = 4_000_000,
                  grids=(32, 128, 512)) -> DataFrame:
    """Per key with a repeated dominant host: the dominant-host row with the
    least summed distance to every row of the key; sums equal to the
    millimetre tie to the first row; any missing coordinate in the key makes
    the first dominant row the anchor.  Returns (key, anchor_row).

    Rows are collapsed to distinct points with weights first (a row's distance
    to itself is 0).  Keys with up to ``exact`` pairs of candidate and point are
    summed out; in larger ones bounds from grids of cells, finer each time, first
    leave the candidates that can be the medoid (:func:`least_sum_candidates`),
    until those few are summed out, so no key is compared points by points.
    """
    ks = _by(by) + [key]
    if summary is None:
        summary = key_summary(df, key, host, by)
    rep = summary.where(F.col("max_rep") >= 2).select(*ks, "dom_host", "dom_first_row")
    rows = store_rows(df.select(*ks, host, "row_id", lat, lng).join(rep, ks), "medoid-rows")
    null_keys = (rows.groupBy(*ks).agg(F.max((F.col(lat).isNull() | F.col(lng).isNull()).cast("int"))
                                       .alias("has_null")))
    rows = rows.join(null_keys, ks)
    clean = rows.where(F.col("has_null") == 0)
    points = (clean.groupBy(*ks, lat, lng).agg(F.count(F.lit(1)).alias("w"))
              .select(*ks, F.col(lat).alias("_plat"), F.col(lng).alias("_plng"), "w"))
    cands = clean.where(F.col(host) == F.col("dom_host")).select(*ks, "row_id", lat, lng)
    cand_points = cands.select(*ks, lat, lng).distinct()
    size = points.groupBy(*ks).agg(F.count(F.lit(1)).alias("_np"))
    hot = None
    for grid in grids:
        work = cand_points.groupBy(*ks).agg(F.count(F.lit(1)).alias("_nc")).join(size, ks)
        large = store_rows(work.where(F.col("_nc") > 1).where(F.col("_nc") * F.col("_np") > exact).select(*ks), "medoid-large")
        if large.isEmpty():
            break
        hot = large if hot is None else hot
        named = lambda d, la, ln: d.join(large, ks, "left_semi").withColumnsRenamed({la: "lat", ln: "lng"})
        left = least_sum_candidates(named(cand_points, lat, lng), named(points, "_plat", "_plng"), ks, grid)
        cand_points = store_rows(cand_points.join(large, ks, "left_anti")
                                 .unionByName(left.withColumnsRenamed({"lat": lat, "lng": lng})), "medoid-candidates")
    dsum = F.sum(F.col("w") * haversine_km(lat, lng, "_plat", "_plng", earth_km)).alias("_dsum")
    if hot is None:
        sums = cand_points.join(points, ks).groupBy(*ks, lat, lng).agg(dsum)
    else:
        # a large key's points are dealt to salted parts; its candidates, by now few, go to each
        salts = 16
        few = lambda d: d.join(hot, ks, "left_anti")
        many = lambda d: d.join(hot, ks, "left_semi")
        sums = (many(cand_points).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
                .join(many(points).withColumn("_salt", F.pmod(F.xxhash64("_plat", "_plng"), F.lit(salts)).cast("int")), [*ks, "_salt"])
                .groupBy(*ks, lat, lng).agg(dsum))
        sums = sums.unionByName(few(cand_points).join(few(points), ks).groupBy(*ks, lat, lng).agg(dsum))
    best = (cands.join(sums, ks + [lat, lng])
            .groupBy(*ks)
            .agg(F.min_by("row_id", F.struct(F.round("_dsum", 6), F.col("row_id"))).alias("anchor_row")))
    first = rows.where(F.col("has_null") == 1).select(*ks, F.col("dom_first_row").alias("anchor_row")).distinct()
    return best.unionByName(first)


def group_by_licence_host(df: DataFrame, key: str = "_license_norm", host: str = "_host_norm",
                          anchor: str = "first", row_suffix: bool = True,
                          lat: str = "lat", lng: str = "lng", by=()) -> DataFrame:
    """Assign ``group_id`` per licence key:

    * no host repeats and >= 2 hosts: every row ``LIC_{key}_ALL``;
    * no host repeats, one host: each row its own ``ROW_{row_id}``;
    * a host repeats: the anchor row of the dominant host and every row of the
      other hosts get ``LIC_{key}_ANCH``; remaining dominant rows ``ROW_{row_id}``.

    ``anchor='first'`` takes the dominant host's first row, ``'medoid'`` the
    geographic medoid.  ``row_suffix`` appends ``_{key}`` to ``ROW`` ids.
    """
    ks = _by(by) + [key]
    summary = store_rows(key_summary(df, key, host, by), "licence-summary")
    out = df.join(summary, ks)
    if anchor == "medoid":
        anchors = store_rows(medoid_anchor(df, key, host, lat, lng, summary=summary, by=by), "licence-anchors")
        out = out.join(anchors, ks, "left")
    elif anchor == "first":
        out = out.withColumn("anchor_row", F.col("dom_first_row"))
    else:
        raise ValueError("anchor must be 'first' or 'medoid'")
    k = F.col(key).cast("string")
    row_gid = F.concat(F.lit("ROW_"), F.col("row_id").cast("string"),
                       *( [F.lit("_"), k] if row_suffix else []))
    gid = (F.when(F.col("max_rep") == 1,
                  F.when(F.col("n_hosts") > 1, F.concat(F.lit("LIC_"), k, F.lit("_ALL"))).otherwise(row_gid))
           .when((F.col(host) != F.col("dom_host")) | (F.col("row_id") == F.col("anchor_row")),
                 F.concat(F.lit("LIC_"), k, F.lit("_ANCH")))
           .otherwise(row_gid))
    return out.withColumn("group_id", gid).drop("max_rep", "n_hosts", "dom_host", "dom_first_row", "anchor_row")


def group_by_licence_platform(df: DataFrame, licence: str = "licencia", platform: str = "plataforma",
                              by=()) -> DataFrame:
    """Cross-platform grouping: licence key, platform as host, medoid anchor,
    ``ROW_{row_id}`` ids."""
    if "_license_norm" not in df.columns:
        df = with_licence_columns(df, licence)
    d = df.withColumn("_host_norm", normalize_host(platform))
    return group_by_licence_host(d, "_license_norm", "_host_norm", anchor="medoid", row_suffix=False, by=by)


def group_licence_flags(df: DataFrame, group="group_id", licence: str = "licencia") -> DataFrame:
    """Attach per-group ``group_has_license`` and ``no_license_count``; rows
    without a group get neither (null)."""
    g = _by(group)
    d = df.withColumn("has_license", is_present(licence))
    flags = d.dropna(subset=g).groupBy(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(g)]).agg(
        F.bool_or("has_license").alias("group_has_license"),
        F.sum((~F.col("has_license")).cast("int")).alias("no_license_count"))
    joined = d.join(flags, [F.col(c) == F.col(f"_g{i}") for i, c in enumerate(g)], "left")
    return joined.drop(*[f"_g{i}" for i in range(len(g))])


def drop_lone_unlicensed(df: DataFrame, group="group_id", licence: str = "licencia") -> DataFrame:
    """Drop an unlicensed row when its group has a licence and exactly one
    unlicensed row.  Rows without a group stay."""
    f = group_licence_flags(df, group, licence)
    drop = (~F.col("has_license")) & F.col("group_has_license") & (F.col("no_license_count") == 1)
    return f.where(~F.coalesce(drop, F.lit(False))).drop("has_license", "group_has_license", "no_license_count")


def first_per_group(df: DataFrame, group="group_id", order: str = "row_id") -> DataFrame:
    """First row (least ``order``) per group, null group included as a group.

    ``order`` must be unique inside a group.  An aggregate rather than a window:
    partial aggregation runs map-side, so a hot group never lands whole in one task.
    """
    g = _by(group)
    # least key per group by hash aggregation, whole rows only through the join
    least = df.groupBy(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(g)]).agg(F.min(order).alias("_least"))
    on = [F.col(c).eqNullSafe(F.col(f"_g{i}")) for i, c in enumerate(g)] + [F.col(order).eqNullSafe(F.col("_least"))]
    return df.join(least, on, "left_semi")


def first_seen(df: DataFrame, id_col: str, order: str = "row_id") -> DataFrame:
    """Keep the first capture of each platform id (deterministic, unlike
    ``dropDuplicates``)."""
    return first_per_group(df, id_col, order)


def unlicensed_survivors(df: DataFrame, suffix: str = "Na", strict_null: bool = True,
                         group: str = "group_id", licence: str = "licencia", by=()) -> DataFrame:
    """Unlicensed rows (null licence, or also blank with ``strict_null=False``),
    first per group, group id suffixed."""
    cond = F.col(licence).isNull() if strict_null else ~is_present(licence)
    out = first_per_group(df.where(cond), _by(by) + [group])
    return out.withColumn(group, F.concat(F.col(group), F.lit(suffix))) if suffix else out


def drop_hostless_known(hostless: DataFrame, licensed: DataFrame, key: str = "_license_norm") -> DataFrame:
    """No-host rows whose canonical licence is already among licensed survivors
    leave (anti-join; null keys never match)."""
    return hostless.join(licensed.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_anti")
