"""Named queries: each takes (spark, sf_dir) and returns a DataFrame built
from the driver's tables (the listing view is derived from ``orders``)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.licence import licence_digits, licence_letters, with_canonical_license
from ..functions.text import fold_title, normalize_host, normalize_title
from ..operators import filters as flt
from ..operators import grouping as grp
from ..operators import quality as q
from ..session import checkpoint_dir, store_rows
from ..sources.tables import load_listings

QUERIES: dict = {}


def query(fn):
    QUERIES[fn.__name__.removeprefix("q_")] = fn
    return fn


def hosted_licensed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hosted and licensed listings with canonical licence and host keys."""
    d = load_listings(spark, sf_dir)
    d = d.where(flt.is_present("anfitrion") & flt.is_present("licencia"))
    return grp.with_licence_columns(d).withColumn("_host_norm", normalize_host("anfitrion"))


def licence_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grp.group_by_licence_host(hosted_licensed(spark, sf_dir), by=["plataforma"])


@query
def q_canonical_license(spark, sf_dir):
    d = with_canonical_license(load_listings(spark, sf_dir), keep_clean="_lic_clean")
    d = d.withColumn("licencia_letras", licence_letters("_license_norm")) \
         .withColumn("licencia_numeros", licence_digits("_license_norm"))
    return d.select("row_id", "licencia", "_lic_clean", "_license_norm", "licencia_letras", "licencia_numeros")


@query
def q_normalize_title(spark, sf_dir):
    d = load_listings(spark, sf_dir)
    return d.select("row_id", normalize_title("nombre").alias("title_norm"),
                    fold_title("nombre").alias("title_fold"),
                    normalize_host("anfitrion").alias("host_norm"))


@query
def q_group_by_licence_host(spark, sf_dir):
    return licence_groups(spark, sf_dir).select("row_id", "plataforma", "_license_norm", "_host_norm", "group_id")


@query
def q_licence_group_summary(spark, sf_dir):
    """Flagship slice: canonical licence -> per-platform licence/host groups ->
    first row per group -> survivors per (platform, group kind)."""
    g = licence_groups(spark, sf_dir)
    first = grp.first_per_group(g, ["plataforma", "group_id"])
    kind = F.when(F.col("group_id").endswith("_ALL"), "ALL").when(F.col("group_id").endswith("_ANCH"), "ANCH") \
            .otherwise("ROW")
    return (first.groupBy("plataforma", kind.alias("group_kind"))
                 .agg(F.count(F.lit(1)).alias("groups"), F.sum("capacidad").alias("capacity"),
                      F.min("row_id").alias("first_row_id")))


@query
def q_host_coverage(spark, sf_dir):
    return q.host_coverage(load_listings(spark, sf_dir))


@query
def q_hostless_licence_coverage(spark, sf_dir):
    return q.hostless_licence_coverage(load_listings(spark, sf_dir))


@query
def q_usable_coverage(spark, sf_dir):
    return q.usable_coverage(load_listings(spark, sf_dir))


# --- filters and projections -------------------------------------------------

from ..operators import joins as jn  # noqa: E402
from ..operators import ordering as ordr  # noqa: E402
from ..operators import survivors as sv  # noqa: E402
from ..operators.graph import cluster_seeded, connected_components  # noqa: E402
from ..operators.similarity import title_candidate_report, title_similarity_edges  # noqa: E402
from . import dedup  # noqa: E402


@query
def q_holidu_cleanup(spark, sf_dir):
    """blank_sentinel + drop_reseller_hosts on the Holidu rows."""
    d = dedup.holidu_cleanup(load_listings(spark, sf_dir))
    return d.select("row_id", "plataforma", "anfitrion", "licencia")


@query
def q_split_host_presence(spark, sf_dir):
    usable, nohost = flt.split_host_presence(load_listings(spark, sf_dir))
    a = usable.groupBy("plataforma").agg(F.count(F.lit(1)).alias("rows")).withColumn("subset", F.lit("usable"))
    b = nohost.groupBy("plataforma").agg(F.count(F.lit(1)).alias("rows")).withColumn("subset", F.lit("no_host"))
    return a.unionByName(b)


@query
def q_class_filters(spark, sf_dir):
    """split_licence_parts + drop_licence_classes + drop_property_types + drop_missing."""
    d = grp.with_licence_columns(load_listings(spark, sf_dir))
    d = flt.drop_missing(flt.drop_property_types(flt.drop_licence_classes(d)), ["capacidad"])
    return d.select("row_id", "_license_norm", "licencia_letras", "licencia_numeros", "tipo")


@query
def q_listing_projections(spark, sf_dir):
    """listing_url, clean_url, derive_type, stamp_snapshot, is_present."""
    d = load_listings(spark, sf_dir)
    pid = F.col("property_id").cast("string")
    url = F.concat(F.lit("https://www.airbnb.es/rooms/"), pid, F.lit("?check_in=2025-07-01&adults=2"))
    d = flt.stamp_snapshot(d, "2025-06-25", kind="Entire home/apt")
    return d.select("row_id", flt.listing_url("booking", pid).alias("booking_url"),
                    flt.listing_url("holidu", pid).alias("holidu_url"),
                    flt.clean_url(url).alias("clean_url"), flt.url_listing_id(url).alias("listing_id"),
                    flt.derive_type("nombre").alias("derived_tipo"), F.col("fecha").cast("string").alias("fecha"),
                    "alojamiento", flt.is_present("anfitrion").alias("host_present"))


@query
def q_parse_result_count(spark, sf_dir):
    """Result headings rendered from the listing counts per (platform, type),
    parsed back: thousands separators, 'Más de', banners, missing heading."""
    c = load_listings(spark, sf_dir).groupBy("plataforma", "tipo").agg(F.count(F.lit(1)).alias("n"))
    fmt = F.regexp_replace(F.format_number(F.col("n"), 0), ",", ".")
    heading = (F.when(F.col("tipo") == "Hotel", F.lit(None).cast("string"))
               .when(F.col("tipo") == "Finca", F.lit("No hay coincidencias exactas"))
               .when(F.col("n") > 1000, F.lit("Más de 1.000 alojamientos"))
               .otherwise(F.concat(fmt, F.lit(" alojamientos"))))
    return c.select("plataforma", "tipo", "n", heading.alias("heading"),
                    flt.parse_result_count(heading).alias("parsed"))


@query
def q_fill_defaults(spark, sf_dir):
    """fill_defaults (origin mode) + exclude_anchored over platform groups."""
    d = dedup_input(spark, sf_dir)
    g = grp.group_by_licence_platform(d)
    g = flt.exclude_anchored(g)
    return flt.fill_defaults(g.select("row_id", "anfitrion", "tipo", "plataforma", "habitaciones",
                                      "capacidad", "lat", "lng", "group_id"), missing="origin")


# --- joins ---------------------------------------------------------------------

def dedup_input(spark, sf_dir):
    """Rows with platform and licence present (the cross-platform grouping input)."""
    d = load_listings(spark, sf_dir)
    return d.where(flt.is_present("plataforma") & flt.is_present("licencia"))


@query
def q_tag_island(spark, sf_dir):
    return jn.tag_island(load_listings(spark, sf_dir)).select("row_id", "isla")


@query
def q_snapshot_counts(spark, sf_dir):
    return q.snapshot_counts(jn.tag_island(load_listings(spark, sf_dir)))


@query
def q_radius_join(spark, sf_dir):
    """same_config_pairs: 200 m (index radius) and equal capacity and rooms, per platform."""
    d = load_listings(spark, sf_dir)
    return jn.radius_join(d, 0.2, equal_on=["plataforma", "capacidad", "habitaciones"])


@query
def q_radius_join_model(spark, sf_dir):
    """500 m with capacity/rooms filled with -1 (nulls match), across platforms."""
    d = flt.fill_defaults(load_listings(spark, sf_dir), missing="exclude").na.fill({"capacidad": -1})
    return jn.radius_join(d, 0.5, equal_on=["capacidad", "habitaciones"], null_equal=True)


@query
def q_group_by_licence_platform(spark, sf_dir):
    g = grp.group_by_licence_platform(dedup_input(spark, sf_dir))
    return g.select("row_id", "_license_norm", "_host_norm", "group_id")


@query
def q_medoid_anchor(spark, sf_dir):
    d = grp.with_licence_columns(dedup_input(spark, sf_dir)).withColumn("_host_norm", normalize_host("plataforma"))
    return grp.medoid_anchor(d, "_license_norm", "_host_norm")


@query
def q_host_counts(spark, sf_dir):
    return grp.host_counts(hosted_licensed(spark, sf_dir), "_license_norm", "_host_norm", by=["plataforma"])


def platform_groups(spark, sf_dir):
    return grp.group_by_licence_platform(grp.with_licence_columns(dedup_input(spark, sf_dir)))


@query
def q_merge_numeric_letter(spark, sf_dir):
    g = jn.merge_numeric_letter(platform_groups(spark, sf_dir))
    return g.select("row_id", "licencia_letras", "licencia_numeros", "group_id")


@query
def q_split_groups_by_distance(spark, sf_dir):
    g = sv.split_groups_by_distance(jn.merge_numeric_letter(platform_groups(spark, sf_dir)), 2.0)
    return g.select("row_id", "group_id")


@query
def q_drop_hostless_known(spark, sf_dir):
    g = sv.split_groups_by_distance(jn.merge_numeric_letter(platform_groups(spark, sf_dir)), 2.0)
    surv = grp.first_per_group(g, "group_id")
    nh = sv.hostless_groups(load_listings(spark, sf_dir))
    return grp.drop_hostless_known(nh, surv).select("row_id", "group_id", "_license_norm", "_host_norm")


@query
def q_hostless_groups(spark, sf_dir):
    return sv.hostless_groups(load_listings(spark, sf_dir)).select("row_id", "group_id", "_license_norm",
                                                                    "_host_norm")


@query
def q_coverage_gaps(spark, sf_dir):
    """Planned listings (all) against collected ones (those a collector could
    place: coordinates present); the gap is the rows never collected."""
    d = load_listings(spark, sf_dir)
    collected = d.where(F.col("lat").isNotNull())
    return jn.coverage_gaps(d.select("row_id", "plataforma"), collected, "row_id")


# --- grouping / survivors -------------------------------------------------------

@query
def q_group_licence_flags(spark, sf_dir):
    g = licence_groups(spark, sf_dir)
    g = grp.group_licence_flags(g, ["plataforma", "group_id"])
    return g.select("row_id", "has_license", "group_has_license", "no_license_count")


@query
def q_drop_lone_unlicensed(spark, sf_dir):
    """Grouping by (platform, property) as the incoming group, then the lone
    unlicensed drop."""
    d = load_listings(spark, sf_dir).withColumn("group_id", F.concat(F.lit("P"), F.col("property_id").cast("string")))
    return grp.drop_lone_unlicensed(d, ["plataforma", "group_id"]).select("row_id", "group_id")


@query
def q_drop_lone_unlicensed_by_host(spark, sf_dir):
    """Groups of (platform, host, capacity, rooms): hundreds of them have one
    unlicensed row, which goes."""
    d = load_listings(spark, sf_dir)
    d = d.withColumn("group_id", F.concat_ws("/", "anfitrion", F.col("property_id") % 97, "habitaciones"))
    return grp.drop_lone_unlicensed(d, ["plataforma", "group_id"]).select("row_id", "group_id")


@query
def q_unlicensed_survivors(spark, sf_dir):
    d = load_listings(spark, sf_dir).withColumn("group_id", F.concat(F.lit("P"), F.col("property_id").cast("string")))
    return grp.unlicensed_survivors(d, by=["plataforma"]).select("row_id", "plataforma", "group_id")


@query
def q_first_seen(spark, sf_dir):
    """First capture per platform id (property id within a platform)."""
    d = load_listings(spark, sf_dir)
    return grp.first_per_group(d, ["plataforma", "property_id"]).select("plataforma", "property_id", "row_id")


@query
def q_first_per_group(spark, sf_dir):
    g = licence_groups(spark, sf_dir)
    return grp.first_per_group(g, ["plataforma", "group_id"]).select("plataforma", "group_id", "row_id", "nombre")


# --- graph ------------------------------------------------------------------------

def _title_input(spark, sf_dir):
    d = load_listings(spark, sf_dir)
    return d.where(F.col("lat").isNotNull() & F.col("lng").isNotNull()).withColumn(
        "title_norm", normalize_title("nombre"))


@query
def q_title_edges_levenshtein(spark, sf_dir):
    return title_similarity_edges(_title_input(spark, sf_dir), metric="levenshtein") \
        .select("src", "dst", F.round("similarity", 6).alias("similarity"))


@query
def q_title_similarity_edges(spark, sf_dir):
    return title_similarity_edges(_title_input(spark, sf_dir)) \
        .select("src", "dst", F.round("similarity", 6).alias("similarity"))


def _loose_titles(spark, sf_dir):
    """Titles without their numbers' first digits and places: neighbours of
    other names, so that the title threshold rejects."""
    t = _title_input(spark, sf_dir)
    return t.withColumn("title_norm", F.regexp_replace("title_norm", "^(casa|villa|finca|hotel) ", ""))


@query
def q_title_candidate_report(spark, sf_dir):
    """Pairs within 8 km of one platform, whatever their size: what the
    bounds leave for the Python step."""
    return title_candidate_report(_loose_titles(spark, sf_dir), radius_m=8000.0, on=())


@query
def q_title_edges_loose(spark, sf_dir):
    """Levenshtein edges within 8 km at 0.8, of which the threshold rejects most."""
    t = _loose_titles(spark, sf_dir)
    return title_similarity_edges(t, radius_m=8000.0, threshold=0.8, metric="levenshtein").select(
        "src", "dst", F.round("similarity", 6).alias("similarity"))


@query
def q_connected_components(spark, sf_dir):
    t = _title_input(spark, sf_dir)
    e = title_similarity_edges(t, metric="levenshtein")
    return connected_components(e, t.select("row_id"))


@query
def q_cluster_seeded(spark, sf_dir):
    t = _title_input(spark, sf_dir)
    return cluster_seeded(t.select("row_id"), title_similarity_edges(t))


@query
def q_cluster_seeded_levenshtein(spark, sf_dir):
    t = _title_input(spark, sf_dir)
    return cluster_seeded(t.select("row_id"), title_similarity_edges(t, metric="levenshtein"))


# --- ordering, sets ------------------------------------------------------------------

@query
def q_add_row_id(spark, sf_dir):
    """Dense 0-based position per platform in (licence, row_id) order."""
    d = load_listings(spark, sf_dir).select("row_id", "plataforma", F.coalesce("licencia", F.lit("")).alias("lic"))
    return ordr.add_row_id(d, ["lic", "row_id"], name="pos", partition_by="plataforma")


@query
def q_union_listings(spark, sf_dir):
    d = load_listings(spark, sf_dir)
    only = lambda p, *cols: d.where(F.col("plataforma") == p).select("row_id", "nombre", *cols)
    return ordr.union_listings(only("airbnb", "lat"), only("booking", "capacidad"), only("holidu", "lat"), only("vrbo", "capacidad"))


@query
def q_distinct_listings(spark, sf_dir):
    d = load_listings(spark, sf_dir)
    return ordr.distinct_listings(d.select("property_id", "plataforma", "tipo", "habitaciones"))


# --- composed flows (rows-only) ------------------------------------------------------

@query
def q_within_platform_dedup(spark, sf_dir):
    return dedup.within_platform_dedup(load_listings(spark, sf_dir))


@query
def q_cross_platform_dedup(spark, sf_dir):
    return dedup.cross_platform_dedup(store_rows(dedup.within_platform_dedup(load_listings(spark, sf_dir)), "within"))


@query
def q_within_platform_dedup_levenshtein(spark, sf_dir):
    return dedup.within_platform_dedup(load_listings(spark, sf_dir), metric="levenshtein")


@query
def q_cross_platform_dedup_levenshtein(spark, sf_dir):
    within = dedup.within_platform_dedup(load_listings(spark, sf_dir), metric="levenshtein")
    return dedup.cross_platform_dedup(store_rows(within, "within"))


@query
def q_platform_catalogue(spark, sf_dir):
    """One platform's licensed, unlicensed and hostless rows, tagged."""
    vrbo = [part.where("plataforma = 'vrbo'").drop("plataforma") for part in dedup.platform_parts(load_listings(spark, sf_dir), "levenshtein")]
    return sv.platform_catalogue(*vrbo, platform="vrbo").select("row_id", "plataforma", "group_id", "licencia", "anfitrion", "nombre")


@query
def q_catalogue(spark, sf_dir):
    """The parts of the catalogue, the licensed one given twice, de-duplicated."""
    lic, unl, nohost = dedup.platform_parts(load_listings(spark, sf_dir), "levenshtein")
    cols = ["row_id", "property_id", "plataforma", "group_id", "nombre"]
    return dedup.catalogue(lic.select(*cols), unl.select(*cols), nohost.select(*cols[:3], "nombre"), lic.select(*cols))


# --- payloads and pages ----------------------------------------------------------

from ..sources import derived as dv  # noqa: E402
from ..sources import pages as pg  # noqa: E402
from ..sources import payloads as pl  # noqa: E402


def _first_capture(df: DataFrame, key: str) -> DataFrame:
    """first_seen over (payload, position): a listing met in several payloads
    keeps its first capture."""
    return grp.first_per_group(df.withColumn("_ord", F.struct("payload_id", "pos")), key, order="_ord").drop("_ord")


@query
def q_flatten_booking(spark, sf_dir):
    f = pl.flatten_booking(dv.booking_payloads(load_listings(spark, sf_dir)))
    return _first_capture(f, "name").select("name", "lat", "lng", "DisplayName")


@query
def q_flatten_holidu(spark, sf_dir):
    f = pl.flatten_holidu(dv.holidu_payloads(load_listings(spark, sf_dir)))
    return _first_capture(f, "id").select("id", "lat", "lng", "nombre", "habitaciones", "capacidad", "tipo")


@query
def q_flatten_vrbo(spark, sf_dir):
    """Marker join + parse_vrbo_heading + first_seen."""
    f = pl.flatten_vrbo(dv.vrbo_payloads(load_listings(spark, sf_dir)))
    return _first_capture(f, "id").select("id", "lat", "lng", "url", "nombre", "tipo", "capacidad", "habitaciones")


@query
def q_flatten_airbnb_detail(spark, sf_dir):
    """First non-null section fields, parse_airbnb_title, registration and host."""
    return pl.flatten_airbnb_detail(dv.airbnb_payloads(load_listings(spark, sf_dir)))


@query
def q_extract_page_attributes(spark, sf_dir):
    """booking_capacity, booking_rooms, extract_licence, extract_type and
    extract_host over every listing page."""
    return pg.extract_page_attributes(dv.listing_pages(load_listings(spark, sf_dir)))


@query
def q_extract_listing_cards(spark, sf_dir):
    return pg.extract_listing_cards(dv.search_pages(load_listings(spark, sf_dir)))


# --- tiling ----------------------------------------------------------------------

from ..operators import tiles as tl  # noqa: E402


@query
def q_adaptive_tiles(spark, sf_dir):
    """Booking rule (count < 100 and != 30, 0.002 degree minimum) over the four boxes."""
    return tl.adaptive_tiles(load_listings(spark, sf_dir), leaf_rule="booking")


@query
def q_assign_tile(spark, sf_dir):
    """The Holidu tiles as a table of their own, and the points joined with it."""
    d = load_listings(spark, sf_dir)
    return tl.assign_tile(d, store_rows(tl.adaptive_tiles(d, leaf_rule="holidu"), "tile-table"))


@query
def q_assign_tile_divided(spark, sf_dir):
    """Tiles divided for the Airbnb listings, all platforms' points joined with them."""
    d = load_listings(spark, sf_dir)
    tiles = store_rows(tl.divided_tiles(d.where("plataforma = 'airbnb'"), leaf_rule=lambda n: n <= 27), "tile-table")
    return tl.assign_tile(d, tiles)


@query
def q_page_plan(spark, sf_dir):
    """Airbnb rule (<= 270, no minimum size) -> pages of 18."""
    return tl.page_plan(tl.divided_tiles(load_listings(spark, sf_dir), leaf_rule="airbnb"))


# --- features, pairs, matcher ------------------------------------------------------

from ..operators import features as ft  # noqa: E402
from ..operators import pairs as pr  # noqa: E402
from ..operators.matching import PairModel, model_dedup, score_candidates, score_pairs, select_best_model  # noqa: E402
from ..operators.similarity import model_similarity_edges  # noqa: E402
from ..sources.csv_io import load_features, save_features  # noqa: E402


#: What the pair operators read of a row; the scorer's features need them all.
PAIR_COLS = ["row_id", "group_id", "capacidad", "habitaciones", "lat", "lng"]


def training_rows(spark, sf_dir, cols=None):
    """Licensed rows grouped by licence/platform, split by distance, anchored
    groups excluded, defaults filled: the matcher's weak labels.  Of ``cols``, only
    those and what the grouping needs go through its joins."""
    d = dedup_input(spark, sf_dir)
    if cols is not None:
        d = d.select(*dict.fromkeys(["row_id", "plataforma", "licencia", "lat", "lng", *[c for c in cols if c in d.columns]]))
    g = grp.group_by_licence_platform(grp.with_licence_columns(d))
    g = sv.split_groups_by_distance(jn.merge_numeric_letter(g), 2.0)
    rows = flt.fill_defaults(flt.exclude_anchored(g))
    return store_rows(rows if cols is None else rows.select(*cols), "training-rows")


@query
def q_encode_categories(spark, sf_dir):
    d = flt.fill_defaults(load_listings(spark, sf_dir))
    out, _ = ft.encode_categories(d, ["plataforma", "tipo", "anfitrion"])
    return out.select("row_id", "plataforma_id", "tipo_id", "anfitrion_id")


def fitted_on_some(spark, sf_dir, d: DataFrame) -> ft.FittedFeatures:
    """Fitted on the Airbnb and Booking rows without hotels, saved and loaded:
    the other platforms, their hosts and the hotels are unseen values."""
    known = d.where("plataforma in ('airbnb', 'booking') and tipo <> 'Hotel' and row_id % 3 <> 0")
    path = f"{checkpoint_dir(spark).rstrip('/')}/staylink_features/{uuid.uuid4().hex}"
    save_features(known.select("row_id"), ft.FittedFeatures.fit(known), path)
    return load_features(spark, path)[1]


@query
def q_load_features(spark, sf_dir):
    """save_features -> load_features -> apply to every listing, unseen values
    included."""
    d = load_listings(spark, sf_dir)
    out = fitted_on_some(spark, sf_dir, d).apply(d)
    return out.select("row_id", "plat_id", "tipo_id", "host_id",
                      *[F.round(c, 9).alias(c) for c in ("cap_scaled", "hab_scaled", "lat_scaled", "lon_scaled")])


#: Weights of the pair model of the queries, given by hand so that SQL can score alike.
FIXED_MODEL = PairModel(["plat_id", "tipo_id", "cap_scaled", "hab_scaled", "lat_scaled", "lon_scaled"],
                        [-0.25, -1.5, -2.0, -2.0, -600.0, -400.0], [0.05, 0.1, 0.0, 0.0, 0.0, 0.0], 2.5)


def model_input(spark, sf_dir):
    d = load_listings(spark, sf_dir)
    d = fitted_on_some(spark, sf_dir, d).apply(d).na.fill({"capacidad": -1, "habitaciones": -1})
    path = f"{checkpoint_dir(spark).rstrip('/')}/staylink_features/{uuid.uuid4().hex}"
    FIXED_MODEL.save(spark, path)
    return store_rows(d, "model-rows"), PairModel.load(spark, path)


@query
def q_score_pairs(spark, sf_dir):
    """The persisted model over the 500 m candidates of equal configuration."""
    d, model = model_input(spark, sf_dir)
    near = jn.radius_join(d, 0.5, equal_on=["capacidad", "habitaciones"], null_equal=True, carry=model.features)
    return score_candidates(model, near.drop("km"), d).select("i", "j", F.round("similarity", 9).alias("similarity"))


@query
def q_pair_metrics(spark, sf_dir):
    """The persisted model's pairs, labelled by property, per platform."""
    d, model = model_input(spark, sf_dir)
    near = jn.radius_join(d, 0.5, equal_on=["capacidad", "habitaciones"], null_equal=True, carry=["property_id", "plataforma", *model.features])
    same = (F.col("property_id_i") == F.col("property_id_j")).cast("int")
    near = jn.with_rows(near, ["property_id", "plataforma"]).select("i", "j", F.col("plataforma_i").alias("plataforma"), same.alias("label"), "_row_i", "_row_j")
    scored = score_candidates(model, near, d)
    m = q.pair_metrics(scored, 0.75, by=["plataforma"])
    return m.select("plataforma", "tp", "fp", "fn", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")])


@query
def q_model_dedup(spark, sf_dir):
    """Candidates -> persisted model -> seeded clusters -> the first row of each."""
    d, model = model_input(spark, sf_dir)
    return model_dedup(d, model).select("row_id", "dup_group_id", "plataforma", "nombre")


@query
def q_scale_minmax(spark, sf_dir):
    d = load_listings(spark, sf_dir)
    out, _ = ft.scale_minmax(d, ["capacidad", "habitaciones", "lat", "lng"],
                             ["cap_scaled", "hab_scaled", "lat_scaled", "lon_scaled"])
    return out.select("row_id", *[F.round(c, 9).alias(c) for c in ("cap_scaled", "hab_scaled", "lat_scaled",
                                                                    "lon_scaled")])


@query
def q_map_unknown_category(spark, sf_dir):
    """Types fitted on the Airbnb rows; every other platform's unseen types
    map to the unknown token."""
    d = flt.fill_defaults(load_listings(spark, sf_dir))
    classes = d.where(F.col("plataforma") == "airbnb").where(F.col("tipo") != "Hotel").select("tipo").distinct()
    return ft.map_unknown_category(d, "tipo", classes, flt.UNKNOWN_TYPE).select("row_id", "tipo")


@query
def q_model_similarity_edges(spark, sf_dir):
    """500 m, equal filled capacity/rooms, cosine >= 0.8 of the rows' vectors
    (the driver's embeddings; a property takes the vector of its id modulo
    their number, the Vrbo rows the next one, so every listing has one)."""
    from ..sources.tables import read_table
    emb = read_table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("_vec"), "embedding")
    other = (F.col("plataforma") == "vrbo").cast("long")
    d = load_listings(spark, sf_dir).na.fill({"capacidad": -1, "habitaciones": -1})
    d = d.withColumn("_vec", (F.col("property_id") + other) % emb.count()).join(emb, "_vec")
    e = model_similarity_edges(d, "embedding", radius_m=500.0, threshold=0.8)
    return e.select("src", "dst", F.round("similarity", 6).alias("similarity"))


@query
def q_positive_pairs(spark, sf_dir):
    return pr.positive_pairs(training_rows(spark, sf_dir, PAIR_COLS))


@query
def q_sample_positives(spark, sf_dir):
    """Three of each group's pairs, uniform over all of them."""
    d = load_listings(spark, sf_dir).withColumn("group_id", F.concat(F.col("tipo"), F.lit("/"), F.col("plataforma")))
    return pr.sample_positives(d, k=3)


@query
def q_hard_negative_pairs_exhaustive(spark, sf_dir):
    return pr.hard_negative_pairs(training_rows(spark, sf_dir, PAIR_COLS), exhaustive=True)


@query
def q_pair_counts(spark, sf_dir):
    return q.pair_counts(pr.training_pairs(training_rows(spark, sf_dir, PAIR_COLS)))


@query
def q_hard_negative_pairs(spark, sf_dir):
    return pr.hard_negative_pairs(training_rows(spark, sf_dir, PAIR_COLS))


@query
def q_geo_negative_pairs(spark, sf_dir):
    return pr.geo_negative_pairs(training_rows(spark, sf_dir, PAIR_COLS))


@query
def q_group_split(spark, sf_dir):
    """Every training pair with its side of the split."""
    rows = training_rows(spark, sf_dir, PAIR_COLS)
    train, val = pr.group_split(store_rows(pr.training_pairs(rows), "pairs"), rows)
    return train.withColumn("side", F.lit("train")).unionByName(val.withColumn("side", F.lit("validation")))


@query
def q_training_pairs(spark, sf_dir):
    return pr.training_pairs(training_rows(spark, sf_dir, PAIR_COLS))


@query
def q_pair_scorer_metrics(spark, sf_dir):
    """Features -> training pairs -> group split -> the better of two logistic
    scorers on validation -> precision / recall / F1 on validation at 0.75."""
    rows = training_rows(spark, sf_dir)
    enc, _ = ft.encode_categories(rows, ["plataforma", "tipo", "anfitrion"])
    enc = enc.withColumnRenamed("plataforma_id", "plat_id").withColumnRenamed("anfitrion_id", "host_id")
    enc, _ = ft.scale_minmax(enc, ["capacidad", "habitaciones", "lat", "lng"],
                             ["cap_scaled", "hab_scaled", "lat_scaled", "lon_scaled"])
    feats = ft.assemble_features(ft.embed_titles(enc))
    pairs = store_rows(pr.training_pairs(rows), "pairs")
    feats = store_rows(feats.select("row_id", "features"), "features")
    train, val = pr.group_split(pairs, rows)
    _, model = select_best_model(train, val, feats, [{"regParam": 1e-4}, {"regParam": 1e-2}])
    return q.pair_metrics(score_pairs(model, val, feats), 0.75)


# --- sources ----------------------------------------------------------------------

from ..sources.csv_io import CONFORM, conform_listings  # noqa: E402


@query
def q_conform_listings(spark, sf_dir):
    """Each platform's rows rendered in its collector's column names, then
    conformed back to the canonical schema."""
    d = load_listings(spark, sf_dir)
    parts = []
    for platform, mapping in CONFORM.items():
        inv = {dst: src for src, dst in mapping.items()}
        base = d.where(F.col("plataforma") == platform).withColumn("listing_id", F.col("property_id").cast("string"))
        raw = base.select("row_id", *[F.col(dst).alias(src) for dst, src in inv.items() if dst in base.columns])
        parts.append(conform_listings(raw, platform))
    return ordr.union_listings(*parts).select("row_id", "plataforma", "listing_id", "nombre", "tipo", "lat", "lng",
                                              "capacidad", "habitaciones", "licencia", "anfitrion")
