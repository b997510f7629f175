"""Spatial and key joins.

``radius_join`` never compares all pairs: each point gets the integer cube of
its unit vector (cube edge = at least the chord of the search radius), one side is
copied to those cubes of the forward half of its 3x3x3 neighbourhood that are
within reach, and the join is an equi-join on (cube, extra keys) followed by the
exact great-circle filter.
Exact at the poles and across the antimeridian; each pair is met once.
"""

from __future__ import annotations

import math
from itertools import product

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from ..functions.geo import EARTH_KM, EARTH_KM_INDEX, haversine_km, unit_vector
from ..session import store_rows

# The four island boxes ((south, west), (north, east)), in the
# order the collectors visit them; the first box containing a point wins.
ISLAND_BOXES = [
    ("mallorca", 39.10129556224702, 2.3739429649583883, 40.17457797140084, 3.4572007960993005),
    ("menorca", 39.73202837261271, 3.8166048322976565, 40.183968810121, 4.306760466171312),
    ("ibiza", 38.76877967614272, 1.19828131814009, 39.164966472991914, 1.6218922749454237),
    ("formentera", 38.579720345013094, 1.3865663541037065, 38.77151823526658, 1.5908027388515222),
]

_ALL_OFFSETS = list(product((-1, 0, 1), repeat=3))
_HALF_OFFSETS = [o for o in _ALL_OFFSETS if o >= (0, 0, 0)]


def _chord(radius_km: float, earth_km: float) -> float:
    theta = radius_km / earth_km
    return 2.0 * math.sin(min(theta, math.pi) / 2.0) * (1.0 + 1e-9)


def _with_cells(df: DataFrame, lat: str, lng: str, chord: float) -> DataFrame:
    x, y, z = unit_vector(lat, lng)
    return (df.withColumn("_cx", F.floor(x / chord)).withColumn("_cy", F.floor(y / chord))
              .withColumn("_cz", F.floor(z / chord)))


def _expand(df: DataFrame, offsets) -> DataFrame:
    arr = F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy"), F.lit(dz).alias("dz"))
                    for dx, dy, dz in offsets])
    return (df.withColumn("_o", F.explode(arr))
              .withColumn("_home", (F.col("_o.dx") == 0) & (F.col("_o.dy") == 0) & (F.col("_o.dz") == 0))
              .withColumn("_cx", F.col("_cx") + F.col("_o.dx"))
              .withColumn("_cy", F.col("_cy") + F.col("_o.dy"))
              .withColumn("_cz", F.col("_cz") + F.col("_o.dz")).drop("_o"))


#: A cell's edge in radii, as long as it stays below ``WIDE_KM``: wide cells need few
#: copies of a row, narrow ones few comparisons.
EDGE, WIDE_KM = 4.0, 2.0
#: Least edge on the unit sphere at which three cell numbers fit one long.
LEAST_EDGE = 4e-6


def cell_edge(chord: float, earth_km: float) -> float:
    return max(chord, min(EDGE * chord, WIDE_KM / earth_km), LEAST_EDGE)


def _keyed_cells(df: DataFrame, lat: str, lng: str, chord: float, edge: float) -> DataFrame:
    """The unit vector, the cell, and for each axis whether the next cell below
    and above is within the chord."""
    df = df.withColumns(dict(zip(("_x", "_y", "_z"), unit_vector(lat, lng))))
    at = {x: F.floor(F.col(f"_{x}") / edge) for x in "xyz"}
    df = df.withColumns({f"_c{x}": at[x] for x in "xyz"})
    low = {f"_b{x}": F.floor((F.col(f"_{x}") - chord) / edge) < F.col(f"_c{x}") for x in "xyz"}
    return df.withColumns(low | {f"_a{x}": F.floor((F.col(f"_{x}") + chord) / edge) > F.col(f"_c{x}") for x in "xyz"})


def _cell_number(x, y, z):
    part = lambda c, bits: F.shiftleft(c + (1 << 20), bits)
    return part(x, 42).bitwiseOR(part(y, 21)).bitwiseOR(part(z, 0))


def with_rows(pairs: DataFrame, cols, sides=("i", "j")) -> DataFrame:
    """The pairs of :func:`radius_join` with the carried columns ``cols`` as
    ``{col}_i`` and ``{col}_j``: the rows a join on the id would bring, which is
    more than one where rows share an id."""
    for s in sides:
        row = f"_row_{s}"
        if isinstance(pairs.schema[row].dataType, ArrayType):
            pairs, row = pairs.withColumn("_one", F.explode(row)), "_one"
        pairs = pairs.withColumns({f"{c}_{s}": F.col(f"{row}.{c}") for c in cols}).drop("_one")
    return pairs


def radius_join(df: DataFrame, radius_km: float, earth_km: float = EARTH_KM_INDEX, equal_on=(),
                null_equal: bool = False, id_col: str = "row_id", lat: str = "lat", lng: str = "lng", carry=()) -> DataFrame:
    """Unordered pairs (i < j) within ``radius_km`` great-circle distance
    (inclusive) that are also equal on ``equal_on``; rows missing a coordinate
    never pair, rows missing an ``equal_on`` value pair only if ``null_equal``.
    Returns (i, j, km) with km rounded to 1e-6.

    With ``carry`` the named columns travel with the points, as ``_row_i`` and
    ``_row_j`` for :func:`with_rows`, so pairs, of which there are many more than
    rows, need not be shuffled to fetch them."""
    eq, held = list(equal_on), []
    df = df.select(id_col, lat, lng, *[c for c in dict.fromkeys([*eq, *carry]) if c not in (id_col, lat, lng)])
    if carry:
        row, held = F.struct(*carry), ["_row"]
        again = store_rows(df.groupBy(id_col).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col(id_col).alias("_again")), "shared-ids")
        if again.isEmpty():
            df = df.withColumn("_row", row)
        else:
            shared = df.join(again, F.col(id_col) == F.col("_again")).groupBy("_again").agg(F.collect_list(row).alias("_shared"))
            df = df.join(shared, F.col(id_col) == F.col("_again"), "left").withColumn("_row", F.coalesce("_shared", F.array(row)))
    pts = df.where(F.col(lat).isNotNull() & F.col(lng).isNotNull())
    if not null_equal:
        for c in eq:
            pts = pts.where(F.col(c).isNotNull())
    chord = _chord(radius_km, earth_km)
    edge = cell_edge(chord, earth_km)
    pts = _keyed_cells(pts.select(id_col, lat, lng, *eq, *held), lat, lng, chord, edge)
    # a pair of two cells is met in the later cell: a row goes to its own and to later cells within reach
    arr = F.array(*[F.struct(*[F.lit(d).alias(x) for d, x in zip(o, "xyz")]) for o in _HALF_OFFSETS])
    copies = pts.withColumn("_o", F.explode(arr))
    for x in "xyz":
        d = F.col(f"_o.{x}")
        copies = copies.where((d == 0) | ((d == -1) & F.col(f"_b{x}")) | ((d == 1) & F.col(f"_a{x}")))
    side = lambda d, s, cell, *more: d.select(
        *[F.col(c).alias(f"{s}_{n}") for c, n in ((id_col, "id"), (lat, "lat"), (lng, "lng"), ("_x", "x"), ("_y", "y"), ("_z", "z"))],
        *[F.col(c).alias(f"{s}{c}") for c in [*eq, *held]], cell.alias(f"{s}_cell"), *more)
    left = side(copies, "_l", _cell_number(*[F.col(f"_c{x}") + F.col(f"_o.{x}") for x in "xyz"]),
                F.expr("_o.x = 0 and _o.y = 0 and _o.z = 0").alias("_home"))
    right = side(pts, "_r", _cell_number(*[F.col(f"_c{x}") for x in "xyz"]))
    cond = [left["_l_cell"] == right["_r_cell"]]
    for c in eq:
        cond.append(left[f"_l{c}"].eqNullSafe(right[f"_r{c}"]) if null_equal else left[f"_l{c}"] == right[f"_r{c}"])
    # sorted and merged whatever the sizes look like: neither side's rows pass through the driver
    j = left.join(right.hint("merge"), cond)
    j = j.where(F.col("_l_id") != F.col("_r_id")).where(~F.col("_home") | (F.col("_l_id") < F.col("_r_id")))
    # the chord is cheap and never less than the radius's; the great circle decides
    apart = sum(((F.col(f"_l_{x}") - F.col(f"_r_{x}")) * (F.col(f"_l_{x}") - F.col(f"_r_{x}")) for x in "xyz"), F.lit(0.0))
    j = j.where(apart <= F.lit((chord + 1e-12) ** 2))
    km = haversine_km("_l_lat", "_l_lng", "_r_lat", "_r_lng", earth_km)
    j = j.withColumn("_km", km).where(F.col("_km") <= F.lit(radius_km))
    first = F.col("_l_id") < F.col("_r_id")
    rows = [F.when(first if s == "i" else ~first, F.col("_l_row")).otherwise(F.col("_r_row")).alias(f"_row_{s}") for s in "ij" if carry]
    return j.select(F.least("_l_id", "_r_id").alias("i"), F.greatest("_l_id", "_r_id").alias("j"), F.round("_km", 6).alias("km"), *rows)


def same_config_pairs(df: DataFrame, radius_km: float, earth_km: float = EARTH_KM_INDEX,
                      null_equal: bool = False, extra=()) -> DataFrame:
    """Radius pairs that also share capacity and rooms.  Title path: a missing
    value never matches; model path (values filled with -1): ``null_equal``."""
    return radius_join(df, radius_km, earth_km, equal_on=[*extra, "capacidad", "habitaciones"],
                       null_equal=null_equal)


def tag_island(df: DataFrame, boxes=ISLAND_BOXES, lat: str = "lat", lng: str = "lng") -> DataFrame:
    """``isla`` = first box (in the given order) containing the point; null
    outside every box.  A fixed handful of boxes is a projection; a DataFrame
    of any number (isla, lat_min, lng_min, lat_max, lng_max, ord; least ``ord``
    first) is an equi-join on half-degree bins of the distinct points."""
    if isinstance(boxes, DataFrame):
        bin_ = lambda c: F.floor(F.col(c) * 2)
        span = lambda c: F.explode(F.sequence(bin_(f"{c}_min"), bin_(f"{c}_max")))
        bx = boxes.where("lat_min <= lat_max AND lng_min <= lng_max").withColumn("_by", span("lat")).withColumn("_bx", span("lng"))
        points = df.select(F.col(lat).alias("_lat"), F.col(lng).alias("_lng")).distinct() \
                   .withColumn("_by", bin_("_lat")).withColumn("_bx", bin_("_lng"))
        inside = F.col("_lat").between(F.col("lat_min"), F.col("lat_max")) & F.col("_lng").between(F.col("lng_min"), F.col("lng_max"))
        tags = points.join(bx, ["_by", "_bx"]).where(inside).groupBy("_lat", "_lng").agg(F.min_by("isla", "ord").alias("isla"))
        return df.join(tags, (F.col(lat) == tags["_lat"]) & (F.col(lng) == tags["_lng"]), "left").drop("_lat", "_lng")
    expr = None
    for name, la0, lo0, la1, lo1 in boxes:
        inside = F.col(lat).between(la0, la1) & F.col(lng).between(lo0, lo1)
        expr = F.when(inside, F.lit(name)) if expr is None else expr.when(inside, F.lit(name))
    return df.withColumn("isla", expr)


def merge_numeric_letter(df: DataFrame, km: float = 1.0, earth_km: float = EARTH_KM,
                         group: str = "group_id", letters: str = "licencia_letras",
                         digits: str = "licencia_numeros") -> DataFrame:
    """A row whose licence is only digits takes the group of the last
    (greatest ``row_id``) lettered row with the same digits within ``km``;
    rows without coordinates are skipped.  Blocked on (digits, cube)."""
    has_xy = F.col("lat").isNotNull() & F.col("lng").isNotNull() & F.col(digits).isNotNull()
    chord = _chord(km, earth_km)
    bare = _with_cells(df.where(has_xy & F.col(letters).isNull()).select("row_id", digits, "lat", "lng"),
                       "lat", "lng", chord)
    lettered = _with_cells(df.where(has_xy & F.col(letters).isNotNull())
                           .select(F.col("row_id").alias("_j"), F.col(digits).alias("_dj"),
                                   F.col("lat").alias("_jlat"), F.col("lng").alias("_jlng"),
                                   F.col(group).alias("_gj")), "_jlat", "_jlng", chord)
    bare_x = _expand(bare, _ALL_OFFSETS)
    m = (bare_x.join(lettered, (bare_x[digits] == lettered["_dj"]) & (bare_x["_cx"] == lettered["_cx"])
                     & (bare_x["_cy"] == lettered["_cy"]) & (bare_x["_cz"] == lettered["_cz"]))
         .where(haversine_km("lat", "lng", "_jlat", "_jlng", earth_km) <= F.lit(km))
         .groupBy(F.col("row_id").alias("_i")).agg(F.max_by("_gj", "_j").alias("_gnew")))
    out = df.join(m, df["row_id"] == m["_i"], "left")
    return out.withColumn(group, F.coalesce("_gnew", group)).drop("_i", "_gnew")


def coverage_gaps(planned: DataFrame, collected: DataFrame, key) -> DataFrame:
    """Planned items (tiles, listings) that never produced a payload."""
    keys = [key] if isinstance(key, str) else list(key)
    return planned.join(collected.select(*keys).distinct(), keys, "left_anti")
