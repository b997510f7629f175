"""Spatial kernels that stay linear on dense groups: edges whose components are
those of the distance graph, and the candidates of the least distance sum.

Both put points into cells, decide with bounds on cells, and look at points only
where the bounds leave a doubt.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import haversine_km, unit_vector
from ..session import store_rows
from .joins import _HALF_OFFSETS

AXES = ("x", "y", "z")
#: Comparisons of points that are made at once instead of dividing cells once more.
EXACT = 100_000_000


def _with_vector(df: DataFrame) -> DataFrame:
    return df.withColumns(dict(zip(AXES, unit_vector("lat", "lng"))))


def _cells(points: DataFrame, by: list, edge: float) -> DataFrame:
    """One row per (by, cube of ``edge``): its first point, size and extent."""
    cube = [F.floor(F.col(a) / edge).alias(f"_{a}") for a in AXES]
    first = F.struct("lat", "lng")
    return points.groupBy(*by, *cube).agg(
        F.min("row_id").alias("rep"), F.count(F.lit(1)).alias("n"), F.min_by(first, F.col("row_id")).alias("at"),
        *[f(a).alias(f"{a}_{f.__name__}") for a in AXES for f in (F.min, F.max)])


def _side(cells: DataFrame, s: str, keep: list) -> DataFrame:
    cols = ["rep", "n", "at", *[f"{a}_{f}" for a in AXES for f in ("min", "max")]]
    return cells.select(*keep, *[F.col(c).alias(f"{s}_{c}") for c in cols])


def _least_chord2() -> Column:
    """Squared chord between the extents of the cells ``a`` and ``b``."""
    gap = lambda x: F.greatest(F.lit(0.0), F.col(f"b_{x}_min") - F.col(f"a_{x}_max"), F.col(f"a_{x}_min") - F.col(f"b_{x}_max"))
    return sum((gap(x) * gap(x) for x in AXES), F.lit(0.0))


def linking_edges(points: DataFrame, km: float, earth_km: float, group: str, exact: int = EXACT) -> DataFrame:
    """(src, dst) with the same components as all pairs of a group within
    ``km``, for points (group, row_id, lat, lng) of distinct coordinates.

    A cube whose diagonal is under the radius holds points that are all linked: a
    star.  Two cubes give one edge at most: by their first points if those are
    close, else by the closest pair, which is found between the parts of the two
    cubes that are near enough; parts are divided on while too many comparisons
    would be left.  So edges are at most one per point and a bounded number per
    occupied cube."""
    chord = 2.0 * math.sin(min(km / earth_km, math.pi) / 2.0)
    edge = max(chord / math.sqrt(3.0) * (1.0 - 1e-9), 1e-12)
    reach = chord * chord * (1.0 + 1e-9) + 1e-30
    pts = store_rows(_with_vector(points.select(group, "row_id", "lat", "lng")), "split-points")
    cells = store_rows(_cells(pts, [group], edge), "split-cells")
    cube = [F.floor(F.col(a) / edge).alias(f"_{a}") for a in AXES]
    own = pts.select(group, "row_id", *cube).join(cells.select(group, "rep", *[f"_{a}" for a in AXES]), [group, *[f"_{a}" for a in AXES]])
    stars = own.where("row_id <> rep").select(F.col("rep").alias("src"), F.col("row_id").alias("dst"))
    # cubes of two edges: what is within reach lies in the same or the next one
    big = [F.floor(F.col(f"_{a}") / 2).alias(f"_{a}") for a in AXES]
    keep = [group, *[f"_{a}" for a in AXES]]
    b = _side(cells.select(group, *big, *[c for c in cells.columns if c not in keep]), "b", keep)
    offsets = F.array(*[F.struct(*[F.lit(d).alias(f"d{x}") for d, x in zip(o, AXES)]) for o in _HALF_OFFSETS])
    a = _side(cells.select(group, *big, *[c for c in cells.columns if c not in keep]), "a", keep).withColumn("_o", F.explode(offsets))
    a = a.withColumn("_home", F.expr("_o.dx = 0 and _o.dy = 0 and _o.dz = 0")) \
         .withColumns({f"_{x}": F.col(f"_{x}") + F.col(f"_o.d{x}") for x in AXES}).drop("_o")
    close = haversine_km("a_at.lat", "a_at.lng", "b_at.lat", "b_at.lng", earth_km) <= F.lit(km)
    near = a.join(b, keep).where("not _home or a_rep < b_rep").where(_least_chord2() <= reach)
    near = near.select(F.col("a_rep").alias("src"), F.col("b_rep").alias("dst"), "a_rep", "b_rep", "a_n", "b_n", close.alias("close"))
    near = store_rows(near.where("close or a_n > 1 or b_n > 1"), "split-pairs")
    found = [stars, near.where("close").select("src", "dst")]
    open_ = near.where("not close").drop("close")
    held = pts.join(own.select("row_id", F.col("rep").alias("cell")), "row_id")
    for _ in range(20):
        left = open_.agg(F.sum(F.col("a_n") * F.col("b_n"))).first()[0] or 0
        if left <= exact:
            break
        # divide the cells of the open pairs, and go on with the parts in reach
        edge /= 4.0
        wanted = open_.select(F.col("a_rep").alias("cell")).union(open_.select(F.col("b_rep").alias("cell"))).distinct()
        held = store_rows(held.join(wanted, "cell", "left_semi"), "split-points")
        parts = store_rows(_cells(held, ["cell"], edge), "split-cells")
        axes = [f"_{x}" for x in AXES]
        held = held.select(*held.columns, *[F.floor(F.col(x) / edge).alias(f"_{x}") for x in AXES]) \
                   .join(parts.select("cell", *axes, "rep"), ["cell", *axes]).drop("cell", *axes).withColumnRenamed("rep", "cell")
        pairs = open_.select("src", "dst", F.col("a_rep").alias("_pa"), F.col("b_rep").alias("_pb"))
        pairs = pairs.join(_side(parts, "a", [F.col("cell").alias("_pa")]), "_pa").join(_side(parts, "b", [F.col("cell").alias("_pb")]), "_pb")
        pairs = pairs.where(_least_chord2() <= reach)
        pairs = store_rows(pairs.select("src", "dst", "a_rep", "b_rep", "a_n", "b_n", close.alias("close")), "split-pairs")
        done = pairs.where("close").select("src", "dst").distinct()
        found.append(done)
        open_ = pairs.where("a_n > 1 or b_n > 1").drop("close").join(done, ["src", "dst"], "left_anti")
    side = lambda s: held.select(F.col("cell").alias(f"{s}_rep"), F.col("lat").alias(f"_lat{s}"), F.col("lng").alias(f"_lng{s}"))
    met = open_.join(side("a"), "a_rep").join(side("b"), "b_rep")
    found.append(met.where(haversine_km("_lata", "_lnga", "_latb", "_lngb", earth_km) <= F.lit(km)).select("src", "dst").distinct())
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def _distance(x: Column) -> Column:
    """Great-circle distance of a chord, in radians."""
    return F.lit(2.0) * F.asin(F.least(x / 2.0, F.lit(1.0)))


def least_sum_candidates(cands: DataFrame, points: DataFrame, ks: list, grid: int, salts: int = 32) -> DataFrame:
    """(ks, lat, lng) of the candidate points whose sum of distances to the
    weighted points of their key can be the least, by bounds from a grid of at most
    ``grid`` squared cells per key.

    The distance to x is convex in x, so w times the distance to a cell's centre
    of mass is a lower bound of the cell's sum; the upper bound adds half the
    largest curvature in the cell times the spread around that centre, or where the
    cell is too near, the slope times the mean spread."""
    box = points.groupBy(*ks).agg(*[f(c).alias(f"{c}_{f.__name__}") for c in ("lat", "lng") for f in (F.min, F.max)])
    at = lambda c: F.coalesce(F.least(F.floor(F.try_divide(F.col(c) - F.col(f"{c}_min"), F.col(f"{c}_max") - F.col(f"{c}_min")) * grid), F.lit(grid - 1)), F.lit(0))
    p = _with_vector(points.join(box, ks)).withColumns({"_cy": at("lat"), "_cx": at("lng")})
    cells = p.groupBy(*ks, "_cy", "_cx").agg(
        F.sum("w").cast("double").alias("w"), *[F.sum(F.col("w") * F.col(a)).alias(f"s{a}") for a in AXES],
        *[(F.max(a) - F.min(a)).alias(f"e{a}") for a in AXES],
        F.sum(F.col("w") * (F.col("x") * F.col("x") + F.col("y") * F.col("y") + F.col("z") * F.col("z"))).alias("q"))
    mean = {f"g{a}": F.col(f"s{a}") / F.col("w") for a in AXES}
    cells = cells.withColumns(mean)
    spread = F.greatest(F.col("q") - F.col("w") * sum((F.col(f"g{a}") * F.col(f"g{a}") for a in AXES), F.lit(0.0)), F.lit(0.0)) + F.col("w") * 1e-14
    cells = cells.select(*ks, "w", *mean, spread.alias("s2"), F.sqrt(sum((F.col(f"e{a}") * F.col(f"e{a}") for a in AXES), F.lit(1e-20))).alias("r"),
                         F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt"))
    c = _with_vector(cands.select(*ks, "lat", "lng")).withColumn("_salt", F.pmod(F.xxhash64("lat", "lng"), F.lit(salts)).cast("int"))
    n = F.sqrt(sum(((F.col(a) - F.col(f"g{a}")) * (F.col(a) - F.col(f"g{a}")) for a in AXES), F.lit(0.0)))
    j = c.join(cells, [*ks, "_salt"]).withColumn("_n", n)
    far, close = F.least(F.col("_n") + F.col("r"), F.lit(1.999)), F.col("_n") - F.col("r")
    slope = F.lit(1.0) / F.sqrt(F.lit(1.0) - far * far / 4.0)
    curve = slope / close + far / 4.0 * slope * slope * slope
    by_slope = slope * F.sqrt(F.col("w") * F.col("s2"))
    more = F.when(close > 0, F.least(curve * F.col("s2") / 2.0, by_slope)).otherwise(by_slope)
    sums = j.groupBy(*ks, "lat", "lng").agg(F.sum(F.col("w") * _distance(F.col("_n"))).alias("_lo"),
                                           F.sum(F.col("w") * _distance(F.col("_n")) + more).alias("_hi"))
    sums = store_rows(sums, "medoid-bounds")
    best = sums.groupBy(*ks).agg(F.min("_hi").alias("_best"))
    # sums are compared to the millimetre later, so those equal within it stay too
    return sums.join(best, ks).where(F.col("_lo") <= F.col("_best") * (1 + 1e-9) + 1e-9).select(*ks, "lat", "lng")
