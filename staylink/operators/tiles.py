"""Adaptive quadtree tiling of points, tile assignment and page planning.

The collectors split a box into quadrants until a tile's result count fits a
page rule.  Here the same tree is computed from a point table in one pass:
each point gets its deepest cell (integer quadrant indices at ``max_depth``),
cells are counted (map-side combine), every cell count is added to its
<= max_depth+1 ancestor tiles, and a tile is visited when all its ancestors
were split.  Work is on aggregated cells, never on points per tile.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import store_rows
from .joins import ISLAND_BOXES, tag_island

# Page rules of the four collectors and their minimum tile.
LEAF_RULES = {
    "booking": lambda n: (n < 100) & (n != 30),
    "holidu": lambda n: n <= 30,
    "vrbo": lambda n: n < 50,
    "airbnb": lambda n: n <= 270,
}
MIN_TILE_DEG = {"booking": 0.002, "holidu": 0.002, "vrbo": None, "airbnb": None}
PAGE_SIZE = 18
PAGE_CAP = 270
#: Levels that a coordinate's double can tell apart.
DOUBLE_BITS = 52


def _boxes_df(spark, boxes):
    return spark.createDataFrame([tuple(b) for b in boxes],
                                 "isla string, box_lat0 double, box_lng0 double, box_lat1 double, box_lng1 double")


def _cells(points: DataFrame, boxes, depth: int) -> DataFrame:
    side = 1 << depth
    pts = tag_island(points.where(F.col("lat").isNotNull() & F.col("lng").isNotNull()), boxes) \
        .where(F.col("isla").isNotNull())
    # the box table is a fixed handful of rows: broadcast is size-bounded
    pts = pts.join(F.broadcast(_boxes_df(points.sparkSession, boxes)), "isla")
    ix = F.least(F.floor((F.col("lng") - F.col("box_lng0")) / (F.col("box_lng1") - F.col("box_lng0")) * side),
                 F.lit(side - 1)).cast("long")
    iy = F.least(F.floor((F.col("lat") - F.col("box_lat0")) / (F.col("box_lat1") - F.col("box_lat0")) * side),
                 F.lit(side - 1)).cast("long")
    return pts.withColumn("ix", ix).withColumn("iy", iy)


def _status(n: Column, depth: Column, leaf_rule, min_deg, max_depth: int, boxes_cols) -> Column:
    lat_side = (F.col("box_lat1") - F.col("box_lat0")) / F.pow(F.lit(2.0), depth)
    lng_side = (F.col("box_lng1") - F.col("box_lng0")) / F.pow(F.lit(2.0), depth)
    small = depth >= F.lit(max_depth)
    if min_deg is not None:
        small = small | (lat_side <= F.lit(min_deg)) | (lng_side <= F.lit(min_deg))
    return (F.when(n == 0, F.lit("empty")).when(leaf_rule(n), F.lit("leaf"))
            .when(small, F.lit("ignored" if min_deg is not None else "leaf")).otherwise(F.lit("split")))


def _tile_frame(df: DataFrame) -> DataFrame:
    k = F.pow(F.lit(2.0), F.col("depth"))
    lat_w = (F.col("box_lat1") - F.col("box_lat0")) / k
    lng_w = (F.col("box_lng1") - F.col("box_lng0")) / k
    return df.select(
        F.concat_ws("/", "isla", "depth", "tx", "ty").alias("tile"), "isla", "depth", "tx", "ty",
        (F.col("box_lat0") + F.col("ty") * lat_w).alias("lat_min"), (F.col("box_lng0") + F.col("tx") * lng_w).alias("lng_min"),
        (F.col("box_lat0") + (F.col("ty") + 1) * lat_w).alias("lat_max"),
        (F.col("box_lng0") + (F.col("tx") + 1) * lng_w).alias("lng_max"), "n", "status")


def _tree(points: DataFrame, boxes, leaf_rule, min_deg, max_depth, least: int = 0):
    D = max_depth
    cells = store_rows(_cells(points, boxes, D).groupBy("isla", "ix", "iy").agg(F.count(F.lit(1)).alias("n")), "tile-cells")
    ex = cells.select("isla", "ix", "iy", "n", F.explode(F.sequence(F.lit(least), F.lit(D))).alias("depth"))
    ex = ex.withColumn("tx", F.expr(f"shiftright(ix, {D} - depth)")) \
           .withColumn("ty", F.expr(f"shiftright(iy, {D} - depth)"))
    bx = F.broadcast(_boxes_df(points.sparkSession, boxes))
    tn = ex.groupBy("isla", "depth", "tx", "ty").agg(F.sum("n").alias("n")).join(bx, "isla")
    st = store_rows(tn.withColumn("status", _status(F.col("n"), F.col("depth"), leaf_rule, min_deg, D, None)), "tile-counts")
    keys = ["isla", "depth", "tx", "ty"]
    path = ex.select("isla", "ix", "iy", *keys[1:]).join(st.select(*keys, "status"), keys)
    stop = path.groupBy("isla", "ix", "iy").agg(
        F.min(F.when(F.col("status") != "split", F.col("depth"))).alias("stop_depth"))
    return cells, ex, st, stop, bx


def adaptive_tiles(points: DataFrame, boxes=ISLAND_BOXES, leaf_rule="booking", min_deg="default",
                   max_depth: int = 10, least: int = 0) -> DataFrame:
    """Every visited tile of the quadtree with its count and status: ``split``
    (over-full, divided), ``leaf`` (fits the page rule), ``empty`` (no
    points) or ``ignored`` (over-full at the rule's own minimum size: its
    points are not collected).  A rule without a minimum ignores nothing: a tile
    still over-full at ``max_depth`` is a leaf with all its points.  Tiles begin at
    depth ``least``, above which all are known to be split."""
    rule = LEAF_RULES[leaf_rule] if isinstance(leaf_rule, str) else leaf_rule
    if min_deg == "default":
        min_deg = MIN_TILE_DEG.get(leaf_rule) if isinstance(leaf_rule, str) else None
    cells, ex, st, stop, bx = _tree(points, boxes, rule, min_deg, max_depth, least)
    keys = ["isla", "depth", "tx", "ty"]
    visited_keys = ex.join(stop, ["isla", "ix", "iy"]).where(F.col("depth") <= F.col("stop_depth")) \
        .select(*keys).distinct()
    visited = st.join(visited_keys, keys)
    # children of split tiles that hold no point are visited and empty
    kids = visited.where(F.col("status") == "split").select(
        "isla", (F.col("depth") + 1).alias("depth"),
        F.explode(F.array(*[F.struct((F.col("tx") * 2 + dx).alias("tx"), (F.col("ty") * 2 + dy).alias("ty"))
                            for dy in (0, 1) for dx in (0, 1)])).alias("c")).select("isla", "depth", "c.tx", "c.ty")
    empty = kids.join(st.select(*keys), keys, "left_anti").join(bx, "isla") \
        .withColumn("n", F.lit(0).cast("long")).withColumn("status", F.lit("empty"))
    return _tile_frame(visited.unionByName(empty.select(visited.columns)))


def divided_tiles(points: DataFrame, boxes=ISLAND_BOXES, leaf_rule="airbnb", batch: int = 7, then: int = 3) -> DataFrame:
    """:func:`adaptive_tiles` of a rule without a minimum size, without a cap of
    depth: after the first ``batch`` of levels, and each ``then`` levels more, only
    the points of tiles that are still over-full go on, until every leaf fits the
    rule or its points share one coordinate.  A round counts at most 4 ** then cells
    below an over-full tile, so its cells are few beside the points."""
    rule = LEAF_RULES[leaf_rule] if isinstance(leaf_rule, str) else leaf_rule
    keys, depth = ["isla", "tx", "ty"], batch
    tiles = store_rows(adaptive_tiles(points, boxes, rule, None, depth), "tiles")
    while (more := min(then, DOUBLE_BITS - depth)) > 0:
        over = tiles.where((F.col("depth") == depth) & (F.col("status") == "leaf") & ~rule(F.col("n"))).select(*keys)
        held = _cells(points, boxes, depth).withColumnsRenamed({"ix": "tx", "iy": "ty"}).select(*keys, "lat", "lng").join(over, keys)
        spread = held.groupBy(*keys).agg(*[f(c).alias(f"{c}_{f.__name__}") for c in ("lat", "lng") for f in (F.min, F.max)]) \
                     .where("lat_min < lat_max or lng_min < lng_max").select(*keys)
        held = store_rows(held.join(spread, keys), "tile-points")
        if held.isEmpty():
            break
        points, open_ = held.select("lat", "lng"), held.select(*keys, F.lit(depth).alias("depth")).distinct()
        # a tile's points are all here or none, so counts below it are whole
        deeper = adaptive_tiles(points, boxes, rule, None, depth + more, least=depth).where(F.col("depth") > depth)
        divided = tiles.join(open_, [*keys, "depth"], "left_semi").withColumn("status", F.lit("split"))
        tiles = store_rows(tiles.join(open_, [*keys, "depth"], "left_anti").unionByName(divided).unionByName(deeper), "tiles")
        depth += more
    return tiles


#: Depth of the coarse cells that tell which depths a point has to look at.
COARSE = 6


def assign_tile(points: DataFrame, tiles: DataFrame, boxes=ISLAND_BOXES, id_col: str = "row_id") -> DataFrame:
    """Each point inside a box -> (id, tile, status): the tile of the given
    table (``adaptive_tiles``, ``divided_tiles``, or a stored one) where the descent
    stops.  Points need not be those that the tiles were made from.

    A join on path prefixes: a point's path is its cell at the finest depth, a
    tile is one of its prefixes.  Coarse cells first give the depths at which tiles
    end below them (one to a few), so a point meets only tiles at those depths, by
    equal keys; the tiles partition a box, so one matches."""
    ends = tiles.where(F.col("status") != "split").select("isla", "depth", "tx", "ty", "tile", "status")
    # tiles above the coarse depth cover several coarse cells, at most 4 ** COARSE of a box in all
    spread = lambda t: F.explode(F.transform(F.sequence(F.lit(0), F.expr(f"cast(pow(2, greatest({COARSE} - depth, 0)) as int) - 1")),
                                             lambda k: F.expr(f"shiftright(shiftleft({t}, greatest({COARSE} - depth, 0)), greatest(depth - {COARSE}, 0))") + k))
    depths = (ends.select("isla", "depth", "ty", spread("tx").alias("_cx")).select("isla", "depth", "_cx", spread("ty").alias("_cy"))
              .groupBy("isla", "_cx", "_cy").agg(F.collect_set("depth").alias("_depths")))
    at = lambda c, d: F.expr(f"shiftright({c}, {DOUBLE_BITS} - {d})")
    pts = _cells(points, boxes, DOUBLE_BITS).select(F.col(id_col), "isla", "ix", "iy",
                                                    at("ix", COARSE).alias("_cx"), at("iy", COARSE).alias("_cy"))
    pts = pts.join(depths, ["isla", "_cx", "_cy"]).select(id_col, "isla", "ix", "iy", F.explode("_depths").alias("depth"))
    pts = pts.select(id_col, "isla", "depth", at("ix", "depth").alias("tx"), at("iy", "depth").alias("ty"))
    return pts.join(ends, ["isla", "depth", "tx", "ty"]).select(id_col, "tile", "status")


def page_plan(tiles: DataFrame, page_size: int = PAGE_SIZE, cap: int = PAGE_CAP) -> DataFrame:
    """Leaf tiles -> result pages: floor(n / page_size) + 1 pages, none for
    empty tiles; item offset = page_size * page.  ``cap`` is the tile size up to
    which the source serves every page; over-full leaves are planned whole."""
    t = tiles.where((F.col("status") == "leaf") & (F.col("n") >= 1))
    return t.select("tile", "n", F.explode(F.sequence(F.lit(0), F.floor(F.col("n") / page_size).cast("int")))
                    .alias("page")).withColumn("item_offset", F.col("page") * page_size)
