"""Quadtree tiling against a direct recursive implementation."""

import random

from staylink.operators.tiles import adaptive_tiles, page_plan

BOX = [("b", 0.0, 0.0, 1.0, 1.0)]


def recursive(points, rule, min_deg, max_depth):
    out = {}

    def go(d, tx, ty):
        w = 1.0 / (1 << d)
        inside = [p for p in points if min(int(p[1] * (1 << max_depth)), (1 << max_depth) - 1) >> (max_depth - d) == tx
                  and min(int(p[0] * (1 << max_depth)), (1 << max_depth) - 1) >> (max_depth - d) == ty]
        n = len(inside)
        if n == 0:
            out[(d, tx, ty)] = (0, "empty")
        elif rule(n):
            out[(d, tx, ty)] = (n, "leaf")
        elif d >= max_depth or (min_deg is not None and w <= min_deg):
            out[(d, tx, ty)] = (n, "ignored")
        else:
            out[(d, tx, ty)] = (n, "split")
            for dy in (0, 1):
                for dx in (0, 1):
                    go(d + 1, tx * 2 + dx, ty * 2 + dy)

    go(0, 0, 0)
    return out


def test_tiles_match_recursion(spark):
    rng = random.Random(5)
    pts = [(rng.random() ** 3, rng.random() ** 2) for _ in range(400)] + [(0.9, 0.9)] * 40
    df = spark.createDataFrame([(i, la, lo) for i, (la, lo) in enumerate(pts)], "row_id long, lat double, lng double")
    got = {(r["depth"], r["tx"], r["ty"]): (r["n"], r["status"])
           for r in adaptive_tiles(df, boxes=BOX, leaf_rule=lambda n: n <= 30, min_deg=0.01, max_depth=8).collect()}
    assert got == recursive(pts, lambda n: n <= 30, 0.01, 8)


def test_page_plan(spark):
    t = spark.createDataFrame([("a", 0, "leaf"), ("b", 17, "leaf"), ("c", 18, "leaf"), ("d", 270, "leaf"),
                               ("e", 300, "ignored")], "tile string, n long, status string")
    pages = {}
    for r in page_plan(t).collect():
        pages.setdefault(r["tile"], []).append((r["page"], r["item_offset"]))
    assert {k: len(v) for k, v in pages.items()} == {"b": 1, "c": 2, "d": 16}
    assert sorted(pages["c"]) == [(0, 0), (1, 18)]


def test_no_point_is_lost_at_the_depth_cap(spark):
    from staylink.operators.tiles import page_plan
    rows = [(i, 0.5 + (i % 40) * 1e-6, 0.5 + (i // 40) * 1e-6) for i in range(1000)] + [(2000 + i, 0.25, 0.25) for i in range(300)]
    df = spark.createDataFrame(rows, "row_id long, lat double, lng double")
    tiles = adaptive_tiles(df, boxes=BOX, leaf_rule=lambda n: n <= 270, min_deg=None, max_depth=6)
    planned = page_plan(tiles).select("tile", "n").distinct().collect()
    assert sum(r.n for r in planned) == len(rows)


def test_dense_tiles_are_divided_until_they_fit(spark, monkeypatch):
    from staylink.operators import tiles
    from staylink.plans import catalog
    rng = random.Random(6)
    pts = [(0.3 + rng.random() / 2000, 0.3 + rng.random() / 2000) for _ in range(700)] + [(0.9, 0.9)] * 300
    pts += [(0.6 + rng.random() / 10 ** 6, 0.6) for _ in range(600)] + [(rng.random(), rng.random()) for _ in range(400)]
    df = spark.createDataFrame([(i, la, lo) for i, (la, lo) in enumerate(pts)], "row_id long, lat double, lng double")
    monkeypatch.setattr(catalog, "load_listings", lambda spark, sf_dir: df)
    for name in ("adaptive_tiles", "divided_tiles"):
        if hasattr(tiles, name):
            f = getattr(tiles, name)
            monkeypatch.setattr(f, "__defaults__", (BOX, *f.__defaults__[1:]))
    plan = {r.tile: r.n for r in catalog.QUERIES["page_plan"](spark, "").collect()}
    found = 0
    for tile, n in plan.items():
        d, tx, ty = map(int, tile.split("/")[1:])
        inside = [p for p in pts if int(p[1] * 2 ** d) == tx and int(p[0] * 2 ** d) == ty]
        assert len(inside) == n and (n <= 270 or len(set(inside)) == 1)
        found += n
    assert found == len(pts)


RULES = {"booking": 0.002, "holidu": 0.002, "vrbo": None, "airbnb": None}


def test_points_meet_the_tile_that_holds_them(spark):
    """Against a scan of all tiles, for the four rules and the divided tiles;
    the points are not those that the tiles come from."""
    from staylink.operators.tiles import adaptive_tiles, assign_tile, divided_tiles
    rng = random.Random(8)
    boxes = [("b", 0.0, 0.0, 1.0, 1.0), ("c", 2.0, 2.0, 3.0, 4.0)]
    dense = [(0.3 + rng.random() / 5000, 0.3 + rng.random() / 5000) for _ in range(900)]
    made = [(rng.random() ** 3, rng.random()) for _ in range(500)] + dense + [(2 + rng.random(), 2 + 2 * rng.random()) for _ in range(80)]
    other = made[::7] + [(rng.random(), rng.random()) for _ in range(200)] + [(1.0, 1.0), (0.0, 0.0), (3.0, 4.0), (2.5, 2.0), (5.0, 5.0), (None, 0.5)]
    frame = lambda pts: spark.createDataFrame([(i, *p, "x") for i, p in enumerate(pts)], "row_id long, lat double, lng double, tile string")
    source, points = frame(made).drop("tile"), frame(other)
    tables = [adaptive_tiles(source, boxes, r, max_depth=10) for r in RULES] + [divided_tiles(source, boxes, lambda n: n <= 5)]
    for tiles in tables:
        want = {}
        ends = [t for t in tiles.collect() if t.status != "split"]
        edge = {"b": (1.0, 1.0), "c": (3.0, 4.0)}
        for i, (la, lo) in enumerate(other):
            hit = [t for t in ends if la is not None and (t.lat_min <= la < t.lat_max or la == t.lat_max == edge[t.isla][0])
                   and (t.lng_min <= lo < t.lng_max or lo == t.lng_max == edge[t.isla][1])]
            assert len(hit) == (0 if la in (None, 5.0) else 1)
            if hit:
                want[i] = (hit[0].tile, hit[0].status)
        got = assign_tile(points, tiles, boxes).collect()
        assert len(got) == len(want) and {r.row_id: (r.tile, r.status) for r in got} == want
