"""Radius join equals brute force (incl. pole and antimeridian); plan shape."""

import math
import random

from pyspark.sql import functions as F

from staylink.functions.geo import EARTH_KM_INDEX
from staylink.operators import joins
from staylink.operators.joins import radius_join, tag_island, with_rows


def hav(a, b, r):
    la1, lo1, la2, lo2 = map(math.radians, (a[0], a[1], b[0], b[1]))
    h = math.sin((la2 - la1) / 2) ** 2 + math.cos(la1) * math.cos(la2) * math.sin((lo2 - lo1) / 2) ** 2
    return 2 * r * math.asin(math.sqrt(h))


def test_matches_brute_force(spark):
    rng = random.Random(3)
    pts = []
    for centre in [(39.5, 2.6), (89.9995, 0.0), (0.0, 179.9995)]:
        for _ in range(60):
            lat = max(min(centre[0] + rng.uniform(-0.004, 0.004), 90.0), -90.0)
            lng = centre[1] + rng.uniform(-0.004, 0.004)
            lng = lng - 360 if lng > 180 else lng
            pts.append((lat, lng))
    df = spark.createDataFrame([(i, la, lo) for i, (la, lo) in enumerate(pts)], "row_id long, lat double, lng double")
    for r_km in (0.05, 0.2, 0.5):
        got = {(r[0], r[1]) for r in radius_join(df, r_km, EARTH_KM_INDEX).collect()}
        want = {(i, j) for i in range(len(pts)) for j in range(i + 1, len(pts))
                if hav(pts[i], pts[j], EARTH_KM_INDEX) <= r_km}
        assert got == want


def test_plan_has_no_cartesian(spark):
    df = spark.createDataFrame([(1, 39.5, 2.6, 4), (2, 39.5001, 2.6, 4)], "row_id long, lat double, lng double, c int")
    plan = radius_join(df, 0.2, equal_on=["c"])._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_tag_island_first_box_wins(spark):
    df = spark.createDataFrame([(1, 38.77, 1.5), (2, 39.6, 2.9), (3, 0.0, 0.0)], "row_id long, lat double, lng double")
    got = {r[0]: r[1] for r in tag_island(df).select("row_id", "isla").collect()}
    assert got == {1: "ibiza", 2: "mallorca", 3: None}


def test_no_side_of_the_pairs_passes_through_the_driver(spark):
    df = spark.createDataFrame([(i, 39.5 + i * 1e-4, 2.6, None if i % 3 else 4) for i in range(50)], "row_id long, lat double, lng double, c int")
    plan = radius_join(df, 0.5, equal_on=["c"], null_equal=True)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan


def test_carried_rows_equal_a_join_on_the_id(spark):
    rng = random.Random(5)
    rows = [(rng.randrange(60) if i % 9 == 0 else 100 + i, 39.5 + rng.random() / 100, 2.6 + rng.random() / 100, rng.choice([2, 3, None]), f"t{i}")
            for i in range(150)]
    for some in (rows, [r for r in rows if r[0] >= 100]):  # with and without shared ids
        df = spark.createDataFrame(some, "row_id long, lat double, lng double, c int, t string")
        pairs = radius_join(df, 0.3, equal_on=["c"], null_equal=True)
        for s in "ij":
            pairs = pairs.join(df.selectExpr(f"row_id as {s}", f"t as t_{s}"), s)
        got = with_rows(radius_join(df, 0.3, equal_on=["c"], null_equal=True, carry=["t"]), ["t"])
        cols = ["i", "j", "km", "t_i", "t_j"]
        want = sorted(map(tuple, pairs.select(cols).collect()))
        assert want and sorted(map(tuple, got.select(cols).collect())) == want


def test_few_copies_of_a_row_are_joined(spark):
    rng = random.Random(6)
    rows = [(i, 39.0 + rng.random(), 2.0 + rng.random()) for i in range(3000)]
    df = spark.createDataFrame(rows, "row_id long, lat double, lng double")
    pts = joins._keyed_cells(df, "lat", "lng", joins._chord(0.5, EARTH_KM_INDEX), joins.EDGE * joins._chord(0.5, EARTH_KM_INDEX))
    near = sum(F.when(F.col(f"_b{x}") | F.col(f"_a{x}"), 1).otherwise(0) for x in "xyz")
    assert pts.agg(F.avg(near)).first()[0] < 1.8  # at edges of one radius: 3, each way
