"""Distance components and medoids on dense and skewed groups, against brute force."""

import math
import random

import pytest
from pyspark.sql import functions as F

from staylink.operators import spatial
from staylink.operators.graph import connected_components
from staylink.operators.grouping import first_per_group, medoid_anchor
from staylink.operators.survivors import split_groups_by_distance

R = 6371.0


def km(a, b):
    (la, lo), (mu, nu) = [(math.radians(x), math.radians(y)) for x, y in (a, b)]
    return 2 * R * math.asin(math.sqrt(math.sin((mu - la) / 2) ** 2 + math.cos(la) * math.cos(mu) * math.sin((nu - lo) / 2) ** 2))


def components(points, limit):
    left, out = set(range(len(points))), {}
    while left:
        todo = [min(left)]
        label = todo[0]
        left.discard(label)
        while todo:
            a = todo.pop()
            out[a] = label
            hit = [b for b in left if points[a][0] == points[b][0] and km(points[a][1:], points[b][1:]) <= limit]
            left -= set(hit)
            todo += hit
    return out


def scene(seed):
    """Dense clumps at about the limit from one another, chains, lone points, the antimeridian, a pole."""
    rng = random.Random(seed)
    pts = []
    for g in ("a", "b"):
        at = 39.0
        for _ in range(4):
            at += rng.choice([0.0175, 0.018, 0.0181, 0.0185, 0.021, 0.03])
            pts += [(g, at + rng.random() * 0.0035, 2.5 + rng.random() * 0.004) for _ in range(rng.choice([1, 3, 25]))]
        pts += [(g, 39.2, 2.5 + 0.02 * k) for k in range(8)] + [(g, rng.uniform(38, 40), rng.uniform(2, 4)) for _ in range(10)]
        pts += [(g, 10.0, 179.995), (g, 10.0, -179.995), (g, 89.995, 10.0), (g, 89.995, -170.0), (g, -0.001, 0.0), (g, 0.001, 0.0)]
    return list(dict.fromkeys(pts))


@pytest.mark.parametrize("seed,exact", [(1, 10 ** 8), (2, 0), (3, 40), (4, 0)])
def test_linking_edges_have_the_components_of_all_pairs(spark, seed, exact):
    """With exact = 0 cells are divided until points are alone."""
    pts = scene(seed)
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pts)], "row_id long, group_id string, lat double, lng double")
    edges = spatial.linking_edges(df, 2.0, R, "group_id", exact=exact)
    got = {r.row_id: r.component for r in connected_components(edges, df.select("row_id")).collect()}
    assert got == components(pts, 2.0)


def test_edges_are_linear_in_a_dense_group(spark):
    rng = random.Random(5)
    n = 6000
    pts = [(i, "g", 39.0 + rng.random() * 0.05, 2.5 + rng.random() * 0.05) for i in range(n)]  # about 5 km
    df = spark.createDataFrame(pts, "row_id long, group_id string, lat double, lng double")
    edges = spatial.linking_edges(df, 2.0, R, "group_id")
    assert edges.count() < 1.2 * n  # all pairs would be millions
    out = split_groups_by_distance(df, 2.0)
    assert out.select("group_id").distinct().collect() == [("g",)]


def medoid(rows):
    """Row of least rounded sum among the dominant host's, by brute force."""
    sums = [(round(sum(km((la, lo), (mu, nu)) for _, _, mu, nu in rows), 6), i) for i, h, la, lo in rows if h == "x"]
    return min(sums)[1]


def keyed(spark, rows):
    return spark.createDataFrame([("k", *r) for r in rows], "key string, row_id long, host string, lat double, lng double")


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_bounded_medoid_is_the_medoid(spark, seed):
    """Grids before exact sums, on clumps, lines, and repeated points."""
    rng = random.Random(seed)
    shape = {1: lambda: (rng.uniform(38, 40), rng.uniform(1, 4)), 2: lambda: (39 + rng.gauss(0, 0.2) ** 3, 2.5 + rng.choice([0, 0, 1.2])),
             3: lambda: (39.5, rng.random())}[seed]
    rows = [(i, "x" if i % 3 else "y", *shape()) for i in range(240)] + [(1000 + i, "x", 39.1, 2.0) for i in range(5)]
    want = medoid(rows)
    for grids, exact in (((4, 16, 64), 0), ((32,), 100), ((), 0)):
        assert [tuple(r) for r in medoid_anchor(keyed(spark, rows), "key", "host", exact=exact, grids=grids).collect()] == [("k", want)]


def test_hot_licence_of_distinct_points_finishes(spark):
    """A key with most rows and distinct points: few candidates reach the sums."""
    rng = random.Random(9)
    n = 30_000
    rows = [(i, "x", rng.uniform(38.6, 40.1), rng.uniform(1.2, 4.2)) for i in range(n)]
    df = keyed(spark, rows)
    points = df.select("key", "lat", "lng").withColumn("w", F.lit(1))
    left = spatial.least_sum_candidates(df, points, ["key"], 32)
    kept = {(r.lat, r.lng) for r in left.collect()}
    assert 0 < len(kept) < 0.02 * n
    assert medoid_anchor(df, "key", "host").first().anchor_row in {i for i, _, la, lo in rows if (la, lo) in kept}


def test_first_per_group_by_hash_aggregate(spark):
    df = spark.createDataFrame([(3, "a", "x"), (1, "a", "y"), (2, None, "z"), (5, None, "w"), (9, "b", None)], "row_id long, g string, v string")
    out = first_per_group(df, "g")
    assert sorted(tuple(r) for r in out.collect()) == [(1, "a", "y"), (2, None, "z"), (9, "b", None)]
    assert "SortAggregate" not in out._jdf.queryExecution().toString()
