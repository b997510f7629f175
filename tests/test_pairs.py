"""The sample of negatives and the island table join against plain Python."""

import hashlib

from staylink.operators.joins import tag_island
from staylink.operators.pairs import sample_negatives


def _md5(*parts):
    return hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()


def test_sample_is_the_first_k_in_md5_order(spark):
    pairs = [(i, i + d) for i in range(1500) for d in (1, 2)]
    df = spark.createDataFrame(pairs, "i long, j long")
    for k in (0, 100, 2999, 3000, 4000):
        want = sorted(pairs, key=lambda p: (_md5(42, *p), p))[:k]
        assert sorted(tuple(r) for r in sample_negatives(df, k).select("i", "j").collect()) == sorted(want)


def test_island_table_takes_the_first_box(spark):
    boxes = [("B", 39.0, 2.0, 40.0, 3.5, 2), ("A", 39.2, 2.2, 39.4, 2.4, 1), ("C", -1.0, -1.0, 0.0, 0.0, 3), ("none", 5.0, 5.0, 4.0, 6.0, 0)]
    pts = [(0, 39.3, 2.3), (1, 39.0, 2.0), (2, 40.0, 3.5), (3, 41.0, 3.0), (4, None, 2.3), (5, -0.5, -0.5), (6, 39.3, 2.3), (7, 4.5, 5.5)]
    df = spark.createDataFrame(pts, "row_id long, lat double, lng double")
    table = spark.createDataFrame(boxes, "isla string, lat_min double, lng_min double, lat_max double, lng_max double, ord int")
    got = {r.row_id: r.isla for r in tag_island(df, table).collect()}
    assert got == {0: "A", 1: "B", 2: "B", 3: None, 4: None, 5: "C", 6: "A", 7: None}
