"""What is written and joined grows with the rows that matter."""

import random

import pytest
from pyspark.ml.linalg import SparseVector, Vectors
from pyspark.sql import functions as F

from staylink.operators import pairs as pr
from staylink.operators import tiles as tl
from staylink.operators.matching import pair_features


@pytest.fixture
def written(monkeypatch):
    """Rows written by a module, by tag."""
    rows = {}

    def watch(module):
        store = module.store_rows

        def counted(df, tag):
            out = store(df, tag)
            rows.setdefault(tag, []).append(out.count())
            return out

        monkeypatch.setattr(module, "store_rows", counted)
        return rows

    return watch


def test_negatives_beyond_the_threshold_are_not_written(spark, written):
    rows = written(pr)
    neg = spark.range(20_000).select(F.col("id").alias("i"), (F.col("id") + 1).alias("j"), F.lit(0).alias("label"))
    want = sorted(map(tuple, pr.sample_negatives(neg, 500).collect()))
    rows.clear()
    assert sorted(map(tuple, pr.sample_negatives(neg, 500, most=20_000).collect())) == want and len(want) == 500
    assert rows["negatives"][0] < 3000
    # too few below the threshold (there are fewer rows than told): the others are taken too
    assert sorted(map(tuple, pr.sample_negatives(neg, 500, most=10_000_000).collect())) == want


def test_the_split_is_read_from_its_tag(spark):
    df = spark.createDataFrame([(i, f"g{i // 2}" if i < 18 else None) for i in range(20)], "row_id long, group_id string")
    pairs = spark.createDataFrame([(i, i + 1, 1) for i in range(19)], "i long, j long, label int")
    train, val = pr.group_split(pairs, df, frac=0.3)
    assert "Join" not in train._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, train.unionByName(val).collect())) == [(i, i + 1, 1) for i in range(19)]
    side = lambda d: {None if r.i >= 18 else r.i // 2 for r in d.collect()}
    assert len(side(val)) == 3 and not side(val) & side(train)


def test_pair_vectors_hold_no_zeros(spark):
    a, b = [0.0] * 40, [0.0] * 40
    a[3], b[3], b[7] = 2.0, 0.5, 1.0
    feats = spark.createDataFrame([(1, Vectors.sparse(40, {3: 2.0})),
                                   (2, Vectors.sparse(40, {3: 0.5, 7: 1.0}))], ["row_id", "features"])
    got = pair_features(spark.createDataFrame([(1, 2, 1)], "i long, j long, label int"), feats).first()["pair_vec"]
    assert isinstance(got, SparseVector)
    assert got.toArray().tolist() == [abs(x - y) for x, y in zip(a, b)] + [x * y for x, y in zip(a, b)]


def test_rounds_of_tiles_count_few_cells(spark, written):
    rng, box = random.Random(3), [("b", 0.0, 0.0, 1.0, 1.0)]
    pts = [(rng.random() / 100, rng.random() / 100) for _ in range(3000)] + [(0.5, 0.5)] * 50
    df = spark.createDataFrame([(i, la, lo) for i, (la, lo) in enumerate(pts)], "row_id long, lat double, lng double")
    rule = lambda n: n <= 200
    rows = written(tl)
    cols = ["tile", "n", "status", "lat_min", "lng_max"]
    got = sorted(map(tuple, tl.divided_tiles(df, box, rule, batch=4).select(*cols).collect()))
    # one tile of depth 4 is over-full: at most 64 cells three levels below it
    assert rows["tile-cells"][1] <= 64 and max(rows["tile-cells"]) < 1500
    plain = sorted(map(tuple, tl.adaptive_tiles(df, box, rule, None, 13).select(*cols).collect()))
    assert got == plain


def test_pair_queries_carry_their_columns_only(spark):
    from staylink.plans.catalog import PAIR_COLS, training_rows
    sf = "/root/testdata/sf0.001"
    narrow, wide = training_rows(spark, sf, PAIR_COLS), training_rows(spark, sf)
    assert narrow.columns == PAIR_COLS
    assert sorted(map(str, narrow.collect())) == sorted(map(str, wide.select(*PAIR_COLS).collect()))
