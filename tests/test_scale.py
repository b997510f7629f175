"""What keeps the larger flows in proportion to their input."""

import random

import pytest
from pyspark.sql import functions as F
from test_spatial import components

from staylink.functions.similarity import letter_bits, letter_counts, letter_levels
from staylink.operators import survivors
from staylink.operators.grouping import medoid_anchor
from staylink.operators.pairs import hard_negative_pairs
from staylink.operators.similarity import title_similarity_edges
from staylink.operators.survivors import split_groups_by_distance
from staylink.sources.tables import load_listings

ROWS = "row_id long, group_id string, lat double, lng double"


def plan_of(df):
    return df._jdf.queryExecution().toString()


def test_listings_are_dealt_to_many_files(spark, tmp_path):
    spark.range(500).withColumnRenamed("id", "o_orderkey").coalesce(1).write.parquet(str(tmp_path / "orders.parquet"))
    files = load_listings(spark, str(tmp_path)).select(F.input_file_name()).distinct().count()
    assert files >= 2 * spark.sparkContext.defaultParallelism


def test_letter_bits_are_the_letter_levels(spark):
    rng = random.Random(3)
    texts = [None, "", "a" * 30, "é" * 12 + "\U0001F600", "casa 12 ñ-", "zz" * 9] + ["".join(rng.choice("ab é7ñ-") for _ in range(rng.randrange(60))) for _ in range(200)]
    d = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "k int, t string")
    rows = d.select("t", letter_bits("t").alias("x"), letter_levels(letter_counts("t")).alias("y")).collect()
    assert [r for r in rows if r.x != r.y] == [] and any(r.x.rest for r in rows)


@pytest.mark.parametrize("metric", ["ratio", "levenshtein"])
def test_title_filters_stay_behind_the_join(spark, metric):
    d = spark.createDataFrame([(1, 39.0, 2.0, "p", 2, 1, "casa uno")], "row_id long, lat double, lng double, plataforma string, capacidad int, habitaciones int, title_norm string")
    plan = title_similarity_edges(d, metric=metric)._jdf.queryExecution().optimizedPlan().toString()
    assert [line for line in plan.split("\n") if "bit_count" in line] and not [line for line in plan.split("\n") if "Join" in line and "bit_count" in line]
    assert "replace(" not in plan  # the letters are read, not counted again on both sides


def split(spark, rows):
    out = split_groups_by_distance(spark.createDataFrame(rows, ROWS), 2.0)
    return sorted((r.row_id, r.group_id or "") for r in out.select("row_id", "group_id").collect())


def test_groups_within_the_distance_go_no_further(spark, monkeypatch):
    def never(*_):
        raise AssertionError("no group is in doubt")

    monkeypatch.setattr(survivors, "connected_components", never)
    assert split(spark, [(1, "A", 39.0, 2.0), (2, "A", 39.01, 2.0), (3, "B", 39.0, 2.0), (4, None, 39.0, 2.0)]) == [(1, "A"), (2, "A"), (3, "B"), (4, "")]
    # small groups in doubt are scanned, without rounds
    assert split(spark, [(1, "A", 39.0, 2.0), (2, "A", 39.05, 2.0), (3, "A", None, 2.0), (4, "A", 39.001, 2.0)]) \
        == [(1, "A_LOC1"), (2, "A_LOC2"), (3, "A_LOC3"), (4, "A_LOC1")]


@pytest.mark.parametrize("small", [0, 64])
def test_split_clusters_are_the_components(spark, monkeypatch, small):
    monkeypatch.setattr(survivors, "SMALL", small)
    rng, rows, expected = random.Random(5), [], []
    for g in range(12):
        points = [(39 + rng.random() * 0.1, 2 + rng.random() * 0.1) for _ in range(rng.randrange(1, 12))]
        found = components([("g", *p) for p in points], 2.0)
        least = sorted(set(found.values()))
        rows += [(g * 100 + i, f"G{g}", *p) for i, p in enumerate(points)]
        expected += [(g * 100 + i, f"G{g}_LOC{least.index(found[i]) + 1}" if len(least) > 1 else f"G{g}") for i in range(len(points))]
    assert split(spark, rows) == sorted(expected)


def test_split_of_shared_and_missing_ids(spark):
    # rows of one id meet each other's groups, rows without an id leave
    rows = [(1, "A", 39.0, 2.0), (1, "A", 39.0, 2.0), (2, "A", 39.2, 2.0), (3, "B", 39.0, 2.0), (3, None, 39.0, 2.0), (None, "B", 39.0, 2.0)]
    assert split(spark, rows) == [(1, "A_LOC1")] * 4 + [(2, "A_LOC2"), (3, ""), (3, ""), (3, "B"), (3, "B")]


def test_small_keys_are_not_salted(spark):
    d = spark.createDataFrame([(i, "K", f"h{i % 3 // 2}", 39 + i / 100, 2.0) for i in range(9)], "row_id long, key string, host string, lat double, lng double")
    out = medoid_anchor(d, "key", "host")
    assert "_salt" not in plan_of(out) and out.first().anchor_row == 4


def test_drawn_negatives_are_shuffled_once_a_side(spark):
    d = spark.createDataFrame([(i, f"g{i % 50}", 2, 1) for i in range(400)], "row_id long, group_id string, capacidad int, habitaciones int")
    out = hard_negative_pairs(d, draws=200)
    # the draws meet by the position that the first join looks up
    assert "REPARTITION_BY_COL" in out._jdf.queryExecution().executedPlan().toString() and 0 < out.count() <= 200
