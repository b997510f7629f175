"""Licence/host grouping golden cases (key = licence A; row_id: host)."""

import pytest

from staylink.operators.grouping import drop_lone_unlicensed, first_per_group, group_by_licence_host


def _groups(spark, rows, **kw):
    df = spark.createDataFrame([(rid, "A", h, 39.5, 2.6) for rid, h in rows],
                               "row_id long, _license_norm string, _host_norm string, lat double, lng double")
    out = group_by_licence_host(df, **kw).select("row_id", "group_id").collect()
    return {r[0]: r[1] for r in out}


@pytest.mark.parametrize("rows,expected", [
    ([(0, "x")], {0: "ROW_0_A"}),
    ([(0, "x"), (1, "y")], {0: "LIC_A_ALL", 1: "LIC_A_ALL"}),
    ([(0, "x"), (1, "x")], {0: "LIC_A_ANCH", 1: "ROW_1_A"}),
    ([(0, "y"), (1, "x"), (2, "x"), (3, "z")], {0: "LIC_A_ANCH", 1: "LIC_A_ANCH", 2: "ROW_2_A", 3: "LIC_A_ANCH"}),
])
def test_golden_groups(spark, rows, expected):
    assert _groups(spark, rows) == expected


def test_tie_goes_to_first_seen_host(spark):
    # x and y both repeat twice; x is seen first (row 0)
    got = _groups(spark, [(0, "x"), (1, "y"), (2, "x"), (3, "y")], row_suffix=False)
    assert got == {0: "LIC_A_ANCH", 1: "LIC_A_ANCH", 2: "ROW_2", 3: "LIC_A_ANCH"}


def test_medoid_anchor(spark):
    rows = [(0, "p", 39.50, 2.60), (1, "p", 39.60, 2.60), (2, "p", 39.55, 2.60), (3, "q", 39.56, 2.60)]
    df = spark.createDataFrame([(r, "A", h, la, lo) for r, h, la, lo in rows],
                               "row_id long, _license_norm string, _host_norm string, lat double, lng double")
    got = {r[0]: r[1] for r in group_by_licence_host(df, anchor="medoid", row_suffix=False)
           .select("row_id", "group_id").collect()}
    assert got == {0: "ROW_0", 1: "ROW_1", 2: "LIC_A_ANCH", 3: "LIC_A_ANCH"}


def test_medoid_null_coordinate_keeps_first(spark):
    rows = [(0, "p", 39.50, 2.60), (1, "p", 39.60, 2.60), (2, "p", None, None)]
    df = spark.createDataFrame([(r, "A", h, la, lo) for r, h, la, lo in rows],
                               "row_id long, _license_norm string, _host_norm string, lat double, lng double")
    got = {r[0]: r[1] for r in group_by_licence_host(df, anchor="medoid", row_suffix=False)
           .select("row_id", "group_id").collect()}
    assert got[0] == "LIC_A_ANCH"


def test_lone_unlicensed_and_first(spark):
    df = spark.createDataFrame([(0, "g", "L1"), (1, "g", None), (2, "h", None), (3, "h", None), (4, "h", "L2")],
                               "row_id long, group_id string, licencia string")
    kept = sorted(r[0] for r in drop_lone_unlicensed(df).collect())
    assert kept == [0, 2, 3, 4]
    firsts = {r["group_id"]: r["row_id"] for r in first_per_group(df).collect()}
    assert firsts == {"g": 0, "h": 2}


def test_rows_without_a_group_keep_no_flags(spark):
    from staylink.operators.grouping import drop_lone_unlicensed
    df = spark.createDataFrame([(1, None, "L1"), (2, None, None), (3, "g", "L1"), (4, "g", None)],
                               "row_id long, group_id string, licencia string")
    assert sorted(r.row_id for r in drop_lone_unlicensed(df).collect()) == [1, 2, 3]
