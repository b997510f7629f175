"""Whitening against numpy on exact integers, and odd rows."""

import numpy as np
import pytest

from staylink.llm import whitening as wh

SCHEMA = "vec_id long, embedding array<float>, label int, n int, whitened string"


@pytest.mark.parametrize("values", [[5.0], [3, 1], [1, 1, 1], [9, 9, 4, 4, 4, 0], list(range(40, 0, -1)),
                                    [10.0 ** -k for k in range(12)], [1e6] + [1.0] * 30, [1.0] * 30 + [0.0], [2, 0, -2, -7]])
def test_components_against_eigh(values):
    n = len(values)
    q = np.linalg.qr(np.random.default_rng(n).standard_normal((n, n)))[0]
    a = q * values @ q.T
    a = (a + a.T) / 2
    e, v = wh.components(a, n)
    exact = np.linalg.eigvalsh(a)[::-1]
    scale = np.abs(exact).max()
    assert np.abs(e - exact).max() <= 1e-13 * scale * n
    assert np.abs(v.T @ v - np.eye(n)).max() < 1e-12
    assert np.abs(a @ v - v * e).max() <= 1e-13 * scale * n
    few, _ = wh.components(a, min(3, n))
    assert np.abs(few - exact[:len(few)]).max() <= 1e-13 * scale * n


def test_polar_factor():
    a = np.random.default_rng(1).standard_normal((30, 30))
    a = a + a.T
    e, v = np.linalg.eigh(a)
    assert np.abs(wh.polar(a) - v * np.sign(e) @ v.T).max() < 1e-13


def test_products_stay_exact():
    z = np.array([[1 << 20, -3], [5, 1 << 25], [-(1 << 25), 7]], np.int64)
    big = z.astype(object)
    assert (wh.products(z) == big.T @ big).all()
    assert (wh.products(z * (1 << 30)) == (big.T @ big) * (1 << 60)).all()


def brute(rows):
    """Eigen decomposition of the distinct integer vectors, in numpy."""
    kept = [(i, [int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v]) for i, v in rows
            if v and all(c is not None and np.isfinite(c) for c in v)]
    x = np.array(sorted({tuple(v) for _, v in kept}))
    n, s = len(x), x.sum(0)
    y = x - s / n
    e, u = np.linalg.eigh(y.T @ y / n)
    return kept, n, s, e[::-1], u[:, ::-1]


def run(spark, rows, tmp_path):
    spark.createDataFrame([(i, v, 1, 2, "z") for i, v in rows], SCHEMA).repartition(3).write.parquet(str(tmp_path / "embeddings.parquet"))
    return wh.op11_whitening(spark, str(tmp_path)).collect()


def test_query_against_numpy(spark, tmp_path):
    rng = np.random.default_rng(4)
    mix = rng.standard_normal((20, 20))
    rows = [(i, (rng.standard_normal(20) @ mix).tolist()) for i in range(300)]
    rows += [(1000 + k, rows[5][1]) for k in range(50)] + [(7, rows[7][1])]  # copies and a repeated row
    rows += [(2000, None), (2001, []), (2002, [None] * 20), (2003, [float("nan")] * 20), (2004, [float("inf")] + [0.0] * 19),
             (2005, [1.0] * 3), (None, rows[9][1])]
    got = run(spark, rows, tmp_path)
    kept, n, s, e, u = brute([r for r in rows if r[1] is None or len(r[1]) != 3])
    assert len(got) == 16 * len(kept) and {r.n for r in got} == {n}
    signs = {}
    by_id = {i: np.array(v) for i, v in kept}
    for r in got:
        x = by_id[r.vec_id]
        assert r.deviation == int(((n * x - s) ** 2).sum()) == int(r.deviation_exact)
        want = (x - s / n) @ u[:, r.component - 1] / np.sqrt(e[r.component - 1])
        sign = signs.setdefault(r.component, np.sign(want) * np.sign(r.whitened))
        assert abs(sign * want - r.whitened) < 1e-9
        assert abs(r.explained - e[r.component - 1] / e.sum()) < 1e-12
        assert r.identity_error < 1e-10
    assert sorted({r.component for r in got}) == list(range(1, 17))


def test_few_vectors_and_empty_tables(spark, tmp_path):
    assert run(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])], tmp_path / "one") == []  # no variance
    got = run(spark, [(1, [1.0, 2.0, 0.0]), (2, [3.0, 2.0, 0.0])], tmp_path / "two")
    assert sorted((r.component, round(abs(r.whitened), 9)) for r in got) == [(1, 1.0), (1, 1.0)]
    assert run(spark, [], tmp_path / "none") == []
    assert run(spark, [(1, None)], tmp_path / "null") == []


def test_large_sums_stay_exact(spark, tmp_path):
    got = run(spark, [(k, [float(2 ** 40) * k, 1.0]) for k in range(3)], tmp_path)
    want = {k: (3 * 64 * 2 ** 40 * k - 64 * 2 ** 40 * 3) ** 2 for k in range(3)}
    assert {r.vec_id: int(r.deviation_exact) for r in got} == want
    assert {r.deviation for r in got} == {0, None}
