"""Rows that share a doc_id and differ in text lose no link."""

import random

import pytest

from staylink.llm.jaccard import jaccard_components


def text(rng, n=400):
    return " ".join(f"w{rng.randrange(9000)}" for _ in range(n))


def test_links_of_every_text_of_an_id(spark):
    rng = random.Random(1)
    a, b, c, d = (text(rng) for _ in range(4))
    rows = [(1, a), (1, b), (2, a + " end"), (3, b + " end"), (1, a),  # all one component
            (7, c), (7, ""), (7, None), (9, c + " more"), (8, d), (6, d + " more"), (None, a), (None, b), (5, None), (5, "   ")]
    got = [tuple(r) for r in jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    want = [(1, 1), (1, 1), (2, 1), (3, 1), (1, 1), (7, 7), (7, 7), (7, 7), (9, 7), (8, 6), (6, 6), (None, None), (None, None), (5, 5), (5, 5)]
    assert sorted([(i, k) for i, _, k in got], key=str) == sorted(want, key=str)
    assert sorted(n for _, n, _ in got)[:4] == [0, 0, 0, 0]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(spark, seed):
    rng = random.Random(seed)
    base = [text(rng, 60) for _ in range(8)]
    rows = [(rng.randrange(12), rng.choice(base) + rng.choice(["", " x", " x y", " z"])) for _ in range(40)]
    sets = [(i, {tuple(t.split()[k:k + 3]) for k in range(len(t.split()) - 2)}) for i, t in rows]
    label = {i: i for i, _ in rows}
    for i, a in sets:
        for j, b in sets:
            if 100 * len(a & b) >= 90 * len(a | b):
                lo, hi = sorted((label[i], label[j]))
                label = {k: lo if v == hi else v for k, v in label.items()}
    got = {(r.doc_id, r.component_id) for r in jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == set(label.items())
