"""Pairs counted by blocks against pairs looked at one by one."""

import math
import random

from staylink.functions.geo import EARTH_KM_INDEX
from staylink.operators import blocks, similarity


def _km(a, b):
    la1, lo1, la2, lo2 = map(math.radians, (*a, *b))
    h = math.sin((la2 - la1) / 2) ** 2 + math.cos(la1) * math.cos(la2) * math.sin((lo2 - lo1) / 2) ** 2
    return 2 * EARTH_KM_INDEX * math.asin(math.sqrt(h))


def _bounds(a, b):
    if a is None or b is None:
        return -1.0, -1.0
    if not a and not b:
        return 1.0, 1.0
    return 2.0 * min(len(a), len(b)) / (len(a) + len(b)), 2.0 * sum(min(a.count(c), b.count(c)) for c in set(a)) / (len(a) + len(b))


def test_candidates_are_counted_without_building_pairs(spark, monkeypatch):
    rng = random.Random(9)
    title = lambda: rng.choice(["", None, "a" * 30, "aaaaaaaaaaaa b", "casa 12", "villa 21", "".join(rng.choice("abc 12") for _ in range(rng.randrange(20)))])
    at = lambda k: (39.5 + (rng.random() - 0.5) * k, 2.9 + (rng.random() - 0.5) * k)
    places = [*(at(0.02) for _ in range(150)), *(at(0.4) for _ in range(120))]
    places += [(None, 2.9)] + places[:20]
    rows = [(i, rng.choice(["p", "q", None]), la, lo, rng.choice([2, 2, None]), title()) for i, (la, lo) in enumerate(places)]
    df = spark.createDataFrame(rows, "row_id long, plataforma string, lat double, lng double, capacidad int, title_norm string")

    def none(*_):
        raise AssertionError("pairs are built")

    monkeypatch.setattr(similarity, "_near", none)
    monkeypatch.setattr(blocks, "HELD", 40)
    for on in ((), ("capacidad",)):
        want = {}
        for i, a in enumerate(rows):
            for b in rows[:i]:
                if a[1] and a[1] == b[1] and None not in (a[2], b[2]) and (not on or (a[4] and a[4] == b[4])) and _km(a[2:4], b[2:4]) <= 8.0:
                    n = want.setdefault(a[1], [0, 0, 0])
                    low, letters = _bounds(a[5], b[5])
                    n[:] = n[0] + 1, n[1] + (low >= 0.7), n[2] + (letters >= 0.7)
        got = {r[0]: list(r[1:]) for r in similarity.title_candidate_report(df, 8000.0, on=on).collect()}
        assert got == {p: [*n, round(n[2] / n[0], 6)] for p, n in want.items()} and len(want) == 2
