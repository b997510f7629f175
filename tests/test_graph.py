"""Seeded clustering against a textbook union-find scan, and components."""

import random

import pytest

from staylink.operators.graph import cluster_seeded, connected_components


def naive_scan(n, edges):
    """Groups by the declarative rule: row i is a seed iff no smaller seed has
    an edge to it; a seed's members are itself and its larger neighbours; groups
    are the unions of member sets that overlap."""
    linked = {frozenset(e) for e in edges}
    seeds = []
    for i in range(n):
        if not any(frozenset((s, i)) in linked for s in seeds):
            seeds.append(i)
    members = [{s} | {j for j in range(s + 1, n) if frozenset((s, j)) in linked} for s in seeds]
    groups = []
    for m in members:
        apart = [g for g in groups if not g & m]
        groups = apart + [m.union(*[g for g in groups if g & m])]
    return sorted(sorted(g) for g in groups)


def spark_partition(spark, n, edges, mode="seeded", **options):
    v = spark.createDataFrame([(i,) for i in range(n)], "row_id long")
    e = spark.createDataFrame(edges or [(0, 0)], "src long, dst long")
    if not edges:
        e = e.limit(0)
    out = cluster_seeded(v, e, mode=mode, **options).collect()
    groups = {}
    for r in out:
        groups.setdefault(r["dup_group_id"], set()).add(r["row_id"])
    labels_ok = all(min(g) == k for k, g in groups.items())
    return sorted(sorted(g) for g in groups.values()), labels_ok


@pytest.mark.parametrize("edges,expected", [
    ([(1, 2), (2, 3)], [[0], [1, 2], [3], [4]]),
    ([(1, 3), (2, 3)], [[0], [1, 2, 3], [4]]),
    ([(1, 2), (1, 3), (3, 4)], [[0], [1, 2, 3], [4]]),
])
def test_golden_seeded(spark, edges, expected):
    got, labels_ok = spark_partition(spark, 5, edges)
    assert got == expected and labels_ok


def test_seeded_matches_naive_loop(spark):
    rng = random.Random(7)
    for _ in range(12):
        n = rng.randint(2, 14)
        edges = sorted({tuple(sorted(rng.sample(range(n), 2))) for _ in range(rng.randint(0, 2 * n))})
        got, labels_ok = spark_partition(spark, n, edges)
        assert got == naive_scan(n, edges), edges
        assert labels_ok


def test_large_components_take_the_rounds(spark):
    """Small ones scanned, larger ones in rounds, together as the naive loop."""
    rng = random.Random(11)
    for scanned in (0, 3):
        n = 40
        edges = sorted({tuple(sorted(rng.sample(range(20), 2))) for _ in range(25)} | {(20, 21), (22, 23), (23, 24), (30, 39)})
        got, labels_ok = spark_partition(spark, n, edges, scanned=scanned)
        assert got == naive_scan(n, edges) and labels_ok


def test_a_long_path_in_order_takes_few_rounds(spark, monkeypatch):
    from staylink.operators import graph
    cuts = []
    cut = graph.cut_lineage
    monkeypatch.setattr(graph, "cut_lineage", lambda df: cuts.append(1) or cut(df))
    n = 100_000
    v = spark.range(n).withColumnRenamed("id", "row_id")
    e = spark.range(n - 1).selectExpr("id as src", "id + 1 as dst")
    got = cluster_seeded(v, e)
    # every second vertex is a seed and takes the next one
    assert got.where("dup_group_id <> row_id - row_id % 2").isEmpty() and got.count() == n
    assert len(cuts) < 30


def test_components(spark):
    e = spark.createDataFrame([(1, 2), (2, 3), (7, 5), (5, 9), (10, 11)], "src long, dst long")
    v = spark.createDataFrame([(i,) for i in range(12)], "row_id long")
    got = {r[0]: r[1] for r in connected_components(e, v).collect()}
    assert got == {0: 0, 1: 1, 2: 1, 3: 1, 4: 4, 5: 5, 6: 6, 7: 5, 8: 8, 9: 5, 10: 10, 11: 10}


def test_edges_are_contracted_before_they_are_written(spark, monkeypatch):
    """100 cliques of 20: 19,000 edges, of which one a vertex is kept, or a row a part."""
    from staylink.operators import graph
    rows, store = {}, graph.store_rows

    def counted(df, tag):
        out = store(df, tag)
        rows[tag] = max(rows.get(tag, 0), out.count())
        return out

    monkeypatch.setattr(graph, "store_rows", counted)
    v = spark.range(2000).withColumnRenamed("id", "row_id")
    e = v.selectExpr("row_id as src", "explode(sequence(row_id, row_id - row_id % 20 + 19)) as dst").where("src <> dst")
    for got in (connected_components(e, v).withColumnRenamed("component", "c"), cluster_seeded(v, e).withColumnRenamed("dup_group_id", "c")):
        assert got.where("c <> row_id - row_id % 20").isEmpty() and got.count() == 2000
    assert rows["packed-edges"] < 200 and max(rows.values()) < 4000, rows


def test_parts_of_chunks_meet(spark):
    """Edges dealt to many partitions, given twice and turned round; parts of more
    edges and vertices than a packed row and a byte hold."""
    rng = random.Random(13)
    n = 1500
    near = {tuple(sorted((a, min(n - 1, a + rng.randint(1, 30))))) for a in range(700) for _ in range(3)}
    clique = {(a, b) for a in range(700, 760) for b in range(a + 1, 760)}
    star = {(800, b) for b in range(801, 1400)} | {(1400, 1401), (1399, 1400)}
    edges = sorted(e for e in near | clique | star if e[0] != e[1])
    v = spark.range(n).withColumnRenamed("id", "row_id")
    e = spark.createDataFrame([*edges, *((b, a) for a, b in edges[::2]), (5, 5), (None, 7)], "src long, dst long")
    linked = {i: set() for i in range(n)}
    for a, b in edges:
        linked[a].add(b)
    taken, root = set(), list(range(n))
    find = lambda x: x if root[x] == x else find(root[x])
    whole = list(range(n))
    top = lambda x: x if whole[x] == x else top(whole[x])
    for a in range(n):
        for b in linked[a]:
            whole[max(top(a), top(b))] = min(top(a), top(b))
            if a not in taken:
                root[max(find(a), find(b))] = min(find(a), find(b))
        taken |= linked[a] if a not in taken else set()
    for parts in (1, 12):
        dealt = e.repartition(parts)
        assert dict(map(tuple, cluster_seeded(v, dealt).collect())) == {x: find(x) for x in range(n)}
        assert dict(map(tuple, connected_components(dealt, v).collect())) == {x: top(x) for x in range(n)}
