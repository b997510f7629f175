"""Graph kernels on edge DataFrames: connected components and the
order-dependent seeded clustering.

Edges are contracted a chunk at a time before anything is shuffled: a chunk
becomes stars around the least vertex of each of its parts, at most one edge a
vertex.  Only stars that share a vertex with another one go through rounds, each
with one small action, kept in ``spark.checkpoint.dir`` until the next is written.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, forget_rows, store_rows

#: Edges of a chunk (some tens of megabytes in a task).
AT_ONCE = 500_000


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The ends of about :data:`AT_ONCE` edges at a time; edges with a missing end join nothing."""
    held, n = [], 0
    ends = lambda: [np.concatenate([b.column(k).to_numpy(zero_copy_only=False) for b in held]) for k in (0, 1)]
    for batch in batches:
        batch = batch.drop_null()
        held, n = [*held, batch], n + batch.num_rows
        if n >= AT_ONCE:
            yield tuple(ends())
            held, n = [], 0
    if n:
        yield tuple(ends())


def _contracted(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(ids, lo, hi, least): the distinct vertices in order, each edge's lesser and
    greater end as places there, and for each vertex the least one of its part.
    Greater roots take the least root they meet until no edge joins two roots."""
    ids, place = np.unique(np.concatenate([u, v]), return_inverse=True)
    lo, hi = np.minimum(place[:len(u)], place[len(u):]), np.maximum(place[:len(u)], place[len(u):])
    least, x, y = np.arange(len(ids)), lo, hi
    while len(x):
        np.minimum.at(least, np.maximum(x, y), np.minimum(x, y))
        while (nearer := least[least] != least).any():
            least = least[least]
        x, y = least[x], least[y]
        apart = x != y
        x, y = x[apart], y[apart]
    return ids, lo, hi, least


def _stars(edges: DataFrame) -> DataFrame:
    """(u, v), u > v, with the components of the edges (u, v)."""

    def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for u, v in _chunks(batches):
            ids, _, _, least = _contracted(u, v)
            leaf = least != np.arange(len(ids))
            yield pa.record_batch({"u": ids[leaf], "v": ids[least[leaf]]}, schema=pa.schema([("u", pa.int64()), ("v", pa.int64())]))

    return edges.mapInArrow(contract, "u long, v long")


def _both_ways(e: DataFrame) -> DataFrame:
    return e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(e: DataFrame) -> DataFrame:
    """Each node links its larger neighbours to the least node of its closed
    neighbourhood."""
    a = _both_ways(e)
    m = a.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    out = a.join(m, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out.distinct()


def _small_star(e: DataFrame) -> DataFrame:
    """Each node links itself and its smaller neighbours to the least of them."""
    a = _both_ways(e).where(F.col("v") < F.col("u"))
    m = a.groupBy("u").agg(F.min("v").alias("m"))
    spokes = a.join(m, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return spokes.unionByName(m.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame, vertices: "DataFrame | None" = None, src: str = "src",
                         dst: str = "dst", vertex: str = "row_id", max_rounds: int = 200) -> DataFrame:
    """(row_id, component) with component = least vertex id of its component.

    The edges' chunks are contracted to stars.  A leaf that no other star holds
    takes the label of its star's centre; the other edges go through alternating
    large-star / small-star rounds (Kiveris et al., 2014) until they stop
    changing: a set of stars around each component's least vertex.  Raises
    instead of returning unconverged labels.
    """
    e = edges.select(F.col(src).cast("long").alias("u"), F.col(dst).cast("long").alias("v")).where(F.col("u") != F.col("v"))
    labels = _star_labels(store_rows(_stars(e), "component-stars"), max_rounds).withColumnRenamed("node", vertex)
    if vertices is None:
        return labels
    v = vertices.select(vertex).distinct()
    return v.join(labels, vertex, "left").select(vertex, F.coalesce("component", F.col(vertex)).alias("component"))


def _shared(stars: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The centres of stored stars (u, v), u > v, and the vertices that are the
    leaf of one star and are in another."""
    centres = stars.select(F.col("v").alias("u")).distinct()
    met = stars.groupBy("u").agg(F.count(F.lit(1)).alias("n")).unionByName(centres.withColumn("n", F.lit(1).cast("long")))
    return centres, store_rows(met.groupBy("u").agg(F.sum("n").alias("n")).where("n > 1").select("u"), "component-shared")


def _centre_labels(stars: DataFrame, max_rounds: int = 200) -> tuple[DataFrame, "DataFrame | None"]:
    """(node, component) of the centres and of the shared vertices of stored
    stars, and the shared vertices, if any."""
    centres, shared = _shared(stars)
    centres = centres.select(F.col("u").alias("node"))
    if shared.isEmpty():
        return centres.withColumn("component", F.col("node")), None
    labels = store_rows(_rounds(stars.join(shared, "u", "left_semi"), max_rounds), "component-labels")
    alone = centres.join(labels, "node", "left_anti").withColumn("component", F.col("node"))
    return labels.unionByName(alone), shared


def _star_labels(stars: DataFrame, max_rounds: int = 200) -> DataFrame:
    """(node, component) of the vertices of stored stars."""
    labels, shared = _centre_labels(stars, max_rounds)
    leaves = stars if shared is None else stars.join(shared, "u", "left_anti")
    leaves = leaves.select(F.col("u").alias("leaf"), F.col("v").alias("node")).join(labels, "node")
    return labels.unionByName(leaves.select(F.col("leaf").alias("node"), "component"))


def _rounds(edges: DataFrame, max_rounds: int) -> DataFrame:
    """(node, component) of the vertices of edges (u, v), u > v."""
    e = store_rows(edges.distinct(), "component-edges")
    n_e = e.count()
    for _ in range(max_rounds):
        nxt = store_rows(_small_star(_large_star(e)), "component-edges")
        n_nxt = nxt.count()
        same = n_nxt == n_e and (n_e == 0 or nxt.join(e, ["u", "v"], "left_anti").isEmpty())
        forget_rows(e)
        e, n_e = nxt, n_nxt
        if same:
            break
    else:
        raise RuntimeError(f"connected_components did not converge in {max_rounds} rounds")
    # converged: every edge joins a vertex to its component's least vertex
    return _both_ways(e).groupBy(F.col("u").alias("node")).agg(F.least(F.min("v"), F.col("u")).alias("component"))


def seed_rounds(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 10_000) -> DataFrame:
    """Seeds of the order-dependent scan: vertex i is a seed iff no smaller
    seed has an edge to it (the lexicographically first maximal independent
    set).  Decided in rounds: an undecided vertex with a smaller seed
    neighbour is not a seed; one whose smaller neighbours are all decided
    non-seeds is a seed.  Rounds follow the longest chain of undecided
    vertices, short when ids are not spatially ordered.  Returns (node, is_seed)
    for every vertex that has an edge."""
    e = edges.select(F.least(src, dst).alias("a"), F.greatest(src, dst).alias("b")) \
             .where(F.col("a") != F.col("b")).distinct()
    e = cut_lineage(e)
    nodes = e.select(F.col("a").alias("node")).unionByName(e.select(F.col("b").alias("node"))).distinct()
    state = cut_lineage(nodes.withColumn("st", F.lit("U")))
    for _ in range(max_rounds):
        if state.where(F.col("st") == "U").isEmpty():
            return state.select("node", (F.col("st") == "S").alias("is_seed"))
        sa = state.select(F.col("node").alias("a"), F.col("st").alias("sa"))
        sb = state.select(F.col("node").alias("b"), F.col("st").alias("sb"))
        live = e.join(sb.where(F.col("sb") == "U"), "b").join(sa.where(F.col("sa") != "N"), "a")
        dec = live.groupBy("b").agg(F.bool_or(F.col("sa") == "S").alias("has_seed"),
                                    F.bool_or(F.col("sa") == "U").alias("blocked"))
        state = cut_lineage(
            state.join(dec, state["node"] == dec["b"], "left")
                 .select("node", F.when(F.col("st") != "U", F.col("st"))
                         .when(F.coalesce("has_seed", F.lit(False)), F.lit("N"))
                         .when(F.coalesce("blocked", F.lit(False)), F.lit("U"))
                         .otherwise(F.lit("S")).alias("st")))
        # edges whose larger end is decided can no longer change anything
        e = cut_lineage(e.join(state.where(F.col("st") == "U").select(F.col("node").alias("b")), "b")
                        .select("a", "b"))
    raise RuntimeError(f"seeds did not settle in {max_rounds} rounds")


#: Edges up to which a component is scanned in one task (a few tens of megabytes there).
SCANNED = 500_000
#: Edges of a packed row.
PACKED = 1024


def _find(parent, x: int) -> int:
    while (up := parent[x]) != x:
        parent[x] = x = parent[up]
    return x


class _Scan:
    """The ends of the edges of one component, joined one after the other."""

    def __init__(self):
        self.parent: dict = {}

    def edge(self, a: int, b: int) -> None:
        lo, hi = sorted(_find(self.parent, self.parent.setdefault(x, x)) for x in (a, b))
        self.parent[hi] = lo

    def labels(self) -> list:
        return [(x, _find(self.parent, x)) for x in self.parent]


def components_in_groups(edges: DataFrame, group: str, src: str = "src", dst: str = "dst", vertex: str = "row_id") -> DataFrame:
    """(row_id, component) of edges that never leave their group, whose groups
    are small enough to be scanned whole, each in one task: no rounds.  An edge
    from a vertex to itself names the vertex."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, at, state = [], None, _Scan()
        pack = lambda rows: pa.record_batch({"node": [x for x, _ in rows], "component": [y for _, y in rows]},
                                            schema=pa.schema([("node", pa.int64()), ("component", pa.int64())]))
        for batch in batches:
            for component, a, b in zip(*(batch[c].to_pylist() for c in ("component", "a", "b"))):
                if component != at:
                    done += state.labels()
                    at, state = component, _Scan()
                    if len(done) >= 50_000:
                        yield pack(done)
                        done = []
                state.edge(a, b)
        yield pack(done + state.labels())

    e = edges.select(F.col(group).alias("component"), F.col(src).alias("a"), F.col(dst).alias("b"))
    return e.repartition("component").sortWithinPartitions("component", "a", "b").mapInArrow(scan, "node long, component long") \
            .select(F.col("node").alias(vertex), "component")


_PACK = pa.schema([("part", pa.int64()), ("n", pa.int32()), ("ids", pa.binary()), ("ends", pa.binary())])


def _binary(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Rows of ``counts`` values each, as bytes."""
    offsets = np.concatenate([[0], np.cumsum(counts * values.itemsize)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def _pack(edges: DataFrame) -> DataFrame:
    """Edges (u, v) in rows of up to :data:`PACKED` edges of one part of a chunk:
    ``part``, the least vertex; ``n`` edges; ``ids``, their vertices in order; ``ends``,
    both ends of each edge as places in ``ids``, in order, the lesser end first.  A
    byte or two an end instead of eight."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for u, v in _chunks(batches):
            ids, lo, hi, least = _contracted(u, v)
            lo, hi = np.divmod(np.unique((lo * len(ids) + hi)[lo != hi]), len(ids))
            if not len(lo):
                continue
            order = np.argsort(least[lo], kind="stable")
            lo, hi = lo[order], hi[order]
            part = least[lo]
            begins = np.flatnonzero(np.diff(part, prepend=-1))
            rank = np.arange(len(lo)) - np.repeat(begins, np.diff(begins, append=len(lo)))
            row = np.cumsum(rank % PACKED == 0) - 1
            met, place = np.unique(np.concatenate([row * len(ids) + lo, row * len(ids) + hi]), return_inverse=True)
            of, vertex = np.divmod(met, len(ids))
            n_edges, n_ids = np.bincount(row), np.bincount(of)
            place -= np.tile((np.cumsum(n_ids) - n_ids)[row], 2)
            ends, part = np.stack([place[:len(lo)], place[len(lo):]], axis=1), ids[part[rank % PACKED == 0]]
            for narrow, kind in ((n_ids <= 256, np.uint8), (n_ids > 256, np.uint16)):
                if narrow.any():
                    yield pa.record_batch([pa.array(part[narrow]), pa.array(n_edges[narrow].astype(np.int32)), _binary(ids[vertex[narrow[of]]], n_ids[narrow]),
                                           _binary(ends[narrow[row]].astype(kind), 2 * n_edges[narrow])], schema=_PACK)

    return edges.mapInArrow(pack, "part long, n int, ids binary, ends binary")


def _unpacked(ids: bytes, ends: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The vertices, and the ends of each edge as places there."""
    ids = np.frombuffer(ids, np.int64)
    return ids, np.frombuffer(ends, np.uint8 if len(ids) <= 256 else np.uint16).reshape(-1, 2)


def _leaves_of(packed: DataFrame) -> DataFrame:
    """(u, v) from each vertex of a packed row to the least of its part."""

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [np.frombuffer(x, np.int64) for x in batch["ids"].to_pylist()]
            u = np.concatenate([*held, np.empty(0, np.int64)])
            v = np.repeat(batch["part"].to_numpy(), [len(x) for x in held])
            yield pa.record_batch({"u": u[u != v], "v": v[u != v]}, schema=pa.schema([("u", pa.int64()), ("v", pa.int64())]))

    return packed.select("part", "ids").mapInArrow(leaves, "u long, v long")


def _edges_of(packed: DataFrame) -> DataFrame:
    """(a, b), a < b, of packed rows."""

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in zip(batch["ids"].to_pylist(), batch["ends"].to_pylist()):
                ids, ends = _unpacked(*row)
                yield pa.record_batch({"a": ids[ends[:, 0]], "b": ids[ends[:, 1]]}, schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    return packed.select("ids", "ends").mapInArrow(edges, "a long, b long")


def _seeded(rows: list) -> tuple[list, list]:
    """(vertices, labels) of the seed scan over the packed rows of a component:
    in order, a vertex that none has taken is a seed and takes its larger neighbours;
    the edges of any other vertex hold nothing."""
    if len(rows) == 1:
        ids, ends = memoryview(rows[0][0]).cast("q").tolist(), rows[0][1]
        ends = ends if len(ids) <= 256 else memoryview(ends).cast("H").tolist()
        a, b = ends[0::2], ends[1::2]
    else:
        parts = [_unpacked(*row) for row in rows]
        all_ids = np.unique(np.concatenate([i for i, _ in parts]))
        ends = np.concatenate([np.searchsorted(all_ids, i)[e] for i, e in parts])
        a, b = (x.tolist() for x in np.divmod(np.unique(ends[:, 0] * len(all_ids) + ends[:, 1]), len(all_ids)))
        ids = all_ids.tolist()
    parent, taken, at = list(range(len(ids))), bytearray(len(ids)), 0
    while at < len(a):
        x = a[at]
        end = bisect_right(a, x, at)
        if not taken[x]:
            root = _find(parent, x)
            for y in b[at:end]:
                taken[y] = 1
                other = _find(parent, y)
                root, other = (root, other) if root < other else (other, root)
                parent[other] = root
        at = end
    return ids, [ids[_find(parent, x)] for x in range(len(ids))]


def _scan_components(packed: DataFrame, out: str) -> DataFrame:
    """(node, out) of the seed scan over packed rows with their ``component``:
    each partition streams through its components one after the other."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes, labels, at, held = [], [], None, []
        schema = pa.schema([("node", pa.int64()), (out, pa.int64())])
        for batch in batches:
            for component, *row in zip(*(batch[c].to_pylist() for c in ("component", "ids", "ends"))):
                if component != at and held:
                    found = _seeded(held)
                    nodes += found[0]
                    labels += found[1]
                    held = []
                    if len(nodes) >= 50_000:
                        yield pa.record_batch([nodes, labels], schema=schema)
                        nodes, labels = [], []
                at = component
                held.append(row)
        if held:
            found = _seeded(held)
            yield pa.record_batch([nodes + found[0], labels + found[1]], schema=schema)

    return packed.select("component", "ids", "ends").repartition("component").sortWithinPartitions("component") \
                 .mapInArrow(scan, f"node long, {out} long")


def cluster_seeded(vertices: DataFrame, edges: DataFrame, mode: str = "seeded", vertex: str = "row_id",
                   src: str = "src", dst: str = "dst", out: str = "dup_group_id", scanned: int = SCANNED) -> DataFrame:
    """(row_id, dup_group_id): groups of the seed scan (``mode='seeded'``: a
    seed absorbs its larger neighbours; groups are components of the seed
    edges) or plain components of all edges (``mode='components'``).  The
    label is the least ``row_id`` of the group.

    The scan never leaves a component of the graph, so components of up to
    ``scanned`` edges are scanned whole, each in one task, and the rounds of
    :func:`seed_rounds` are left for larger ones.  Edges are written and shuffled
    packed (:func:`_pack`)."""
    e = edges.select(F.col(src).cast("long").alias("u"), F.col(dst).cast("long").alias("v"))
    if mode == "components":
        return connected_components(e, vertices.select(vertex), src="u", dst="v", vertex=vertex).withColumnRenamed("component", out)
    if mode != "seeded":
        raise ValueError("mode must be 'seeded' or 'components'")
    packed = store_rows(_pack(e), "packed-edges")
    parts, _ = _centre_labels(store_rows(_leaves_of(packed), "component-stars"))
    packed = packed.join(parts.withColumnRenamed("node", "part"), "part")
    large = store_rows(packed.groupBy("component").agg(F.sum("n").alias("n")).where(F.col("n") > scanned).select("component"), "large-components")
    if large.isEmpty():
        labels = _scan_components(packed, out)
    else:
        labels = _scan_components(packed.join(large, "component", "left_anti"), out)
        rest = store_rows(_edges_of(packed.join(large, "component", "left_semi")), "large-edges")
        s = seed_rounds(rest, "a", "b").where("is_seed").select(F.col("node").alias("a"))
        held = connected_components(rest.join(s, "a"), src="a", dst="b", vertex="node").withColumnRenamed("component", out)
        labels = labels.unionByName(held)
    v = vertices.select(vertex).distinct()
    return v.join(labels.withColumnRenamed("node", vertex), vertex, "left") \
            .select(vertex, F.coalesce(out, F.col(vertex)).alias(out))
