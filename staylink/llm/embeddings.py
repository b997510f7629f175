"""Near-duplicate embeddings by a forest of random projection trees.

Each tree splits recursively at the median of the projections on a random
direction; vectors close to the cut go to both sides (spill), so near pairs
seldom part.  The trees are fitted on at most ``SAMPLE`` vectors (those of least
hash); every vector is then dropped through every tree.  Vectors of one leaf and
label are compared by cosine in double precision; a pair is reported in the first
leaf that both share, so once.  Equal vectors are folded into one class before.

A node whose sample is tight (a group of near copies) is not split, since its
pairs are links; a leaf with more than ``BLOCK`` vectors is compared in blocks,
each pair of blocks a task of its own, so no leaf is one unbounded group.

Defined results: vectors that are null, empty, zero, or hold null or non-finite
components, and rows without a label, link with nothing (n_links 0, own
component); repeated rows link with one another; vectors of different length
never link; an empty table gives no rows.  Only vec_id, embedding and label are
read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.graph import connected_components
from .common import load, stored

COSINE = 0.98
TREES, LEAF, SPILL, SAMPLE = 10, 150, 0.012, 20_000
BLOCK = 1500
#: Sample distance from the middle below which a node is tight: that of a pair at the least cosine.
TIGHT = 0.2


def grow_tree(x: np.ndarray, rng, leaf: int = LEAF) -> list:
    """Nodes (direction, cut, left, right); direction None marks a leaf."""
    nodes: list = []

    def node(part: np.ndarray) -> int:
        k = len(nodes)
        nodes.append(None)
        if len(part) > leaf and np.linalg.norm(part - part.mean(0), axis=1).max() > TIGHT:
            g = rng.standard_normal(part.shape[1])
            g /= np.linalg.norm(g)
            p = part @ g
            cut = float(np.median(p))
            lo, hi = part[p <= cut], part[p > cut]
            if len(lo) and len(hi):
                nodes[k] = (g, cut, node(lo), node(hi))
        return k

    node(x)
    return nodes


def leaves(tree: list, x: np.ndarray, spill: float = SPILL) -> list[tuple[int, np.ndarray]]:
    """(leaf, rows of x in it) for each leaf that gets any."""
    out, todo = [], [(0, np.arange(len(x)))]
    while todo:
        k, rows = todo.pop()
        if not len(rows):
            continue
        if tree[k] is None:
            out.append((k, rows))
            continue
        g, cut, left, right = tree[k]
        p = x[rows] @ g
        todo += [(left, rows[p <= cut + spill]), (right, rows[p > cut - spill])]
    return out


def unit(column: pa.Array) -> list:
    """Unit vectors in double precision; None where none is defined."""
    out = []
    for v in column.to_pylist():
        x = None
        if v and None not in v:
            x = np.array(v, float)
            norm = np.sqrt((x * x).sum()) if np.isfinite(x).all() else 0.0
            x = x / norm if norm > 0 and np.isfinite(norm) else None
        out.append(x)
    return out


def near_links(vectors: DataFrame, cosine: float = COSINE, trees: int = TREES, sample: int = SAMPLE,
               spill: float = SPILL, block: int = BLOCK, seed: int = 3) -> tuple[DataFrame, DataFrame]:
    """(classes, links): classes (label, fp, cls, copies) of equal vectors, links
    (a, b) between classes."""

    @F.arrow_udf("binary")
    def units(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for v in parts:
            yield pa.array([None if x is None else x.tobytes() for x in unit(v)], pa.binary())

    rows = vectors.select("vec_id", "label", units(F.col("embedding").cast("array<double>")).alias("u")) \
                  .where(F.col("u").isNotNull() & F.col("label").isNotNull() & F.col("vec_id").isNotNull())
    rows = stored(rows, "units")
    classes = stored(rows.groupBy("label", "u").agg(F.min("vec_id").alias("cls"), F.count("*").alias("copies")), "vec-classes")
    kept = [np.frombuffer(r[0]) for r in classes.orderBy(F.xxhash64("cls"), "cls").limit(sample).select("u").collect()]
    by_width: dict = {}
    for x in kept:
        by_width.setdefault(len(x), []).append(x)
    rng = np.random.default_rng(seed)
    forest = {w: [grow_tree(np.array(xs), rng) for _ in range(trees)] for w, xs in by_width.items()}
    stride = 1 << 24

    @F.arrow_udf("array<bigint>")
    def leaf_ids(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in parts:
            xs = [np.frombuffer(b) for b in column.to_pylist()]
            found: list[list[int]] = [[] for _ in xs]
            for width in {len(x) for x in xs}:
                at = [i for i, x in enumerate(xs) if len(x) == width]
                x = np.array([xs[i] for i in at])
                for t, tree in enumerate(forest.get(width, [[None]])):
                    for leaf, part in leaves(tree, x, spill):
                        for i in part:
                            found[at[i]].append((width * 1000 + t) * stride + leaf)
            yield pa.array([sorted(f) for f in found], pa.list_(pa.int64()))

    placed = stored(classes.select("cls", "label", "u", leaf_ids("u").alias("leaves")), "placed")
    ids = placed.select("cls", "label", F.explode("leaves").alias("leaf"))
    sizes = ids.groupBy("label", "leaf").agg(F.ceil(F.count("*") / F.lit(block)).alias("blocks"))
    each = ids.join(sizes, ["label", "leaf"]).withColumn("own", F.pmod(F.xxhash64("cls"), F.col("blocks")))
    # a row meets each block of its leaf; the pair of blocks is ordered
    each = each.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))) \
               .select("cls", "label", "leaf", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    each = each.join(placed.select("cls", "u", "leaves"), "cls")

    def compare(key, group: pd.DataFrame) -> pd.DataFrame:
        _, leaf, i, j = key
        x = np.array([np.frombuffer(b) for b in group["u"]])
        own, cls = group["own"].to_numpy(), group["cls"].to_numpy()
        lists = group["leaves"].tolist()
        left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
        a, b = [], []
        if len(left) and len(right):
            sure = [frozenset(k) for k in lists]
            for p, q in zip(*np.nonzero(x[left] @ x[right].T >= cosine)):
                p, q = left[p], right[q]
                if (i != j or cls[p] < cls[q]) and min(sure[p] & sure[q]) == leaf:
                    a.append(min(cls[p], cls[q]))
                    b.append(max(cls[p], cls[q]))
        return pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})

    links = each.groupBy("label", "leaf", "i", "j").applyInPandas(compare, "a long, b long")
    return classes, stored(links, "vec-links")


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, **forest) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row of ``vectors``."""
    classes, links = near_links(vectors, cosine, **forest)
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    copies = classes.select(F.col("cls").alias("b"), "copies")
    others = both.join(copies, "b").groupBy("a").agg(F.sum("copies").alias("others")).withColumnRenamed("a", "cls")
    label = connected_components(links, classes.select("cls"), "a", "b", "cls")
    per = classes.join(others, "cls", "left").join(label, "cls").select(
        "label", "u", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.col("component").alias("component_id"))

    @F.arrow_udf("binary")
    def units(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for v in parts:
            yield pa.array([None if x is None else x.tobytes() for x in unit(v)], pa.binary())

    rows = vectors.select("vec_id", "label", units(F.col("embedding").cast("array<double>")).alias("u"))
    out = rows.join(per, ["label", "u"], "left")
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("component_id", "vec_id"))
    return out.select("vec_id", F.when(F.col("vec_id").isNull(), 0).otherwise(F.coalesce("n_links", F.lit(0))).cast("long").alias("n_links"),
                      component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"))


def op1_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(load(spark, sf_dir, "embeddings"))
