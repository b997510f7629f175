"""Counts over the pairs within a radius, by blocks of points in numpy: nothing
is written or moved for a pair.  Distances and common letters of a block are two
matrix products."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import LongType, StructField, StructType

from ..functions.similarity import LEVELS
from .joins import _HALF_OFFSETS, _cell_number, _chord, _keyed_cells, cell_edge

#: Points of a cell that are held at once; rows of a matrix product.
HELD, TILE = 8192, 512
_COUNTS = ("candidates", "by_length", "by_letters")


class _Points:
    """Some points with the lengths and letters of their titles."""

    def __init__(self, batch: pa.RecordBatch):
        col = lambda c: batch[c].to_numpy(zero_copy_only=False)
        self.xyz = np.stack([col(f"_{a}") for a in "xyz"], axis=1)
        self.lat, self.lng = col("lat"), col("lng")
        self.length = batch["_length"].fill_null(-1).to_numpy().astype(np.int64)
        self.bits = np.stack([col(f"_l{k}") for k in range(LEVELS)], axis=1)
        self.rest = batch["_rest"].to_pylist() if pc.any(batch["_many"]).as_py() else [()] * len(self.lat)

    def unary(self, some: np.ndarray, names: np.ndarray) -> np.ndarray:
        """A one for each occurrence of a letter that is among ``some``, and each of
        ``names`` beyond those: common letters are the product of two rows."""
        ones = np.unpackbits(self.bits.view(np.uint8), axis=1, bitorder="little")[:, some].astype(np.float32)
        if not len(names):
            return ones
        return np.hstack([ones, np.array([np.isin(names, r) for r in self.rest], np.float32)])


def _least_common(total: np.ndarray, threshold: float) -> np.ndarray:
    """Common letters from which 2*M/total reaches the threshold, less a half."""
    out, guess = np.full(total.shape, np.inf), np.floor(threshold * total / 2.0)
    for step in (2.0, 1.0, 0.0, -1.0):
        with np.errstate(invalid="ignore", divide="ignore"):
            enough = np.where(total == 0, 1.0, 2.0 * (guess + step) / total) >= threshold
        out = np.where(enough, guess + step, out)
    return (out - 0.5).astype(np.float32)


class _Held:
    """The points of a block, met by others tile by tile."""

    def __init__(self, points: _Points, radius_km: float, earth_km: float, chord: float, threshold: float):
        self.p, self.radius, self.earth, self.threshold = points, radius_km, earth_km, threshold
        self.reach = chord * chord
        self.some = np.flatnonzero(np.unpackbits(np.bitwise_or.reduce(points.bits, axis=0).view(np.uint8), bitorder="little"))
        self.names = np.unique(np.array([x for r in points.rest for x in r], np.int64))
        self.ones = points.unary(self.some, self.names)
        self.lengths, self.of_length = np.unique(points.length, return_inverse=True)
        self.tiles = [slice(k, k + TILE) for k in range(0, len(points.lat), TILE)]
        self.boxes = [(points.xyz[t].min(axis=0), points.xyz[t].max(axis=0)) for t in self.tiles]

    def _near(self, t: slice, q: _Points, s: slice) -> np.ndarray:
        """Which points are within the radius: by the chord, and where that is too
        close to tell by the great circle."""
        p = self.p
        chord2 = 2.0 - 2.0 * (p.xyz[t] @ q.xyz[s].T)
        slack = 1e-8 * self.reach + 4e-15
        near = chord2 <= self.reach + slack
        i, j = np.nonzero(near & (chord2 >= self.reach - slack))
        if len(i):
            (la1, lo1), (la2, lo2) = ((np.radians(v.lat[w][k]), np.radians(v.lng[w][k])) for v, w, k in ((p, t, i), (q, s, j)))
            a = np.sin((la2 - la1) / 2.0) ** 2 + np.cos(la1) * np.cos(la2) * np.sin((lo2 - lo1) / 2.0) ** 2
            near[i, j] = 2.0 * self.earth * np.arcsin(np.sqrt(a)) <= self.radius
        return near

    def meet(self, q: _Points, itself: bool = False) -> np.ndarray:
        """(candidates, by_length, by_letters) of the pairs with the points q, or
        of the pairs of the block's own points."""
        found, own = np.zeros(3, np.int64), self.ones if itself else q.unary(self.some, self.names)
        for s in (slice(k, k + TILE) for k in range(0, len(q.lat), TILE)):
            low, high = q.xyz[s].min(axis=0), q.xyz[s].max(axis=0)
            total, known = self.lengths[:, None] + q.length[s], (self.lengths[:, None] >= 0) & (q.length[s] >= 0)
            with np.errstate(invalid="ignore", divide="ignore"):
                bound = np.where(total == 0, 1.0, 2.0 * np.minimum(self.lengths[:, None], q.length[s]) / total)
            fits = known & (bound >= self.threshold)
            least = np.where(known, _least_common(np.maximum(total, 0), self.threshold), np.float32(np.inf))
            for t, (least_at, most_at) in zip(self.tiles, self.boxes):
                gap = np.maximum(0.0, np.maximum(low - most_at, least_at - high))
                if (itself and t.start > s.start) or gap @ gap > self.reach * (1.0 + 1e-8) + 1e-14:
                    continue
                near = self._near(t, q, s)
                if itself and t == s:
                    near = np.triu(near, 1)
                if not (n := np.count_nonzero(near)):
                    continue
                of = self.of_length[t]
                found += n, np.count_nonzero(near & fits[of]), np.count_nonzero(near & (self.ones[t] @ own[s].T > least[of]))
        return found


def count_candidates(df: DataFrame, radius_km: float, earth_km: float, by, on, threshold: float) -> DataFrame:
    """(by, candidates, by_length, by_letters) of the pairs within the radius
    that are equal on ``by`` and ``on``, of points (row_id, lat, lng, _length,
    _letters) whose ids differ.

    Cells and copies are those of :func:`~.joins.radius_join`.  A cell's own points
    are dealt to blocks of about :data:`HELD`; any two blocks meet under one key, and
    copies from earlier cells meet each block, a batch at a time: a hot cell is
    shared by many tasks and none holds more than a block."""
    keys = list(dict.fromkeys([*by, *on]))
    chord = _chord(radius_km, earth_km)
    edge = cell_edge(chord, earth_km)
    pts = df.dropna(subset=["row_id", "lat", "lng", *keys]).select("row_id", "lat", "lng", "_length", *keys, F.col("_letters.rest").alias("_rest"),
                                                                  *[F.col(f"_letters.l{k}").alias(f"_l{k}") for k in range(LEVELS)])
    pts = _keyed_cells(pts, "lat", "lng", chord, edge).withColumn("_many", F.size("_rest") > 0)
    cell = lambda d: _cell_number(*[F.col(f"_c{x}") + d(x) for x in "xyz"])
    own = pts.withColumn("_cell", cell(lambda x: F.lit(0)))
    others = pts.withColumn("_o", F.explode(F.array(*[F.struct(*[F.lit(d).alias(x) for d, x in zip(o, "xyz")]) for o in _HALF_OFFSETS if any(o)])))
    for x in "xyz":
        d = F.col(f"_o.{x}")
        others = others.where((d == 0) | ((d == -1) & F.col(f"_b{x}")) | ((d == 1) & F.col(f"_a{x}")))
    others = others.withColumn("_cell", cell(lambda x: F.col(f"_o.{x}")))
    blocks = own.groupBy("_cell", *keys).agg(F.ceil(F.count(F.lit(1)) / HELD).cast("int").alias("_blocks"))
    held = ["_x", "_y", "_z", "lat", "lng", "_length", *[f"_l{k}" for k in range(LEVELS)], "_rest", "_many"]
    turn, block = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)), F.pmod(F.xxhash64("row_id"), F.col("_blocks")).cast("int")
    own = own.join(blocks, ["_cell", *keys]).withColumn("_mine", block).withColumn("_turn", turn)
    own = own.select("_cell", *keys, F.least("_mine", "_turn").alias("_p"), F.greatest("_mine", "_turn").alias("_q"),
                     (F.col("_mine") > F.col("_turn")).cast("int").alias("_side"), *held)
    others = others.join(blocks, ["_cell", *keys]).withColumn("_turn", turn)
    others = others.select("_cell", *keys, F.col("_turn").alias("_p"), F.col("_turn").alias("_q"), F.lit(2).alias("_side"), *held)
    key = ["_cell", *keys, "_p", "_q"]
    fine = [F.floor(F.col(a) / F.lit(edge / 4)) for a in ("_x", "_y", "_z")]
    rows = own.unionByName(others).repartition(*key).sortWithinPartitions(*key, "_side", *fine)
    fields = [df.schema[c] for c in by]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, first, block, sums = None, [], None, {}

        def add(counts) -> None:
            group = tuple(at[1 + keys.index(c)] for c in by)
            sums[group] = sums.get(group, 0) + counts

        def close() -> _Held:
            held = _Held(_Points(pa.Table.from_batches(first).combine_chunks().to_batches()[0]), radius_km, earth_km, chord, threshold)
            if at[-2] == at[-1]:
                add(held.meet(held.p, itself=True))
            return held

        for batch in batches:
            starts = np.zeros(batch.num_rows, bool)
            for v in (batch[c].dictionary_encode().indices.to_numpy() for c in (*key, "_side")):
                starts[1:] |= v[1:] != v[:-1]
            begins = [0, *np.flatnonzero(starts).tolist()] if batch.num_rows else []
            for a, b in zip(begins, [*begins[1:], batch.num_rows]):
                now, some = tuple(batch[c][a].as_py() for c in key), batch.slice(a, b - a)
                if now != at:
                    if first and block is None:
                        close()
                    at, first, block = now, [], None
                if batch["_side"][a].as_py() == 0:
                    first.append(some)
                elif first:
                    block = block or close()
                    add(block.meet(_Points(some)))
        if first and block is None:
            close()
        schema = pa.schema([*[(f.name, to_arrow_type(f.dataType)) for f in fields], *[(c, pa.int64()) for c in _COUNTS]])
        groups = [(*g, *map(int, n)) for g, n in sums.items() if n[0]]
        yield pa.record_batch([list(c) for c in zip(*groups)] if groups else [[]] * len(schema), schema=schema)

    out = rows.mapInArrow(count, StructType([*fields, *[StructField(c, LongType()) for c in _COUNTS]]))
    return out.groupBy(*by).agg(*[F.sum(c).alias(c) for c in _COUNTS])
