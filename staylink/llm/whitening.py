"""Whitening of embeddings by QDWH spectral divide and conquer.

Entries become integers, so all sums are exact: Spark folds the vectors into the
distinct ones, sums them, then sums the products of their distances from the
integer nearest to the mean (a row of sums per task and pair of dimensions).
What reaches the driver is bounded by the square of the dimension; from it the
covariance is computed in whole numbers and rounded once.

The matrix is then split, not iterated on: the polar factor U of the covariance
shifted by s has the eigenvalues 1 above s and -1 below, so (I + U) / 2 projects
on the components above s.  U comes from QDWH, Halley's iteration with weights
that follow a bound of the least singular value, by QR.  An orthonormal basis of
each projector's range turns the matrix into two smaller ones, which are split in
turn until a component is alone.  Components with small eigenvalues that are not
asked for are left unsplit.

The whitening matrix (dimension x components) travels to the rows, and a second
pass over the distinct vectors measures how far the covariance of the result is
from the identity.

Defined results: rows whose vector is null or empty, or holds null or non-finite
entries, go, and so do vectors of another length than the most frequent one
(ties: the longer); repeated vectors count once in the fit, rows with them all get
their values; a component without variance (eigenvalue within rounding of zero)
has no rows; components of equal eigenvalue are some orthonormal basis of their
space; ``deviation`` is null where it exceeds a long, ``deviation_exact`` holds it
always; an empty table gives no rows.  Only vec_id and embedding are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import load, stored

COMPONENTS = 16
SCALE, OFFSET = 64, 1_000_000
EPS = np.finfo(float).eps

# --- spectral divide and conquer -----------------------------------------------------


def polar(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix by QDWH."""
    n = len(a)
    x = a / np.abs(a).sum(0).max()  # the 1-norm bounds the largest singular value
    low = EPS / n  # a bound that holds for every matrix that is not singular to working precision
    for _ in range(40):
        gap = (4 * (1 - low * low) / low ** 4) ** (1 / 3)
        root = np.sqrt(1 + gap)
        p = root + 0.5 * np.sqrt(8 - 4 * gap + 8 * (2 - low * low) / (low * low * root))
        q = (p - 1) ** 2 / 4
        r = p + q - 1
        both = np.linalg.qr(np.vstack([np.sqrt(r) * x, np.eye(n)]))[0]
        x_new = q / r * x + (p - q / r) / np.sqrt(r) * both[:n] @ both[n:].T
        x_new = (x_new + x_new.T) / 2
        low = min(1.0, low * (p + q * low * low) / (1 + r * low * low))
        moved = np.abs(x_new - x).max()
        x = x_new
        if low > 1 - 10 * EPS and moved < 1e-10:
            break
    return x


def split(a: np.ndarray) -> "tuple[np.ndarray, np.ndarray] | None":
    """Orthonormal bases of the invariant subspaces above and below a shift that
    parts the eigenvalues; None when they are equal to working precision."""
    n = len(a)
    mean = np.trace(a) / n
    spread = np.linalg.norm(a - mean * np.eye(n)) / np.sqrt(n)
    size = np.linalg.norm(a)
    if spread <= 4 * EPS * size:
        return None
    rng = np.random.default_rng(n)
    best = None
    # the middle of the diagonal halves the work; the mean always parts the eigenvalues unless it is one
    for shift in (np.median(np.diag(a)), mean, *(mean + f * spread for f in (1e-3, -1e-3, 0.03, -0.03, 0.1, -0.1))):
        u = polar(a - shift * np.eye(n))
        rank = int(round((np.trace(u) + n) / 2))
        if not 0 < rank < n or np.abs(u @ u - np.eye(n)).max() > 1e-8:
            continue
        above, below = (np.eye(n) + u) / 2, (np.eye(n) - u) / 2
        bases = []
        for projector, k in ((above, rank), (below, n - rank)):
            q = np.linalg.qr(projector @ rng.standard_normal((n, k)))[0]
            bases.append(np.linalg.qr(projector @ q)[0])
        off = np.abs(bases[1].T @ a @ bases[0]).max()
        if best is None or off < best[0]:
            best = off, bases[0], bases[1]
        if off <= 100 * EPS * size:
            break
    return best and best[1:]


def components(a: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, eigenvectors as columns) of the ``most`` largest
    eigenvalues of a symmetric matrix, falling."""
    found: list[np.ndarray] = []

    def part(block: np.ndarray, basis: np.ndarray) -> None:
        if len(found) >= most:  # those above were all that was asked for
            return
        if len(block) == 1:
            found.append(basis[:, 0])
            return
        bases = split(block)
        if bases is None:
            found.extend(basis.T)
            return
        for q in bases:
            inner = q.T @ block @ q
            part((inner + inner.T) / 2, basis @ q)

    if len(a):
        part((a + a.T) / 2, np.eye(len(a)))
    vectors = np.array(found).reshape(len(found), len(a)).T
    vectors = vectors / np.linalg.norm(vectors, axis=0)
    values = np.einsum("ij,ij->j", vectors, a @ vectors)
    order = np.argsort(-values, kind="stable")[:most]
    return values[order], vectors[:, order]


# --- sums ----------------------------------------------------------------------------


def integers(vector: Column) -> Column:
    """floor(64 c) + 1000000 of each entry; null for vectors that do not count."""
    vector = F.transform(vector, lambda c: c.cast("double"))
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return F.when(~bad & (F.size(vector) > 0), F.transform(vector, lambda c: F.floor(c * SCALE) + OFFSET))


def matrix(column: pa.Array) -> np.ndarray:
    """The rows of a column of long arrays of one length."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0), np.int64)


def products(z: np.ndarray) -> np.ndarray:
    """z' z in whole numbers, as Python integers: by floating point as long as
    that is exact."""
    z = z.astype(object) if z.size and int(np.abs(z).max()) >= 1 << 26 else z
    if z.dtype == object:
        return z.T @ z
    largest = max(1, int(np.abs(z).max()) if z.size else 1)
    step = max(1, (1 << 53) // (largest * largest))
    total = np.zeros((z.shape[1], z.shape[1]), object)
    for k in range(0, len(z), step):
        part = z[k:k + step].astype(float)
        total = total + (part.T @ part).astype(np.int64)
    return total


def pair_sums(rows: DataFrame, centre: list[int]) -> DataFrame:
    """(i, j, total) for i <= j: sums of the products of the distances from
    ``centre``; one row per pair and task before the shuffle."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = products(matrix(batch["x"]) - np.array(centre, np.int64))
                total = part if total is None else total + part
        if total is not None:
            i, j = np.triu_indices(len(centre))
            yield pa.record_batch({"i": i.astype(np.int32), "j": j.astype(np.int32),
                                   "total": pa.array([str(int(v)) for v in total[i, j]], pa.string())})

    parts = rows.select("x").mapInArrow(sums, "i int, j int, total string")
    return parts.groupBy("i", "j").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))


@dataclass
class Whitening:
    """What the fit knows: ``n`` distinct vectors, their sums per dimension,
    falling eigenvalues and components (columns), the covariance's trace."""
    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n, rounded once: both parts of the distance are exact."""
        nearest = np.array([round_div(s, self.n) for s in self.sums])
        rest = np.array([(s - self.n * int(m)) / self.n for s, m in zip(self.sums, nearest)])
        return (x - nearest) - rest

    def apply(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.vectors / np.sqrt(self.values))


def round_div(a: int, b: int) -> int:
    return (2 * a + b) // (2 * b)


def covariance(rows: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """Of the rows x, divisor n, each entry rounded once."""
    centre = [round_div(s, n) for s in sums]
    rest = [s - n * m for s, m in zip(sums, centre)]
    v = np.zeros((len(sums), len(sums)))
    for r in pair_sums(rows, centre).collect():  # bounded by the square of the dimension
        v[r.i, r.j] = v[r.j, r.i] = (n * int(r.total) - rest[r.i] * rest[r.j]) / (n * n)
    return v


def fit(rows: DataFrame, most: int = COMPONENTS) -> Whitening:
    """Fits on the distinct vectors ``x`` of ``rows``."""
    rows = stored(rows.select("x").distinct(), "whitening-fit")
    by_dim = rows.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("v").cast("decimal(38,0)")).alias("s")).orderBy("i").collect()
    n, sums = (by_dim[0].n if by_dim else 0), [int(r.s) for r in by_dim]
    v = covariance(rows, n, sums) if n else np.zeros((0, 0))
    values, vectors = components(v, most)
    real = values > len(v) * EPS * values.max(initial=0.0)
    found = Whitening(n, sums, values[real], vectors[:, real], float(np.trace(v)))
    if len(found.values):
        found.identity_error = identity_error(rows, found)
    return found


def identity_error(rows: DataFrame, w: Whitening) -> float:
    """Largest entry of the whitened vectors' covariance minus the identity."""
    k = len(w.values)

    def total(what) -> np.ndarray:
        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            parts = [what(w.apply(matrix(b["x"]))) for b in batches if b.num_rows]
            if parts:
                held = sum(parts).ravel()
                yield pa.record_batch({"at": np.arange(len(held), dtype=np.int32), "v": held})

        found = rows.mapInArrow(sums, "at int, v double").groupBy("at").agg(F.sum("v").alias("v")).orderBy("at").collect()
        return np.array([r.v for r in found]) / w.n

    mean = total(lambda y: y.sum(0))
    cov = total(lambda y: (y - mean).T @ (y - mean)).reshape(k, k)
    return float(np.abs(cov - np.eye(k)).max())


def vectors_of(table: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, x) of the rows that count."""
    rows = table.select(F.col(key).alias("vec_id"), integers(F.col(vector)).alias("x")).where("x is not null")
    rows = stored(rows, "whitening-rows")
    length = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.where(F.size("x") == length.d) if length else rows


def whiten(rows: DataFrame, w: Whitening) -> DataFrame:
    """One row per (vec_id, x) and component."""
    k = len(w.values)
    explained = [float(v) / w.trace for v in w.values]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nearest = np.array([round_div(s, w.n) for s in w.sums])
        rest = np.array([s - w.n * int(m) for s, m in zip(w.sums, nearest)])
        for batch in batches:
            if not batch.num_rows or not k:
                continue
            x = matrix(batch["x"])
            near = x - nearest
            if len(rest) * (w.n * (int(np.abs(near).max()) + 1)) ** 2 >= 1 << 63:
                near, rest = near.astype(object), rest.astype(object)
            deviation = ((w.n * near - rest) ** 2).sum(1).tolist()
            yield pa.record_batch({
                "vec_id": batch["vec_id"].take(np.repeat(np.arange(len(x)), k)), "component": np.tile(np.arange(1, k + 1, dtype=np.int32), len(x)),
                "deviation": pa.array([d for d in map(str, deviation) for _ in range(k)], pa.string()),
                "whitened": w.apply(x).ravel(), "explained": np.tile(explained, len(x))})

    key = rows.schema["vec_id"].dataType.simpleString()
    out = rows.select("vec_id", "x").mapInArrow(project, f"vec_id {key}, component int, deviation string, whitened double, explained double")
    return out.select("vec_id", "component", F.lit(w.n).cast("long").alias("n"), F.expr("try_cast(deviation as long)").alias("deviation"),
                      "whitened", "explained", F.lit(w.identity_error).alias("identity_error"),
                      F.col("deviation").cast("decimal(38,0)").alias("deviation_exact"))


def op11_whitening(spark, sf_dir: str) -> DataFrame:
    rows = vectors_of(load(spark, sf_dir, "embeddings"))
    return whiten(rows, fit(rows))
