"""Quality rules judged by an isolation forest on rule statistics.

Statistics of a whole text (counts of words, characters, symbols, repeated lines
and repeated five-word windows, capitals, marks, digits) become capped rates.  Trees cut
the box of the labelled rows by random splits around the rows labelled good: a
text that such a cut isolates early, far from the good rows, has a short path.
The mean path length, scaled by that of an average search, is the score in
(0, 1); the threshold is calibrated on all labelled rows: the one of least cost
(share of bad rows kept, twice the share of good rows rejected) among those that
reject at most ``MAX_FALSE`` of the good rows.

Every text is read whole, in one map; fitting takes at most ``FIT_ROWS`` good
labelled rows (those of least hash), the threshold counts of all labelled rows,
gathered as ``BINS`` bins per label.

Defined results: a null or empty text has no words and fails the base rule (under
ten words); repeated rows are judged row by row; without labelled rows of both
kinds the forest rejects nothing; an empty table gives no rows.  Only doc_id and
text are read of the documents, doc_id and quality of the labels.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bytes_of, load, stored

FIT_ROWS = 20_000
TREES, SUBSAMPLE, DEPTH = 120, 256, 12
MAX_FALSE = 0.005
BINS = 2000
WINDOW = 5
SYMBOLS = b"#*$%&|<>"
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Rates with the value at which each counts as extreme: more is no worse.
RATES = {"symbols": 0.08, "dup_lines": 0.5, "repeats": 0.5, "capitals": 0.4, "marks": 0.04, "digits": 0.4}

_EXTREME = np.array(list(RATES.values()))
_KIND = np.zeros(256, np.uint8)  # 1 symbol, 2 capital, 4 mark, 8 digit, 16 white space, 32 continuation byte
for _b in SYMBOLS:
    _KIND[_b] |= 1
_KIND[65:91] |= 2
for _b in b"!?~^_=+@":
    _KIND[_b] |= 4
_KIND[48:58] |= 8
for _b in b" \t\n\r\x0b\x0c":
    _KIND[_b] |= 16
_KIND[0x80:0xC0] |= 32


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a window of ``window`` words found twice or more."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    ids: dict = {}
    a = np.fromiter([ids.setdefault(w, len(ids)) for w in words], np.int64, len(words))
    m = len(ids)
    if m ** window < 2 ** 62:  # windows as exact numbers
        code = a[:n].copy()
        for k in range(1, window):
            code *= m
            code += a[k:n + k]
    else:  # rank the windows of one word more at a time, exact as well
        code = a
        for k in range(1, window):
            _, code = np.unique(code[:len(words) - k] * m + a[k:], return_inverse=True)
    order = np.argsort(code, kind="stable")
    ordered = code[order]
    same = ordered[1:] == ordered[:-1]
    if not same.any():
        return 0
    again = np.zeros(n, bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    edge = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(again)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + window, -1)
    return int((np.cumsum(edge)[:-1] > 0).sum())


def statistics(raw: bytes) -> tuple:
    """The five base counts and the rates of one text."""
    words = raw.split()
    kinds = np.bincount(_KIND[np.frombuffer(raw, np.uint8)], minlength=64) if raw else np.zeros(64, np.int64)
    of = lambda bit: int(kinds[(np.arange(64) & bit) > 0].sum())
    chars = len(raw) - of(32) - of(16)
    lines, seen, dup = raw.split(b"\n"), set(), 0
    for line in lines:
        if line.split(None, 1):
            dup += line in seen
            seen.add(line)
    n, symbols, repeats = len(words), of(1), repeated_words(words)
    soft = chars + 40.0
    rates = (symbols / soft, dup / (len(lines) + 4.0), repeats / (n + 5.0), of(2) / soft, of(4) / soft, of(8) / soft)
    return n, chars, symbols, dup, repeats, tuple(np.minimum(np.divide(rates, _EXTREME), 1.0).tolist())


def average_path(n: np.ndarray) -> np.ndarray:
    """Mean path of an unsuccessful search among n rows."""
    n = np.asarray(n, float)
    h = np.log(np.maximum(n - 1, 1)) + 0.5772156649015329
    return np.where(n > 2, 2 * h - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


def grow(rows: np.ndarray, low: np.ndarray, high: np.ndarray, rng, depth: int = DEPTH) -> tuple:
    """One tree as arrays (feature or -1, cut, left, right, path length)."""
    feature, cut, left, right, path = [], [], [], [], []

    def node(part, lo, hi, level):
        k = len(feature)
        feature.append(-1), cut.append(0.0), left.append(k), right.append(k)
        path.append(level + float(average_path(len(part))))
        wide = np.flatnonzero(hi > lo)
        if level < depth and len(part) > 1 and len(wide):
            f = int(rng.choice(wide))
            c = rng.uniform(lo[f], hi[f])
            below = part[:, f] < c
            mid_hi, mid_lo = hi.copy(), lo.copy()
            mid_hi[f] = mid_lo[f] = c
            feature[k], cut[k] = f, c
            left[k] = node(part[below], lo, mid_hi, level + 1)
            right[k] = node(part[~below], mid_lo, hi, level + 1)
        return k

    node(rows, low, high, 0)
    return tuple(np.array(x) for x in (feature, cut, left, right, path))


def fit_forest(good: np.ndarray, low: np.ndarray, high: np.ndarray, trees: int = TREES,
               subsample: int = SUBSAMPLE, seed: int = 7) -> list[tuple]:
    rng = np.random.default_rng(seed)
    return [grow(good[rng.choice(len(good), min(subsample, len(good)), replace=False)], low, high, rng)
            for _ in range(trees)]


def anomaly(forest: list[tuple], rows: np.ndarray, subsample: int = SUBSAMPLE) -> np.ndarray:
    """2 ** (-mean path / average path): near 1 is anomalous."""
    total = np.zeros(len(rows))
    every = np.arange(len(rows))
    for feature, cut, left, right, path in forest:
        at = np.zeros(len(rows), np.int64)
        while True:
            f = feature[at]
            inner = f >= 0
            if not inner.any():
                break
            below = rows[every, np.where(inner, f, 0)] < cut[at]
            at = np.where(inner, np.where(below, left[at], right[at]), at)
        total += path[at]
    return 2.0 ** (-(total / max(1, len(forest))) / float(average_path(subsample)))


STATS = T.StructType([T.StructField(c, T.LongType()) for c in BASE] + [T.StructField("rates", T.ArrayType(T.DoubleType()))])


@F.arrow_udf(STATS)
def text_statistics(texts: pa.Array) -> pa.Array:
    found = [statistics(b) for b in bytes_of(texts)]
    columns = list(zip(*found)) if found else [()] * 6
    return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns[:5]]
                                      + [pa.array(columns[5], pa.list_(pa.float64()))], names=[*BASE, "rates"])


def judge(forest: list[tuple], threshold: float):
    """A column function: text -> the base counts, base_failed, score and kept."""

    @F.arrow_udf("struct<n_words: bigint, word_chars: bigint, n_symbols: bigint, n_dup_lines: bigint, "
                 "n_repeat_words: bigint, base_failed: boolean, score: double, kept: boolean>")
    def judged(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in parts:
            found = [statistics(b) for b in bytes_of(texts)]
            base = np.array([x[:5] for x in found], np.int64).reshape(-1, 5)
            failed = (base[:, 0] < 10) | (100 * base[:, 4] > 20 * base[:, 0])
            rates = np.array([x[5] for x in found], float).reshape(-1, len(RATES))
            score = anomaly(forest, rates) if forest else np.zeros(len(found))
            columns = [*base.T, failed, score, ~failed & (score <= threshold)]
            yield pa.StructArray.from_arrays([pa.array(c) for c in columns],
                                             names=[*BASE, "base_failed", "score", "kept"])

    return judged


def fit(documents: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, max_false: float = MAX_FALSE) -> tuple[list, float]:
    """(forest, threshold) from the labelled rows among ``documents``."""
    marks = labels.where(F.col("quality").isNotNull()).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    # statistics first: the join shuffles a few numbers a document, never its text,
    # and by the hint does so at every size
    rows = documents.select("doc_id", text_statistics(F.col("text")).alias("s")) \
                    .select("doc_id", "s.rates", "s.n_words", "s.n_repeat_words")
    rows = rows.where((F.col("n_words") >= 10) & (F.col("n_repeat_words") * 100 <= F.col("n_words") * 20))
    rows = rows.select("doc_id", "rates").hint("merge").join(marks, "doc_id")
    rows = stored(rows.select("doc_id", "quality", "rates"), "labelled-rates")
    box = rows.agg(*[f(F.col("rates")[k]) for f in (F.min, F.max) for k in range(len(RATES))]).first()
    good = rows.where("quality = 1").orderBy(F.xxhash64("doc_id"), "doc_id").select("rates").limit(fit_rows).collect()
    if len(good) < 2:
        return [], 1.0
    low, high = (np.array(box[k * len(RATES):(k + 1) * len(RATES)], float) for k in (0, 1))
    forest = fit_forest(np.array([r[0] for r in good]), low, high + 1e-9)

    @F.arrow_udf("double")
    def score(rates: pa.Array) -> pa.Array:
        return pa.array(anomaly(forest, np.array(rates.to_pylist(), float).reshape(-1, len(RATES))))

    counts = rows.select(F.floor(score("rates") * BINS).cast("int").alias("b"), "quality") \
                 .groupBy("b").agg(F.count(F.when(F.col("quality") == 1, 1)).alias("good"),
                                   F.count(F.when(F.col("quality") == 0, 1)).alias("bad")).collect()
    n_good, n_bad = np.zeros(BINS + 1), np.zeros(BINS + 1)
    for b, g, x in counts:
        n_good[b], n_bad[b] = g, x
    if not n_bad.sum():
        return forest, 1.0
    above = n_good[::-1].cumsum()[::-1]  # good rows at this bin or higher
    missed = np.concatenate([[0.0], n_bad.cumsum()[:-1]])  # bad rows below it
    cost = missed / n_bad.sum() + 2 * above / n_good.sum()
    cost[above > max_false * n_good.sum()] = np.inf
    best = np.flatnonzero(cost == cost.min())[-1] if np.isfinite(cost).any() else BINS
    return forest, float(best / BINS)


def quality_rules(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, base counts, base_failed, kept, score) per document."""
    judged = judge(*fit(documents, labels))
    return documents.select("doc_id", judged(F.col("text")).alias("_j")) \
                    .select("doc_id", *[f"_j.{c}" for c in (*BASE, "base_failed", "kept", "score")])


def op3_quality_rules(spark, sf_dir: str) -> DataFrame:
    return quality_rules(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels")).drop("score")
