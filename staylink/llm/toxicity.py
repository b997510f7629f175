"""Toxicity by weak supervision.

Many voters look at a text: each word of a fixed lexicon and each word stem mined
from labelled training rows votes toxic where it stands; patterns vote toxic for
several hits, hits close to "you" and dense hits, and clean for none.  A
generative label model, fitted by expectation-maximisation, estimates the prior,
each voter's accuracy given the class, and correlations: voters form a tree of
the largest conditional mutual information, and each is modelled given the class
and its parent.  Its posteriors label the training rows, on which a logistic
classifier over the votes and hit rates is trained.  Only that linear classifier
scores documents.

Labels are read of training rows alone (crc32 of the id modulo 5 is not 0): to
mine words and as one more voter of fixed accuracy.  Mining counts over all
labelled training rows in Spark; the models are fitted on at most ``FIT_ROWS``
labelled training rows, those of least hash.  Scoring is one map, no shuffle.

Defined results: a null or empty text gets the score of a text without hits;
repeated rows score alike; without labels the fixed lexicon votes alone; an
empty table gives no rows.  labels, lang, source and doc_id are no input of a
score.  Only doc_id and text are read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WordHash, bytes_of, load, remainder, stored
from .jaccard import shingles
from .ngram_lm import sliced

#: The starting lexicon.
LEXICON = ("idiot", "moron", "stupid", "loser", "trash", "scum", "clown", "pathetic", "worthless", "disgusting",
           "dumb", "garbage", "filth", "vermin", "coward", "imbecile", "bastard", "bitch", "cretin", "hate")
FOLDS = 5
FIT_ROWS = 20_000
#: A stem is mined if it stands in so many classes of unmarked toxic training rows, is so many times likelier there,
#: and that is chance for one of all candidates with at most this probability.
MINED_SUPPORT, MINED_ODDS, MINED_CHANCE = 3, 10.0, 0.01
#: Words that a worker remembers, and bytes of text that it handles at once.
REMEMBERED, RUN = 150_000, 2_000_000
#: Shortest and longest stem.
STEM = (3, 8)
_LETTERS = bytes(c if chr(c).isalpha() or c >= 0x80 else 32 for c in range(256))
PATTERNS = ("two_hits", "three_hits", "near_you", "dense", "none")
YOU = frozenset((b"you", b"your", b"youre", b"are"))


def letter_words(raw: bytes) -> list[bytes]:
    """Lower-case runs of letters."""
    return raw.lower().translate(_LETTERS).split()


class Voters(dict):
    """word -> numbers of the voters that it makes fire: a lexicon word itself,
    or a mined stem that it begins with.  Remembers a bounded number of words."""

    def __init__(self, words: tuple, stems: tuple, most: int = REMEMBERED):
        super().__init__()
        self.names, self._most = [*words, *(f"{s}-" for s in stems)], most
        self._words = {w: k for k, w in enumerate(words)}
        self._stems = {w: k + len(words) for k, w in enumerate(stems)}
        self._lengths = sorted({len(s) for s in stems})
        self.width = len(self.names) + len(PATTERNS)

    def __missing__(self, word: bytes):
        if len(self) >= self._most:
            self.clear()
        w = word.decode(errors="replace").lower()
        found = [k for k in (self._words.get(w), *(self._stems.get(w[:n]) for n in self._lengths)) if k is not None]
        self[word] = found or None
        return self[word]


def votes(raw: bytes, voters: Voters) -> tuple[np.ndarray, tuple[float, float]]:
    """The votes of all voters (1: fires) and two hit rates."""
    words = letter_words(raw)
    out = np.zeros(voters.width, np.int8)
    at = [i for i, k in enumerate(map(voters.__getitem__, words)) if k]
    total, near = len(at), False
    if at:
        for i in at:
            out[voters[words[i]]] = 1
        near = any(not YOU.isdisjoint(words[max(0, i - 3):i + 4]) for i in at)
    out[-len(PATTERNS):] = (total >= 2, total >= 3, near, total * 50 >= len(words) and total > 0, not total)
    return out, (np.log1p(total), min(1.0, 20.0 * total / (len(words) + 20.0)))


def inputs(raw: list[bytes], voters: Voters) -> tuple[np.ndarray, np.ndarray]:
    """(votes, inputs of the linear classifier)."""
    found = [votes(b, voters) for b in raw]
    v = np.array([f[0] for f in found], np.int8).reshape(-1, voters.width)
    rates = np.array([f[1] for f in found], float).reshape(-1, 2)
    return v, np.hstack([v, rates, np.ones((len(found), 1))])


def correlation_tree(v: np.ndarray, p: np.ndarray) -> list[int]:
    """Parent of each voter (-1: none) in the tree of the largest mutual
    information between voters given the class."""
    k = v.shape[1]
    info = np.zeros((k, k))
    for w in (p, 1 - p):
        mass = w.sum() + 1e-9
        one = (v * w[:, None]).sum(0) / mass
        both = (v * w[:, None]).T.astype(float) @ v / mass
        for a, pa_ in ((1, one), (0, 1 - one)):
            for b, pb in ((1, one), (0, 1 - one)):
                joint = both if a and b else one[:, None] - both if a else one[None, :] - both if b else \
                    1 - one[:, None] - one[None, :] + both
                joint = np.clip(joint, 1e-9, 1)
                info += mass / len(v) * joint * np.log(joint / np.clip(np.outer(pa_, pb), 1e-9, 1))
    parent, best, near = [-1] * k, info[0].copy(), np.zeros(k, int)
    best[0] = -np.inf
    for _ in range(k - 1):  # Prim's
        j = int(best.argmax())
        parent[j] = int(near[j])
        closer = (info[j] > best) & (best > -np.inf)
        best[closer], near[closer] = info[j][closer], j
        best[j] = -np.inf
    return parent


def label_model(v: np.ndarray, marks: np.ndarray, trust: float = 0.95, rounds: int = 25) -> tuple[np.ndarray, dict]:
    """Posterior of class 1 for each row, and the estimates (prior, accuracies,
    tree of correlations).  ``marks`` are labels of the training rows, one more
    voter whose accuracy ``trust`` stays fixed: it says which class is which."""
    mark_odds = np.where(marks > 0.5, 1.0, -1.0) * np.log(trust / (1 - trust))
    p = np.where(marks > 0.5, trust, 1 - trust)
    for _ in range(rounds):
        parent = correlation_tree(v, p)
        prior = np.clip(p.mean(), 0.01, 0.99)
        odds = np.log(prior / (1 - prior)) + mark_odds
        rates = np.zeros((2, v.shape[1]))
        for j, up in enumerate(parent):
            for given in ((0, 1) if up >= 0 else (None,)):
                here = np.ones(len(v), bool) if given is None else v[:, up] == given
                x = v[here, j]
                fires = []
                for w in (1 - p[here], p[here]):
                    fires.append((x @ w + 0.5) / (w.sum() + 1.0))
                odds[here] += np.where(x == 1, np.log(fires[1] / fires[0]), np.log((1 - fires[1]) / (1 - fires[0])))
        for y, w in enumerate((1 - p, p)):
            rates[y] = (v * w[:, None]).sum(0) / (w.sum() + 1e-9)
        new = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        if np.abs(new - p).max() < 1e-4:
            p = new
            break
        p = new
    return p, {"prior": float(p.mean()), "fires": rates, "parent": parent}


def linear_classifier(x: np.ndarray, p: np.ndarray, ridge: float = 0.1, rounds: int = 30) -> np.ndarray:
    """Logistic regression on soft labels by Newton steps."""
    w = np.zeros(x.shape[1])
    pull = np.full(x.shape[1], ridge)
    pull[-1] = 1e-3
    for _ in range(rounds):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (q * (1 - q))[:, None]).T @ x + np.diag(pull), x.T @ (p - q) - pull * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def stems_of(raw: bytes) -> set:
    """The beginnings of a text's words."""
    words = {w.decode(errors="replace").lower() for w in letter_words(raw)}
    return {w[:n] for w in words for n in range(STEM[0], min(STEM[1], len(w)) + 1)}


def class_of(raw: bytes, hashes: WordHash) -> int:
    """The least hash of a text's three-word shingles, which copies share and most near copies."""
    s = shingles(raw, hashes, 3)
    return int(s.min().view(np.int64)) if len(s) else 0


def significant(n: int, m: int, n1: int, n0: int, tests: int, odds: float = MINED_ODDS, chance: float = MINED_CHANCE) -> bool:
    """Whether standing in n of n1 toxic and m of n0 clean classes is ``odds``
    times likelier in toxic ones and no chance (Chernoff's bound of the binomial
    tail, shared among ``tests``)."""
    if (n + 0.5) / (n1 + 1) < odds * (m + 0.5) / (n0 + 1):
        return False
    share, q = n / (n + m), n1 / (n1 + n0)
    apart = n * np.log(share / q) + (m * np.log((1 - share) / (1 - q)) if m else 0.0)
    return share > q and apart >= np.log(tests / chance)


def mined_stems(rows: DataFrame, support: int = MINED_SUPPORT, odds: float = MINED_ODDS, most_rows: int = FIT_ROWS) -> tuple:
    """Word beginnings that mark toxic rows which no lexicon word marks.

    ``rows``: (doc_id, text, toxic).  Counts are of shingle classes, not of rows,
    so that a much-copied text counts about once; a candidate stands in
    ``support`` classes of those toxic rows and is :func:`significant` against
    the clean ones.  No share of the rows is asked for: a stem that passes among
    few rows passes among more of the same kind.  Counts are over all rows; the
    choice (best cover first, until no class is left that a candidate covers) is
    made on at most ``most_rows`` rows."""
    plain = Voters(LEXICON, ())

    @F.arrow_udf("boolean")
    def unmarked(texts: pa.Array) -> pa.Array:
        return pa.array([not any(map(plain.__getitem__, letter_words(b))) for b in bytes_of(texts)])

    def counted(known: frozenset | None = None):
        """text -> (class, its stems among ``known`` and "", which every text has)."""
        @F.arrow_udf("struct<cls: bigint, stems: array<string>>")
        def of(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
            hashes = WordHash(REMEMBERED)
            # a few texts at a time: the stems of a batch are many times its texts
            for raw in (part for texts in parts for part in sliced(bytes_of(texts), RUN)):
                stems = [["", *(stems_of(b) if known is None else known & stems_of(b))] for b in raw]
                yield pa.StructArray.from_arrays([pa.array([class_of(b, hashes) for b in raw], pa.int64()),
                                                  pa.array(stems, pa.list_(pa.string()))], names=["cls", "stems"])
        return of(F.col("text"))

    def classes(df: DataFrame, known: frozenset | None = None) -> DataFrame:
        return df.select(counted(known).alias("c")).select("c.cls", F.explode("c.stems").alias("stem")) \
                 .groupBy("stem").agg(F.approx_count_distinct("cls").alias("n"))

    toxic, clean = rows.where("toxic = 1").where(unmarked(F.col("text"))), rows.where("toxic = 0")
    in_toxic = dict(classes(toxic).where(F.col("n") >= support).collect())
    n1 = in_toxic.pop("", 0)
    if not in_toxic:
        return ()
    known = frozenset(in_toxic)
    in_clean = dict(classes(clean, known).collect())
    n0 = in_clean.pop("", 0)
    if not n0:
        return ()
    good = {s for s, n in in_toxic.items() if significant(n, in_clean.get(s, 0), n1, n0, len(known), odds)}
    sample = least_by_hash(toxic, most_rows).select(counted(frozenset(good)).alias("c"))
    cover = {cls: set(stems[1:]) for cls, stems in sample.select("c.*").collect()}
    stands: dict = {s: set() for s in good}
    for cls, stems in cover.items():
        for s in stems:
            stands[s].add(cls)
    rank = lambda s: (-len(stands[s]), in_clean.get(s, 0), len(s), s)
    todo, chosen = [(rank(s), s) for s in good], []
    heapq.heapify(todo)
    while todo:
        was, best = heapq.heappop(todo)
        if was != rank(best):
            heapq.heappush(todo, (rank(best), best))
        elif stands[best]:
            chosen.append(best)
            for cls in tuple(stands[best]):
                for s in cover[cls]:
                    stands[s].discard(cls)
    return tuple(chosen)


def least_by_hash(rows: DataFrame, most: int) -> DataFrame:
    """The rows of the ``most`` least (hash of the id, id), and any that share the
    last one.  Only ids below a hash that should let a few more through are sorted,
    so no task sends ``most`` rows of its own; texts stay where they are."""
    key = F.struct(F.xxhash64("doc_id").alias("hash"), F.col("doc_id"))
    ids = rows.select(key.alias("key"))
    share = (1.2 * most + 1000) / max(1, rows.count())
    if share < 1:
        few = ids.where(F.col("key.hash") < F.lit(int(share * 2 ** 64) - 2 ** 63))
        ids = few if few.count() >= most else ids
    last = ids.orderBy("key").limit(most).agg(F.max("key").alias("k")).first().k
    return rows.where("false") if last is None else \
        rows.where(key <= F.struct(F.lit(last["hash"]).cast("long").alias("hash"), F.lit(last["doc_id"]).cast("long").alias("doc_id")))


def fit(documents: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> tuple[Voters, np.ndarray, dict]:
    """(voters, weights of the linear classifier, estimates of the label model)."""
    marks = labels.where(F.col("toxic").isNotNull() & (remainder(F.col("doc_id"), FOLDS) != 0)) \
                  .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    # texts that cannot learn stay out of the join, which is the same one at every size
    learned = documents.select("doc_id", "text").where(remainder(F.col("doc_id"), FOLDS) != 0).hint("merge")
    rows = stored(learned.join(marks, "doc_id").select("doc_id", "text", "toxic"), "toxic-rows")
    voters = Voters(LEXICON, mined_stems(rows))

    @F.arrow_udf("array<double>")
    def row_inputs(texts: pa.Array) -> pa.Array:
        return pa.array(list(inputs(bytes_of(texts), voters)[1]), pa.list_(pa.float64()))

    least = least_by_hash(rows, fit_rows).select("toxic", row_inputs(F.col("text")).alias("x")).collect()
    x = np.array([r[1] for r in least], float).reshape(-1, voters.width + 3)
    if not len(x):  # nothing to fit: two hits are toxic
        w = np.zeros(x.shape[1])
        w[len(voters.names)], w[-1] = 8.0, -4.0
        return voters, w, {}
    v = x[:, :voters.width].astype(np.int8)
    used = v.any(0)
    posterior, estimates = label_model(v[:, used], np.array([r[0] for r in least], float))
    return voters, linear_classifier(x, posterior), estimates


def score_with(voters: Voters, weights: np.ndarray):
    """A column function: text -> score."""
    kinds = tuple(voters.names[:len(voters._words)]), tuple(s[:-1] for s in voters.names[len(voters._words):])

    @F.arrow_udf("double")
    def score(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = Voters(*kinds)
        for raw in (part for texts in parts for part in sliced(bytes_of(texts), RUN)):
            x = inputs(raw, own)[1]
            yield pa.array(1 / (1 + np.exp(-np.clip(x @ weights, -30, 30))), pa.float64())

    return score


def toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) per document."""
    voters, weights, _ = fit(documents, labels)
    return documents.select("doc_id", (remainder(F.col("doc_id"), FOLDS) == 0).alias("held_out"),
                            score_with(voters, weights)(F.col("text")).alias("score")) \
                    .withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op5_toxicity(spark, sf_dir: str) -> DataFrame:
    return toxicity(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))
