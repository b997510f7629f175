"""Language-model scores from an Elias-Fano n-gram trie.

Counting.  Level 1 holds every word (a 64-bit hash) of the training texts with
its exact count; level 2 the bigrams seen ``LEAST`` times or more (a bigram whose
words are rarer cannot be, so it is not even gathered).  Each partition sorts and
sums its n-grams before a shuffle by shard; shards are as many as the corpus'
characters ask for, so no group grows with the corpus.

Trie.  Each shard of a level is a few flat files in the shared folder that
``spark.checkpoint.dir`` names.  A level-1 shard is the Elias-Fano sequence of
its word hashes; the place of a word, plus the shard's offset, is its id.  A
level-2 shard holds the sequence of its context ids, the monotone pointers to
where each context's successors begin, the sequence of the successors (each
context's ids on top of the last value of the context before, so it increases),
their quantised log probabilities and each context's quantised backoff weight.

Queries.  Scoring maps the files into memory - pages that the system may drop,
not heap - and looks up the distinct words and bigrams of a batch at once: the
context's place, its two pointers, and between them the successor, relative to the
value before the first.  A search halves the values that share the high bits, so
a context with very many successors costs no more than their logarithm.

Model.  p(w | v) = (c(v w) - D) / c(v) [if kept] + b(v) p(w), with b(v) the mass
that the kept successors leave, and p(w) = (c(w) + 1) / (N + V + 1).

Defined results: a null or empty text is the end token alone; unknown words
have count 0; repeated rows are scored row by row; without training rows every
word is unknown; an empty table gives no rows.  Only doc_id and text are read.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from urllib.parse import urlparse

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHash, bytes_of, load, remainder, shared_dir

FOLDS, HELD_OUT = 7, 2
LEAST, DISCOUNT = 2, 0.75
#: Characters of the corpus for each shard.
SHARD_CHARS = 24_000_000
#: n-grams that a task holds before it sums and sends them.
HELD = 3_000_000
#: Quantised log10 values: 16 bits from FLOOR to 0.
FLOOR = -24.0
END = b"\n"  # no word can hold it


def quantise(x: np.ndarray) -> np.ndarray:
    return np.round(np.clip(x, FLOOR, 0.0) / FLOOR * 65535).astype(np.uint16)


def restore(q: np.ndarray) -> np.ndarray:
    return q * (FLOOR / 65535)


class EliasFano:
    """An increasing sequence of 64-bit numbers in about 2 + log2(U / n) bits
    each: low bits packed, high bits in unary with a directory of ones per word."""

    def __init__(self, words: np.ndarray):
        n, self.low, upper, lower, self.top = (int(x) for x in words[:5])
        self.n = n
        self.upper = words[5:5 + upper]
        self.ones = words[5 + upper:5 + 2 * upper + 1]
        self.lower = words[5 + 2 * upper + 1:5 + 2 * upper + 1 + lower]

    @staticmethod
    def pack(values: np.ndarray) -> np.ndarray:
        v = np.asarray(values, np.uint64)
        n = len(v)
        top = int(v[-1]) if n else 0
        low = max(0, (top // max(1, n)).bit_length() - 1) if n else 0
        high = (v >> np.uint64(low)).astype(np.int64)
        at = high + np.arange(n)  # a one for each value, a zero for each step of the high part
        size = (int(at[-1]) if n else 0) // 64 + 2
        upper = np.zeros(size, np.uint64)
        np.bitwise_or.at(upper, at >> 6, np.uint64(1) << (at & 63).astype(np.uint64))
        ones = np.concatenate([[0], np.cumsum(np.bitwise_count(upper).astype(np.uint64), dtype=np.uint64)])
        lower = np.zeros(n * low // 64 + 2, np.uint64)
        if low:
            bit = np.arange(n, dtype=np.int64) * low
            part = v & np.uint64((1 << low) - 1)
            shift = (bit & 63).astype(np.uint64)
            np.bitwise_or.at(lower, bit >> 6, part << shift)
            over = (bit & 63) + low > 64
            np.bitwise_or.at(lower, (bit[over] >> 6) + 1, part[over] >> (np.uint64(64) - shift[over]))
        head = np.array([n, low, len(upper), len(lower), top], np.uint64)
        return np.concatenate([head, upper, ones.astype(np.uint64), lower])

    def _select(self, k: np.ndarray, ones: bool) -> np.ndarray:
        """Position of the k-th one or zero (from 0) of the unary part.  The
        directory stays in the mapped file: its words are searched by halving."""
        before = (lambda w: self.ones[w].astype(np.int64)) if ones else (lambda w: 64 * w - self.ones[w].astype(np.int64))
        word = np.zeros(len(k), np.int64)
        for step in 1 << np.arange(len(self.upper).bit_length() - 1, -1, -1):
            ahead = word + step
            ok = np.flatnonzero(ahead < len(self.upper))
            ok = ok[before(ahead[ok]) <= k[ok]]
            word[ok] = ahead[ok]
        left = k - before(word)
        bits = self.upper[word] if ones else ~self.upper[word]
        at = np.zeros(len(k), np.int64)
        for width in (32, 16, 8, 4, 2, 1):
            mask = np.uint64((1 << width) - 1)
            there = np.bitwise_count((bits >> at.astype(np.uint64)) & mask).astype(np.int64)
            go = left >= there
            left = np.where(go, left - there, left)
            at = np.where(go, at + width, at)
        return word * 64 + at

    def value(self, i: np.ndarray) -> np.ndarray:
        """The values at the places ``i``."""
        return ((self._select(i, True) - i).astype(np.uint64) << np.uint64(self.low)) | self._low(i)

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low:
            return np.zeros(len(i), np.uint64)
        bit = i * self.low
        shift = (bit & 63).astype(np.uint64)
        value = self.lower[bit >> 6] >> shift
        over = (bit & 63) + self.low > 64
        if over.any():
            value[over] |= self.lower[(bit[over] >> 6) + 1] << (np.uint64(64) - shift[over])
        return value & np.uint64((1 << self.low) - 1)

    def find(self, x: np.ndarray, begin: "np.ndarray | None" = None, end: "np.ndarray | None" = None) -> np.ndarray:
        """Index of each x, or -1: the successor search of its high part, then,
        by halving, of its low bits among the values that share it; with ``begin``
        and ``end`` only among the places from one to before the other."""
        out = np.full(len(x), -1, np.int64)
        if not self.n or not len(x):
            return out
        ask = np.flatnonzero(x <= np.uint64(self.top))
        v = x[ask]
        high = (v >> np.uint64(self.low)).astype(np.int64)
        first = np.where(high > 0, self._select(np.maximum(high - 1, 0), False) + 1 - high, 0)
        last = self._select(high, False) - high
        if begin is not None:
            first, last = np.maximum(first, begin[ask]), np.minimum(last, end[ask])
        low, stop = v & np.uint64((1 << self.low) - 1), last.copy()
        live = np.flatnonzero(first < last)
        while len(live):  # the least place in [first, stop) whose low bits are not below
            middle = (first[live] + stop[live]) // 2
            below = self._low(middle) < low[live]
            first[live] = np.where(below, middle + 1, first[live])
            stop[live] = np.where(below, stop[live], middle)
            live = live[first[live] < stop[live]]
        hit = np.flatnonzero(first < last)
        hit = hit[self._low(first[hit]) == low[hit]]
        out[ask[hit]] = first[hit]
        return out


def local_path(uri: str) -> str:
    """The folder as a path; the shared folder must be mounted on all machines."""
    parts = urlparse(uri)
    if parts.scheme not in ("", "file"):
        raise ValueError("the trie is mapped into memory: spark.checkpoint.dir must be a mounted folder (file:)")
    return parts.path


def save(folder: str, name: str, array: np.ndarray) -> None:
    """Whole files only: a retried or doubled task leaves the same one."""
    os.makedirs(folder, exist_ok=True)
    part = f"{folder}/.{name}.{os.getpid()}.{np.random.default_rng().integers(1 << 62)}"
    with open(part, "wb") as f:
        np.save(f, array)
    os.replace(part, f"{folder}/{name}.npy")


def mapped(folder: str, name: str) -> np.ndarray:
    return np.load(f"{folder}/{name}.npy", mmap_mode="r")


def sliced(texts: list[bytes], most: int = 3_000_000) -> Iterator[list[bytes]]:
    """The texts in runs of about ``most`` bytes, so that a batch of long texts
    does not decide how much memory its arrays take."""
    held, n = [], 0
    for t in texts:
        held.append(t)
        n += len(t)
        if n > most:
            yield held
            held, n = [], 0
    if held:
        yield held


def hashed(texts: list[bytes], hashes: WordHash) -> tuple[np.ndarray, np.ndarray]:
    """(token hashes of all texts, each ended by END; tokens per text)."""
    words = [b.lower().split() for b in texts]
    for w in words:
        w.append(END)
    sizes = np.array([len(w) for w in words], np.int64)
    return hashes.array([w for ws in words for w in ws]), sizes


class Level1:
    """Words: hash -> (id, count)."""

    def __init__(self, folder: str, bases: list[int]):
        self.folder, self.bases, self.open = folder, bases, {}
        self.shards = len(bases) - 1
        self.size = bases[-1]

    def _shard(self, s: int):
        if s not in self.open:
            d = f"{self.folder}/w{s}"
            self.open[s] = (EliasFano(mapped(d, "hash")), mapped(d, "count"))
        return self.open[s]

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, counts) of sorted hashes; unknown words have id -1, count 0."""
        ids, counts = np.full(len(h), -1, np.int64), np.zeros(len(h), np.int64)
        shard = word_shard(h, self.shards)
        for s in np.unique(shard):
            if self.bases[s + 1] == self.bases[s]:
                continue
            at = np.flatnonzero(shard == s)
            ef, count = self._shard(int(s))
            k = ef.find(h[at])
            ok = k >= 0
            ids[at[ok]] = k[ok] + self.bases[s]
            counts[at[ok]] = count[k[ok]]
        return ids, counts


def word_shard(h: np.ndarray, shards: int) -> np.ndarray:
    return ((h >> np.uint64(33)) % np.uint64(shards)).astype(np.int64)


class Level2:
    """Bigrams: (context id, word id) -> log10 part; context id -> log10 backoff."""

    def __init__(self, folder: str, shards: int, filled: set):
        self.folder, self.shards, self.filled, self.open = folder, shards, filled, {}

    def _shard(self, s: int):
        if s not in self.open:
            d = f"{self.folder}/b{s}"
            if not os.path.exists(f"{d}/prob.npy"):
                raise FileNotFoundError(f"{d}: a shard of the trie is missing; the folder must be mounted on all machines")
            self.open[s] = (EliasFano(mapped(d, "context")), EliasFano(mapped(d, "pointer")), EliasFano(mapped(d, "next")),
                            mapped(d, "backoff"), mapped(d, "prob"))
        return self.open[s]

    def find(self, context: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(probability part, backoff weight) of pairs of ids sorted by context:
        the pointers of a context bound its successors, which follow the last
        successor of the context before."""
        part = np.zeros(len(context))
        distinct, back = np.unique(context, return_inverse=True)
        weight = np.ones(len(distinct))
        shard = distinct % self.shards
        begin, end, base = (np.zeros(len(distinct), np.int64) for _ in range(3))
        for s in np.unique(shard).tolist():
            if s not in self.filled:
                continue
            contexts, pointers, successors, weights, probs = self._shard(s)
            at = np.flatnonzero(shard == s)
            rank = contexts.find((distinct[at] // self.shards).astype(np.uint64))
            at, rank = at[rank >= 0], rank[rank >= 0]
            begin[at], end[at] = pointers.value(rank).astype(np.int64), pointers.value(rank + 1).astype(np.int64)
            later = at[begin[at] > 0]
            base[later] = successors.value(begin[later] - 1).astype(np.int64) + 1
            weight[at] = 10.0 ** restore(weights[rank])
            mine = np.flatnonzero((shard[back] == s) & (end[back] > 0))
            of = back[mine]
            k = successors.find((base[of] + word[mine]).astype(np.uint64), begin[of], end[of])
            part[mine[k >= 0]] = 10.0 ** restore(probs[k[k >= 0]])
        return part, weight[back]


def _sums(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _sent(keys: list, shard_of) -> Iterator[pa.RecordBatch]:
    """One row per shard: its distinct keys and their counts in this task."""
    if not keys:
        return
    k, c = np.unique(np.concatenate(keys), return_counts=True)
    shard = shard_of(k)
    order = np.argsort(shard, kind="stable")
    k, c, shard = k[order], c[order], shard[order]
    cuts = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1], [True]])) if len(k) else [0]
    for a, b in zip(cuts, cuts[1:]):
        yield pa.RecordBatch.from_pydict({"shard": pa.array([int(shard[a])], pa.int64()), "keys": [k[a:b].astype("<u8").tobytes()],
                                          "counts": [c[a:b].astype("<u4").tobytes()]})


def _group(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    return _sums(np.concatenate([np.frombuffer(b, "<u8") for b in pdf["keys"]]),
                 np.concatenate([np.frombuffer(b, "<u4") for b in pdf["counts"]]).astype(np.int64))


SENT = "shard long, keys binary, counts binary"


class Model:
    """Where a trie lies and what it was trained on (a few numbers per shard)."""

    def __init__(self, folder: str, bases: list[int], tokens: int, shards: int):
        self.folder, self.bases, self.tokens, self.shards = folder, bases, tokens, shards
        self.filled: set = set()  # shards of the second level that hold anything

    def word_level(self) -> Level1:
        return Level1(self.folder, self.bases)

    def pair_level(self) -> Level2:
        return Level2(self.folder, self.shards, self.filled)


def train(texts: DataFrame, shard_chars: int = SHARD_CHARS, least: int = LEAST, discount: float = DISCOUNT) -> Model:
    """Build the trie from a frame with a column ``text``."""
    spark = texts.sparkSession
    folder = local_path(shared_dir(spark, "ngram-trie"))
    chars = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    shards = int(chars // shard_chars) + 1

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, held, n = WordHash(), [], 0
        for batch in batches:
            for part in sliced(bytes_of(batch["text"])):
                h, _ = hashed(part, hashes)
                held.append(h)
                n += len(h)
                if n > HELD:
                    yield from _sent(held, lambda k: word_shard(k, shards))
                    held, n = [], 0
        yield from _sent(held, lambda k: word_shard(k, shards))

    def write_words(pdf: pd.DataFrame) -> pd.DataFrame:
        s = int(pdf["shard"].iloc[0])
        keys, counts = _group(pdf)
        save(f"{folder}/w{s}", "hash", EliasFano.pack(keys))
        save(f"{folder}/w{s}", "count", counts.astype(np.uint32 if counts.max() < 1 << 32 else np.uint64))
        return pd.DataFrame({"shard": [s], "n": [len(keys)], "tokens": [int(counts.sum())]})

    only = texts.select("text")
    sizes = {r[0]: r[1:] for r in only.mapInArrow(words, SENT).groupBy("shard")
             .applyInPandas(write_words, "shard long, n long, tokens long").collect()}  # a row per shard
    bases = np.concatenate([[0], np.cumsum([sizes.get(s, (0, 0))[0] for s in range(shards)])]).astype(int).tolist()
    tokens = int(sum(v[1] for v in sizes.values()))
    model = Model(folder, bases, tokens, shards)
    width = bases[-1] + 1  # the last id stands for the beginning of a text

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, level, held, n = WordHash(), model.word_level(), [], 0
        shard_of = lambda k: (k // np.uint64(width)).astype(np.int64) % shards
        for batch in batches:
            for part in sliced(bytes_of(batch["text"])):
                h, lengths = hashed(part, hashes)
                distinct, back = np.unique(h, return_inverse=True)
                ids, counts = level.find(distinct)
                often = (counts >= least)[back]
                ids = ids[back]
                context, often_before = np.empty_like(ids), np.empty_like(often)
                context[1:], often_before[1:] = ids[:-1], often[:-1]
                starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
                context[starts], often_before[starts] = width - 1, True
                both = often & often_before
                code = context[both].astype(np.uint64) * np.uint64(width) + ids[both].astype(np.uint64)
                held.append(code)
                n += len(code)
                if n > HELD:
                    yield from _sent(held, shard_of)
                    held, n = [], 0
        yield from _sent(held, shard_of)

    def write_pairs(pdf: pd.DataFrame) -> pd.DataFrame:
        s = int(pdf["shard"].iloc[0])
        keys, counts = _group(pdf)
        keys, counts = keys[counts >= least], counts[counts >= least]
        if len(keys):
            # ordered by context, then successor; contexts of a shard are its residues
            context, word = keys // np.uint64(width), keys % np.uint64(width)
            distinct, first, rank = np.unique(context, return_index=True, return_inverse=True)
            total = np.full(len(distinct), 0, np.int64)
            level, ids = model.word_level(), distinct.astype(np.int64)
            total[:] = level_counts(level, ids)
            total[ids == width - 1] = texts_n
            part = (counts - discount) / total[rank]
            left = np.maximum(1.0 - np.add.reduceat(part, first), 1e-9)
            d = f"{folder}/b{s}"
            save(d, "context", EliasFano.pack(distinct // np.uint64(shards)))
            save(d, "pointer", EliasFano.pack(np.append(first, len(keys))))
            # successors of a context come after the last one of the context before
            final = word[np.append(first[1:], len(keys)) - 1] + np.uint64(1)
            base = np.cumsum(final) - final
            save(d, "next", EliasFano.pack(base[rank] + word))
            save(d, "backoff", quantise(np.log10(left)))
            save(d, "prob", quantise(np.log10(part)))
        return pd.DataFrame({"shard": [s], "n": [len(keys)]})

    texts_n = texts.count()
    if tokens:
        written = only.mapInArrow(pairs, SENT).groupBy("shard").applyInPandas(write_pairs, "shard long, n long").collect()
        model.filled = {r.shard for r in written if r.n}
    return model


def level_counts(level: Level1, ids: np.ndarray) -> np.ndarray:
    """Counts of sorted word ids; those beyond the words have 1."""
    out = np.ones(len(ids), np.int64)
    shard = np.searchsorted(level.bases, ids, side="right") - 1
    for s in np.unique(shard):
        if s < level.shards:
            at = shard == s
            out[at] = level._shard(int(s))[1][ids[at] - level.bases[s]]
    return out


def _scores(texts: list[bytes], hashes: WordHash, words: Level1, pairs: Level2, model: Model) -> tuple:
    """(tokens, known tokens, base score, score) of each text, as arrays."""
    n, v = model.tokens, model.bases[-1]
    h, lengths = hashed(texts, hashes)
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    distinct, back = np.unique(h, return_inverse=True)
    ids, counts = words.find(distinct)
    p1 = ((counts + 1) / (n + v + 1))[back]
    ids, known = ids[back], (counts > 0)[back]
    context = np.empty_like(ids)
    context[1:] = ids[:-1]
    context[starts] = v
    code = context * (v + 1) + np.where(known, ids, v)  # v: a word without an id
    code[context < 0] = -1
    pair, where = np.unique(code, return_inverse=True)
    part, backoff = np.zeros(len(pair)), np.ones(len(pair))
    ask = pair >= 0
    part[ask], backoff[ask] = pairs.find(pair[ask] // (v + 1), pair[ask] % (v + 1))
    p = part[where] + backoff[where] * p1
    return (lengths, np.add.reduceat(known.astype(np.int64), starts),
            np.add.reduceat(np.log10(p1), starts), np.add.reduceat(np.log10(p), starts))


def scorer(model: Model):
    """A column function: text -> struct(n_tokens, n_known, base_score, score)."""

    @F.arrow_udf("struct<n_tokens: bigint, n_known: bigint, base_score: double, score: double>")
    def score(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        hashes, words, pairs = WordHash(), model.word_level(), model.pair_level()
        for texts in parts:
            found = [_scores(part, hashes, words, pairs, model) for part in sliced(bytes_of(texts))]
            columns = [np.concatenate(c) for c in zip(*found)] or [np.zeros(0, t) for t in (int, int, float, float)]
            yield pa.StructArray.from_arrays([pa.array(c) for c in columns], names=["n_tokens", "n_known", "base_score", "score"])

    return score


def lm_scores(documents: DataFrame, **options) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)."""
    held_out = remainder(F.col("doc_id"), FOLDS) == HELD_OUT
    model = train(documents.where(~held_out).select("text"), **options)
    return documents.select("doc_id", held_out.alias("held_out"), scorer(model)(F.col("text")).alias("_s")) \
                    .select("doc_id", "held_out", "_s.n_tokens", "_s.n_known", F.lit(model.tokens).cast("long").alias("train_tokens"),
                            "_s.base_score", "_s.score")


def op6_lm_scores(spark, sf_dir: str) -> DataFrame:
    return lm_scores(load(spark, sf_dir, "documents"))
