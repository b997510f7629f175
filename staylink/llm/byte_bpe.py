"""Byte-level BPE encoding and decoding with public ranks.

Spark counts the distinct words (matches of the split pattern).  Those that make
up at least one in ``FREQUENT`` of all words - so at most ``FREQUENT`` of them,
however large the corpus - are encoded in Spark: a higher-order fold over the
array of a word's bytes joins the adjacent pair of least rank, found in a literal
rank map (an array of small maps, picked by hash, since a Spark map is searched
linearly), until no pair has a rank.  Their ids form the dictionary.  One map
over the documents then cuts each whole text, takes the ids of dictionary words,
merges every other distinct word by the same ranks (remembered in bounded
memory; a heap for very long words), and joins the ids.  Decoding looks up each
id's bytes and concatenates the pieces.

Defined results: a null or empty text has no ids (the hashes are those of no
bytes); repeated rows are encoded row by row; an empty table gives no rows.  Only
doc_id and text are read.
"""

from __future__ import annotations

import base64
import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bytes_of, load, stored
from .merges import merged

#: At most so many dictionary words: each is at least one in FREQUENT of all.
FREQUENT = 20_000
#: Longest word, in bytes, that the fold takes; longer ones are merged with a heap.
FOLDED = 48
REMEMBERED, LONGEST = 500_000, 200
BUCKETS = 8192


def read_ranks(path: str) -> dict:
    """bytes -> rank (bounded by the vocabulary)."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def _bucket(key: Column) -> Column:
    return F.pmod(F.hash(key), F.lit(BUCKETS)) + 1


def rank_map(spark: SparkSession, ranks: dict) -> Column:
    """The literal rank map: an array of maps from hex strings to ranks."""
    keys = spark.createDataFrame([(k.hex(), r) for k, r in ranks.items()], "k string, r int")
    maps: list[dict] = [{} for _ in range(BUCKETS)]
    for b, k, r in keys.select(_bucket(F.col("k")), "k", "r").collect():
        maps[b - 1][k] = r
    return F.from_json(F.lit(json.dumps(maps, separators=(",", ":"))), "array<map<string,int>>")


def fold_merges(word: Column, ranks: Column) -> Column:
    """Ids of a word (binary) by a fold over its bytes."""
    n = F.length(word)
    parts = F.transform(F.sequence(F.lit(1), n), lambda i: F.lower(F.hex(F.substring(word, i, F.lit(1)))))
    rank = lambda k: F.element_at(F.element_at(ranks, _bucket(k)), k)

    def step(parts: Column, _: Column) -> Column:
        def joined(found: Column) -> Column:
            least = F.array_min(found)
            at = F.array_position(found, least).cast("int")
            return F.when(least.isNull(), parts).otherwise(F.concat(
                F.slice(parts, F.lit(1), at - 1),
                F.array(F.concat(F.element_at(parts, at), F.element_at(parts, at + 1))),
                F.slice(parts, at + 2, F.size(parts))))

        pairs = F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda i: rank(
            F.concat(F.element_at(parts, i), F.element_at(parts, i + 1))))
        # a one-element array binds the pair ranks, so that they are computed once
        return F.when(F.size(parts) > 1, F.element_at(F.transform(F.array(pairs), joined), 1)).otherwise(parts)

    return F.transform(F.aggregate(F.sequence(F.lit(1), n), parts, step), rank)


def count_words(documents: DataFrame, pattern: str) -> DataFrame:
    """(word, n) with counts gathered per partition first."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex
        from collections import Counter
        find, held = regex.compile(pattern).findall, Counter()
        as_batch = lambda c: pa.RecordBatch.from_pydict({"word": list(c), "n": list(c.values())})
        for batch in batches:
            for text in batch["text"].to_pylist():
                if text:
                    held.update(find(text))
            if len(held) > REMEMBERED:
                yield as_batch(held)
                held = Counter()
        if held:
            yield as_batch(held)

    return documents.select("text").mapInArrow(counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def dictionary(documents: DataFrame, ranks: dict, pattern: str, frequent: int = FREQUENT) -> dict:
    """word -> ids as bytes, for the frequent words, folded in Spark."""
    words = stored(count_words(documents, pattern), "bpe-words")
    total = words.agg(F.sum("n")).first()[0] or 0
    chosen = words.where((F.col("n") * frequent >= total) & (F.octet_length("word") <= FOLDED)).select("word")
    spark = documents.sparkSession
    ids = chosen.repartition(2 * spark.sparkContext.defaultParallelism, "word") \
                .select("word", fold_merges(F.col("word").cast("binary"), rank_map(spark, ranks)).alias("ids"))
    return {w: np.array(i, "<u4").tobytes() for w, i in ids.collect()}


class Encoder(dict):
    """word -> its ids as little-endian bytes."""

    def __init__(self, ranks: dict, known: dict):
        super().__init__(known)
        self.ranks, self.known = ranks, known

    def __missing__(self, word: str) -> bytes:
        raw = word.encode()
        parts = [raw] if raw in self.ranks else merged([raw[i:i + 1] for i in range(len(raw))], self.ranks)
        ids = np.array([self.ranks[p] for p in parts], "<u4").tobytes()
        if len(word) <= LONGEST:
            if len(self) >= REMEMBERED + len(self.known):
                self.clear()
                self.update(self.known)
            self[word] = ids
        return ids


def encoder(ranks: dict, known: dict, pattern: str):
    """A column function: text -> ids as little-endian bytes."""

    @F.arrow_udf("binary")
    def encode(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import regex
        find, words = regex.compile(pattern).findall, Encoder(ranks, known)
        for texts in parts:
            yield pa.array([b"".join(map(words.__getitem__, find(b.decode()))) for b in bytes_of(texts)], pa.large_binary()).cast(pa.binary())

    return encode


def decoder(ranks: dict):
    """A column function: ids as little-endian bytes -> the text's bytes."""

    @F.arrow_udf("binary")
    def decode(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        piece = {r: b for b, r in ranks.items()}.__getitem__
        for ids in parts:
            yield pa.array([b"".join(map(piece, np.frombuffer(b, "<u4").tolist())) for b in bytes_of(ids)], pa.binary())

    return decode


def encode(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids): ids as little-endian unsigned 32-bit integers."""
    ranks = read_ranks(path)
    return documents.select("doc_id", encoder(ranks, dictionary(documents, ranks, pattern), pattern)(F.col("text")).alias("ids"))


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, raw): the bytes of each row's ids."""
    return encoded.select("doc_id", decoder(read_ranks(path))(F.col("ids")).alias("raw"))


def round_trip(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) per document."""
    ranks = read_ranks(path)
    known = dictionary(documents, ranks, pattern)

    @F.arrow_udf("struct<n_tokens: bigint, ids_sha256: string, decoded_sha256: string>")
    def digests(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import regex
        find, words = regex.compile(pattern).findall, Encoder(ranks, known)
        piece = {r: b for b, r in ranks.items()}.__getitem__
        for texts in parts:
            out = []
            for raw in bytes_of(texts):
                ids = b"".join(map(words.__getitem__, find(raw.decode())))
                back = b"".join(map(piece, np.frombuffer(ids, "<u4").tolist()))
                out.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(back).hexdigest()))
            n, a, b = zip(*out) if out else ((), (), ())
            yield pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())],
                                             names=["n_tokens", "ids_sha256", "decoded_sha256"])

    return documents.select("doc_id", digests(F.col("text")).alias("_d")).select("doc_id", "_d.*")


def op8_byte_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers as public
    return round_trip(load(spark, sf_dir, "documents"), public.path("byte_bpe_50k.tiktoken"), public.PATTERN)
