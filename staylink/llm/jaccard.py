"""Exact n-gram Jaccard self-join by universe partitioning.

A document's set holds the 64-bit hashes of its distinct word shingles.  Two
sets of sizes a and b are linked when ``100 * common >= percent * union``; then
their symmetric difference is at most ``(a + b) (100 - percent) / (100 + percent)``.
Sizes fall into bands; every set is indexed in its own band and, if a partner
there is possible, in the next.  In a band whose largest partners differ in at
most H elements, the universe of hashes is cut into H + 1 segments: by the
pigeonhole two linked sets agree wholly on at least one.  A signature is the
hash of the elements of one segment.

Costs decide how a signature is used.  Equal sets are first folded into one class.
Signatures are shuffled once and those met once dropped.  Of every other signature
only the star (its least class to each other one) is verified; most groups of near
copies are connected by that.  Where members of a signature still lie in different
components, they are compared across components.  Near copies share many signatures
of one least class, so the members of all of these are compared once, together,
unless the signatures apart have fewer pairs.  A group is compared inside blocks of
``BLOCK`` members (a larger one takes each pair of its blocks).  Signatures used
apart with more than ``HOT`` members (an empty segment, a common passage) are
refined first: their members are indexed again under the pair of this segment and
each other one with such a signature, and under the one-deletion neighbourhood of
the following segment.  That is exact: with one segment equal, H others are left for
at most H differences, so another agrees wholly or all differ in just one element,
the following segment too; and one that agrees wholly and has fewer members is
compared under its own signature.

A comparison reads the parities of the set's elements by hash bucket (eight to
sixteen buckets a difference that a link allows): two sets differ in at least as many elements as parities, so a
pair with more of those than a link allows is none.  Only the others reach the
verification, which intersects the two sets, recomputed from the texts; only texts
of candidates are shuffled (a bitmap of fixed size picks them).  Links become
components by star contraction in Spark.

Defined results: null, empty and word-less texts have an empty set and link with
nothing; texts of fewer words than a shingle are one shingle as a whole; repeated
rows and rows of one doc_id are one vertex; a null doc_id links with nothing and
is its own null component; an empty table gives no rows.  Only doc_id and text
are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.graph import connected_components
from ..operators.ordering import add_row_id
from .common import WordHash, bytes_of, drop_stored, load, mix64, stored

WORDS, PERCENT = 3, 90
#: Largest size of a band over its least (at limits below 90 no more than of two
#: linked sets: segments hold few elements there, fewest at the low end of a band).
BAND = 1.6
#: Members from which a signature is refined instead of paired.
HOT = 512
#: Members of a signature compared at once.
BLOCK = 256
#: Size of the bitmap that picks the candidates' texts (2 MB).
BITS = 1 << 24
_P = np.uint64(0x9E3779B97F4A7C15)


def shingles(raw: bytes, hashes: WordHash, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes of a text (A-Z lower-cased)."""
    w = hashes.array(raw.lower().split())
    if not len(w):
        return w
    n = len(w) - words + 1
    with np.errstate(over="ignore"):
        if n < 1:  # the whole sequence; its length keeps it apart from shingles
            code = np.uint64(len(w))
            for x in w:
                code = code * _P + x
            return mix64(np.array([code], np.uint64) ^ np.uint64(0x5851F42D4C957F2D))
        code = w[:n].copy()
        for k in range(1, words):
            code = code * _P + w[k:n + k]
    return np.unique(mix64(code))


def bands(percent: int = PERCENT, least: int = 1, ratio: float = BAND, most: int = 1 << 40) -> np.ndarray:
    """Lowest sizes of the bands."""
    out = [least]
    while out[-1] < most:
        out.append(max(out[-1] + 1, int(out[-1] * ratio)))
    return np.array(out, np.int64)


@cache
def _bands(percent: int) -> np.ndarray:
    return bands(percent, ratio=BAND if percent >= 90 else min(BAND, 100 / percent))


def differences(band: int, percent: int = PERCENT) -> int:
    """Most elements in which two linked sets differ if the larger is in ``band``."""
    largest = int(_bands(percent)[band + 1]) - 1
    return 2 * largest * (100 - percent) // (100 + percent)


def indexed_in(size: int, percent: int = PERCENT) -> list[int]:
    """The bands in which a set is indexed: its own and those of larger partners."""
    own = int(np.searchsorted(_bands(percent), size, side="right")) - 1
    top = int(np.searchsorted(_bands(percent), size * 100 // percent, side="right")) - 1
    return list(range(own, top + 1))


def segments(s: np.ndarray, band: int, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """(signature of each segment, segment of each element)."""
    m = differences(band, percent) + 1
    with np.errstate(over="ignore"):
        seg = (mix64(s * _P + np.uint64(band)) % np.uint64(m)).astype(np.int64)
        total = np.zeros(m, np.uint64)
        np.add.at(total, seg, mix64(s ^ np.uint64(0xD1B54A32D192ED03)))
        key = (np.uint64(band) << np.uint64(40)) + np.arange(m, dtype=np.uint64)
        return mix64(mix64(total) + key * _P), seg


def signatures(s: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    if not len(s):
        return s
    return np.concatenate([segments(s, b, percent)[0] for b in indexed_in(len(s), percent)])


def refined(s: np.ndarray, hot: set, percent: int = PERCENT, others_too: bool = True) -> np.ndarray:
    """Keys of a set below its hot signatures: (hot segment, other segment) and
    (hot segment, following segment less one element).  Without ``others_too``
    the other segment is a hot one as well: those that are not meet by themselves."""
    out = []
    with np.errstate(over="ignore"):
        for b in indexed_in(len(s), percent):
            sig, seg = segments(s, b, percent)
            m = len(sig)
            at = np.flatnonzero(np.isin(sig, np.fromiter(hot, np.uint64, len(hot))))
            for j in at:
                if m == 1:  # equal sets only, and those are one class already
                    continue
                others = np.delete(sig, j) if others_too else sig[at[at > j]]
                out.append(mix64(sig[j] * _P + others))
                nxt = int((j + 1) % m)
                of = mix64(s[seg == nxt] ^ np.uint64(0xD1B54A32D192ED03))
                total = np.uint64(of.sum(dtype=np.uint64))
                out.append(mix64(sig[j] * _P ^ mix64(np.append(total - of, total))))
    return np.unique(np.concatenate(out)) if out else np.zeros(0, np.uint64)


def _long(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def parities(s: np.ndarray, percent: int = PERCENT) -> bytes:
    """Parity of the elements in each of 2^k buckets, at least eight a difference
    that a link to a set of the same size allows."""
    most = 2 * len(s) * (100 - percent) // (100 + percent)
    m = max(64, 1 << int(8 * most - 1).bit_length()) if most else 64
    odd = np.bincount((s & np.uint64(m - 1)).astype(np.int64), minlength=m) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def folded(bits: bytes, size: int) -> np.ndarray:
    """The parities over ``size`` bytes of buckets, as 64-bit words."""
    x = np.frombuffer(bits, np.uint64)
    while len(x) * 8 > size:
        x = x[:len(x) // 2] ^ x[len(x) // 2:]
    return x


def may_link(percent: int = PERCENT):
    """A column function: (parities, n) twice -> whether a link is possible."""

    @F.arrow_udf("boolean")
    def of(bits_a: pa.Array, bits_b: pa.Array, n_a: pa.Array, n_b: pa.Array) -> pa.Array:
        most = (n_a.to_numpy() + n_b.to_numpy()) * (100 - percent) // (100 + percent)
        apart = [int(np.bitwise_count(folded(a, min(len(a), len(b))) ^ folded(b, min(len(a), len(b)))).sum())
                 for a, b in zip(bits_a.to_pylist(), bits_b.to_pylist())]
        return pa.array(np.array(apart, np.int64) <= most)

    return of


def _across(n, part, cls, own, bits, one_block: bool, percent: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """The pairs of one block pair that lie in different components and may link."""
    if (part == part[0]).all():
        return []
    order = np.argsort(n, kind="stable")
    n, part, cls, own = n[order], part[order], cls[order], own[order]
    size = min(map(len, bits))
    rows, found = np.stack([folded(bits[k], size) for k in order]), []
    for i in range(len(n) - 1):
        end = np.searchsorted(n, n[i] * 100 // percent, side="right")
        other = part[i + 1:end] != part[i]
        if not one_block:
            other &= own[i + 1:end] != own[i]
        at = i + 1 + np.flatnonzero(other)
        apart = np.bitwise_count(rows[at] ^ rows[i]).sum(axis=1, dtype=np.int64)
        at = at[apart <= (n[at] + n[i]) * (100 - percent) // (100 + percent)]
        if len(at):
            found.append((np.minimum(cls[at], cls[i]), np.maximum(cls[at], cls[i])))
    return found


def _two(n, part, cls, own, bits, one_block: bool, percent: int) -> list[tuple[list, list]]:
    """:func:`_across` for two members, which most signatures have."""
    (n_a, n_b), (a, b) = n.tolist(), cls.tolist()
    if part[0] == part[1] or not one_block and own[0] == own[1] or 100 * min(n_a, n_b) < percent * max(n_a, n_b):
        return []
    x, y = bits
    if len(x) != len(y):
        size = min(len(x), len(y))
        x, y = folded(x, size).tobytes(), folded(y, size).tobytes()
    apart = (int.from_bytes(x, "little") ^ int.from_bytes(y, "little")).bit_count()
    return [([min(a, b)], [max(a, b)])] if apart <= (n_a + n_b) * (100 - percent) // (100 + percent) else []


def candidates(sides: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(a, b): pairs across components that share a signature and may link.
    ``sides`` holds (sig, members, cls, n, component, bits); members fall into
    blocks by hash, and each pair of blocks is a group of its own."""
    key, columns = ["sig", "lo", "hi"], ["sig", "lo", "hi", "own", "cls", "n", "component", "bits"]
    blocks = F.ceil(F.col("members") / BLOCK)
    each = sides.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("cls"), "blocks")) \
                .withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))) \
                .withColumn("lo", F.least("own", "with")).withColumn("hi", F.greatest("own", "with")).select(*columns)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table])
            keys = [table[c].to_numpy() for c in key]
            cuts = np.flatnonzero(np.logical_or.reduce([k[1:] != k[:-1] for k in keys])) + 1
            held = table.slice(int(cuts[-1]) if len(cuts) else 0)  # its group may go on
            yield from pairs_of(table, [0, *cuts.tolist()])
        if held is not None and len(held):
            yield from pairs_of(held, [0, len(held)])

    def pairs_of(table: pa.Table, cuts: list[int]) -> Iterator[pa.RecordBatch]:
        column = [table[c].to_numpy() for c in ("n", "component", "cls", "own")]
        bits, one_block, found = table["bits"].to_pylist(), table["lo"].to_numpy() == table["hi"].to_numpy(), []
        for at, end in zip(cuts, cuts[1:]):
            if end - at > 1:
                of = _two if end - at == 2 else _across
                found += of(*(c[at:end] for c in column), bits[at:end], bool(one_block[at]), percent)
        if found:
            a, b = (np.concatenate(x) for x in zip(*found))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return each.repartition(*key).sortWithinPartitions(*key).mapInArrow(compare, "a bigint, b bigint")


def overlaps(words: int = WORDS):
    """A column function: two texts -> (common, n_a, n_b) of their sets."""

    @F.arrow_udf("struct<common: bigint, n_a: bigint, n_b: bigint>")
    def of(parts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        hashes, seen = WordHash(), {}

        def of_text(b: bytes) -> np.ndarray:
            if b not in seen:
                if len(seen) >= 64:  # the centre of a star comes again and again
                    seen.clear()
                seen[b] = shingles(b, hashes, words)
            return seen[b]

        for left, right in parts:
            out = []
            for a, b in zip(bytes_of(left), bytes_of(right)):
                x, y = of_text(a), of_text(b)
                small, large = (x, y) if len(x) <= len(y) else (y, x)
                at = np.minimum(np.searchsorted(large, small), max(0, len(large) - 1))
                out.append((int((large[at] == small).sum()) if len(small) else 0, len(x), len(y)))
            columns = list(zip(*out)) or [(), (), ()]
            yield pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["common", "n_a", "n_b"])

    return of


def among(ids: DataFrame):
    """A column function: doc_id -> whether it may be in ``ids`` (a column
    ``id``).  A bitmap of ``BITS`` bits, however many ids there are: false
    alarms cost work, nothing is missed."""
    bits = ids.select(F.pmod(F.xxhash64("id"), F.lit(BITS)).alias("bit"))
    words = bits.selectExpr("bit div 64 AS w", "shiftleft(1L, cast(bit % 64 AS int)) AS b").groupBy("w").agg(F.bit_or("b").alias("b")).collect()  # at most BITS / 64 numbers
    bitmap = np.zeros(BITS // 64, np.int64)
    for w, b in words:
        bitmap[w] = b
    held = bitmap.view(np.uint8)

    @F.arrow_udf("boolean")
    def of(hashes: pa.Array) -> pa.Array:
        h = np.mod(hashes.to_numpy(zero_copy_only=False), BITS)
        return pa.array((held[h >> 3] >> (h & 7).astype(np.uint8)) & 1 > 0)

    return of(F.xxhash64("doc_id"))


def indexes(words: int = WORDS, percent: int = PERCENT):
    """A column function: text -> (n, fp1, fp2, bits, sigs)."""

    @F.arrow_udf("struct<n: bigint, fp1: bigint, fp2: bigint, bits: binary, sigs: array<bigint>>")
    def of(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        hashes = WordHash()
        for texts in parts:
            found = [shingles(b, hashes, words) for b in bytes_of(texts)]
            sigs = [_long(signatures(s, percent)) for s in found]
            ends = np.cumsum([0] + [len(x) for x in sigs])
            flat = np.concatenate(sigs) if sigs else np.zeros(0, np.int64)
            fps = [[int(_long(mix64(s ^ np.uint64(c)).sum(dtype=np.uint64).reshape(1))[0]) if len(s) else 0 for s in found]
                   for c in (0x2545F4914F6CDD1D, 0x9FB21C651E98DF25)]
            yield pa.StructArray.from_arrays(
                [pa.array([len(s) for s in found], pa.int64()), pa.array(fps[0], pa.int64()), pa.array(fps[1], pa.int64()),
                 pa.array([parities(s, percent) for s in found], pa.binary()),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int64()))],
                names=["n", "fp1", "fp2", "bits", "sigs"])

    return of


def verified(pairs: DataFrame, documents: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(a, b) of the distinct pairs of classes that link.  Only the candidates'
    texts are shuffled."""
    pairs = stored(pairs.distinct(), "pairs")
    ids = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id")))
    texts = stored(documents.where(F.col("doc_id").isNotNull()).where(among(ids)).dropDuplicates(["doc_id"]), "candidates")
    a = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    b = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(a, "a").join(b, "b").select("a", "b", overlaps(words)("text_a", "text_b").alias("o"))
    links = stored(both.select("a", "b", "o.*").where(linked(percent)).select("a", "b"), "links")
    drop_stored(pairs)
    drop_stored(texts)
    return links


def linked(percent: int = PERCENT):
    return F.col("common") * 100 >= (F.col("n_a") + F.col("n_b") - F.col("common")) * percent


def jaccard_components(documents: DataFrame, words: int = WORDS, percent: int = PERCENT, hot: int = HOT) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row of ``documents``.

    Rows that share a doc_id are one vertex.  Where their texts differ, each
    further text goes through the join under an id of its own beyond all others, and
    what it reaches is tied to the doc_id afterwards; rows without words are tied to
    nothing."""
    docs = documents.select("doc_id", "text")
    digest = F.coalesce(F.md5(F.col("text")), F.lit(""))
    keyed = docs.where("doc_id is not null").groupBy("doc_id").agg(F.min(F.xxhash64("text")).alias("lo"), F.max(F.xxhash64("text")).alias("hi"))
    again = stored(keyed.where("lo < hi").select("doc_id"), "again")
    if again.isEmpty():
        return _components(docs, words, percent, hot)
    texts = docs.join(again, "doc_id", "left_semi").select("doc_id", digest.alias("digest")).distinct()
    first = texts.groupBy("doc_id").agg(F.min("digest").alias("least"))
    last = docs.agg(F.max("doc_id")).first()[0]
    own = add_row_id(texts.join(first, "doc_id").where("digest <> least").select("doc_id", "digest"), ["doc_id", "digest"], name="n")
    own = stored(own.select(F.col("doc_id").alias("of"), "digest", (F.col("n") + F.lit(last) + 1).alias("vertex")), "own-ids")
    renamed = docs.withColumn("own", digest).join(own, (F.col("doc_id") == F.col("of")) & (F.col("own") == F.col("digest")), "left") \
                  .select(F.coalesce("vertex", "doc_id").alias("doc_id"), "text")
    found = stored(_components(renamed, words, percent, hot), "components")
    held = found.where("n_shingles > 0 and doc_id is not null").select(F.col("doc_id").alias("v"), F.col("component_id").alias("c")).distinct()
    ties = own.select("vertex", "of").join(held, F.col("vertex") == F.col("v")).select(F.col("c").alias("a"), "of")
    ties = ties.join(held, F.col("of") == F.col("v"), "left").select("a", F.coalesce("c", "of").alias("b"))
    tied = connected_components(ties, None, "a", "b", "_c").withColumnRenamed("component", "_tied")
    out = found.join(own.select("vertex", "of"), F.col("doc_id") == F.col("vertex"), "left") \
               .join(tied, F.col("component_id") == F.col("_c"), "left")
    own_id = F.coalesce("of", "doc_id")
    return out.select(own_id.alias("doc_id"), "n_shingles",
                      F.when(F.col("n_shingles") == 0, own_id).otherwise(F.coalesce("_tied", "component_id")).alias("component_id"))


def _components(docs: DataFrame, words: int, percent: int, hot: int) -> DataFrame:
    """(doc_id, n_shingles, component_id); rows that share a doc_id share the text."""
    rows = stored(docs.select("doc_id", indexes(words, percent)(F.col("text")).alias("x")).select("doc_id", "x.*"), "sigs")
    alive = rows.where((F.col("n") > 0) & F.col("doc_id").isNotNull())
    # equal sets fold into their least document
    fp = ["n", "fp1", "fp2"]
    classes = stored(alive.groupBy(*fp).agg(F.min("doc_id").alias("cls")), "classes")
    firsts = alive.join(classes, (alive["doc_id"] == classes["cls"]) & (alive["fp1"] == classes["fp1"]), "left_semi")
    sigs = firsts.select(F.col("doc_id").alias("cls"), F.explode("sigs").alias("sig"))
    same = Window.partitionBy("sig")
    met = sigs.withColumns({"least": F.min("cls").over(same), "members": F.count("*").over(same)})
    met = stored(met.where("members > 1"), "met")  # (sig, cls, least, members)
    of = firsts.select(F.col("doc_id").alias("cls"), "n", "bits").dropDuplicates(["cls"])
    side = lambda c: of.select(F.col("cls").alias(c), F.col("n").alias(f"n_{c}"), F.col("bits").alias(f"bits_{c}"))
    star = met.where("cls != least").select(F.col("least").alias("a"), F.col("cls").alias("b")).distinct()
    star = star.join(side("b"), "b").join(side("a"), "a").where(may_link(percent)("bits_a", "bits_b", "n_a", "n_b"))
    links = verified(star.select("a", "b"), docs, words, percent)
    vertices = classes.select("cls").distinct()
    label = stored(connected_components(links, vertices, "a", "b", "cls"), "labels")
    # signatures whose members lie in more than one component
    open_ = met.join(label, "cls")
    split = open_.groupBy("sig").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi")
    open_ = stored(open_.join(split.select("sig"), "sig"), "open")
    drop_stored(met)
    if not open_.isEmpty():
        keyed, apart = _together(open_)
        keyed = keyed.unionByName(apart.where(F.col("members") <= hot))
        many = apart.where(F.col("members") > hot)
        if not many.isEmpty():
            keyed = keyed.unionByName(_refine(many, docs, words, percent))
        rest = verified(candidates(keyed.join(of, "cls"), percent), docs, words, percent)
        firm = label.where("cls != component").select(F.col("component").alias("a"), F.col("cls").alias("b"))
        label = connected_components(firm.unionByName(rest), vertices, "a", "b", "cls")
    member = classes.join(label, "cls").select(*fp, F.col("component").alias("component_id"))
    return rows.join(member, fp, "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNull(), F.col("doc_id")).otherwise(F.coalesce("component_id", F.col("doc_id"))).alias("component_id"))


def _together(open_: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(sig, members, cls, component) of the groups to compare: the members of all
    signatures of one least class under that class's id, each once; and those of the
    signatures that have fewer pairs each on its own."""
    columns = ["sig", "members", "cls", "component"]
    whole = open_.groupBy("least", "cls").agg(F.first("component").alias("component"), F.sum("members").alias("pairs"))
    costs = whole.groupBy("least").agg(F.count("*").alias("of_least"), F.sum("pairs").alias("pairs"))
    # a group of so many members costs their square; a signature's members, summed over its rows, are its square
    costs = stored(costs.select("least", "of_least", (F.col("of_least") * F.col("of_least") <= F.col("pairs")).alias("as_one")), "costs")
    one = whole.join(costs.where("as_one").select("least", "of_least"), "least")
    one = one.select(F.col("least").alias("sig"), F.col("of_least").alias("members"), "cls", "component")
    return one, open_.join(costs.where("not as_one").select("least"), "least").select(*columns)


def _refine(many: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The members of hot signatures under their refined keys that meet again."""
    per = many.groupBy("cls").agg(F.first("component").alias("component"), F.collect_set("sig").alias("hot"))

    @F.arrow_udf("array<bigint>")
    def keys(parts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        hashes = WordHash()
        for texts, hot in parts:
            yield pa.array([_long(refined(shingles(b, hashes, words), {x & (2 ** 64 - 1) for x in h}, percent, others_too=False))
                            for b, h in zip(bytes_of(texts), hot.to_pylist())], pa.list_(pa.int64()))

    one = docs.dropDuplicates(["doc_id"])
    found = one.join(per, one["doc_id"] == per["cls"]).select("cls", "component", F.explode(keys("text", "hot")).alias("sig"))
    found = stored(found, "refined")
    meets = found.groupBy("sig").agg(F.count("*").alias("members"), F.min("component").alias("lo"), F.max("component").alias("hi")) \
                 .where("lo < hi").select("sig", "members")
    return found.join(meets, "sig").select("sig", "members", "cls", "component")


def op9_ngram_jaccard(spark, sf_dir: str) -> DataFrame:
    return jaccard_components(load(spark, sf_dir, "documents"))
