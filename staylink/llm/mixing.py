"""Mixing sources to target weights by systematic sampling.

Every document of a source is expected ``target / source_size`` times in the
mix.  Within a source the documents stand in one fixed order (size, then a hash
of the id); the expected copies are prefix-summed along it, one random offset of
the source is added, and a document is emitted once per integer boundary that
its stretch crosses.  The order by size makes the words taken come within about
one largest document of the target.

The prefix sum is two-level, so a source with a third of all rows is no single
task: a document belongs to a chunk (source, size band, hash part); chunks are
counted with map-side aggregation, chunk counts are prefix-summed per source,
and only chunks of about ``CHUNK`` rows are sorted.  Sums are decimals and
counts: they do not depend on the order in which partitions arrive.

Defined results: a null text has size 0 and is taken 0 words; null sources are
one source, sorted last; rows that repeat are separate documents; a source of
size 0 has target 0 and no copies; an empty table gives no rows.  Only doc_id,
text and source are read, so further columns cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import join_null_safe, load, n_words, stored

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
CHUNK = 500
SEED = 1


def size_band(size: Column) -> Column:
    """Digits and the two leading digits of a size; never falls as it grows."""
    s = size.cast("string")
    return (F.length(s) * 100 + F.substring(s, 1, 2).cast("int")).cast("int")


def uniform(*parts: Column) -> Column:
    """A fixed number in [0, 1) from the md5 of the parts (null: a mark)."""
    key = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("~")) for p in parts])
    return F.conv(F.substring(F.md5(key), 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(source, source_size, target) from rows (source, size).

    Water filling: the targets are ``min(most * size, level * weight)``.  With
    the sources sorted by the level at which they fill up, the level follows
    from the prefix sums of caps and weights.  One row per source is sorted,
    never the documents.
    """
    per = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    per = per.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    by_fill = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    per = per.withColumn("budget", F.sum("source_size").over(every) * F.lit(share)) \
             .withColumn("filled", F.sum("cap").over(by_fill.rowsBetween(Window.unboundedPreceding, -1))) \
             .withColumn("open", F.sum("weight").over(by_fill.rowsBetween(0, Window.unboundedFollowing)))
    per = per.withColumn("level", (F.col("budget") - F.coalesce("filled", F.lit(0.0))) / F.col("open"))
    # the level at the first source that it does not fill; if all fill up, none is cut
    cut = F.col("level") <= F.col("cap") / F.col("weight")
    per = per.withColumn("level", F.first(F.when(cut, F.col("level")), ignorenulls=True)
                         .over(by_fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    target = F.when(F.col("level").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("level") * F.col("weight")))
    return per.select("source", "source_size", target.alias("target"))


def copies(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """``docs`` (doc_id, source, size, expected) with ``copies`` (long): how many
    integer boundaries each document's stretch of expected copies crosses."""
    band = docs.withColumn("_band", size_band(F.col("size")))
    per_band = band.groupBy("source", "_band").agg(F.ceil(F.count("*") / F.lit(CHUNK)).alias("_parts"))
    rows = join_null_safe(band, per_band, ["source", "_band"]) \
               .withColumn("_part", F.floor(uniform(F.lit("part"), F.col("doc_id")) * F.col("_parts")).cast("long")) \
               .withColumn("_expected", F.col("expected").cast("decimal(20,12)"))
    chunks = rows.groupBy("source", "_band", "_part").agg(F.sum("_expected").alias("_sum"))
    before = Window.partitionBy("source").orderBy("_band", "_part").rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.withColumn("_before", F.coalesce(F.sum("_sum").over(before), F.lit(0).cast("decimal(38,12)")))
    rows = join_null_safe(rows, chunks.drop("_sum"), ["source", "_band", "_part"])
    upto = Window.partitionBy("source", "_band", "_part").orderBy("size", F.md5(F.col("doc_id").cast("string")), "doc_id") \
                 .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.col("_before").cast("decimal(38,12)") + F.sum("_expected").over(upto)
    offset = uniform(F.lit(f"offset{seed}"), F.col("source")).cast("decimal(13,12)")
    rows = rows.withColumn("_end", (end + offset).cast("decimal(38,12)"))
    return rows.withColumn("copies", (F.floor("_end") - F.floor(F.col("_end") - F.col("_expected"))).cast("long")) \
               .select(*docs.columns, "copies")


def mix(documents: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST, seed: int = SEED,
        keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, size, source_size, target, taken, copies) per document, and the
    columns of ``keep``.  ``taken`` is copies times size."""
    sizes = documents.select("doc_id", "source", n_words(F.col("text")).alias("size"), *keep)
    if not keep:  # a narrow table, read again by each of the sums
        sizes = stored(sizes, "mix-sizes")
    per = source_targets(sizes, weights, share, most)
    rows = join_null_safe(sizes, per, ["source"])
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    out = copies(rows.withColumn("expected", expected), seed)
    return out.select("doc_id", "size", "source_size", "target",
                      (F.col("copies") * F.col("size")).alias("taken"), "copies", *keep)


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
wt AS (SELECT *, [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight,
  source_size * 2.0::DOUBLE AS cap, sum(source_size) OVER () * 1.5::DOUBLE AS budget FROM per),
fl AS (SELECT *, (budget - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
  / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM wt),
lv AS (SELECT *, first_value(CASE WHEN level <= cap / weight THEN level END IGNORE NULLS)
  OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS l FROM fl),
tg AS (SELECT source, source_size, CASE WHEN l IS NULL THEN cap ELSE least(cap, l * weight) END AS target FROM lv),
x AS (SELECT d.*, tg.source_size, tg.target,
  (CASE WHEN tg.source_size > 0 THEN tg.target / tg.source_size ELSE 0.0 END)::DECIMAL(20,12) AS e,
  length(size::VARCHAR) * 100 + substr(size::VARCHAR, 1, 2)::INT AS band,
  ('0x' || substr(md5('part|' || coalesce(doc_id::VARCHAR, '~')), 1, 12))::BIGINT::DOUBLE / 281474976710656.0 AS u,
  (('0x' || substr(md5('offset1|' || coalesce(d.source, '~')), 1, 12))::BIGINT::DOUBLE / 281474976710656.0)::DECIMAL(13,12) AS o
  FROM d JOIN tg ON d.source IS NOT DISTINCT FROM tg.source),
p AS (SELECT *, floor(u * ceil(count(*) OVER (PARTITION BY source, band) / 500.0)) AS part FROM x),
c AS (SELECT *, (sum(e) OVER (PARTITION BY source ORDER BY band, part, size, md5(doc_id::VARCHAR), doc_id ROWS UNBOUNDED PRECEDING) + o)::DECIMAL(38,12) AS fin FROM p)
SELECT doc_id, size, source_size, target, ((floor(fin) - floor(fin - e)) * size)::BIGINT AS taken FROM c
"""


def op10_mixing(spark, sf_dir: str) -> DataFrame:
    return mix(load(spark, sf_dir, "documents")).drop("copies")
