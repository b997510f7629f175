"""A corpus pipeline: toxicity, quality rules, n-gram Jaccard join, mixing,
byte-level BPE.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor
kept, and returns the columns of documents; the last returns the encoding.  Models
are fitted on the labelled rows among the stage's own input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from staylink.llm import byte_bpe, jaccard, mixing, quality, toxicity
from staylink.llm.common import load, stored

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Near copies: words of a shingle and least percent of common shingles (op9's query has its own).
COPY_WORDS, COPY_PERCENT = 5, 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score of 0.5 or more go."""
    voters, weights, _ = toxicity.fit(docs, load(spark, sf_dir, "labels"))
    score = toxicity.score_with(voters, weights)
    return docs.select(*COLUMNS).where(score(F.col("text")) < 0.5)


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules or the isolation forest reject go."""
    judged = quality.judge(*quality.fit(docs, load(spark, sf_dir, "labels")))
    return docs.select(*COLUMNS).where(judged(F.col("text")).getField("kept"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: the one of least doc_id (of rows that
    share it, one).  Rows without a doc_id or without words are in no group."""
    groups = jaccard.jaccard_components(docs, words=COPY_WORDS, percent=COPY_PERCENT)
    gone = groups.where("doc_id <> component_id").select("doc_id").distinct()
    kept = docs.select(*COLUMNS).join(gone, "doc_id", "left_anti")
    again = groups.where("doc_id is not null and n_shingles > 0").groupBy("doc_id").count().where("count > 1").select("doc_id")
    if again.isEmpty():
        return kept
    once = kept.join(again, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return kept.join(again, "doc_id", "left_anti").unionByName(once)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, up to twice."""
    key = ["doc_id", "source", "size"]
    taken = stored(mixing.mix(docs, keep=("source",)).select(*key, "copies"), "mix-copies")
    # rows alike in id, source and size are told apart by their turn
    turn = Window.partitionBy(*key).orderBy(F.col("copies").desc())
    many = taken.groupBy(*key).count().where("count > 1").drop("count")
    docs = docs.select(*COLUMNS, mixing.n_words(F.col("text")).alias("size"))
    if many.isEmpty():
        rows = mixing.join_null_safe(docs, taken.where("copies > 0"), key)
    else:
        taken = taken.withColumn("_turn", F.row_number().over(turn)).where("copies > 0")
        own = Window.partitionBy(*key).orderBy(F.md5("text"), "lang", "n_chars")
        rows = mixing.join_null_safe(docs.withColumn("_turn", F.row_number().over(own)), taken, [*key, "_turn"])
    return rows.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row."""
    import public_tokenizers as public
    return byte_bpe.round_trip(docs, public.path("byte_bpe_50k.tiktoken"), public.PATTERN)


STAGES = [("toxicity", drop_toxic), ("quality_rules", drop_low_quality), ("ngram_jaccard", drop_near_copies),
          ("mixing", mix_sources), ("byte_bpe", encode)]

#: The classifier and the forest cannot be put in SQL; tests check the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
