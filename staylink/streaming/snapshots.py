"""Dated payload snapshots arriving in a folder: flattened with the batch
operators as they come, first capture per platform id kept.

The table is a log: each micro-batch adds the rows whose id is new, or captured
earlier than what the log holds (snapshots may arrive out of order), as a folder of
its own that a repeated batch writes over.  Reading it takes the first capture per
id, so it always equals the batch result over all payloads seen so far.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.grouping import first_per_group
from ..sources import payloads as pl

FLATTEN = {"booking": (pl.flatten_booking, "name"), "holidu": (pl.flatten_holidu, "id"),
           "vrbo": (pl.flatten_vrbo, "id")}
PAYLOADS = "payload_id long, payload string, captured_at timestamp"
CAPTURE = ("captured_at", "payload_id", "pos")


def captures(payloads: DataFrame, platform: str) -> DataFrame:
    """The flattened rows of dated payloads, the first capture of each id."""
    flatten, key = FLATTEN[platform]
    rows = flatten(payloads).join(payloads.select("payload_id", "captured_at"), "payload_id")
    return _first(rows, key)


def _first(rows: DataFrame, key: str) -> DataFrame:
    return first_per_group(rows.withColumn("_capture", F.struct(*CAPTURE)), key, "_capture").drop("_capture")


def _log(spark: SparkSession, table: str) -> "DataFrame | None":
    """The log's rows; None before its first batch."""
    path = spark._jvm.org.apache.hadoop.fs.Path(table)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return None
    return spark.read.parquet(table)


def first_seen_table(spark: SparkSession, table: str, platform: str) -> DataFrame:
    """The first capture of each id in the log."""
    return _first(_log(spark, table).drop("batch"), FLATTEN[platform][1])


def ingest(spark: SparkSession, source: str, table: str, checkpoint: str, platform: str) -> StreamingQuery:
    """Takes what has newly arrived in ``source`` (Parquet files of payload_id,
    payload, captured_at; a payload id is used once) and ends."""
    key = FLATTEN[platform][1]

    def add(batch: DataFrame, batch_id: int) -> None:
        s = batch.sparkSession
        new, log = captures(batch, platform), _log(s, table)
        if log is not None:
            known = log.where(F.col("batch") != batch_id).groupBy(key).agg(F.min(F.struct(*CAPTURE)).alias("_known"))
            new = new.join(known, key, "left").where(F.col("_known").isNull() | (F.struct(*CAPTURE) < F.col("_known"))).drop("_known")
        new.write.mode("overwrite").parquet(f"{table}/batch={batch_id}")

    return (spark.readStream.schema(PAYLOADS).parquet(source).writeStream.foreachBatch(add)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
