"""Dense row numbering, keyed sampling and set operations.

``add_row_id`` never uses a window without partition keys: it range-sorts,
materialises the sorted data once, counts rows per partition (one small
action, at most ``spark.sql.shuffle.partitions`` rows reach the driver) and
adds per-partition offsets to ``monotonically_increasing_id``.
"""

from __future__ import annotations

from functools import reduce
from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage


def add_row_id(df: DataFrame, sort_keys, name: str = "row_id", partition_by=None) -> DataFrame:
    """0-based dense position in ``sort_keys`` order (keys must be unique).
    With ``partition_by`` the position restarts in each partition group."""
    keys = ([partition_by] if isinstance(partition_by, str) else list(partition_by or [])) + list(sort_keys)
    ordered = (df.orderBy(*keys)
                 .withColumn("_pid", F.spark_partition_id())
                 .withColumn("_mid", F.monotonically_increasing_id()))
    ordered = cut_lineage(ordered)
    counts = sorted((r["_pid"], r["n"]) for r in ordered.groupBy("_pid").agg(F.count(F.lit(1)).alias("n")).collect())
    starts = [0] + list(accumulate(n for _, n in counts))[:-1]
    # one row per partition: bounded by the partition count, safe to broadcast
    offsets = df.sparkSession.createDataFrame(
        [(pid, start - (pid << 33)) for (pid, _), start in zip(counts, starts)], "_pid int, _off long")
    out = (ordered.join(F.broadcast(offsets), "_pid")
                  .withColumn(name, F.col("_mid") + F.col("_off")).drop("_off"))
    if partition_by:
        part = [partition_by] if isinstance(partition_by, str) else list(partition_by)
        base = out.groupBy(*[F.col(c).alias(f"_p{i}") for i, c in enumerate(part)]).agg(F.min(name).alias("_base"))
        out = out.join(base, [F.col(c).eqNullSafe(F.col(f"_p{i}")) for i, c in enumerate(part)], "left") \
                 .withColumn(name, F.col(name) - F.col("_base")) \
                 .drop("_base", *[f"_p{i}" for i in range(len(part))])
    return out.drop("_pid", "_mid")


#: Bits of an id that one window of :func:`positions_in` takes: at most 2 ** CHUNK rows.
CHUNK = 17


def positions_in(df: DataFrame, keys, name: str = "_pos", order: str = "row_id") -> DataFrame:
    """0-based dense position in ``order`` inside each group of ``keys`` (null
    is a group).  ``order`` is a unique integer: rows are numbered inside chunks
    of neighbouring values, which bounds a window's rows however hot a group is, and
    the chunks' counts, a small table, give where each chunk begins.  No sort of the
    whole, no checkpoint."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    chunked = df.withColumn("_chunk", F.shiftright(F.col(order), CHUNK))
    inside = Window.partitionBy(*keys, "_chunk").orderBy(order)
    chunked = chunked.withColumn("_in", F.row_number().over(inside) - 1)
    counts = df.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.shiftright(F.col(order), CHUNK).alias("_c")).agg(F.count(F.lit(1)).alias("_n"))
    upto = F.sum("_n").over(Window.partitionBy(*[f"_k{i}" for i in range(len(keys))]).orderBy("_c"))
    starts = counts.withColumn("_start", upto - F.col("_n")).drop("_n")
    on = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)] + [F.col("_chunk") == F.col("_c")]
    return chunked.join(starts, on).withColumn(name, F.col("_start") + F.col("_in")) \
                  .drop("_chunk", "_c", "_in", "_start", *[f"_k{i}" for i in range(len(keys))])


def hash_key(seed, *cols):
    """Deterministic pseudo-random sort key (hex md5 of seed and columns);
    DuckDB computes the same ``md5``."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in cols]))


def union_listings(*dfs: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def distinct_listings(df: DataFrame) -> DataFrame:
    return df.distinct()


def distinct_pairs(df: DataFrame) -> DataFrame:
    """(i, j) and (j, i) stay distinct, as in a Python set of tuples."""
    return df.distinct()
