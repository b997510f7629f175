"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: One word: a maximal run of characters that are no ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession, tag: str) -> str:
    """A new folder under the shared one that ``spark.checkpoint.dir`` names."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"


def stored(df: DataFrame, tag: str, **options) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: cuts the
    lineage, survives executor loss, and keeps column pruning."""
    path = shared_dir(df.sparkSession, tag)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_stored(df: DataFrame) -> None:
    """Delete the files behind a frame made by :func:`stored` that nothing reads
    any more (rounds of an iteration)."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def n_words(text: Column) -> Column:
    """Words of a text as long; null texts have none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def remainder(doc_id: Column, mod: int) -> Column:
    """crc32 of the id's text, modulo ``mod`` (null ids: 0)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % mod, F.lit(0))


def bytes_of(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; nulls are empty."""
    return [b or b"" for b in column.cast(pa.large_binary()).to_pylist()]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective mixer of 64-bit words (splitmix64's finaliser)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class WordHash(dict):
    """word bytes -> 64-bit hash, remembering up to ``most`` words."""

    def __init__(self, most: int = 400_000):
        super().__init__()
        import xxhash
        self._hash, self._most = xxhash.xxh3_64_intdigest, most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self._most:
            self.clear()
        value = self[word] = self._hash(word)
        return value

    def array(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on keys of which null equals null; the columns of ``left``,
    then those of ``right`` besides the keys."""
    r = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    on = [left[k].eqNullSafe(F.col(f"_right_{k}")) for k in keys]
    return left.join(r, on).drop(*[f"_right_{k}" for k in keys])
