"""Session helpers: configuration that matters at scale, and lineage cuts.

Library code never invents storage locations.  Iterative operators cut their
lineage with ``DataFrame.checkpoint()`` into the directory the cluster names in
``spark.checkpoint.dir``; only local entry points (tests, bench, the driver
contract) fill that setting in when it is missing.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Session settings used by the local entry points.  On a cluster these are
#: expected to come from the job submission instead.
LOCAL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "staylink") -> SparkSession:
    """A local session for tests and benchmarks (UI off, AQE on)."""
    builder = (SparkSession.builder.master(f"local[{cpus}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", os.environ.get("STAYLINK_DRIVER_MEM", "16g")))
    for k, v in LOCAL_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint directory named by the session.

    Raises if none is configured: iterative operators must not fall back to a
    machine-local folder on a cluster.
    """
    d = spark.sparkContext.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        spark.sparkContext.setCheckpointDir(d)
        return spark.sparkContext.getCheckpointDir() or d
    raise RuntimeError(
        "spark.checkpoint.dir is not set; iterative operators need a shared "
        "checkpoint directory (set it on the session or the cluster)")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the configured directory; a session of one machine (master
    ``local``) that names none gets a scratch one.  A cluster must name it."""
    try:
        return checkpoint_dir(spark)
    except RuntimeError:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise
        d = tempfile.mkdtemp(prefix="staylink-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
        spark.sparkContext.setCheckpointDir(d)
        return d


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` into the shared checkpoint directory (reliable:
    survives executor loss) and return the truncated-lineage DataFrame."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def store_rows(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet into a new folder below the shared checkpoint
    directory and read it back.  A stage boundary: later uses scan the columns
    and rows they need instead of recomputing the stage."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/staylink_stages/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget_rows(df: DataFrame) -> None:
    """Delete the folder that :func:`store_rows` wrote ``df`` into: rows of a
    round that nothing reads any more."""
    spark = df.sparkSession
    own = f"{checkpoint_dir(spark).rstrip('/')}/staylink_stages/"
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        if path.toUri().getPath().startswith(spark._jvm.org.apache.hadoop.fs.Path(own).toUri().getPath()):
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
