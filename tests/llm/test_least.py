"""The bounded sample of labelled rows."""

import pytest
from pyspark.sql import functions as F

from staylink.llm.toxicity import least_by_hash


@pytest.mark.parametrize("n,most", [(0, 5), (3, 5), (5000, 40), (5000, 5000), (200_000, 100)])
def test_least_by_hash(spark, n, most):
    rows = spark.range(n).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    got = sorted(r.doc_id for r in least_by_hash(rows, most).collect())
    assert got == sorted(r.doc_id for r in rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).collect())


def test_rows_that_share_the_last_id_stay_together(spark):
    rows = spark.createDataFrame([(7, "a")] * 4, "doc_id long, text string")
    assert least_by_hash(rows, 2).count() == 4
