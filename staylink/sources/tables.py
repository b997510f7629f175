"""Reading the driver's parquet tables and deriving the listing table."""

from __future__ import annotations

import hashlib
import os

from pyspark.sql import DataFrame, SparkSession

from ..session import checkpoint_dir

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table; Catalyst prunes columns and pushes filters into the scan."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Fixed value: the listing view over ``orders`` given in FIXTURES.md section 5.
# It is the shared starting point of every Spark query and every DuckDB oracle,
# so it is kept verbatim as SQL text that runs unchanged on both engines.
LISTING_VIEW_SQL = """
WITH b AS (SELECT o_orderkey AS k,
  CASE WHEN o_orderkey % 3 <> 0 OR o_orderkey % 12 = 0 THEN o_orderkey - o_orderkey % 4 ELSE o_orderkey END AS p FROM orders),
c AS (SELECT k, p, CAST(1000 + p AS STRING) AS n, CAST(floor(p / 4.0) AS BIGINT) AS q FROM b)
SELECT k AS row_id, p AS property_id,
 CASE (k * 5 + CAST(floor(k / 7.0) AS BIGINT)) % 4 WHEN 0 THEN 'airbnb' WHEN 1 THEN 'booking' WHEN 2 THEN 'vrbo' ELSE 'holidu' END AS plataforma,
 CASE WHEN k % 11 = 0 THEN NULL WHEN k % 23 = 0 THEN '  ' WHEN k % 6 = 0 THEN concat('HOST ', CAST(p % 89 AS STRING)) WHEN k % 10 = 7 THEN 'Vrbo' ELSE concat('Host ', CAST(p % 97 AS STRING)) END AS anfitrion,
 CASE q % 8
  WHEN 4 THEN CASE k % 3 WHEN 0 THEN concat('VT/', n) WHEN 1 THEN concat('VTV ', n) ELSE concat(n, 'VT') END
  WHEN 5 THEN CASE k % 3 WHEN 0 THEN concat('L95E', n) WHEN 1 THEN concat('L12S', n) ELSE concat('hotel', n) END
  WHEN 6 THEN CASE k % 3 WHEN 0 THEN n ELSE concat('ETV/', n) END
  WHEN 7 THEN CASE k % 3 WHEN 0 THEN NULL WHEN 1 THEN 'No proporcionado' ELSE '' END
  WHEN 3 THEN CASE k % 3 WHEN 0 THEN NULL WHEN 1 THEN concat('AG/', n) ELSE concat('TI ', n) END
  ELSE CASE k % 3 WHEN 0 THEN concat('ETV/', n) WHEN 1 THEN concat('etv ', n, '/2017') ELSE concat('ESFCTU00000700', n, 'ETV/', n) END
 END AS licencia,
 CASE WHEN k % 29 = 0 THEN NULL ELSE CAST(38.6 AS DOUBLE) + CAST((p * 7919) % 150000 AS DOUBLE) / CAST(100000 AS DOUBLE) + CAST(k % 3 AS DOUBLE) * CAST(0.0004 AS DOUBLE) + CASE WHEN k % 13 = 0 THEN CAST(0.05 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END END AS lat,
 CASE WHEN k % 29 = 0 THEN NULL ELSE CAST(1.2 AS DOUBLE) + CAST((p * 104729) % 300000 AS DOUBLE) / CAST(100000 AS DOUBLE) END AS lng,
 CASE WHEN k % 31 = 0 THEN NULL ELSE CAST(2 + q % 7 + CASE WHEN k % 17 = 0 THEN 1 ELSE 0 END AS INT) END AS capacidad,
 CAST(1 + q % 4 AS INT) AS habitaciones,
 concat(CASE q % 5 WHEN 0 THEN 'Casa Señorial ' WHEN 1 THEN 'Villa Bonita ' WHEN 2 THEN 'Apto. Playa ' WHEN 3 THEN 'Hotel Sóller ' ELSE 'Finca Es Pí ' END, CAST(p AS STRING), CASE k % 3 WHEN 0 THEN '' WHEN 1 THEN ' (vistas)' ELSE ' - Mallorca' END) AS nombre,
 CASE q % 5 WHEN 0 THEN 'Casa rural' WHEN 1 THEN 'Villa' WHEN 2 THEN 'Apartamento' WHEN 3 THEN 'Hotel' ELSE 'Finca' END AS tipo
FROM c
"""


def listings_from_orders(orders: DataFrame) -> DataFrame:
    """The listing table derived from ``orders`` (one listing per order)."""
    spark = orders.sparkSession
    return spark.sql(LISTING_VIEW_SQL.replace("FROM orders)", "FROM {orders})"), orders=orders)


_WRITTEN: dict = {}


def load_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The listing table for ``sf_dir``.

    Derived from ``orders`` once per application and written as parquet into
    the shared checkpoint directory; every query then scans that table, so
    filters and column pruning reach a real parquet scan (as they would on the
    stored listing table of a production run) instead of being inlined into
    the view's expressions.  The keys are dealt evenly first: a file of few row
    groups would leave the whole table, and every scan of it, to as few tasks.
    """
    key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir))
    path = _WRITTEN.get(key)
    if path is None:
        base = checkpoint_dir(spark).rstrip("/")
        path = f"{base}/staylink_tables/listings_{hashlib.md5(key[1].encode()).hexdigest()[:12]}"
        keys = read_table(spark, sf_dir, "orders").select("o_orderkey").repartition(4 * spark.sparkContext.defaultParallelism)
        listings_from_orders(keys).write.mode("overwrite").parquet(path)
        _WRITTEN[key] = path
    return spark.read.parquet(path)
