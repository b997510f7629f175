"""Collector CSVs in, canonical listings out; listing and feature sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.features import FittedFeatures

# Collector column names -> canonical names, per platform.
CONFORM = {  # in each collector's written column order (CSV columns bind by position)
    "airbnb": {"Nombre": "nombre", "url": "url", "Precio": "precio", "Fechas": "fechas",
               "alojamiento": "alojamiento", "fecha_scraping": "fecha", "isla": "isla", "lat": "lat", "lng": "lng",
               "capacidad": "capacidad", "licencia": "licencia", "habitaciones": "habitaciones", "baños": "banos",
               "titulo": "titulo", "anfitrion": "anfitrion", "tipo": "tipo"},
    "booking": {"name": "listing_id", "lat": "lat", "lng": "lng", "DisplayName": "nombre",
                "habitaciones": "habitaciones", "licencia": "licencia", "capacidad": "capacidad", "niños": "ninos",
                "tipo de alojamiento": "tipo", "anfitrion": "anfitrion", "url": "url", "fecha": "fecha", "isla": "isla"},
    "holidu": {"id": "listing_id", "lat": "lat", "lng": "lng", "nombre": "nombre", "habitaciones": "habitaciones",
               "capacidad": "capacidad", "tipo": "tipo", "licencia": "licencia", "anfitrion": "anfitrion",
               "url": "url", "fecha": "fecha", "isla": "isla"},
    "vrbo": {"_index": "_index", "lat": "lat", "lng": "lng", "id": "listing_id", "url": "url", "nombre": "nombre",
             "tipo": "tipo", "capacidad": "capacidad", "habitaciones": "habitaciones", "licencia": "licencia",
             "anfitrion": "anfitrion", "fecha": "fecha", "isla": "isla"},
}

CANONICAL = [("listing_id", "string"), ("url", "string"), ("nombre", "string"), ("tipo", "string"),
             ("lat", "double"), ("lng", "double"), ("capacidad", "int"), ("habitaciones", "int"), ("banos", "int"),
             ("ninos", "int"), ("licencia", "string"), ("anfitrion", "string"), ("isla", "string"), ("fecha", "date")]


def collector_schema(platform: str) -> str:
    types = {**dict(CANONICAL), "_index": "long"}
    return ", ".join(f"`{src}` {types.get(dst, 'string')}" for src, dst in CONFORM[platform].items())


def conform_listings(df: DataFrame, platform: str, keep=()) -> DataFrame:
    """Rename and cast one collector's columns to the canonical schema; columns
    a collector does not produce are null; the platform is stamped.  Columns in
    ``keep`` (and a ``row_id``) stay as they are."""
    m = CONFORM[platform]
    inv = {dst: src for src, dst in m.items()}
    cols = [F.lit(platform).alias("plataforma")]
    for name, typ in CANONICAL:
        src = inv.get(name)
        cols.append((F.col(f"`{src}`") if src in df.columns else F.lit(None)).cast(typ).alias(name))
    first = [c for c in ("row_id",) if c in df.columns]
    return df.select(*first, *cols, *keep)


def read_listings_csv(spark: SparkSession, path: str, platform: str, multiline: bool = True,
                      rejected: "str | None" = None) -> DataFrame:
    """Header CSV with the collector's declared schema (never inferred).

    Quoted fields may hold line breaks, for which Spark reads a file in one task;
    ``multiline=False`` is for files without such fields and splits them.
    ``rejected`` names a column with the raw text of rows that do not fit the
    schema (their values that do are kept), null for all others."""
    schema = collector_schema(platform) + (f", `{rejected}` string" if rejected else "")
    read = (spark.read.schema(schema).option("header", True).option("multiLine", multiline).option("escape", '"')
            .option("mode", "PERMISSIVE"))
    raw = (read.option("columnNameOfCorruptRecord", rejected) if rejected else read).csv(path)
    return conform_listings(raw, platform, keep=(rejected,) if rejected else ())


def write_listings(df: DataFrame, path: str, fmt: str = "parquet", partition_by=("plataforma",)) -> None:
    """Partitioned by platform (and date/island when present) so later reads
    prune.  Only the partitions that ``df`` holds are replaced: snapshots of other
    dates and platforms stay.  CSV files keep all columns (their folders are named
    by copies) and double their quotes, so ``read_listings_csv`` reads them."""
    parts = list(dict.fromkeys(c for c in (*partition_by, "fecha", "isla") if c in df.columns))
    if fmt == "csv":
        df, parts = df.withColumns({f"part_{c}": F.col(c) for c in parts}), [f"part_{c}" for c in parts]
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts)
    (w.option("header", True).option("escape", '"').csv(path) if fmt == "csv" else w.format(fmt).save(path))


def save_features(df: DataFrame, fitted: FittedFeatures, path: str) -> None:
    """Rows with their feature vectors, and what was fitted, as Parquet."""
    df.write.mode("overwrite").parquet(f"{path}/rows")
    fitted.save(path)


def load_features(spark: SparkSession, path: str) -> tuple[DataFrame, FittedFeatures]:
    """The rows and the fitted parameters of :func:`save_features`, ready to be
    applied to new rows."""
    return spark.read.parquet(f"{path}/rows"), FittedFeatures.load(spark, path)
