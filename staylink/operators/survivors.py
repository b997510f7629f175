"""Group splitting and survivor assembly."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..functions.geo import EARTH_KM, haversine_km, unit_vector
from ..functions.licence import with_canonical_license
from ..session import store_rows
from .graph import components_in_groups, connected_components
from .ordering import add_row_id, union_listings
from .spatial import linking_edges


def split_groups_by_distance(df: DataFrame, km: float = 2.0, group: str = "group_id",
                             earth_km: float = EARTH_KM) -> DataFrame:
    """Within each group, clusters are the components of the <= ``km`` graph
    (a row without coordinates is its own cluster).  A group with more than
    one cluster gets ``_LOC{n}`` suffixes, n numbered by each cluster's first
    row.  Only (row_id, group, lat, lng) go through the graph, written once.

    A group whose extent is within ``km`` is one cluster and goes no further.  Of
    the others, those of up to ``SMALL`` rows are compared pair by pair and scanned
    whole, each in one task.  In larger ones, rows at identical coordinates are
    collapsed to one representative first, and :func:`linking_edges` links the rest
    with a number of edges linear in the rows, however dense a group is."""
    keys = store_rows(df.select("row_id", group, "lat", "lng"), "split-keys")
    # rows that share an id are one vertex, in whatever groups they are: those groups take the general way
    shared = store_rows(keys.groupBy("row_id").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1 or row_id is null")
                        .select(F.col("row_id").alias("_id")), "split-shared")
    unique = shared.isEmpty()
    chord = 2.0 * math.sin(min(km / earth_km, math.pi) / 2.0)
    axes = dict(zip("xyz", unit_vector("lat", "lng")))
    extent = keys.where(F.col(group).isNotNull()).groupBy(group).agg(
        F.count(F.lit(1)).alias("_rows"), F.bool_or(F.col("lat").isNull() | F.col("lng").isNull()).alias("_lost"),
        F.sqrt(sum(((F.max(v) - F.min(v)) * (F.max(v) - F.min(v)) for v in axes.values()), F.lit(0.0))).alias("_wide"))
    doubt = extent.where((F.col("_rows") > 1) & (F.col("_lost") | ~(F.col("_wide") <= F.lit(chord * (1.0 - 1e-9) - 1e-15))))
    doubt = doubt.select(group, (F.col("_rows") <= SMALL).alias("_small"))
    if not unique:
        touched = keys.join(shared, F.col("row_id").eqNullSafe(F.col("_id"))).where(F.col(group).isNotNull()).select(group).distinct()
        doubt = doubt.join(touched, group, "left_anti").unionByName(touched.withColumn("_small", F.lit(False)))
    open_ = store_rows(keys.join(doubt, group), "split-open")
    labelled = _small_labels(open_.where("_small"), km, earth_km, group)
    large = open_.where("not _small")
    if not large.isEmpty():
        labelled = labelled.unionByName(_large_labels(large, km, earth_km, group))
    labelled = store_rows(labelled, "split-labels")
    # cluster numbering works on the (group, cluster) table, never on whole groups of rows
    clusters = labelled.select(group, "component").distinct()
    w = Window.partitionBy(group).orderBy("component")
    clusters = (clusters.withColumn("_n", F.row_number().over(w))
                .withColumn("_k", F.count(F.lit(1)).over(Window.partitionBy(group))))
    new = F.when(F.col("_k") > 1, F.concat(F.col(group), F.lit("_LOC"), F.col("_n").cast("string"))).otherwise(F.col(group))
    # groups of one cluster keep their id; shared ids meet each of their rows
    clusters = clusters.where("_k > 1") if unique else clusters
    split = labelled.join(clusters, [group, "component"]).select("row_id", new.alias("_split"), F.lit(True).alias("_met"))
    if not unique:
        lone = keys.where(F.col(group).isNull()).join(shared, F.col("row_id") == F.col("_id"))
        split = split.unionByName(lone.select("row_id", F.lit(None).cast("string").alias("_split"), F.lit(True).alias("_met")))
    out = df.where(F.col("row_id").isNotNull()).join(split, "row_id", "left")
    return out.withColumn(group, F.when(F.col("_met"), F.col("_split")).otherwise(F.col(group))).drop("_split", "_met")


#: Rows of a group up to which all its pairs are looked at.
SMALL = 64


def _small_labels(rows: DataFrame, km: float, earth_km: float, group: str) -> DataFrame:
    """(row_id, group, component) of small groups of unique row ids."""
    a = rows.select(group, F.col("row_id").alias("src"), F.col("lat").alias("_lat1"), F.col("lng").alias("_lng1"))
    b = rows.select(group, F.col("row_id").alias("dst"), F.col("lat").alias("_lat2"), F.col("lng").alias("_lng2"))
    same = (F.col("_lat1") == F.col("_lat2")) & (F.col("_lng1") == F.col("_lng2"))
    near = same | (haversine_km("_lat1", "_lng1", "_lat2", "_lng2", earth_km) <= F.lit(km))
    edges = a.join(b.hint("merge"), group).where("src <= dst").where((F.col("src") == F.col("dst")) | near).select(group, "src", "dst")
    return rows.select("row_id", group).join(components_in_groups(edges, group), "row_id")


def _large_labels(keys: DataFrame, km: float, earth_km: float, group: str) -> DataFrame:
    """(row_id, group, component) of groups of any size, row ids shared or not."""
    pts = keys.where(F.col("lat").isNotNull() & F.col("lng").isNotNull())
    reps = pts.groupBy(group, "lat", "lng").agg(F.min("row_id").alias("rep"))
    rep_edges = linking_edges(reps.withColumnRenamed("rep", "row_id"), km, earth_km, group)
    members = pts.select("row_id", group, "lat", "lng").join(reps, [group, "lat", "lng"]) \
        .where(F.col("row_id") != F.col("rep")).select(F.col("rep").alias("src"), F.col("row_id").alias("dst"))
    cc = connected_components(rep_edges.unionByName(members), keys.select("row_id"))
    return keys.select("row_id", group).join(cc, "row_id")


def hostless_groups(df: DataFrame, host: str = "anfitrion", licence: str = "licencia") -> DataFrame:
    """Rows with a null host: ``{n}No_host`` ids (n = 0-based position in
    ``row_id`` order), host key ``NA`` and the canonical licence."""
    nh = with_canonical_license(df.where(F.col(host).isNull()).drop("_license_norm"), licence)
    nh = add_row_id(nh, ["row_id"], name="_pos")
    return (nh.withColumn("group_id", F.concat(F.col("_pos").cast("string"), F.lit("No_host")))
              .withColumn("_host_norm", F.lit("NA")).drop("_pos"))


def platform_catalogue(licensed: DataFrame, unlicensed: DataFrame, hostless: DataFrame,
                       platform: "str | None" = None) -> DataFrame:
    out = union_listings(licensed, unlicensed, hostless)
    return out if platform is None else out.withColumn("plataforma", F.lit(platform))
