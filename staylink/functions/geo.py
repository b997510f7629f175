"""Great-circle distance, unit vectors and vector cosine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import col

# Earth radii used by the three distance conventions.
EARTH_KM = 6371.0          # arcsin haversine used for grouping and merging
EARTH_KM_INDEX = 6371.0088  # mean radius used by the neighbour searches


def haversine_km(lat1, lng1, lat2, lng2, earth_km: float = EARTH_KM) -> Column:
    """Haversine great-circle distance in km (arcsin form).  Null in, null out."""
    la1, lo1, la2, lo2 = (F.radians(col(x)) for x in (lat1, lng1, lat2, lng2))
    a = (F.pow(F.sin((la2 - la1) / 2.0), 2)
         + F.cos(la1) * F.cos(la2) * F.pow(F.sin((lo2 - lo1) / 2.0), 2))
    return F.lit(2.0 * earth_km) * F.asin(F.sqrt(a))


def unit_vector(lat, lng) -> tuple[Column, Column, Column]:
    """(x, y, z) of the point on the unit sphere."""
    la, lo = F.radians(col(lat)), F.radians(col(lng))
    return F.cos(la) * F.cos(lo), F.cos(la) * F.sin(lo), F.sin(la)


def vector_length(v) -> Column:
    v = col(v)
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))


def cosine_similarity(a, b, length_a=None, length_b=None) -> Column:
    """dot(a, b) / (|a| |b|) over two equal-length numeric arrays, JVM-side; 0
    if either is a zero vector.  Lengths may be given."""
    a, b = col(a), col(b)
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)
    na, nb = (vector_length(v) if n is None else col(n) for v, n in ((a, length_a), (b, length_b)))
    return F.when((na == 0) | (nb == 0), F.lit(0.0)).otherwise(dot / (na * nb))
