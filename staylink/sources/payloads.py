"""Platform payloads: JSON text -> typed rows.

A payload table is ``(payload_id, payload: string)``.  Parsing is
``from_json`` with an explicit schema (never inferred), then ``explode`` /
``posexplode`` and struct access, so the whole path stays in the JVM.  Only
the paths the collectors read are declared; unknown fields are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.parsing import RX_AIRBNB_REGISTRATION, RX_AIRBNB_TITLE_HOST, parse_airbnb_title, parse_vrbo_heading
from ..functions._util import py_strip

S, D, I, L = T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType()


def _st(**fields) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


BOOKING_SCHEMA = _st(data=_st(searchQueries=_st(search=_st(results=T.ArrayType(_st(
    basicPropertyData=_st(pageName=S, location=_st(latitude=D, longitude=D)),
    displayName=_st(text=S)))))))

HOLIDU_SCHEMA = _st(metaData=_st(cursor=_st(totalCount=L)), offers=T.ArrayType(_st(
    id=S, location=_st(lat=D, lng=D),
    details=_st(name=S, bedroomsCount=I, guestsCount=I, apartmentTypeTitle=S))))

VRBO_SCHEMA = _st(data=_st(propertySearch=_st(
    dynamicMap=_st(map=_st(markers=T.ArrayType(_st(id=S, markerPosition=_st(latitude=D, longitude=D))))),
    propertySearchListings=T.ArrayType(_st(
        id=S, headingSection=_st(heading=S, messages=T.ArrayType(_st(text=S))),
        cardLink=_st(resource=_st(value=S)))))))

AIRBNB_SCHEMA = _st(data=_st(presentation=_st(stayProductDetailPage=_st(
    sections=_st(metadata=_st(loggingContext=_st(eventDataLogging=_st(listingLat=D, listingLng=D))),
                 sections=T.ArrayType(_st(section=_st(
                     listingTitle=S,
                     shareSave=_st(embedData=_st(personCapacity=I), sharingConfig=_st(title=S)),
                     htmlDescription=_st(htmlText=S))))),
    listing=_st(primaryHost=_st(firstName=S))))))


def flatten_booking(payloads: DataFrame) -> DataFrame:
    """results[] -> (payload_id, pos, name, lat, lng, DisplayName); the display
    name is optional, the rest required."""
    p = payloads.select("payload_id", F.from_json("payload", BOOKING_SCHEMA).alias("j"))
    r = p.select("payload_id", F.posexplode("j.data.searchQueries.search.results").alias("pos", "r"))
    return r.select("payload_id", "pos", F.col("r.basicPropertyData.pageName").alias("name"),
                    F.col("r.basicPropertyData.location.latitude").alias("lat"),
                    F.col("r.basicPropertyData.location.longitude").alias("lng"),
                    F.col("r.displayName.text").alias("DisplayName"))


def flatten_holidu(payloads: DataFrame) -> DataFrame:
    p = payloads.select("payload_id", F.from_json("payload", HOLIDU_SCHEMA).alias("j"))
    r = p.select("payload_id", F.posexplode("j.offers").alias("pos", "o"))
    return r.select("payload_id", "pos", F.col("o.id").alias("id"), F.col("o.location.lat").alias("lat"),
                    F.col("o.location.lng").alias("lng"), F.col("o.details.name").alias("nombre"),
                    F.col("o.details.bedroomsCount").alias("habitaciones"),
                    F.col("o.details.guestsCount").alias("capacidad"),
                    F.col("o.details.apartmentTypeTitle").alias("tipo"))


def flatten_vrbo(payloads: DataFrame) -> DataFrame:
    """Listings inner-joined to their map markers on (payload, id); a listing
    without a marker is dropped; the heading is parsed into type, guests and
    rooms."""
    p = payloads.select("payload_id", F.from_json("payload", VRBO_SCHEMA).alias("j"))
    markers = p.select("payload_id", F.posexplode("j.data.propertySearch.dynamicMap.map.markers").alias("mpos", "m"))
    # markers form an id -> position map: a repeated id keeps its last marker
    markers = (markers.groupBy("payload_id", F.col("m.id").alias("id"))
               .agg(F.max_by(F.col("m.markerPosition"), F.col("mpos")).alias("mp"))
               .select("payload_id", "id", F.col("mp.latitude").alias("lat"), F.col("mp.longitude").alias("lng")))
    listings = p.select("payload_id", F.posexplode("j.data.propertySearch.propertySearchListings").alias("pos", "l"))
    listings = listings.select(
        "payload_id", "pos", F.col("l.id").alias("id"), F.col("l.headingSection.heading").alias("nombre"),
        F.col("l.cardLink.resource.value").alias("url"),
        F.try_element_at("l.headingSection.messages", F.lit(1))["text"].alias("heading"))
    h = parse_vrbo_heading("heading")
    return listings.join(markers, ["payload_id", "id"]).select(
        "payload_id", "pos", "id", "lat", "lng", "url", "nombre", h["tipo"].alias("tipo"),
        h["capacidad"].alias("capacidad"), h["habitaciones"].alias("habitaciones"))


def _first_non_null(arr, getter):
    return F.try_element_at(F.filter(F.transform(arr, getter), lambda x: x.isNotNull()), F.lit(1))


def flatten_airbnb_detail(payloads: DataFrame) -> DataFrame:
    """One detail payload per listing: coordinates from the logging metadata;
    first non-null capacity, share title and listing title over sections;
    registration from the first description that matches; host from the
    primary host, else the first JSON ``title`` naming a host."""
    p = payloads.select("payload_id", "payload", F.from_json("payload", AIRBNB_SCHEMA).alias("j"))
    page = F.col("j.data.presentation.stayProductDetailPage")
    secs = page["sections"]["sections"]
    share_title = _first_non_null(secs, lambda s: s["section"]["shareSave"]["sharingConfig"]["title"])
    regs = F.transform(secs, lambda s: s["section"]["htmlDescription"]["htmlText"])
    reg = F.try_element_at(F.filter(F.transform(regs, lambda h: F.when(
        h.rlike(RX_AIRBNB_REGISTRATION), py_strip(F.regexp_extract(h, RX_AIRBNB_REGISTRATION, 1)))),
        lambda x: x.isNotNull()), F.lit(1))
    title_host = F.when(F.col("payload").rlike(RX_AIRBNB_TITLE_HOST),
                        py_strip(F.regexp_extract("payload", RX_AIRBNB_TITLE_HOST, 1)))
    out = p.select(
        "payload_id",
        page["sections"]["metadata"]["loggingContext"]["eventDataLogging"]["listingLat"].alias("lat"),
        page["sections"]["metadata"]["loggingContext"]["eventDataLogging"]["listingLng"].alias("lng"),
        _first_non_null(secs, lambda s: s["section"]["shareSave"]["embedData"]["personCapacity"]).alias("capacidad"),
        share_title.alias("share_title"),
        _first_non_null(secs, lambda s: s["section"]["listingTitle"]).alias("titulo"),
        reg.alias("licencia"),
        F.coalesce(page["listing"]["primaryHost"]["firstName"], title_host).alias("anfitrion"))
    t = parse_airbnb_title("share_title")
    return out.select("payload_id", "lat", "lng", "capacidad", t["habitaciones"].alias("habitaciones"),
                      t["banos"].alias("banos"), "titulo", "licencia", "anfitrion")
