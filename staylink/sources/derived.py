"""Collector-shaped inputs derived by Spark from the listing table.

The driver's tables hold no platform payloads or listing pages, so these
render them from listings: payload JSON with ``to_json`` packed per tile
(``pack_size`` consecutive listings of a platform, so a payload is bounded
like a result page), listing pages and search pages as text.  Their work
grows with the listing table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _nl() -> Column:
    return F.lit("\n")


def _s(c) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


def _pack(items: DataFrame, pack_size: int, wrap) -> DataFrame:
    packed = items.groupBy(F.floor(F.col("row_id") / pack_size).alias("payload_id")) \
                  .agg(F.array_sort(F.collect_list("item")).alias("items"))
    return packed.select("payload_id", F.to_json(wrap(F.col("items"))).alias("payload"))


def booking_payloads(listings: DataFrame, pack_size: int = 64) -> DataFrame:
    b = listings.where((F.col("plataforma") == "booking") & F.col("lat").isNotNull())
    item = F.struct(F.col("row_id").alias("_rid"),
                    F.struct(F.concat(F.lit("bk"), F.col("property_id").cast("string")).alias("pageName"),
                             F.struct(F.col("lat").alias("latitude"), F.col("lng").alias("longitude"))
                             .alias("location")).alias("basicPropertyData"),
                    F.when(F.col("anfitrion").isNotNull(), F.struct(F.col("nombre").alias("text"))).alias("displayName"))
    wrap = lambda a: F.struct(F.struct(F.struct(F.struct(a.alias("results")).alias("search"))
                                       .alias("searchQueries")).alias("data"))
    return _pack(b.select("row_id", item.alias("item")), pack_size, wrap)


def holidu_payloads(listings: DataFrame, pack_size: int = 64) -> DataFrame:
    h = listings.where((F.col("plataforma") == "holidu") & F.col("lat").isNotNull())
    item = F.struct(F.col("row_id").alias("_rid"), F.concat(F.lit("h"), F.col("property_id").cast("string")).alias("id"),
                    F.struct(F.col("lat").alias("lat"), F.col("lng").alias("lng")).alias("location"),
                    F.struct(F.col("nombre").alias("name"), F.col("habitaciones").alias("bedroomsCount"),
                             F.col("capacidad").alias("guestsCount"), F.col("tipo").alias("apartmentTypeTitle"))
                    .alias("details"))
    wrap = lambda a: F.struct(F.struct(F.struct(F.size(a).cast("long").alias("totalCount")).alias("cursor"))
                              .alias("metaData"), a.alias("offers"))
    return _pack(h.select("row_id", item.alias("item")), pack_size, wrap)


def vrbo_heading(listings_cols=None) -> Column:
    return F.concat_ws(" · ", F.col("tipo"), F.concat(F.col("capacidad").cast("string"), F.lit(" huéspedes")),
                       F.concat(F.col("habitaciones").cast("string"), F.lit(" habitaciones")), F.lit("1 baño"))


def vrbo_payloads(listings: DataFrame, pack_size: int = 64) -> DataFrame:
    """Markers only for listings with coordinates; every listing in the list."""
    v = listings.where(F.col("plataforma") == "vrbo")
    vid = F.concat(F.lit("v"), F.col("row_id").cast("string"))
    marker = F.when(F.col("lat").isNotNull(), F.struct(F.col("row_id").alias("_rid"), vid.alias("id"), F.struct(
        F.col("lat").alias("latitude"), F.col("lng").alias("longitude")).alias("markerPosition")))
    listing = F.struct(F.col("row_id").alias("_rid"), vid.alias("id"),
                       F.struct(F.col("nombre").alias("heading"),
                                F.array(F.struct(vrbo_heading().alias("text"))).alias("messages")).alias("headingSection"),
                       F.struct(F.struct(F.concat(F.lit("https://www.vrbo.com/es-es/p"), F.col("property_id").cast("string"),
                                                  F.lit("?dateless=true")).alias("value")).alias("resource"))
                       .alias("cardLink"))
    packed = v.groupBy(F.floor(F.col("row_id") / pack_size).alias("payload_id")).agg(
        F.array_sort(F.collect_list(marker)).alias("markers"), F.array_sort(F.collect_list(listing)).alias("listings"))
    body = F.struct(F.struct(F.struct(F.struct(F.col("markers").alias("markers")).alias("map")).alias("dynamicMap"),
                             F.col("listings").alias("propertySearchListings")).alias("propertySearch")).alias("data")
    return packed.select("payload_id", F.to_json(F.struct(body)).alias("payload"))


def airbnb_share_title() -> Column:
    return F.concat_ws(" · ", F.col("tipo"), F.concat(F.col("habitaciones").cast("string"), F.lit(" bedrooms")),
                       F.lit("1 bath"))


def airbnb_registration_html() -> Column:
    return F.concat(F.lit("<p>Contacto</p><b>Registration Details</b><br/>"), _s("licencia"))


def airbnb_payloads(listings: DataFrame) -> DataFrame:
    """One detail payload per Airbnb listing; the primary host is given except
    for upper-case host names, which are only found through a section title."""
    a = listings.where(F.col("plataforma") == "airbnb")
    direct = F.col("anfitrion").isNotNull() & ~F.col("anfitrion").startswith("HOST")
    null_s = F.lit(None).cast("string")
    share = F.struct(F.struct(F.col("capacidad").alias("personCapacity")).alias("embedData"),
                     F.struct(airbnb_share_title().alias("title")).alias("sharingConfig"))

    def section(listing_title=null_s, share_save=None, html=null_s, title=null_s):
        # every element carries the same struct type; null members are left
        # out of the JSON by to_json
        ss = share_save if share_save is not None else F.lit(None).cast(
            "struct<embedData:struct<personCapacity:int>,sharingConfig:struct<title:string>>")
        return F.struct(F.struct(listing_title.alias("listingTitle"), ss.alias("shareSave"),
                                 F.when(html.isNotNull(), F.struct(html.alias("htmlText"))).alias("htmlDescription"),
                                 title.alias("title")).alias("section"))

    sections = F.array(
        section(share_save=share),
        section(listing_title=F.col("nombre")),
        section(title=F.when(F.col("anfitrion").startswith("HOST"), F.concat(F.lit("Host: "), F.col("anfitrion")))),
        section(html=airbnb_registration_html()))
    page = F.struct(
        F.struct(F.struct(F.struct(F.struct(F.col("lat").alias("listingLat"), F.col("lng").alias("listingLng"))
                                   .alias("eventDataLogging")).alias("loggingContext")).alias("metadata"),
                 sections.alias("sections")).alias("sections"),
        F.struct(F.struct(F.when(direct, F.col("anfitrion")).alias("firstName")).alias("primaryHost")).alias("listing"))
    body = F.struct(F.struct(F.struct(page.alias("stayProductDetailPage")).alias("presentation")).alias("data"))
    return a.select(F.col("row_id").alias("payload_id"), F.to_json(body).alias("payload"))


def booking_aria(listings_cap="capacidad") -> Column:
    kids = F.when(F.col("habitaciones") > 2, F.concat(F.lit(", "), (F.col("habitaciones") - 2).cast("string"),
                                                      F.lit(" niños"))).otherwise(F.lit(""))
    return F.when(F.col(listings_cap).isNotNull(),
                  F.concat(F.lit('<div aria-label="'), F.col(listings_cap).cast("string"), F.lit(" adultos"), kids,
                           F.lit('"></div>'))).otherwise(F.lit(""))


def listing_pages(listings: DataFrame) -> DataFrame:
    """(listing_id, capture, plataforma, page_html, page_text) per listing."""
    p = F.col("plataforma")
    text = (F.when(p == "booking", F.concat(F.lit("Número de licencia: "), _s("licencia"), _nl(),
                                            F.lit("Ofertas en Mallorca ("), _s("tipo"), F.lit(")"), _nl(),
                                            F.lit("Dormitorio "), _s("habitaciones"), _nl(), F.lit("Cama doble")))
            .when(p == "holidu", F.concat(F.when(F.col("anfitrion") == "Vrbo", F.lit("Gestionado por Holidu"))
                                          .otherwise(F.concat(F.lit("Nuestro socio verificado "), _s("anfitrion"),
                                                              F.lit(" gestionará tu reserva"))),
                                          _nl(), F.lit("Número de licencia: "), _s("licencia")))
            .when(p == "vrbo", F.concat(F.lit("Propietario/a: "), _s("anfitrion"), _nl(),
                                        F.lit("Número de registro de la propiedad "), _s("licencia")))
            .otherwise(F.lit("")))
    html = (F.when(p == "booking", F.concat(booking_aria(), F.when(F.col("anfitrion").isNotNull(), F.concat(
                F.lit('{"__typename":"HotelierInfo","name":"'), _s("anfitrion"), F.lit('"}'))).otherwise(F.lit(""))))
            .when(p == "airbnb", F.concat(airbnb_registration_html(), _nl(), F.lit('{"title":"Host: '), _s("anfitrion"),
                                          F.lit('"}')))
            .otherwise(F.concat(F.lit("<html>"), text, F.lit("</html>"))))
    return listings.select(F.col("row_id").alias("listing_id"), F.lit(0).alias("capture"), "plataforma",
                           html.alias("page_html"), text.alias("page_text"))


def search_pages(listings: DataFrame, page_size: int = 18) -> DataFrame:
    """Airbnb search pages: ``page_size`` cards each; cards of listings without
    capacity carry no price and are dropped by the extractor."""
    a = listings.where(F.col("plataforma") == "airbnb")
    price = F.when(F.col("capacidad").isNotNull(),
                   F.concat(F.lit("<span>"), (F.col("capacidad") * 35).cast("string"), F.lit(" € noche</span>")))
    card = F.concat(F.lit('<div data-testid="card-container"><div data-testid="listing-card-title">'),
                    F.col("nombre"), F.lit('</div><a class="l" href="/rooms/'), F.col("property_id").cast("string"),
                    F.lit('?adults=2">ver</a>'), F.coalesce(price, F.lit("")),
                    F.lit("<span>1–7 jul</span></div>"))
    packed = a.groupBy(F.floor(F.col("row_id") / (page_size * 4)).alias("page_id")).agg(
        F.array_sort(F.collect_list(F.struct("row_id", card.alias("card")))).alias("cards"))
    return packed.select("page_id", F.concat(F.lit("<html><body><h1>Mallorca</h1>"),
                                             F.array_join(F.col("cards.card"), ""), F.lit("</body></html>")).alias("html"))
