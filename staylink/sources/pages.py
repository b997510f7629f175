"""Search-result cards and listing pages (HTML / text in, rows out)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.parsing import booking_capacity, booking_rooms, extract_host, extract_licence, extract_type

# Markers of a search-result card.
CARD_SPLIT = 'data-testid="card-container"'
RX_CARD_TITLE = r'data-testid="listing-card-title"[^>]*>([^<]+)<'
RX_CARD_HREF = r'<a [^>]*href="([^"]+)"'
RX_CARD_PRICE = r"<span[^>]*>([^<]*€[^<]*)</span>"
RX_CARD_DATES = r"<span[^>]*>([^<]*–[^<]*)</span>"


def extract_listing_cards(pages: DataFrame, page_id: str = "page_id", html: str = "html") -> DataFrame:
    """One row per card (title, url, price text, dates text); a card missing
    any of the four is dropped, as the collector skips it."""
    cards = pages.select(page_id, F.posexplode(F.split(F.col(html), CARD_SPLIT)).alias("card_pos", "card"))
    cards = cards.where(F.col("card_pos") > 0)
    out = cards.select(page_id, "card_pos",
                       *[F.regexp_extract("card", rx, 1).alias(name) for name, rx in
                         (("Nombre", RX_CARD_TITLE), ("url", RX_CARD_HREF), ("Precio", RX_CARD_PRICE),
                          ("Fechas", RX_CARD_DATES))])
    return out.where((F.col("Nombre") != "") & (F.col("url") != "") & (F.col("Precio") != "") & (F.col("Fechas") != ""))


def extract_page_attributes(pages: DataFrame, key: str = "listing_id", platform: str = "plataforma",
                            html: str = "page_html", text: str = "page_text", order: str = "capture") -> DataFrame:
    """Listing pages -> one row per listing: rooms, adults, children, licence,
    type and host, each taken from the earliest capture that yields it."""
    cap = booking_capacity(html)
    # booking: the licence and the hotelier's name stand in the page source, the
    # chain and company lines in the visible text
    whole = F.concat_ws("\n", html, text)
    rows = pages.select(
        key, order,
        F.when(F.col(platform) == "booking", booking_rooms(html, text)).alias("habitaciones"),
        F.when(F.col(platform) == "booking", cap["adultos"]).alias("capacidad"),
        F.when(F.col(platform) == "booking", cap["ninos"]).alias("ninos"),
        extract_licence(platform, F.when(F.col(platform) == "airbnb", F.col(html))
                        .when(F.col(platform) == "booking", whole).otherwise(F.col(text)))
        .alias("licencia"),
        F.when(F.col(platform) == "booking", extract_type(text)).alias("tipo"),
        extract_host(platform, F.when(F.col(platform) == "airbnb", F.col(html))
                     .when(F.col(platform) == "booking", whole).otherwise(F.col(text))).alias("anfitrion"))
    fields = ["habitaciones", "capacidad", "ninos", "licencia", "tipo", "anfitrion"]
    return rows.groupBy(key).agg(*[F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(order))).alias(c)
                                   for c in fields])
